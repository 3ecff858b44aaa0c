"""BK-trees over 64-bit fingerprints, many trees at once.

A node's children are keyed by their Hamming distance to it.  A search for fingerprints
within a radius follows only the children whose key differs from the distance to the node
by at most the radius.  Trees and searches advance level by level in numpy arrays, so a
forest of thousands of small trees costs no more calls than one tree.
"""

import numpy as np

_PAIRS = 1 << 20


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class Forest:
    """A tree for each group of nodes; ``groups`` (sorted) has the group of every node.

    Nodes enter their tree in order: the first of a group is its root.
    """

    def __init__(self, groups: np.ndarray, prints: np.ndarray):
        n = len(prints)
        self.prints = prints
        heads = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if n else np.zeros(0, np.int64)
        self.groups, self.roots = groups[heads], heads
        parents, keys = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        owner = np.repeat(heads, np.diff(np.r_[heads, n]))
        pending = np.flatnonzero(owner != np.arange(n))
        while len(pending):
            distance = distances(prints[pending], prints[owner[pending]])
            order = np.lexsort((pending, distance, owner[pending]))
            pending, distance = pending[order], distance[order]
            parent = owner[pending]
            first = np.r_[True, (parent[1:] != parent[:-1]) | (distance[1:] != distance[:-1])]
            child = pending[first]
            parents[child], keys[child] = parent[first], distance[first]
            owner[pending] = np.repeat(child, np.diff(np.r_[np.flatnonzero(first), len(pending)]))
            pending = pending[~first]
        self.children = np.lexsort((keys, parents))
        self.children = self.children[parents[self.children] >= 0]
        self.keys = keys[self.children]
        self.starts = np.searchsorted(parents[self.children], np.arange(n), "left")
        self.ends = np.searchsorted(parents[self.children], np.arange(n), "right")

    def search(self, groups: np.ndarray, prints: np.ndarray, radius: int):
        """Yield (queries, nodes) arrays: all nodes of each query's own tree within
        ``radius``, a bounded number of queries at a time."""
        at = np.minimum(np.searchsorted(self.groups, groups), max(len(self.groups) - 1, 0))
        if not len(self.groups):
            return
        queries = np.flatnonzero(self.groups[at] == groups)
        sizes = np.diff(np.r_[self.roots, len(self.prints)])[at[queries]]
        blocks = np.cumsum(sizes) // _PAIRS
        for block in np.split(queries, np.flatnonzero(np.diff(blocks)) + 1):
            query, node, found = block, self.roots[at[block]], []
            while len(query):
                distance = distances(prints[query], self.prints[node])
                hit = distance <= radius
                found.append((query[hit], node[hit]))
                number = self.ends[node] - self.starts[node]
                first = np.cumsum(number) - number
                child = np.arange(number.sum()) - np.repeat(first - self.starts[node], number)
                near = np.abs(self.keys[child] - np.repeat(distance, number)) <= radius
                query, node = np.repeat(query, number)[near], self.children[child[near]]
            if found:
                yield tuple(np.concatenate(x) for x in zip(*found, strict=True))


def merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the least member of a set) after joining the sets of a[i] and b[i]."""
    while True:
        differ = labels[a] != labels[b]
        if not differ.any():
            return labels
        a, b = a[differ], b[differ]
        np.minimum.at(labels, np.maximum(labels[a], labels[b]), np.minimum(labels[a], labels[b]))
        while (labels[labels] != labels).any():
            labels = labels[labels]
