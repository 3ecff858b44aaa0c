"""Shortest paths, counted in hops."""

from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import new_folder, settle
from .graph import Graph
from .reports import first_per_group
from .skew import broadcast_if, fits_in_memory


class _RouteIndex:
    """Routes laid out by one end, for loops that repeatedly look up that end."""

    def __init__(self, graph: Graph, end: str):
        self.end, self.other = end, "dst" if end == "src" else "src"
        self.hot = graph.by_route.hot_sources if end == "src" else graph.by_route.hot_targets
        routes = graph.by_route.edges.select("src", "dst")
        self.laid = self.hot.lay_out(self.hot.divide(routes, F.col(end), F.col(self.other)), end)

    def step(self, frontier: DataFrame) -> DataFrame:
        """Vertices one route away from the frontier's, each once."""
        return self.met(frontier).distinct()

    def met(self, frontier: DataFrame, *carry: str) -> DataFrame:
        """The other end of every route at the frontier, with the frontier's ``carry``."""
        near = frontier.withColumnRenamed("id", "__at")
        at_end = F.col(self.end) == F.col("__at")
        # A broadcast row meets every part; only a shuffled one is copied per part.
        if fits_in_memory(near):
            met = self.laid.join(F.broadcast(near), at_end)
        else:
            met = self.laid.join(self.hot.copy(near, F.col("__at")), self.hot.match(at_end))
        return met.select(F.col(self.other).alias("id"), *carry)

    def close(self) -> None:
        self.laid.unpersist()


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


_WORD = 64
#: Landmarks whose bits travel together: 64 words a vertex.
_SWEEP = 64 * _WORD
#: Rings after which the state is written, and laid out again.
_WRITTEN_EVERY = 4


def hop_counts(graph: Graph, landmarks: Sequence[str]) -> DataFrame:
    """Fewest hops from each vertex to each landmark it can reach: ``id, landmark, hops``.

    Works backwards from the landmarks, one ring at a time, until a ring is empty.  A
    vertex has one bit per landmark, so all landmarks travel together: what a ring sends
    along the routes is joined by OR inside every task before the shuffle.  The bits that
    every vertex has seen are laid out by vertex and meet what arrives where they are; only
    every fourth ring they are written and laid out anew, which keeps plans short.  A ring is
    written once, under its number of hops, and is never moved again.  Names that are no
    vertex reach nothing; more than 4096 landmarks go in several sweeps.
    """
    names = sorted(set(landmarks))
    sweeps = [names[i : i + _SWEEP] for i in range(0, len(names), _SWEEP)] or [[]]
    index = _RouteIndex(graph, "dst")
    try:
        return _union([_sweep(graph, index, part) for part in sweeps])
    finally:
        index.close()


def _sweep(graph: Graph, index: _RouteIndex, names: list[str]) -> DataFrame:
    spark = graph.vertices.sparkSession
    words = [f"w{i}" for i in range(max(1, -(-len(names) // _WORD)))]
    path = new_folder(spark, "hops")
    listed = [(name, i // _WORD, 1 << (i % _WORD)) for i, name in enumerate(names)]
    listed = [(name, word, bit - (1 << _WORD) if bit >> (_WORD - 1) else bit) for name, word, bit in listed]
    marks = F.broadcast(spark.createDataFrame(listed, "landmark string, word int, bit long"))
    of_word = [F.bit_or(F.when(F.col("word") == i, F.col("bit")).otherwise(0)).alias(w) for i, w in enumerate(words)]
    first = graph.vertices.join(marks, F.col("id") == F.col("landmark")).groupBy("id").agg(*of_word)

    def written(ring: DataFrame, hops: int) -> DataFrame:
        ring.write.parquet(f"{path}/hops={hops}")
        return spark.read.schema(ring.schema).parquet(f"{path}/hops={hops}")

    ring, hops = written(first, 0), 0
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    nothing = [F.lit(0).cast("long").alias(f"seen_{w}") for w in words]
    base = graph.vertices.select("id", *nothing).repartition(slots, "id")
    seen = _marked(base, ring, words).persist(StorageLevel.MEMORY_AND_DISK)
    while not ring.isEmpty():
        hops += 1
        sent = index.met(ring, *words).groupBy("id").agg(*[F.bit_or(w).alias(w) for w in words])
        fresh = [F.col(w).bitwiseAND(F.bitwise_not(F.coalesce(f"seen_{w}", F.lit(0)))).alias(w) for w in words]
        some = reduce(Column.__or__, [F.col(w) != 0 for w in words])
        ring = written(sent.join(seen, "id").select("id", *fresh).filter(some), hops)
        # Rings are written, so what is kept of the state can be made again from them; now
        # and then it is written itself, so that its plan stays short.
        after = _marked(seen, ring, words)
        if hops % _WRITTEN_EVERY == 0:
            after = settle(after).repartition(slots, "id")
        after = after.persist(StorageLevel.MEMORY_AND_DISK)
        after.count()
        seen.unpersist()
        seen = after
    seen.unpersist()

    schema = StructType([*ring.schema.fields, StructField("hops", IntegerType())])
    rings = spark.read.schema(schema).option("basePath", path).parquet(path)
    parts = F.posexplode(F.array(*[F.col(w) for w in words])).alias("at", "bits")
    rows = rings.select("id", "hops", parts).filter("bits <> 0")
    ones = F.expr(f"filter(sequence(0, {_WORD - 1}), i -> shiftrightunsigned(bits, i) % 2 <> 0)")
    rows = rows.select("id", "hops", "at", F.explode(ones).alias("bit_at"))
    listed = F.array(*map(F.lit, names)).cast("array<string>")
    return rows.select("id", F.get(listed, F.col("at") * _WORD + F.col("bit_at")).alias("landmark"), "hops")


def _marked(seen: DataFrame, ring: DataFrame, words: list[str]) -> DataFrame:
    """The state after a ring; it stays laid out as it is."""
    side = ring.withColumnRenamed("id", "__ring")
    joined = seen.join(broadcast_if(side, fits_in_memory(side)), F.col("id") == F.col("__ring"), "left")
    both = [F.col(f"seen_{w}").bitwiseOR(F.coalesce(w, F.lit(0))).alias(f"seen_{w}") for w in words]
    return joined.select("id", *both)


def shortest_paths(graph: Graph, landmarks: Sequence[str]) -> DataFrame:
    """Vertices with a map ``distances`` from landmark to hops, empty where none is reached."""
    pairs = F.map_from_entries(F.collect_list(F.struct("landmark", "hops")))
    reached = hop_counts(graph, landmarks).groupBy("id").agg(pairs.alias("distances"))
    nothing = F.expr("cast(map() as map<string, int>)")
    return graph.vertices.join(reached, "id", "left").withColumn(
        "distances", F.coalesce("distances", nothing)
    )


class _Side:
    """One side of a search: its rings so far, and the vertices that it has seen."""

    def __init__(self, graph: Graph, end: str, start: DataFrame):
        self.graph, self.end, self.index = graph, end, None
        self.rings = [settle(start)]
        self.sizes = [self.rings[0].count()]

    def grow(self) -> None:
        if self.index is None:
            self.index = _RouteIndex(self.graph, self.end)
        # A vertex one hop further on may be in any earlier ring: those are few rows so far
        # as the search is short, and each is written.
        seen = _union(self.rings)
        self.rings.append(settle(self.index.step(self.rings[-1]).join(seen, "id", "left_anti")))
        self.sizes.append(self.rings[-1].count())

    def close(self) -> None:
        if self.index is not None:
            self.index.close()


def _meeting(forward: _Side, backward: _Side, max_length: int) -> DataFrame | None:
    """Grow the side whose last ring is smaller until the sides meet; where they do.

    They first meet when the rings together are as long as the shortest path, in the
    vertices that stand at this place of some shortest path.
    """
    try:
        while True:
            if not (forward.sizes[-1] and backward.sizes[-1]):
                return None
            met = settle(forward.rings[-1].join(backward.rings[-1], "id", "left_semi"))
            if not met.isEmpty():
                return met
            if len(forward.rings) + len(backward.rings) - 2 >= max_length:
                return None
            (forward if forward.sizes[-1] <= backward.sizes[-1] else backward).grow()
    finally:
        forward.close()
        backward.close()


def search_sizes(
    graph: Graph, start: str | Column, end: str | Column, max_length: int = 10
) -> tuple[list[int], list[int]]:
    """How many vertices each ring of ``breadth_first`` has, from the start and from the end."""
    sides = [_Side(graph, end_of, graph.vertices.filter(c).select("id")) for end_of, c in (("src", start), ("dst", end))]
    _meeting(*sides, max_length)
    return sides[0].sizes, sides[1].sizes


def _routes_between(graph: Graph, near: DataFrame, far: DataFrame) -> DataFrame:
    """Routes from a vertex of ``near`` to one of ``far``."""
    routes = graph.by_route.edges.select("src", "dst")
    near, far = near.select(F.col("id").alias("src")), far.select(F.col("id").alias("dst"))
    far, near = (broadcast_if(side, fits_in_memory(side)) for side in (far, near))
    return settle(routes.join(far, "dst", "left_semi").join(near, "src", "left_semi"))


def breadth_first(
    graph: Graph,
    start: str | Column,
    end: str | Column,
    max_length: int = 10,
    first: int | None = None,
    edge_key: str = "id",
) -> DataFrame:
    """All shortest paths from a vertex meeting ``start`` to one meeting ``end``.

    Only paths of the overall least length are returned, as structs
    ``from, e0, v1, e1, ..., to``; so the columns depend on the length found.  A vertex
    meeting both conditions is a path of length zero (``from, to``).  No path within
    ``max_length`` gives an empty frame with ``from`` and ``to``.

    ``first`` returns the first so many paths, ordered by ``edge_key`` of e0, e1, ...
    It does not build the others: such a path can use only the ``first`` smallest
    edges of each route, since swapping in a smaller one gives an earlier path, and
    only the ``first`` smallest beginnings of the paths to each vertex on the way.
    Edges with equal keys may be taken in any order.

    The search runs on routes, from both ends: the side whose last ring is smaller grows.
    Edges are fetched only for routes on a shortest path.
    """
    sources = graph.vertices.filter(start).select("id")
    targets = graph.vertices.filter(end).select("id")

    both = settle(sources.join(targets, "id", "left_semi"))
    if not both.isEmpty():
        return _attach(graph, both.select(F.col("id").alias("n0")), [], 0)

    forward, backward = _Side(graph, "src", sources), _Side(graph, "dst", targets)
    met = _meeting(forward, backward, max_length)
    if met is None:
        return _attach(graph, forward.rings[0].limit(0).select(F.col("id").alias("n0")), [], 0)

    # From the vertices where the sides met, back to the start and on to the end: which
    # routes lie on some shortest path, by position.
    hops, needed = [], met
    for ring in reversed(forward.rings[:-1]):
        on_path = _routes_between(graph, ring, needed)
        hops.insert(0, on_path)
        needed = on_path.select(F.col("src").alias("id")).distinct()
    needed = met
    for ring in reversed(backward.rings[:-1]):
        on_path = _routes_between(graph, needed, ring)
        hops.append(on_path)
        needed = on_path.select(F.col("dst").alias("id")).distinct()
    length = len(hops)
    return _attach(graph, None, hops, length, first, edge_key)


def _attach(
    graph: Graph,
    single: DataFrame | None,
    hops: list[DataFrame],
    length: int,
    first: int | None = None,
    edge_key: str = "id",
) -> DataFrame:
    """Turn routes by position into paths of edges with the vertex structs attached."""
    paths = single
    for position, on_path in enumerate(hops):
        side = broadcast_if(on_path, fits_in_memory(on_path))
        edges = graph.edges.join(side, ["src", "dst"], "left_semi")
        if first is not None:
            edges = first_per_group(edges, ["src", "dst"], [edge_key], first)
        edges = edges.select(
            F.struct(*[F.col(f"`{c}`") for c in graph.edges.columns]).alias(f"e{position}"),
            F.col("src").alias(f"n{position}"),
            F.col("dst").alias(f"n{position + 1}"),
        )
        paths = edges if paths is None else paths.join(edges, f"n{position}")
        if first is not None and position:
            # Paths to one vertex go on alike, so only the first few of them can matter.
            keys = [F.col(f"e{i}.`{edge_key}`") for i in range(position + 1)]
            paths = first_per_group(paths, [f"n{position + 1}"], keys, first)
    if first is not None and length:
        order = [F.col(f"e{i}.`{edge_key}`") for i in range(length)]
        paths = paths.orderBy(*order).limit(first)

    names = ["from"] + [f"v{i}" for i in range(1, length)] + ["to"]
    positions = list(range(length)) + [length] if length else [0, 0]
    small = graph.small_vertices
    for name, position in zip(names, positions):
        vertex = graph.vertices.select(
            F.struct(*[F.col(f"`{c}`") for c in graph.vertices.columns]).alias(name)
        )
        paths = paths.join(
            broadcast_if(vertex, small), F.col(f"n{position}") == F.col(f"`{name}`.id")
        )
    columns = [names[0]]
    for i in range(length):
        columns += [f"e{i}", names[i + 1]]
    return paths.select(*(columns if length else names))


def path_texts(paths: DataFrame, edge_key: str = "id") -> DataFrame:
    """Paths of any length under fixed columns: ``path, edges`` (ids joined) and ``hops``."""
    hops = sum(1 for c in paths.columns if c not in ("from", "to") and c.startswith("e"))
    vertices = ["from"] + [f"v{i}" for i in range(1, hops)] + ["to"]
    if hops == 0:
        vertices = ["from"]
    return paths.select(
        F.concat_ws(",", *[F.col(f"`{v}`.id") for v in vertices]).alias("path"),
        F.concat_ws(",", *[F.col(f"e{i}.`{edge_key}`") for i in range(hops)]).alias("edges"),
        F.lit(hops).alias("hops"),
    )
