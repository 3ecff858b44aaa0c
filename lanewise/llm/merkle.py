"""A Merkle manifest of a dataset, its trees stored as blocks in van Emde Boas order.

Every source has a tree over its documents and one more tree stands over the sources'
roots.  A tree is cut into aligned subtrees of fixed height (blocks); a block's nodes are
stored in van Emde Boas order: split at half height, the upper part first, then the lower
subtrees one after another, each stored the same way.  The roots of the blocks are the
leaves of the next blocks above, until one node is left.  Building a level is one shuffle
that brings the nodes of each block together, a block being bounded; siblings are read
from the blocks, from the top down, by address arithmetic alone.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ranking import numbered
from ..operators.skew import broadcast_if, fits_in_memory
from ..session import store
from .common import crc_remainder

ARITY = 3
#: Levels above the leaves that a block spans: it has 3 ** 6 = 729 leaves at most.
HEIGHT = 6
_DIGEST = 32


def combined(digests: list[bytes]) -> bytes:
    """The parent of nodes: sha256 over their digests as hexadecimal text."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def nodes_of(levels: int) -> int:
    """Nodes of a complete tree of so many levels."""
    return (ARITY**levels - 1) // (ARITY - 1)


_PLACES: dict[int, list[np.ndarray]] = {1: [np.zeros(1, np.int64)]}


def addresses(levels: int) -> list[np.ndarray]:
    """Place in van Emde Boas order of every node of a complete tree, by depth and index."""
    if levels in _PLACES:
        return _PLACES[levels]
    top = levels // 2
    upper, lower = addresses(top), addresses(levels - top)
    places = list(upper)
    for depth in range(top, levels):
        below = ARITY ** (depth - top)
        index = np.arange(ARITY**depth)
        start = nodes_of(top) + index // below * nodes_of(levels - top)
        places.append(start + lower[depth - top][index % below])
    _PLACES[levels] = places
    return places


def build(layout: list[bytes], leaves: list[bytes], levels: int, base: int = 0) -> bytes:
    """Fill ``layout`` from ``base`` with the tree over ``leaves``; return its root.

    The lower subtrees are built first, each in its own stretch, then the upper part over
    their roots.  The last run of a depth may have fewer than three nodes, even one.
    """
    if levels == 1:
        layout[base] = leaves[0]
        return leaves[0]
    top = levels // 2
    bottom = levels - top
    width, start, step = ARITY ** (bottom - 1), base + nodes_of(top), nodes_of(bottom)
    roots = [
        build(layout, leaves[at : at + width], bottom, start + number * step)
        for number, at in enumerate(range(0, len(leaves), width))
    ]
    above = [combined(roots[i : i + ARITY]) for i in range(0, len(roots), ARITY)]
    return build(layout, above, top, base)


def siblings(layout: bytes, count: int, levels: int, leaf: int) -> list[tuple[int, list[bytes]]]:
    """From a leaf up to below the root: place in the run, and the run's other digests."""
    places, path = addresses(levels), []
    for depth in range(levels - 1, 0, -1):
        run = leaf - leaf % ARITY
        found = []
        for other in range(run, min(run + ARITY, count)):
            if other != leaf:
                at = int(places[depth][other]) * _DIGEST
                found.append(layout[at : at + _DIGEST])
        path.append((leaf - run, found))
        leaf, count = leaf // ARITY, -(-count // ARITY)
    return path


def folded(digest: bytes, path: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that a leaf's digest leads to with the siblings of ``path``."""
    for place, others in path:
        digest = combined([*others[:place], digest, *others[place:]])
    return digest


def _levels(count: int) -> int:
    """Levels of the tree over ``count`` nodes."""
    levels = 1
    while ARITY ** (levels - 1) < count:
        levels += 1
    return levels


def _built(digests: Column | str, total: Column | str, height: int) -> Column:
    """A block from its leaves' digests and the number of nodes of its stage of the tree."""
    kinds = {"layout": pa.binary(), "levels": pa.int32(), "root": pa.string()}

    @F.arrow_udf("struct<layout: binary, levels: int, root: string>")
    def made(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for lists, totals in columns:
            rows = []
            for leaves, number in zip(lists.to_pylist(), totals.to_pylist(), strict=True):
                levels = min(_levels(number), height + 1)
                layout = [bytes(_DIGEST)] * nodes_of(levels)
                root = build(layout, [bytes.fromhex(d) for d in leaves], levels)
                rows.append({"layout": b"".join(layout), "levels": levels, "root": root.hex()})
            yield pa.array(rows, pa.struct(list(kinds.items())))

    return made(digests, total)


_STEP = pa.struct([("place", pa.int32()), ("others", pa.list_(pa.string()))])


def _steps(path: list[dict] | None) -> list[tuple[int, list[bytes]]]:
    return [(step["place"], [bytes.fromhex(d) for d in step["others"]]) for step in path or []]


def _paths(layout: str, levels: str, count: Column, above: str) -> Column:
    """For every leaf of a block its whole path: inside the block, then the block's own."""

    @F.arrow_udf("array<array<struct<place: int, others: array<string>>>>")
    def read(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for layouts, *others in columns:
            rows = []
            for block, depth, number, upper in zip(layouts, *(o.to_pylist() for o in others), strict=True):
                block = block.as_py()
                own = (siblings(block, number, depth, leaf) for leaf in range(number))
                paths = [[{"place": p, "others": [d.hex() for d in o]} for p, o in path] for path in own]
                rows.append([path + (upper or []) for path in paths])
            yield pa.array(rows, pa.list_(pa.list_(_STEP)))

    return read(layout, levels, count, above)


def _proofs(layout: str, levels: str, above: str, digests: Column) -> Column:
    """For every leaf of a block the digest of its siblings and the root it folds to."""
    kind = pa.struct([("proof_sha256", pa.string()), ("folded_root", pa.string())])

    @F.arrow_udf("array<struct<proof_sha256: string, folded_root: string>>")
    def read(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for layouts, *others in columns:
            rows = []
            for block, depth, upper, leaves in zip(layouts, *(o.to_pylist() for o in others), strict=True):
                block, upper, proofs = block.as_py(), _steps(upper), []
                for number, leaf in enumerate(leaves):
                    path = siblings(block, len(leaves), depth, number) + upper
                    text = "".join(d.hex() for _, others in path for d in others)
                    root = folded(bytes.fromhex(leaf), path).hex()
                    proof = hashlib.sha256(text.encode()).hexdigest()
                    proofs.append({"proof_sha256": proof, "folded_root": root})
                rows.append(proofs)
            yield pa.array(rows, pa.list_(kind))

    return read(layout, levels, above, digests)


def _counted(value: Column) -> Column:
    text = value.cast("string")
    told = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.when(value.isNull(), F.lit("-")).otherwise(told)


def leaf_digest(values: list[Column]) -> Column:
    """sha256 of the values: each ``-`` if null, else its UTF-8 byte count, ``:``, itself."""
    return F.sha2(F.concat(*map(_counted, values)), 256)


class Forest:
    """The trees over ``nodes`` (tree, rank from 0, digest; more columns stay with leaves).

    ``blocks[i]`` has the blocks of stage i: tree, block, its leaves in order, layout,
    levels and root.  ``roots`` has tree and root.
    """

    def __init__(self, nodes: DataFrame, height: int = HEIGHT):
        self.blocks: list[DataFrame] = []
        width, leaves = ARITY**height, nodes
        while True:
            totals = leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("total"))
            totals = store(totals, "merkle-totals")
            carried = [c for c in leaves.columns if c not in ("tree", "rank")]
            # A group is bounded: the ranks of a block, 729 by default.
            grouped = leaves.groupBy("tree", F.floor(F.col("rank") / width).alias("block")).agg(
                F.sort_array(F.collect_list(F.struct("rank", *carried))).alias("leaves")
            )
            small = broadcast_if(totals, fits_in_memory(totals))
            made = grouped.join(small, "tree").withColumn("made", _built("leaves.digest", "total", height))
            made = made.select("tree", "block", "total", "leaves", "made.*")
            self.blocks.append(store(made, "merkle-blocks"))
            if totals.filter(F.col("total") > width).isEmpty():
                break
            leaves = self.blocks[-1].select("tree", F.col("block").alias("rank"), F.col("root").alias("digest"))
        self.roots = self.blocks[-1].select("tree", "root")

    def _with_paths(self, stage: int, tops: DataFrame | None) -> DataFrame:
        """The blocks of a stage with ``above``, the path from the block's root upwards."""
        blocks = self.blocks[stage]
        if stage + 1 < len(self.blocks):
            higher = self._with_paths(stage + 1, tops)
            paths = _paths("layout", "levels", F.size("leaves"), "above")
            higher = higher.select("tree", F.arrays_zip("leaves.rank", paths.alias("path")).alias("z"))
            higher = higher.select("tree", F.explode("z").alias("z"))
            higher = higher.select("tree", F.col("z.rank").alias("block"), F.col("z.path").alias("above"))
            return blocks.join(store(higher, "merkle-paths"), ["tree", "block"])
        if tops is None:
            nothing = F.array().cast("array<struct<place: int, others: array<string>>>")
            return blocks.withColumn("above", nothing)
        return blocks.join(tops, "tree")

    def leaf_paths(self) -> DataFrame:
        """tree, rank and ``above``: the whole path of every leaf."""
        blocks = self._with_paths(0, None)
        paths = _paths("layout", "levels", F.size("leaves"), "above")
        zipped = blocks.select("tree", F.explode(F.arrays_zip("leaves.rank", paths.alias("path"))).alias("z"))
        return zipped.select("tree", F.col("z.rank").alias("rank"), F.col("z.path").alias("above"))

    def proofs(self, folds: str, tops: DataFrame | None = None) -> DataFrame:
        """All leaves with their columns, proof_sha256 and folded_root.

        The root is folded from the leaf column ``folds``; ``tops`` (tree, above) has the
        path that goes on above each tree's root.
        """
        blocks = self._with_paths(0, tops)
        proofs = _proofs("layout", "levels", "above", F.col(f"leaves.{folds}"))
        zipped = F.explode(F.arrays_zip("leaves", proofs.alias("proof")))
        return blocks.select("tree", zipped.alias("z")).select("tree", "z.leaves.*", "z.proof.*")


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    tampered: Column | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    height: int = HEIGHT,
) -> DataFrame:
    """One row per document: doc_id, source, leaf, subroot, root, proof_sha256,
    folded_root and verified.

    A source's leaves stand in the order of doc_id, its null first and equal ones by leaf;
    sources stand in UTF-8 order, null first and a source of its own.  ``tampered`` is the
    text that is checked instead of each document's own (by default its own): folded_root is
    computed from that text and the stored siblings, and verified where it is the root.
    Null and empty texts differ (``-`` and ``0:``).  Repeated rows are leaves of their own;
    an empty table gives an empty result; other columns of ``docs`` are not looked at.
    """
    values = {c: F.col(f"`{c}`") for c in fields}
    if tampered is None:
        tampered = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        leaf_digest(list(values.values())).alias("digest"),
        leaf_digest(list((values | {text: tampered}).values())).alias("checked"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = store(rows, "merkle-rows")
    sources = numbered(rows.select("source").distinct(), ["source"], name="tree")
    named = store(sources.select(F.col("source").alias("__source"), "tree"), "merkle-sources")
    ranked = numbered(rows, ["doc_id", "digest", "row"], ["source"]).drop("row")
    small = broadcast_if(named, fits_in_memory(named))
    leaves = ranked.join(small, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    trees = Forest(leaves, height)
    subroots = trees.roots.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), F.col("root").alias("digest")
    )
    over = Forest(subroots, height)
    tops = over.leaf_paths().select(F.col("rank").alias("tree"), "above")
    tops = store(tops.join(trees.roots.withColumnRenamed("root", "subroot"), "tree"), "merkle-tops")
    proofs = trees.proofs("checked", tops.select("tree", "above"))
    names = tops.select("tree", "subroot", F.lit(0).cast("long").alias("over"))
    names = names.join(F.broadcast(over.roots.toDF("over", "root")), "over").drop("over")
    names = store(names, "merkle-names")
    return (
        proofs.join(broadcast_if(names, fits_in_memory(names)), "tree")
        .withColumn("verified", F.col("folded_root") == F.col("root"))
        .select(
            "doc_id", "source", F.col("digest").alias("leaf"), "subroot", "root",
            "proof_sha256", "folded_root", "verified",
        )
    )


def without_newlines(doc_id: Column, text: Column) -> Column:
    """The text without its newlines where 2 divides the crc32 of the id, else the text."""
    even = F.coalesce(crc_remainder(doc_id, 2) == 0, F.lit(False))
    return F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def _tree_sql(name: str, rows: str, levels: int) -> str:
    """CTEs ``name_0`` to ``name_<levels>`` (tree, place, h) of all nodes of trees over ``rows``
    (tree, place, h), and ``name_path`` with the siblings of every leaf."""
    parts = [f"{name}_0 AS ({rows})"]
    for level in range(levels):
        parts.append(
            f"""{name}_{level + 1} AS (
  SELECT tree, place // 3 AS place, CASE WHEN any_value(n) = 1 THEN any_value(h)
         ELSE sha256(string_agg(h, '' ORDER BY place)) END AS h
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}_{level}) GROUP BY tree, place // 3)"""
        )
        parts.append(
            f"""{name}_s{level} AS (
  SELECT a.tree, a.place, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS before,
         coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS after, count(*) OVER (PARTITION BY a.tree) AS n
  FROM {name}_{level} a JOIN {name}_{level} b ON a.tree = b.tree AND a.place // 3 = b.place // 3
  GROUP BY a.tree, a.place)"""
        )
    return ",\n".join(parts)


def duckdb_manifest(table: str, levels: int = 9, source_levels: int = 5) -> str:
    """``manifest`` as DuckDB SQL, for up to 3 ** levels documents a source."""
    fields = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars")]
    head = " || ".join(fields)
    crc = (
        "list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),"
        " lambda c, b: list_reduce([xor(c, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],"
        " lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))"
    )
    text = f"CASE WHEN xor({crc}, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"
    sql = f"""WITH d AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         sha256({head} || coalesce(strlen(text) || ':' || text, '-')) AS h,
         sha256({head} || coalesce(strlen({text}) || ':' || {text}, '-')) AS checked
  FROM {table}
), leaf AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS place FROM d
),
{_tree_sql("t", "SELECT tree, place, h FROM leaf", levels)},
{_tree_sql("u", f"SELECT 0 AS tree, tree AS place, h FROM t_{levels}", source_levels)},
f0 AS (SELECT doc_id, tree, h AS leaf, place, checked AS folded, '' AS proof FROM leaf)"""
    step = 0
    for name, count in (("t", levels), ("u", source_levels)):
        if name == "u":
            sql += f",\nf{step + 1} AS (SELECT doc_id, tree, leaf, tree AS place, folded, proof FROM f{step})"
            step += 1
        for level in range(count):
            tree = "f.tree" if name == "t" else "0"
            sql += f""",
f{step + 1} AS (
  SELECT doc_id, f.tree, leaf, f.place // 3 AS place, proof || s.before || s.after AS proof,
         CASE WHEN s.n = 1 THEN folded ELSE sha256(s.before || folded || s.after) END AS folded
  FROM f{step} f JOIN {name}_s{level} s ON s.tree = {tree} AND s.place = f.place)"""
            step += 1
    return f"""{sql}
SELECT doc_id, leaf, t.h AS subroot, u.h AS root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = u.h AS verified
FROM f{step} f JOIN t_{levels} t ON t.tree = f.tree CROSS JOIN u_{source_levels} u"""
