"""SimHash fingerprints and near-duplicate groups found with BK-trees.

Trees are kept per shard.  Fingerprints are cut in blocks so that any two within the radius
agree on some choice of blocks; every choice is a shard key, and a shard's tree is built
where its fingerprints meet.  So a tree is as small as a shard, and nothing that grows with
the corpus is broadcast.  Within a shard a spanning set of links is enough: links that
join what is joined already are not kept, however many copies there are.
"""

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.skew import broadcast_if, fits_in_memory
from ..session import settle, store
from .bktree import Forest, merge
from .common import binary_values, plain_words
from .components import components

_BITS = 64
#: Members of a shard that one tree holds; larger shards are searched in pairs of parts.
SHARD_ROWS = 4096
_BUFFER = 100_000


def shingles(text: bytes | None, width: int) -> list[bytes]:
    """Runs of ``width`` words (A-Z in lower case), space-joined, repeats included; fewer
    words give the whole sequence, no words nothing."""
    words = plain_words(text.lower() if text else None)
    if len(words) < width:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)))


def shingle_hashes(text: bytes | None, width: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, 42) for s in shingles(text, width)], ">u8")


def simhash(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of the hashes; no hashes give zero."""
    if not len(hashes):
        return 0
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << _BITS) if value >> (_BITS - 1) else value


def fingerprint(text: Column, width: int = 3) -> Column:
    """The SimHash of a text as a signed long; null and wordless texts give 0."""

    @F.arrow_udf("long")
    def prints(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            values = [_signed(simhash(shingle_hashes(v, width))) for v in binary_values(column)]
            yield pa.array(values, pa.int64())

    return prints(text)


def hex_print(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def block_masks(radius: int, kept: int) -> list[int]:
    """Masks of which any two fingerprints within ``radius`` agree on at least one."""
    count = radius + kept
    bounds = [round(i * _BITS / count) for i in range(count + 1)]
    blocks = [((1 << (high - low)) - 1) << low for low, high in zip(bounds, bounds[1:], strict=False)]
    return [sum(blocks[i] for i in chosen) for chosen in combinations(range(count), kept)]


def _kept_blocks(number: int, radius: int) -> int:
    """Blocks per shard key, so that chance fills a shard with some dozens only."""
    for kept in (1, 2, 3):
        if number >> (_BITS * kept // (radius + kept)) < 64:
            return kept
    return 4


def split_shards(members: DataFrame, member: str, limit: int) -> DataFrame:
    """Add ``pair`` and ``side`` to rows with a ``shard``, so that no shard is too large.

    A shard of more than ``limit`` rows is divided into parts by the hash of ``member``.
    Each two parts meet once, in a pair of their own: one as the tree (side 1), the other
    as queries (side 2); a part meets itself with side 0.
    """
    hot = settle(
        members.groupBy("shard")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > limit)
        .select(F.col("shard").alias("__hot"), F.ceil(F.col("n") / limit).cast("int").alias("__parts"))
    )
    whole = members.withColumns({"pair": F.lit(0), "side": F.lit(0)})
    if hot.isEmpty():
        return whole
    parts, part, other = F.coalesce("__parts", F.lit(1)), F.col("__part"), F.col("__other")
    return (
        members.join(hot, F.col("shard") == F.col("__hot"), "left")
        .withColumn("__part", F.pmod(F.xxhash64(member, F.lit("part")), parts).cast("int"))
        .withColumn("__other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumn("pair", F.least(part, other) * parts + F.greatest(part, other))
        .withColumn("side", F.when(part == other, 0).when(part < other, 1).otherwise(2))
        .drop("__hot", "__parts", "__part", "__other")
    )


def _whole_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of complete (shard, pair) groups, some ten thousand at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < _BUFFER:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        shard, pair = (table[c].to_numpy() for c in ("shard", "pair"))
        last = np.flatnonzero((shard[1:] != shard[:-1]) | (pair[1:] != pair[:-1]))
        if len(last):
            yield table.slice(0, last[-1] + 1)
            table = table.slice(last[-1] + 1)
        held, rows = table.to_batches(), 0 if len(last) else rows - _BUFFER
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _groups(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    shard, pair, side = (table[c].to_numpy() for c in ("shard", "pair", "side"))
    change = (shard[1:] != shard[:-1]) | (pair[1:] != pair[:-1])
    groups = np.cumsum(np.r_[False, change]) if len(shard) else np.zeros(0, np.int64)
    return groups, np.flatnonzero(side != 2), np.flatnonzero(side != 1)


def _hits(table: pa.Table, radius: int):
    """Pairs of row numbers of one shard within the radius, as found in its tree."""
    groups, nodes, queries = _groups(table)
    prints = table["print"].to_numpy().astype(np.uint64)
    forest = Forest(groups[nodes], prints[nodes])
    for query, node in forest.search(groups[queries], prints[queries], radius):
        yield queries[query], nodes[node]


def _search(shards: DataFrame, run: Callable, schema: str) -> DataFrame:
    return (
        shards.repartition("shard", "pair").sortWithinPartitions("shard", "pair").mapInArrow(run, schema)
    )


def linked_prints(prints: DataFrame, radius: int = 3, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links (a, b) that connect all of ``prints`` (distinct longs, column ``print``) that
    are within ``radius`` of each other, directly or by a chain of such links."""
    masks = block_masks(radius, _kept_blocks(prints.count(), radius))
    keys = [
        F.xxhash64(F.lit(i), F.col("print").bitwiseAND(F.lit(_signed(mask))))
        for i, mask in enumerate(masks)
    ]
    members = prints.select("print", F.explode(F.array(*keys)).alias("shard"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_shards(batches):
            labels = np.arange(table.num_rows)
            for query, node in _hits(table, radius):
                labels = merge(labels, query, node)
            linked = np.flatnonzero(labels != np.arange(len(labels)))
            values = table["print"].to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[linked]), pa.array(values[labels[linked]])], ["a", "b"]
            )

    return _search(split_shards(members, "print", shard_rows), run, "a long, b long")


def simhash_groups(
    docs: DataFrame,
    radius: int = 3,
    width: int = 3,
    shard_rows: int = SHARD_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, print (long) and component_id.

    Documents are linked when their fingerprints differ in at most ``radius`` bits;
    component_id is the smallest doc_id reachable, itself included.  Null and empty texts
    have fingerprint zero and are linked like any other.  Null doc_ids never name a
    component unless it has no other; repeated rows stay repeated; an empty table gives
    an empty result.  Only doc_id and text are read of ``docs``.
    """
    rows = store(
        docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), width).alias("print")),
        "simhash-rows",
    )
    prints = store(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash-prints")
    roots = components(linked_prints(prints.select("print"), radius, shard_rows))
    rooted = store(
        prints.join(roots, F.col("print") == F.col("node"), "left").select(
            "print", "least", F.coalesce("root", "print").alias("root")
        ),
        "simhash-roots",
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = store(rooted.join(least, "root").select("print", "component_id"), "simhash-named")
    return rows.join(named, "print").select("doc_id", "print", "component_id")


def drop_near_duplicates(
    docs: DataFrame, radius: int = 3, width: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that keep one document of each SimHash component.

    The document of smallest doc_id stays; a null doc_id stays only where the component has
    no other.  Null and wordless texts are near duplicates of each other.  Rows that repeat a
    document that stays are left out.  An empty table stays empty; all columns, also those of
    clashing names, are returned as they are.
    """
    groups = store(simhash_groups(docs, radius, width, doc_id=doc_id, text=text), "near-groups")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    seen = groups.groupBy("doc_id", "print").agg(F.bool_or(stays).alias("__stays"), F.count("*").alias("__n"))
    marked = store(seen.filter("not __stays or __n > 1").toDF("__id", "__print", "__stays", "__n"), "near-marked")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key, value = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    # Few rows are marked as a rule; only they, and no texts, move where they fit in memory.
    rows = docs.select(F.struct(*columns).alias("row"), key.alias("id"), fingerprint(value, width).alias("print"))
    same = F.col("id").eqNullSafe(F.col("__id")) & (F.col("print") == F.col("__print"))
    judged = rows.join(broadcast_if(marked, fits_in_memory(marked)), same, "left")
    once = judged.filter("__stays is null")
    repeated = judged.filter("__stays").dropDuplicates(["id", "print"])
    return once.select("row.*").unionByName(repeated.select("row.*"))
