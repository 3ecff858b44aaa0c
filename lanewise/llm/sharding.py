"""Shards of near equal size from a minimax contiguous partition of atomic groups.

Groups (documents with equal text) stand in a fixed order, by the md5 of their text.  The
smallest shard capacity for which at most ``shards`` runs of whole groups suffice is found
by binary search, each capacity checked greedily, and the order is cut under that
capacity.  Everything is DataFrame functions; the driver sees counters of a few thousand
cells of the order, never groups or documents.
"""

import math
from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import store

KEY_BITS = 60
_FIRST_BITS = 12
_CELLS = 1 << 14
#: Documents per numbered bucket of a shard, about.
_BUCKET_ROWS = 20_000


def order_key(text: Column) -> Column:
    """Place of a text in the order of groups: the first 60 bits of its md5.

    Null and empty texts are one group.  Different texts with the same 60 bits would be
    kept together as one group, which keeps every promise made here.
    """
    digest = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


@dataclass(frozen=True)
class Cell:
    """Consecutive groups: those whose key starts with ``prefix``, ``bits`` long."""

    prefix: int
    bits: int
    size: int
    many: bool

    @property
    def start(self) -> int:
        return self.prefix << (KEY_BITS - self.bits)


@dataclass(frozen=True)
class Cuts:
    """``keys[i]`` is the first key of shard ``i + 1``; ``capacity`` the minimax size."""

    keys: list[int]
    capacity: int

    def shard(self, key: Column) -> Column:
        if not self.keys:
            return F.lit(0)
        cuts = F.array(*[F.lit(k).cast("long") for k in self.keys])
        return F.size(F.filter(cuts, lambda cut: cut <= key))


class _Line:
    """Cells laid end to end by size."""

    def __init__(self, cells: list[Cell]):
        self.cells, self.ends = cells, [0]
        for cell in cells:
            self.ends.append(self.ends[-1] + cell.size)
        self.total = self.ends[-1]

    def whole(self, start: int, capacity: int) -> int:
        """The last cell border within ``capacity`` of ``start``."""
        return self.ends[bisect_right(self.ends, start + capacity) - 1]

    def loose(self, start: int, capacity: int) -> int:
        """As if a cell of many groups could be cut anywhere: no real cut gets further."""
        reach = start + capacity
        at = bisect_right(self.ends, reach) - 1
        return reach if at < len(self.cells) and self.cells[at].many else self.ends[at]

    def fits(self, step, capacity: int, shards: int) -> bool:
        position = 0
        for _ in range(shards):
            position = step(position, capacity)
            if position >= self.total:
                return True
        return False

    def smallest(self, step, shards: int, low: int) -> int:
        high = max(self.total, low)
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if self.fits(step, middle, shards) else (middle + 1, high)
        return low

    def undecided(self, low: int, high: int, shards: int) -> list[Cell]:
        """Cells of many groups in which a greedy cut can fall, for capacities from
        ``low`` to ``high``."""
        found, least, most = {}, 0, 0
        for _ in range(shards):
            least, most = self.whole(least, low), self.loose(most, high)
            first = max(bisect_right(self.ends, least) - 1, 0)
            for cell in self.cells[first : bisect_left(self.ends, most)]:
                if cell.many:
                    found[cell.prefix, cell.bits] = cell
        return list(found.values())

    def even_borders(self, capacity: int, shards: int) -> list[int]:
        """Cell borders that divide the rest evenly, no shard above ``capacity``."""
        latest = [self.total]
        for _ in range(shards - 1):
            need = latest[-1] - capacity
            latest.append(self.ends[bisect_left(self.ends, max(need, 0))])
        borders, at = [], 0
        for left in range(shards, 1, -1):
            goal = at + (self.total - at) / left
            right = bisect_left(self.ends, goal)
            near = min(
                (self.ends[i] for i in (right - 1, right) if 0 <= i < len(self.ends)),
                key=lambda end: (abs(end - goal), end),
            )
            at = min(max(near, latest[left - 1]), self.whole(at, capacity))
            borders.append(at)
        return borders


def _cells(groups: DataFrame, bits: int) -> list[Cell]:
    prefix = F.shiftright("key", KEY_BITS - bits)
    rows = (
        groups.groupBy(prefix.alias("prefix"))
        .agg(
            F.sum("size").alias("size"),
            (F.min("key") < F.max("key")).alias("many"),
        )
        .collect()
    )
    return [Cell(row.prefix, bits, row["size"], row.many) for row in rows]


def _split(groups: DataFrame, cells: list[Cell]) -> tuple[list[Cell], set[tuple[int, int]]]:
    """Finer cells in place of those given: at most some thousands in all."""
    spark, made = groups.sparkSession, []
    by_bits: dict[int, list[Cell]] = {}
    for cell in cells:
        by_bits.setdefault(cell.bits, []).append(cell)
    for bits, same in by_bits.items():
        finer = max(1, int(math.log2(max(2, _CELLS // len(cells)))))
        chosen = spark.createDataFrame([(c.prefix,) for c in same], "chosen long")
        inside = groups.join(
            F.broadcast(chosen), F.shiftright("key", KEY_BITS - bits) == F.col("chosen"), "semi"
        )
        made += _cells(inside, min(bits + finer, KEY_BITS))
    return made, {(c.prefix, c.bits) for c in cells}


def minimax_cuts(groups: DataFrame, shards: int) -> Cuts:
    """Cuts of the groups (columns ``key`` and ``size``, one row per key) into shards.

    The order is first seen as a few thousand cells.  With whole cells the search gives a
    capacity that suffices, with cells of many groups cut anywhere one that is needed.
    Where the two differ, the cells that a cut can fall into are counted again in finer
    cells, until both are equal: then the capacity is the smallest for the groups
    themselves.  Each round reads the groups once; a dozen rounds reach single keys.
    An empty table has no cuts and capacity 0.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    cells = _cells(groups, _FIRST_BITS)
    if not cells:
        return Cuts([], 0)
    while True:
        line = _Line(sorted(cells, key=lambda cell: cell.start))
        needed = line.smallest(line.loose, shards, -(-line.total // shards))
        enough = line.smallest(line.whole, shards, needed)
        if needed == enough:
            break
        finer, gone = _split(groups, line.undecided(needed, enough, shards))
        cells = [c for c in line.cells if (c.prefix, c.bits) not in gone] + finer
    starts = [cell.start for cell in line.cells] + [1 << KEY_BITS]
    borders = line.even_borders(enough, shards)
    return Cuts([starts[bisect_left(line.ends, border)] for border in borders], enough)


def group_cuts(docs: DataFrame, shards: int, text: str = "text") -> Cuts:
    """Minimax cuts for the texts of ``docs``."""
    sized = docs.select(order_key(F.col(text)).alias("key"), byte_size(F.col(text)).alias("size"))
    groups = store(sized.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups")
    return minimax_cuts(groups, shards)


def assign_shards(docs: DataFrame, shards: int, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with an int column ``shard`` (replaced if present).

    Equal texts share a shard.  The texts are read twice and never shuffled: a shard
    follows from a row's own text and the cuts.  Null and empty texts count 8 bytes;
    repeated rows stay repeated; an empty table stays empty.
    """
    cuts = group_cuts(docs, shards, text)
    return docs.withColumn("shard", cuts.shard(order_key(F.col(text))))


def shard_slots(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, key, shard and a gapless slot.

    Slots run from 0 within each shard.  A shard is numbered in buckets by a hash of the
    document, so that even a shard with a third of all rows is many small tasks; a
    bucket's first slot is the number of rows in the buckets before it.
    """
    value = F.col(text)
    rows = store(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            byte_size(value).alias("size"),
            F.crc32(F.coalesce(value, F.lit("")).cast("binary")).alias("text_crc32"),
            order_key(value).alias("key"),
        ),
        "shard-rows",
    )
    groups = store(rows.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups")
    cuts = minimax_cuts(groups, shards)
    buckets = rows.count() // _BUCKET_ROWS + 1
    placed = rows.withColumn("shard", cuts.shard(F.col("key"))).withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "key"), F.lit(buckets)).cast("int")
    )
    before = Window.partitionBy("shard").orderBy("bucket")
    firsts = (
        placed.groupBy("shard", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("first", F.sum("n").over(before) - F.col("n"))
        .drop("n")
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "key")
    return (
        placed.withColumn("place", F.row_number().over(inside))
        .join(firsts, ["shard", "bucket"])
        .withColumn("slot", F.col("first") + F.col("place") - 1)
        .select("doc_id", "size", "text_crc32", "key", "shard", "slot")
    )


def write_shards(docs: DataFrame, shards: int, path: str, text: str = "text") -> None:
    """Write all rows of ``docs`` as parquet below ``path``, a folder per shard."""
    assign_shards(docs, shards, text).write.partitionBy("shard").parquet(path)
