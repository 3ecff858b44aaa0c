"""Joins that stay even when one key holds much of the table."""

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import BROADCAST_BYTES, BROADCAST_ROWS, ROWS_PER_SPLIT, setting, settle

PART, COPY = "__part", "__copy"


def fits_in_memory(df: DataFrame) -> bool:
    """Whether ``df`` is small enough to copy to every executor: measured, not estimated.

    Rows are counted up to the bound only; bytes are measured only where the rows pass.
    """
    spark = df.sparkSession
    most = setting(spark, BROADCAST_ROWS)
    if most < 0 or df.limit(most + 1).count() > most:
        return False
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return size <= setting(spark, BROADCAST_BYTES)


def broadcast_if(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


@contextmanager
def parts_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """For tables written inside: reads and shuffles of ``rows`` rows in parts of about a split's
    worth, where the session's number of shuffle partitions would make larger ones.

    That number does not grow with the data, and files packed, or parts joined again, up to a
    size in bytes are millions of rows where these are short.
    """
    number = "spark.sql.shuffle.partitions"
    parts = math.ceil(rows / setting(spark, ROWS_PER_SPLIT))
    if parts <= int(spark.conf.get(number)):
        yield
        return
    asked = {
        number: str(parts),
        "spark.sql.files.minPartitionNum": str(parts),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in asked}
    for key, value in asked.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@dataclass(frozen=True, eq=False)
class HotKeys:
    """The keys of a table that hold more than one split's worth of rows.

    The table's side of a join is ``divide``d, the other side ``copy``ed, and the join
    condition passed through ``match``; then a hot key's rows meet in several tasks.
    ``table`` has ``key`` and ``splits`` and cannot exceed (rows / rows per split)
    rows; it is None when no key is hot, and all three steps then do nothing.
    """

    table: DataFrame | None
    small: bool = True

    def _splits(self, df: DataFrame, key: Column) -> DataFrame:
        hot = broadcast_if(self.table.toDF("__hot", "__splits"), self.small)
        return df.join(hot, key == F.col("__hot"), "left").drop("__hot")

    def divide(self, df: DataFrame, key: Column, spread: Column) -> DataFrame:
        """Number the rows of each hot key into parts, by the hash of ``spread``."""
        if self.table is None:
            return df
        part = F.pmod(F.xxhash64(spread), F.coalesce("__splits", F.lit(1))).cast("int")
        return self._splits(df, key).withColumn(PART, part).drop("__splits")

    def copy(self, df: DataFrame, key: Column) -> DataFrame:
        """Repeat each row of a hot key once per part."""
        if self.table is None:
            return df
        parts = F.sequence(F.lit(0), F.coalesce("__splits", F.lit(1)) - 1)
        return self._splits(df, key).withColumn(COPY, F.explode(parts)).drop("__splits")

    def match(self, condition: Column) -> Column:
        return condition if self.table is None else condition & (F.col(PART) == F.col(COPY))

    def lay_out(self, divided: DataFrame, key: str) -> DataFrame:
        """Partition and sort a divided table by its join key and keep it, for a loop of joins.

        Loaded at once: only a loaded table's layout is known to the planner, and then
        the loop's joins neither shuffle nor sort it again.
        """
        spark, rows = divided.sparkSession, divided.count()
        slots = max(
            min(spark.sparkContext.defaultParallelism, math.ceil(rows / 10_000)),
            math.ceil(rows / setting(spark, ROWS_PER_SPLIT)),
            1,
        )
        keys = [key] if self.table is None else [key, PART]
        laid = divided.repartition(slots, *keys).sortWithinPartitions(*keys)
        laid = laid.persist(StorageLevel.MEMORY_AND_DISK)
        laid.count()
        return laid


def hot_keys(df: DataFrame, key: str) -> HotKeys:
    """Find the hot keys of one column: an aggregate whose result is tiny."""
    per_split = setting(df.sparkSession, ROWS_PER_SPLIT)
    heavy = (
        df.groupBy(F.col(key).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > per_split) & F.col("key").isNotNull())
        .select("key", F.ceil(F.col("n") / per_split).cast("int").alias("splits"))
    )
    heavy = settle(heavy)
    if heavy.isEmpty():
        return HotKeys(None)
    return HotKeys(heavy, fits_in_memory(heavy))
