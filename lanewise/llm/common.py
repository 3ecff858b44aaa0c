"""What several operators of this package share."""

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Characters that separate words everywhere in this package: space, tab, newline,
#: vertical tab, form feed, carriage return.  ``bytes.split()`` splits on exactly these.
WORD = r"[^\x20\x09-\x0D]+"

_SLICE = 256
#: Bytes of rows, about, that are handed to a Python worker at once.
_BATCH_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key written as text, modulo ``divisor``; null for a null key."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(divisor))


def held_out(key: Column, divisor: int, remainder: int) -> Column:
    """Whether a row is held out of learning; rows without a key are not."""
    return F.coalesce(crc_remainder(key, divisor) == remainder, F.lit(False))


def plain_words(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


def binary_values(column: pa.Array) -> Iterator[bytes | None]:
    """The values of a string column as UTF-8 bytes, a few hundred at a time."""
    for start in range(0, len(column), _SLICE):
        yield from column.slice(start, _SLICE).cast(pa.binary()).to_pylist()


def text_values(column: pa.Array) -> Iterator[str | None]:
    """The values of a string column, a few hundred at a time."""
    for start in range(0, len(column), _SLICE):
        yield from column.slice(start, _SLICE).to_pylist()


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """For tables written inside: rows reach Python workers in batches of a few megabytes.

    Spark counts rows only, and ten thousand long texts are tens of megabytes, held several
    times over in the executor and in the worker.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(_BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def bounded_sample(rows: DataFrame, limit: int, *key: str) -> DataFrame:
    """At most ``limit`` rows, those with the smallest hash of ``key``: the same rows in
    every run and however the table is partitioned."""
    return rows.orderBy(F.xxhash64(*key), *key).limit(limit)
