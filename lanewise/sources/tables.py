"""Batch scans and views."""

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines under a fixed schema: one pass, and only the asked fields are parsed."""
    return spark.read.schema(schema).json(path)


def read_json_inferred(
    spark: SparkSession, path: str, sampling_ratio: float | None = None
) -> DataFrame:
    """JSON lines with the schema found by reading them.

    Inference is a full extra pass; ``sampling_ratio`` shortens it for large inputs at
    the risk of missing rare fields.
    """
    return spark.read.json(path, samplingRatio=sampling_ratio)


def read_json_variant(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines whose fields change their shape from line to line: ``value``, ``message``.

    ``message`` is the line as a variant, null where the line is not JSON; nothing is
    decided about its fields before they are asked for, and no line is left out.
    """
    lines = spark.read.text(path)
    return lines.select("value", F.try_parse_json("value").alias("message"))


def variant_schema(messages: DataFrame, column: str = "message") -> DataFrame:
    """One row, ``schema``: the type that holds all messages, found in one pass over them.

    Fields of one shape get its type, fields of several shapes become VARIANT.  Tasks merge
    the types of their rows, so what is shuffled is a schema each.
    """
    return messages.agg(F.schema_of_variant_agg(column).alias("schema"))


def variant_field(message: str | Column, kind: str, *paths: str) -> Column:
    """A field that has stood in several places: the first of ``paths`` that gives a ``kind``.

    A path whose value is missing or cannot be read as ``kind`` gives way to the next.
    """
    value = F.col(message) if isinstance(message, str) else message
    return F.coalesce(*[F.try_variant_get(value, path, kind) for path in paths])


def register_views(**tables: DataFrame) -> None:
    """Name DataFrames for ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def keep_in_memory(
    df: DataFrame, view: str | None = None, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> DataFrame:
    """Cache a table that several queries will read, load it now, and optionally name it.

    Only for tables that fit the cluster's storage memory; the caller calls
    ``unpersist``.
    """
    cached = df.persist(level)
    cached.count()
    if view:
        cached.createOrReplaceTempView(view)
    return cached
