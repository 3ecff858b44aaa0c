"""Filters, grouped reports and top-k lists."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import AtomicType

Condition = str | Column


def rows_where(df: DataFrame, condition: Condition, columns: Sequence[str] | None = None):
    """Rows meeting a condition (a Column or SQL text), narrowed to ``columns``."""
    kept = df.filter(condition)
    return kept.select(*columns) if columns else kept


def group_report(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: dict[str, Column],
    where: Condition | None = None,
    order_by: Sequence[Column | str] = (),
    limit: int | None = None,
) -> DataFrame:
    """``aggregates`` (named) per group of ``keys``, filtered before, ordered after.

    Each task combines its own rows before the shuffle, so a group's size does not
    matter.  With a limit, give an order that ends in the keys: the result is then the
    same on every run.
    """
    source = df if where is None else df.filter(where)
    measures = [column.alias(name) for name, column in aggregates.items()]
    report = source.groupBy(*keys).agg(*measures) if keys else source.agg(*measures)
    return _ordered(report, order_by, limit)


def count_report(
    df: DataFrame,
    keys: Sequence[str],
    of: str | None = None,
    name: str = "count",
    **options,
) -> DataFrame:
    """Rows per group, or non-null values of column ``of`` per group."""
    counted = F.count(F.lit(1)) if of is None else F.count(of)
    return group_report(df, keys, {name: counted}, **options)


def top_rows(
    df: DataFrame,
    order_by: Sequence[Column | str],
    n: int,
    where: Condition | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The first ``n`` rows in an order, as one fused sort-and-limit.

    Every task keeps only its best ``n``.  End the order with a unique column to make
    ties certain.
    """
    source = df if where is None else df.filter(where)
    top = source.orderBy(*order_by).limit(n)
    return top.select(*columns) if columns else top


# Up to the n of this setting Spark limits groups inside tasks by itself; beyond it a
# group is first limited in so many parts.
_LIMITED_BY_SPARK, _PARTS = "spark.sql.optimizer.windowGroupLimitThreshold", 256


def first_per_group(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str], n: int
) -> DataFrame:
    """The first ``n`` rows of each group.

    Spark limits each group inside every task before the shuffle, so a group that holds
    much of the table sends no more than ``n`` rows per task.  For a large ``n`` a
    group's rows are first spread over parts and each part is limited.
    """
    if n > int(df.sparkSession.conf.get(_LIMITED_BY_SPARK, "1000")):
        simple = [f.name for f in df.schema if isinstance(f.dataType, AtomicType)]
        part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in simple]), F.lit(_PARTS))
        df = _numbered(df.withColumn("__part", part), [*keys, "__part"], order_by, n).drop("__part")
    return _numbered(df, keys, order_by, n)


def _numbered(df, keys, order_by, n):
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("__position", position).filter(F.col("__position") <= n).drop("__position")


def _ordered(df: DataFrame, order_by: Sequence[Column | str], limit: int | None) -> DataFrame:
    if order_by:
        df = df.orderBy(*order_by)
    return df if limit is None else df.limit(limit)
