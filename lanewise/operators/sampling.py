"""Splits and samples.

The hash variants depend only on the row's key and the seed: a retried task, another
layout or another engine picks the same rows.  The random variants are Spark's own
generators, whose choice depends on the layout of the input.
"""

from pyspark.sql import DataFrame, functions as F

from ..functions import hash_below


def hash_split(
    df: DataFrame, fraction: float = 0.7, key: str = "id", seed: int | str = ""
) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts that together are the table."""
    chosen = F.coalesce(hash_below(key, fraction, seed), F.lit(False))
    return df.filter(chosen), df.filter(~chosen)


def random_split(
    df: DataFrame, fraction: float = 0.7, seed: int = 5043
) -> tuple[DataFrame, DataFrame]:
    first, second = df.randomSplit([fraction, 1 - fraction], seed)
    return first, second


def stratified_sample(
    df: DataFrame,
    column: str,
    fractions: dict[float, float],
    key: str = "id",
    seed: int | str = "",
) -> DataFrame:
    """``fractions[c]`` of the rows of each class ``c``; classes not listed are left out."""
    chosen = F.lit(False)
    for value, fraction in fractions.items():
        chosen = chosen | ((F.col(column) == F.lit(value)) & hash_below(key, fraction, seed))
    return df.filter(chosen)


def random_stratified_sample(
    df: DataFrame, column: str, fractions: dict[float, float], seed: int = 36
) -> DataFrame:
    return df.stat.sampleBy(column, fractions, seed)
