"""Text columns built from other columns."""

from pyspark.sql import Column, DataFrame, functions as F


def route_name(src: str = "src", dst: str = "dst", separator: str = "_") -> Column:
    """``src_dst``; null when either end is null."""
    return F.concat(F.col(src), F.lit(separator), F.col(dst))


def as_message(df: DataFrame) -> Column:
    """The whole row as one JSON object (null fields are left out)."""
    return F.to_json(F.struct(*[F.col(f"`{name}`") for name in df.columns]))
