"""Places in an order, and numbers for the values of a column, without gathering them."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import store
from .skew import broadcast_if, fits_in_memory

#: Rows per numbered run of an order, about.
RUN_ROWS = 20_000


def numbered(
    rows: DataFrame,
    order: Sequence[str | Column],
    group: Sequence[str] = (),
    name: str = "rank",
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """``rows`` with ``name``, gapless from 0 in each group (or over all) by ``order``.

    Rows are dealt into runs of the whole order and each run is numbered by itself; a run's
    first number is the count of the group's rows in the runs before it.  So no task holds
    a whole group, however large.  End ``order`` with columns that tell rows apart; rows
    equal in all of it are numbered in any order.
    """
    group = list(group)
    runs = rows.count() // run_rows + 1
    dealt = rows.repartitionByRange(runs, *group, *order).withColumn("__run", F.spark_partition_id())
    dealt = store(dealt, "runs")
    counts = dealt.groupBy(*group, "__run").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__run") if group else Window.orderBy("__run")
    named = [F.col(c).alias(f"__at_{c}") for c in [*group, "__run"]]
    firsts = counts.withColumn("__first", F.sum("__n").over(before) - F.col("__n"))
    firsts = store(firsts.select(*named, "__first"), "run-firsts")
    same = F.col("__run") == F.col("__at___run")
    for column in group:
        same &= F.col(column).eqNullSafe(F.col(f"__at_{column}"))
    inside = Window.partitionBy(*group, "__run").orderBy(*order)
    placed = dealt.withColumn("__place", F.row_number().over(inside))
    joined = placed.join(broadcast_if(firsts, fits_in_memory(firsts)), same)
    number = F.col("__first") + F.col("__place") - 1
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], number.alias(name))


class FrequencyIndex:
    """Numbers for the values of category columns, the most frequent 0, as tables.

    The same numbers as the ``pyspark.ml`` stage gives (equal counts by the value's text),
    but the values stay in tables: counted, ranked and joined where they are, however many
    there are.
    """

    def __init__(self, tables: dict[str, DataFrame]):
        #: By column: value (string) and index (double).
        self.tables = tables
        self.sizes = {column: table.count() for column, table in tables.items()}

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> "FrequencyIndex":
        """Null values are not counted."""
        tables = {}
        for column in columns:
            value = F.col(f"`{column}`").cast("string")
            counts = df.select(value.alias("value")).filter("value is not null").groupBy("value").count()
            ranked = numbered(store(counts, "category-counts"), [F.desc("count"), "value"], name="index")
            tables[column] = store(ranked.select("value", F.col("index").cast("double").alias("index")), "categories")
        return cls(tables)

    def transform(self, df: DataFrame, unseen: str = "keep", suffix: str = "Indexed") -> DataFrame:
        """Add each column's number under its name and ``suffix``.

        Nulls and values not met in fitting get the number after the last with
        ``unseen="keep"``, null with ``"null"``, and stop the job with ``"error"``.  A
        table of values is copied to the tasks if it is measured small, and met by a shuffle
        of both sides (which adaptive execution splits where one value is frequent) if not.
        """
        if unseen not in ("keep", "null", "error"):
            raise ValueError("unseen must be 'keep', 'null' or 'error'")
        for column, table in self.tables.items():
            side = table.select(F.col("value").alias("__value"), F.col("index").alias("__index"))
            side = broadcast_if(side, fits_in_memory(table))
            text = F.col(f"`{column}`").cast("string")
            joined = df.join(side, text == F.col("__value"), "left")
            number = F.col("__index")
            if unseen == "keep":
                number = F.coalesce(number, F.lit(float(self.sizes[column])))
            elif unseen == "error":
                said = F.concat(F.lit(f"unseen value of {column}: "), F.coalesce(text, F.lit("null")))
                number = F.coalesce(number, F.raise_error(said).cast("double"))
            df = joined.withColumn(f"{column}{suffix}", number).drop("__value", "__index")
        return df
