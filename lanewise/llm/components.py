"""Connected components of links that may be far too many for one machine."""

from pyspark.sql import DataFrame, functions as F

from ..session import settle


def _state(links: DataFrame) -> tuple[int, int]:
    return tuple(
        links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 31) - 1)))).first()
    )


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step: neighbours of each node above (large) or below it point to its least one.

    The least neighbour is an aggregate with partial results, and a join brings it to the
    links, so a node with a third of all links is split like any skewed join.
    """
    if large:
        around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = links
    least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    joined = around.join(least.withColumnRenamed("a", "node"), F.col("a") == F.col("node"))
    if large:
        made = joined.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        made = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
    return made.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of ``links`` (columns a, b) but the roots.

    The root is the least node of the component.  Alternating large and small stars
    (Kiveris and others) until nothing changes; each step's links are checkpointed.  Node
    columns may have any type that has an order; no links give an empty result.
    """
    a, b = F.col("a"), F.col("b")
    links = settle(
        links.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    )
    before = None
    while (now := _state(links)) != before and now[0]:
        before = now
        links = settle(_star(_star(links, large=True), large=False))
    return links.toDF("node", "root")
