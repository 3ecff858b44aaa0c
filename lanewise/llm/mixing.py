"""Mixing sources to target weights by weighted sampling without replacement.

Every document draws an exponential key, scaled by its quality weight (Efraimidis and
Spirakis).  A source's documents in key order, cut where their sizes add up to the
budget, are a weighted sample.  A budget above the source's size takes whole passes over
the source first, and the sample only for the rest.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import settle, store
from .common import WORD

#: Characters that lower a document's quality weight.
_SYMBOLS = "#*$%&|<>!"
_DRAW_DIGITS = 13
#: Documents per bucket of keys, about.
_BUCKET_ROWS = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def plain_share(text: Column) -> Column:
    """Default quality weight, in (0, 1]: the squared share of plain characters."""
    text = F.coalesce(text, F.lit(""))
    share = (F.length(F.translate(text, _SYMBOLS, "")) + 1.0) / (F.length(text) + 1.0)
    return share * share


def uniform_draw(key: Column, seed: str) -> Column:
    """A number in (0, 1) that depends on the key and the seed only; null keys share one."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    whole = F.conv(F.substring(digest, 1, _DRAW_DIGITS), 16, 10).cast("long")
    return (whole + 0.5) / F.lit(float(16**_DRAW_DIGITS))


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...], share: float, most_epochs: int
) -> DataFrame:
    """``target`` for each row of ``sizes`` (columns source, source_size).

    Sources by code point, null last, take the weights in turn and share ``share`` of all
    sizes; what would go beyond ``most_epochs`` passes over a source is shared again
    among the others.  Only four sums a round reach the driver.
    """
    ordered = settle(
        sizes.orderBy(F.col("source").asc_nulls_last()).withColumn(
            "__id", F.monotonically_increasing_id()
        )
    )
    part = F.shiftright("__id", 33)
    earlier = Window.orderBy("part")
    starts = (
        ordered.groupBy(part.alias("part"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("first", F.sum("n").over(earlier) - F.col("n"))
        .drop("n")
    )
    place = F.col("first") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    turns = F.array(*[F.lit(float(w)) for w in weights])
    weighed = settle(
        ordered.join(F.broadcast(starts), part == F.col("part"))
        .withColumn("weight", F.get(turns, F.pmod(place, F.lit(len(weights)))))
        .withColumn("most", F.col("source_size") * most_epochs)
        .select("source", "source_size", "weight", "most")
    )
    total, all_weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    if total is None:
        return weighed.withColumn("target", F.lit(0.0)).drop("weight", "most")
    level, wanted = total * share / all_weight, total * share
    while True:
        above = F.col("most") < F.lit(level) * F.col("weight")
        capped, rest = weighed.agg(
            F.coalesce(F.sum(F.when(above, F.col("most"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)),
        ).first()
        if rest == 0:
            break
        raised = (wanted - capped) / rest
        if raised <= level:
            break
        level = raised
    target = F.least(F.col("most").cast("double"), F.lit(float(level)) * F.col("weight"))
    return weighed.withColumn("target", target).drop("weight", "most")


def _draws(docs: DataFrame, doc_id: str, text: str, quality: Column | None, seed: str) -> dict:
    value = F.col(text)
    weight = plain_share(value) if quality is None else quality
    draw = uniform_draw(F.coalesce(F.col(doc_id).cast("string"), value), seed)
    return {"__key": -F.log(draw) / weight, "__tie": F.xxhash64(value)}


def _bucket(buckets: int) -> Column:
    return F.floor(F.col("__key") / (F.col("__key") + 1) * buckets).cast("int")


class Mix:
    """The mix of ``docs``: how often each document is taken.

    Sources by code point, null last, take ``weights`` in turn and share ``share`` of all
    words; no source is passed over more than ``most_epochs`` times.  ``quality`` is the
    document weight (above 0), by default the squared share of plain characters.

    A document at the edge of a budget is taken when at least half of it fits, so a source
    misses its target by half a document at most.  A null source is a source of its own.
    Null and empty texts have size 0 and take nothing.  An empty table gives an empty mix.
    Columns of ``docs`` other than the three named are never looked at.

    Keys are counted in buckets, so no source is ever sorted whole: only the bucket in
    which its budget ends is put in order.
    """

    def __init__(
        self,
        docs: DataFrame,
        weights: tuple[float, ...] = (5, 2, 1),
        share: float = 1.0,
        most_epochs: int = 3,
        seed: str = "mix",
        quality: Column | None = None,
        doc_id: str = "doc_id",
        text: str = "text",
        source: str = "source",
    ):
        self.docs, self.doc_id, self.text, self.source = docs, doc_id, text, source
        self._drawn = _draws(docs, doc_id, text, quality, seed)
        rows = store(
            docs.select(
                F.col(doc_id).alias("doc_id"),
                F.col(source).alias("source"),
                word_count(F.col(text)).alias("size"),
                *[column.alias(name) for name, column in self._drawn.items()],
            ),
            "mix-rows",
        )
        self.buckets = rows.count() // _BUCKET_ROWS + 16
        self.rows = rows.withColumn("__bucket", _bucket(self.buckets))
        self.plans = self._plans(weights, share, most_epochs)

    def _plans(self, weights, share, most_epochs) -> DataFrame:
        """Per source: whole passes, the rest, and the bucket in which the rest ends."""
        sums = store(
            self.rows.groupBy("source", "__bucket").agg(F.sum("size").alias("size")), "mix-sums"
        )
        sizes = sums.groupBy("source").agg(F.sum("size").alias("source_size"))
        size, target = F.col("source_size"), F.col("target")
        budgets = (
            source_targets(sizes, weights, share, most_epochs)
            .withColumn("epochs", F.when(size > 0, F.floor(target / size)).otherwise(0).cast("long"))
            .withColumn("rest", target - F.col("epochs") * size)
            .withColumnRenamed("source", "__source")
        )
        upto = Window.partitionBy("source").orderBy("__bucket")
        before = F.sum("size").over(upto) - F.col("size")
        ends = (
            sums.withColumn("before", before)
            .join(budgets.select("__source", "rest"), F.col("source").eqNullSafe(F.col("__source")))
            .filter((F.col("before") < F.col("rest")) & (F.col("before") + F.col("size") >= F.col("rest")))
            .select(F.col("source").alias("__ends"), F.col("__bucket").alias("edge"), "before")
        )
        same = F.col("__source").eqNullSafe(F.col("__ends"))
        # Stored, so that the planner knows how few rows the sources are.
        return store(budgets.join(ends, same, "left").drop("__ends"), "mix-plans")

    def _planned(self, at_edge: bool) -> DataFrame:
        planned = self.rows.join(self.plans, F.col("source").eqNullSafe(F.col("__source")))
        edge = F.coalesce(F.col("__bucket") == F.col("edge"), F.lit(False))
        return planned.filter(edge if at_edge else ~edge)

    def _edge_rows(self) -> DataFrame:
        """The documents of the buckets in which budgets end, with their decision."""
        in_order = Window.partitionBy("source").orderBy("__key", "doc_id", "__tie")
        so_far = F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
        middle = (F.col("before") + so_far) * 2 - F.col("size")
        return self._planned(True).withColumn("chosen", middle <= F.col("rest") * 2)

    def taken(self) -> DataFrame:
        """One row per document: doc_id, source, size, source_size, target, times, taken.

        ``times`` is how often the mix takes the document, ``taken`` its words so taken.
        """
        below = F.coalesce(F.col("__bucket") < F.col("edge"), F.lit(False))
        chosen = self._planned(False).withColumn("chosen", below).unionByName(self._edge_rows())
        times = F.col("epochs") + F.col("chosen").cast("long")
        return chosen.select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            times.alias("times"),
            (times * F.col("size")).alias("taken"),
        )

    def documents(self) -> DataFrame:
        """The rows of ``docs``, each as often as the mix takes it.

        A document's key is compared with the last key that its source takes, so where the
        sources are few enough to broadcast, texts are not shuffled.  Rows equal in doc_id and text are taken or left together.
        """
        last = F.struct("__key", "doc_id", "__tie")
        lasts = (
            self._edge_rows()
            .filter("chosen")
            .groupBy(F.col("__source").alias("__of"))
            .agg(F.max(last).alias("__last"))
        )
        plans = self.plans.join(lasts, F.col("__source").eqNullSafe(F.col("__of")), "left").select(
            "__source", "epochs", "edge", "__last"
        )
        plans = store(plans.toDF("__source", "__epochs", "__edge", "__last"), "mix-lasts")
        drawn = self.docs.withColumns(self._drawn).withColumn("__bucket", _bucket(self.buckets))
        own = F.struct("__key", F.col(self.doc_id).alias("doc_id"), "__tie")
        inside = (F.col("__bucket") < F.col("__edge")) | (
            (F.col("__bucket") == F.col("__edge")) & (own <= F.col("__last"))
        )
        times = F.col("__epochs") + F.coalesce(inside, F.lit(False)).cast("int")
        copies = F.array_repeat(F.lit(0), times.cast("int"))
        return (
            drawn.join(plans, F.col(self.source).eqNullSafe(F.col("__source")))
            .withColumn("__copy", F.explode(copies))
            .select(*[F.col(f"`{c}`") for c in self.docs.columns])
        )


def duckdb_mix(table: str, most_epochs: int = 3, seed: str = "mix") -> str:
    """``Mix.taken`` with weights 5, 2, 1 as DuckDB SQL, every source sorted whole."""
    return f"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, coalesce(doc_id::VARCHAR, text, '') AS k FROM {table}
), drawn AS (
  SELECT doc_id, source, len(regexp_extract_all(t, '{WORD}'))::BIGINT AS size,
         -ln((('0x' || substr(md5('{seed}:' || k), 1, {_DRAW_DIGITS}))::BIGINT + 0.5) / 16.0::DOUBLE ** {_DRAW_DIGITS})
         / (((length(translate(t, '{_SYMBOLS}', '')) + 1.0::DOUBLE) / (length(t) + 1.0::DOUBLE))
            * ((length(translate(t, '{_SYMBOLS}', '')) + 1.0::DOUBLE) / (length(t) + 1.0::DOUBLE))) AS key
  FROM d
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM drawn GROUP BY source
), turns AS (
  SELECT source, source_size, {most_epochs} * source_size AS most,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sizes
), ranked AS (
  SELECT weight, most, row_number() OVER o AS place, (SELECT sum(source_size) FROM turns)::DOUBLE AS total,
         sum(most) OVER o - most AS capped,
         (SELECT sum(weight) FROM turns) - (sum(weight) OVER o - weight) AS rest
  FROM turns WINDOW o AS (ORDER BY most / weight, source)
), level AS (
  SELECT arg_min((total - capped) / rest, place) AS level FROM ranked
  WHERE (total - capped) / rest * weight <= most
), budgets AS (
  SELECT source AS s, source_size, least(most::DOUBLE, level * weight) AS target
  FROM turns, level
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM budgets
), ordered AS (
  SELECT doc_id, size, source_size, target, epochs, target - epochs * source_size AS rest,
         sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS so_far
  FROM drawn JOIN parts ON source IS NOT DISTINCT FROM s
)
SELECT doc_id, size, source_size, target,
       ((epochs + (2 * so_far - size <= 2 * rest)::BIGINT) * size)::BIGINT AS taken
FROM ordered"""
