"""A hand-made forest over flights: scores, quality and importances that SQL can state."""

from pyspark.sql import functions as F

from ..operators.forest import (
    Forest,
    Leaf,
    Split,
    permutation_importance,
    two_class_prediction,
)
from ..operators.quality import area_under_roc, confusion
from .registry import register
from .standin import scored_flights

#: Three small trees over the flights' columns.
RULES = Forest(
    (
        Split(
            "crsdephour",
            Leaf((90.0, 10.0)),
            Split("carrier", Leaf((35.0, 65.0)), Leaf((60.0, 40.0)), values=("Brand#11", "Brand#23", "Brand#42")),
            threshold=11.0,
        ),
        Split(
            "dofW",
            Split("dist", Leaf((80.0, 20.0)), Leaf((30.0, 70.0)), threshold=900.0),
            Leaf((25.0, 75.0)),
            values=(1.0, 2.0, 3.0, 4.0),
        ),
        Split("arrdelay", Leaf((95.0, 5.0)), Leaf((10.0, 90.0)), threshold=35.0),
    )
)


def _rules_sql(**columns: str) -> str:
    """The same three trees, written out; ``columns`` stand in for some of theirs."""
    names = {name: name for name in ("crsdephour", "carrier", "dofW", "dist", "arrdelay")} | columns
    return """(CASE WHEN {crsdephour} <= 11 THEN 0.1::DOUBLE
                   WHEN {carrier} IN ('Brand#11', 'Brand#23', 'Brand#42') THEN 0.65::DOUBLE ELSE 0.4::DOUBLE END
              + CASE WHEN {dofW} NOT IN (1, 2, 3, 4) THEN 0.75::DOUBLE
                     WHEN {dist} <= 900 THEN 0.2::DOUBLE ELSE 0.7::DOUBLE END
              + CASE WHEN {arrdelay} <= 35 THEN 0.05::DOUBLE ELSE 0.9::DOUBLE END) / 3.0::DOUBLE""".format(**names)


_SAID = f"""said AS (SELECT id, label, p AS probability, CASE WHEN p > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
                     FROM (SELECT id, label, {_rules_sql()} AS p FROM scored))"""


def _said(spark, sf):
    scored = scored_flights(spark, sf).withColumn("probability", RULES.probability())
    return scored.select("id", "label", "probability", two_class_prediction(F.col("probability")).alias("prediction"))


register("forest_score", _said, f", {_SAID} SELECT * FROM said")
register(
    "forest_confusion",
    lambda spark, sf: confusion(_said(spark, sf), by="label"),
    f""", {_SAID}
       SELECT count(*) AS total,
              count(*) FILTER (label = prediction) AS correct,
              count(*) FILTER (label <> prediction) AS wrong,
              count(*) FILTER (label = prediction) / count(*) AS ratio_correct,
              count(*) FILTER (label <> prediction) / count(*) AS ratio_wrong,
              count(*) FILTER (prediction = 1 AND label = 1) / count(*) AS true_positive,
              count(*) FILTER (prediction = 0 AND label = 0) / count(*) AS true_negative,
              count(*) FILTER (prediction = 1 AND label = 0) / count(*) AS false_positive,
              count(*) FILTER (prediction = 0 AND label = 1) / count(*) AS false_negative
       FROM said""",
)
register(
    "forest_auc",
    lambda spark, sf: area_under_roc(_said(spark, sf), score="probability").select(
        "positives", "negatives", F.round("auc", 9).alias("auc")
    ),
    f""", {_SAID}, s AS (
         SELECT probability, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
         FROM said GROUP BY probability
       ), below AS (
         SELECT *, coalesce(sum(neg) OVER (ORDER BY probability ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower
         FROM s
       )
       SELECT sum(pos)::BIGINT AS positives, sum(neg)::BIGINT AS negatives,
              round(sum(pos * (lower + neg / 2.0::DOUBLE))::DOUBLE / (sum(pos)::DOUBLE * sum(neg)::DOUBLE), 9) AS auc
       FROM below""",
)

#: Rows change places within so many buckets.
_BUCKETS = 64
_MOVED = ("crsdephour", "carrier", "dofW", "dist", "arrdelay")


def _importance(spark, sf):
    """What the accuracy loses when a feature's values change places among the rows."""
    predict = lambda columns: two_class_prediction(RULES.probability(columns=columns))
    moved = permutation_importance(scored_flights(spark, sf), predict, _MOVED, buckets=_BUCKETS)
    return moved.select(F.coalesce("feature", F.lit("none")).alias("feature"), "correct", "loss")


def _importance_sql() -> str:
    own = "CASE WHEN {} > 0.5 THEN 1 ELSE 0 END"
    counts = ["count(*) FILTER (a.label = " + own.format(_rules_sql(**{c: f"a.{c}" for c in _MOVED})) + ") AS c0"]
    joins = []
    for j, name in enumerate(_MOVED):
        columns = {c: f"a.{c}" for c in _MOVED} | {name: f"m{j}.{name}"}
        counts.append(f"count(*) FILTER (a.label = {own.format(_rules_sql(**columns))}) AS c{j + 1}")
        joins.append(f"JOIN r m{j} ON m{j}.bucket = a.bucket AND m{j}.place = (a.place + {j + 1}) % a.n")
    listed = " UNION ALL ".join(
        f"SELECT '{name}' AS feature, c{j} / n AS correct, (c0 - c{j}) / n AS loss FROM totals"
        for j, name in enumerate(("none", *_MOVED))
    )
    return f""", h AS (SELECT *, md5(id) AS h, ('0x' || substr(md5(id), 1, 8))::BIGINT % {_BUCKETS} AS bucket FROM scored),
      r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY substr(h, 9, 24), id) - 1 AS place,
                   count(*) OVER (PARTITION BY bucket) AS n FROM h),
      totals AS (SELECT count(*) AS n, {', '.join(counts)} FROM r a {' '.join(joins)})
      {listed}"""


register("forest_importance", _importance, _importance_sql())

