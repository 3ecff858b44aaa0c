"""How well a 0/1 prediction or a score matches a 0/1 label."""

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from ..session import store


def confusion(
    df: DataFrame,
    by: str = "prediction",
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """Counts and ratios of right and wrong predictions, in one pass over the table.

    The four cells are shares of *all* rows.  ``by`` says which column decides the
    cell of a wrong row: its prediction (1 is a false positive) or its label (0 is a
    false positive).  The two differ only for values other than 0 and 1.  A row
    lacking either value is in the total but in no cell.
    """
    if by not in ("prediction", "label"):
        raise ValueError("by must be 'prediction' or 'label'")
    y, p = F.col(label), F.col(prediction)
    same, differ = y == p, y != p
    decides = p if by == "prediction" else y
    said_yes = (p == 1.0) if by == "prediction" else (y == 0.0)
    said_no = (p == 0.0) if by == "prediction" else (y == 1.0)

    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(same).alias("correct"),
        F.count_if(differ).alias("wrong"),
        F.count_if(same & (decides == 1.0)).alias("true_positive"),
        F.count_if(same & (decides == 0.0)).alias("true_negative"),
        F.count_if(differ & said_yes).alias("false_positive"),
        F.count_if(differ & said_no).alias("false_negative"),
    )
    share = lambda name: F.col(name) / F.expr("nullif(total, 0)")
    return counts.select(
        "total",
        "correct",
        "wrong",
        share("correct").alias("ratio_correct"),
        share("wrong").alias("ratio_wrong"),
        *[
            share(cell).alias(cell)
            for cell in ("true_positive", "true_negative", "false_positive", "false_negative")
        ],
    )


def area_under_roc(
    df: DataFrame, score: str = "score", label: str = "label", ranges: int | None = None
) -> DataFrame:
    """Exact area under the ROC curve of ``score`` against a 0/1 label, ties halved.

    Equal scores are first counted together.  The distinct scores are then cut into
    ``ranges`` consecutive ranges (by default one for every hundred thousand), so the running count of negatives is a window
    inside each range plus the total of the ranges below: no task sees all scores.
    Rows without a score or label are left out; the area is null when a class is
    missing.
    """
    scored = (
        df.select(F.col(score).cast("double").alias("s"), F.col(label).cast("double").alias("y"))
        .filter(F.col("s").isNotNull() & ~F.isnan("s") & F.col("y").isin(0.0, 1.0))
        .groupBy("s")
        .agg(F.count_if(F.col("y") == 1.0).alias("pos"), F.count_if(F.col("y") == 0.0).alias("neg"))
    )
    scored = store(scored, "scores")

    # At most ``ranges`` cut points reach the driver.
    ranges = ranges or 8 + scored.count() // 100_000
    quantiles = scored.approxQuantile("s", [i / ranges for i in range(1, ranges)], 0.5 / ranges)
    cuts = sorted({q for q in quantiles if math.isfinite(q)})
    if cuts:
        splits = [-math.inf, *cuts, math.inf]
        ranged = Bucketizer(inputCol="s", outputCol="r", splits=splits).transform(scored)
    else:
        ranged = scored.withColumn("r", F.lit(0.0))

    # One row per range, so these two windows are over at most ``ranges`` rows.
    below = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("r")
        .agg(F.sum("neg").alias("range_neg"))
        .select("r", F.coalesce(F.sum("range_neg").over(below), F.lit(0)).alias("neg_before"))
    )
    within = Window.partitionBy("r").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    running = ranged.withColumn("neg_within", F.coalesce(F.sum("neg").over(within), F.lit(0)))
    won = F.col("pos") * (F.col("neg_before") + F.col("neg_within") + F.col("neg") / 2)
    return (
        running.join(F.broadcast(offsets), "r")
        .agg(
            F.sum("pos").alias("positives"),
            F.sum("neg").alias("negatives"),
            F.sum(won).alias("won"),
        )
        .select(
            "positives",
            "negatives",
            (
                F.col("won")
                / F.expr("nullif(cast(positives as double) * cast(negatives as double), 0)")
            ).alias("auc"),
        )
    )
