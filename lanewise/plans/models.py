"""Training, evaluation and scoring of the delay classifier on flights."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window, functions as F

from ..functions import route_name
from ..operators.forest import read_forest, two_class_prediction
from ..operators.learning import (
    CATEGORIES,
    FEATURES,
    feature_importance,
    load_model,
    save_model,
    score,
    train_and_hold_out,
)
from ..operators.quality import area_under_roc, confusion
from ..operators.ranking import FrequencyIndex
from ..operators.sampling import hash_split
from ..session import new_folder
from .registry import register
from .standin import FLIGHT_TABLES, flights, once


def model_folder(spark, sf):
    """The classifier trained on 70 % of the flights and saved, once per application."""

    def fit():
        model, _ = train_and_hold_out(flights(spark, sf))
        path = new_folder(spark, "model")
        save_model(model, path)
        return path

    return once(spark, sf, "model", FLIGHT_TABLES, fit)


def trained(spark, sf):
    """The saved classifier, loaded once per application."""
    return once(
        spark, sf, "loaded model", FLIGHT_TABLES, lambda: load_model(model_folder(spark, sf))
    )


def _held_out(spark, sf):
    prepared = flights(spark, sf).withColumn("orig_dest", route_name())
    return hash_split(prepared, 0.7, "id", 5043)[1]


def _scored(spark, sf):
    return score(trained(spark, sf), _held_out(spark, sf))


def _string_index(spark, sf):
    df = flights(spark, sf)
    numbers = FrequencyIndex.fit(df, ["carrier", "dofW"])
    indexed = numbers.transform(df, unseen="error")
    return indexed.select("id", "carrier", "carrierIndexed", "dofW", "dofWIndexed")


register(
    "string_index",
    _string_index,
    """, c AS (SELECT carrier, (row_number() OVER (ORDER BY count(*) DESC, carrier) - 1)::DOUBLE
                      AS "carrierIndexed" FROM flights GROUP BY carrier),
         d AS (SELECT dofW, (row_number() OVER (ORDER BY count(*) DESC, dofW) - 1)::DOUBLE
                      AS "dofWIndexed" FROM flights GROUP BY dofW)
       SELECT id, carrier, "carrierIndexed", dofW, "dofWIndexed"
       FROM flights JOIN c USING (carrier) JOIN d USING (dofW)""",
)


def _string_index_many(spark, sf):
    """Columns whose values grow with the flights: the route on a day, and the flight itself."""
    df = flights(spark, sf).select("id", F.concat_ws("/", "src", "dst", "fldate").alias("day_route"))
    return FrequencyIndex.fit(df, ["day_route", "id"]).transform(df)


register(
    "string_index_many",
    _string_index_many,
    """, f AS (SELECT id, src || '/' || dst || '/' || fldate AS day_route FROM flights),
         r AS (SELECT day_route, (row_number() OVER (ORDER BY count(*) DESC, day_route) - 1)::DOUBLE
                      AS "day_routeIndexed" FROM f GROUP BY day_route),
         i AS (SELECT id, (row_number() OVER (ORDER BY count(*) DESC, id) - 1)::DOUBLE
                      AS "idIndexed" FROM f GROUP BY id)
       SELECT id, day_route, "day_routeIndexed", "idIndexed"
       FROM f JOIN r USING (day_route) JOIN i USING (id)""",
)


def _features(spark, sf):
    """The classifier's label and feature vector, spread into columns by feature name."""
    scored = _scored(spark, sf)
    values = vector_to_array("features")
    return scored.select(
        "id", "label", *[values[i].alias(name) for i, name in enumerate(FEATURES)]
    )


def _features_sql() -> str:
    """Index the training part's categories by frequency; unseen ones get the next number."""
    kept = "substr(md5('5043' || id), 1, 8) < 'b3333333'"
    ctes, joins, columns = [], [], []
    for i, category in enumerate(CATEGORIES):
        ctes.append(
            f""", x{i} AS (SELECT {category} AS k,
                   (row_number() OVER (ORDER BY count(*) DESC, {category}::varchar) - 1)::DOUBLE AS n
                 FROM scored WHERE {kept} GROUP BY {category})"""
        )
        joins.append(f"LEFT JOIN x{i} ON x{i}.k = s.{category}")
        columns.append(
            f'coalesce(x{i}.n, (SELECT count(*) FROM x{i})::DOUBLE) AS "{category}Indexed"'
        )
    columns += [f"{name}::DOUBLE AS {name}" for name in FEATURES[len(CATEGORIES) :]]
    return (
        f"{''.join(ctes)} SELECT s.id, s.label, {', '.join(columns)} FROM scored s"
        f" {' '.join(joins)} WHERE NOT {kept}"
    )


register("ml_features", _features, _features_sql())
_HELD_OUT = "NOT substr(md5('5043' || id), 1, 8) < 'b3333333'"


def _checked_scores(spark, sf):
    """The held-out flights; whether the model's probability and prediction are what its
    trees, compiled to expressions over the indexed columns, say."""
    forest = once(
        spark, sf, "compiled forest", FLIGHT_TABLES, lambda: read_forest(spark, model_folder(spark, sf))
    )
    own, late = F.col("own"), vector_to_array("probability")[1]
    same = (F.abs(late - own) < 1e-9) & (F.col("prediction") == two_class_prediction(own))
    scored = _scored(spark, sf).withColumn("own", forest.probability())
    return scored.select("id", "label", same.alias("agrees"))


register(
    "ml_score", _checked_scores, f"SELECT id, label, true AS agrees FROM scored WHERE {_HELD_OUT}"
)


def _checked_confusion(spark, sf):
    """Totals of the confusion report, and whether its cells and ratios add up."""
    report = confusion(_scored(spark, sf), by="label")
    cells = sum(
        F.col(c) for c in ("true_positive", "true_negative", "false_positive", "false_negative")
    )
    return report.select(
        "total",
        (F.abs(cells - 1) < 1e-9).alias("cells_add_up"),
        (F.col("correct") + F.col("wrong") == F.col("total")).alias("counts_add_up"),
    )


register(
    "ml_confusion",
    _checked_confusion,
    f"""SELECT count(*) AS total, true AS cells_add_up, true AS counts_add_up
        FROM scored WHERE {_HELD_OUT}""",
)


def held_out_auc(spark, sf):
    """Exact area under ROC of the forest's probabilities on the held-out flights."""
    scored = _scored(spark, sf).select("label", vector_to_array("probability")[1].alias("score"))
    return area_under_roc(scored)


register(
    "ml_auc",
    lambda spark, sf: held_out_auc(spark, sf).select(
        "positives", "negatives", F.col("auc").between(0.0, 1.0).alias("in_range")
    ),
    f"""SELECT count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives,
               true AS in_range
        FROM scored WHERE {_HELD_OUT}""",
)


def _checked_importances(spark, sf):
    """Names of the features, each with whether its importance stands in order."""
    listed = feature_importance(trained(spark, sf))
    every = Window.partitionBy()
    before = F.lag("importance", 1, 1.0).over(Window.orderBy(F.desc("importance"), "feature"))
    return listed.select(
        "feature",
        F.col("importance").between(0.0, before).alias("in_range"),
        (F.abs(F.sum("importance").over(every) - 1) < 1e-9).alias("sums_to_one"),
    )


register(
    "ml_feature_importance",
    _checked_importances,
    "SELECT unnest([{}]) AS feature, true AS in_range, true AS sums_to_one".format(
        ", ".join(f"'{name}'" for name in FEATURES)
    ),
)
