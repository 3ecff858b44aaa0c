"""Delay classification with ``pyspark.ml``: train, evaluate, save, score."""

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import bucketize, route_name
from ..functions.buckets import CLASS_SPLITS, LABEL_SPLITS
from ..session import ROWS_PER_SPLIT, setting
from .sampling import hash_split, stratified_sample

# The columns the classifier reads, and the order of its features.
CATEGORIES = ("carrier", "src", "dst", "dofW", "orig_dest")
FEATURES = (
    "carrierIndexed", "dstIndexed", "srcIndexed", "dofWIndexed", "orig_destIndexed",
    "crsdephour", "crsdeptime", "crsarrtime", "crselapsedtime", "dist",
)
# Columns of the scored frame that are not stored.
MODEL_COLUMNS = ("features", "rawPrediction", "probability")
# The forest's size.
TREES, LEAST_BINS, MAX_DEPTH = 10, 1000, 8
# Category values are model state on the driver; more than this is no category.
MAX_CATEGORIES = 1_000_000


def _read_columns(df: DataFrame, categories: Sequence[str], features: Sequence[str]) -> list[str]:
    """The columns of ``df`` that the model's stages read."""
    read = {*categories, *features}
    return [name for name in df.columns if name in read]


def trainable(
    df: DataFrame,
    categories: Sequence[str] = CATEGORIES,
    features: Sequence[str] = FEATURES,
    delay: str = "depdelay",
    splits: Sequence[float] = LABEL_SPLITS,
) -> DataFrame:
    """The rows that can teach: every category and feature is there (no null, no NaN) and
    the delay lies in the label's splits.  Early departures, under 0, have no label."""
    whole = bucketize(delay, splits).isNotNull()
    for name, kind in df.dtypes:
        if name in _read_columns(df, categories, features):
            value = F.col(f"`{name}`")
            whole = whole & value.isNotNull()
            if kind in ("double", "float"):
                whole = whole & ~F.isnan(value)
    return df.filter(whole)


def category_index(categories: Sequence[str] = CATEGORIES, unseen: str = "keep") -> StringIndexer:
    """Stage numbering each category column's values, the most frequent 0.

    ``unseen="keep"`` gives values not met in training one number more; ``"error"``
    raises on them, which would end a streaming query.
    """
    return StringIndexer(
        inputCols=list(categories),
        outputCols=[f"{c}Indexed" for c in categories],
        handleInvalid=unseen,
    )


def train(
    training: DataFrame,
    categories: Sequence[str] = CATEGORIES,
    features: Sequence[str] = FEATURES,
    delay: str = "depdelay",
    splits: Sequence[float] = LABEL_SPLITS,
    trees: int = TREES,
    max_bins: int | None = None,
    max_depth: int = MAX_DEPTH,
    seed: int = 36,
    unseen: str = "keep",
) -> PipelineModel:
    """Fit category numbering, label, feature vector and random forest.

    Rows that lack a feature or have no usable delay are set aside (see ``trainable``).
    The forest's bins are the larger of 1000 and the widest category, unless
    ``max_bins`` asks for more.  The category values are model state and reach the
    driver; about how many there are is counted first, without collecting them.
    (``FrequencyIndex`` numbers columns of more values, in tables.)

    The forest keeps its rows, some 170 bytes each, and reads them once a level.  They are
    numbered and dealt evenly before that, so a task holds at most
    ``spark.lanewise.skew.rowsPerSplit`` of them whatever the files or values are.
    """
    training = trainable(training, categories, features, delay, splits)
    counts = training.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.approx_count_distinct(c).alias(c) for c in categories]
    ).first()
    for name in categories:
        if counts[name] > MAX_CATEGORIES:
            raise ValueError(f"{name} has about {counts[name]} values, too many for a category")
    indexer = category_index(categories, unseen).fit(training)
    widest = max(len(values) for values in indexer.labelsArray) + (unseen == "keep")
    max_bins = max(max_bins or LEAST_BINS, widest)

    label = Bucketizer(inputCol=delay, outputCol="label", splits=list(splits))
    vector = VectorAssembler(inputCols=list(features), outputCol="features")
    forest = RandomForestClassifier(
        labelCol="label",
        featuresCol="features",
        numTrees=trees,
        maxBins=max_bins,
        maxDepth=max_depth,
        seed=seed,
    )
    numbered = label.transform(indexer.transform(training)).select("label", *dict.fromkeys(features))
    # Kept on disk: the forest plans its input several times, and would deal it each time.
    dealt = numbered.repartition(_parts(training.sparkSession, counts["__rows"]))
    dealt = dealt.persist(StorageLevel.DISK_ONLY)
    try:
        return PipelineModel([indexer, label, vector, forest.fit(vector.transform(dealt))])
    finally:
        dealt.unpersist()


def _parts(spark: SparkSession, rows: int) -> int:
    """Into how many parts so many training rows are dealt; many parts go evenly on all cores."""
    cores = spark.sparkContext.defaultParallelism
    most = math.ceil(rows / setting(spark, ROWS_PER_SPLIT))
    parts = max(most, min(cores, math.ceil(rows / 10_000)), 1)
    return parts if parts <= cores else cores * math.ceil(parts / cores)


def score(model: PipelineModel, df: DataFrame, drop: Sequence[str] = ()) -> DataFrame:
    """Add the model's columns to a batch or streaming frame; ``drop`` some of them.

    Pass ``MODEL_COLUMNS`` to leave what a table can store.
    """
    return model.transform(df).drop(*drop)


def score_rows(
    model: PipelineModel,
    rows: DataFrame,
    delay: str = "depdelay",
    splits: Sequence[float] = LABEL_SPLITS,
    categories: Sequence[str] = CATEGORIES,
    features: Sequence[str] = FEATURES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """All rows, batch or streaming, with ``label`` and ``prediction``; none ends the job.

    A row that lacks something the model reads (null or NaN) gets a null prediction, and one
    without a usable delay a null label; columns of these names are replaced.  ``keep``
    names further columns of the model to return, null like the prediction.
    """
    rows = rows.drop("label", "prediction", *keep)
    # The model's stages refuse such rows: they are shown stand-ins, and keep their own.
    read = _read_columns(rows, categories, features)
    usable = bucketize(delay, splits).isNotNull()
    whole, shown = F.lit(True), {}
    for name, kind in rows.dtypes:
        if name in read:
            value = F.col(f"`{name}`")
            there = value.isNotNull() & ~F.isnan(value) if kind in ("double", "float") else value.isNotNull()
            whole = whole & there
            shown[name] = F.when(there, value).otherwise(F.lit("" if kind == "string" else 0).cast(kind))
    shown[delay] = F.when(usable, F.col(delay)).otherwise(F.lit(float(splits[0])))
    marked = rows.withColumns({"__row": F.struct("*"), "__whole": whole, "__usable": usable})
    scored = score(model, marked.withColumns(shown), [c for c in MODEL_COLUMNS if c not in keep])
    return scored.select(
        "__row.*",
        F.when(F.col("__usable"), F.col("label")).alias("label"),
        F.when(F.col("__whole"), F.col("prediction")).alias("prediction"),
        *[F.when(F.col("__whole"), F.col(name)).alias(name) for name in keep],
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_importance(model: PipelineModel) -> DataFrame:
    """The forest's features by importance, the greatest first."""
    forest = model.stages[-1]
    names = next(s for s in reversed(model.stages) if isinstance(s, VectorAssembler)).getInputCols()
    rows = list(zip(names, (float(v) for v in forest.featureImportances.toArray())))
    listed = SparkSession.active().createDataFrame(rows, "feature string, importance double")
    return listed.orderBy(F.desc("importance"), "feature")


def evaluate_auc(predictions: DataFrame) -> float:
    """Area under ROC of the scored frame's ``rawPrediction``.

    The evaluator reads its input several times; keeping its two columns saves scoring
    the rows again.
    """
    kept = predictions.select("label", "rawPrediction").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return BinaryClassificationEvaluator().evaluate(kept)
    finally:
        kept.unpersist()


def train_and_hold_out(
    flights: DataFrame,
    fraction: float = 0.7,
    seed: int = 5043,
    balance: dict[float, float] | None = None,
    key: str = "id",
    **options,
) -> tuple[PipelineModel, DataFrame]:
    """The whole training job: add the route, split by key, fit; also the rows held out.

    ``balance`` thins the training rows by delay class, for instance ``{0.0: 0.13,
    1.0: 1.0}``.
    """
    prepared = flights.withColumn("orig_dest", route_name())
    training, held_out = hash_split(prepared, fraction, key, seed)
    if balance is not None:
        delayed = training.withColumn("delayed", bucketize("depdelay", CLASS_SPLITS))
        # Another salt than the split's: with the same one both would look at one number.
        training = stratified_sample(delayed, "delayed", balance, key, f"{seed}-balance")
    return train(training, **options), held_out
