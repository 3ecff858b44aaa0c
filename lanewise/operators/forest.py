"""Decision forests as Spark expressions, and what their features are worth.

A forest, hand-made or read from a saved classifier, becomes nested ``when`` expressions over
feature columns.  Scoring is then a projection: no model object at the executors, no vectors,
and Catalyst reads only the columns that the trees look at.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import store
from .skew import broadcast_if, fits_in_memory


@dataclass(frozen=True)
class Leaf:
    """Training rows of each class that reached the leaf."""

    counts: tuple[float, ...]

    def shares(self) -> list[float]:
        total = sum(self.counts)
        return [c / total if total else 0.0 for c in self.counts]


@dataclass(frozen=True)
class Split:
    """Goes left where the feature is at most ``threshold``, or is one of ``values``."""

    feature: str
    left: Split | Leaf
    right: Split | Leaf
    threshold: float | None = None
    values: tuple[float | str, ...] | None = None

    def goes_left(self, feature: Column) -> Column:
        if self.values is None:
            return feature <= F.lit(self.threshold)
        return feature.isin(list(self.values)) if self.values else F.lit(False)


Node = Split | Leaf


@dataclass(frozen=True)
class Forest:
    """Trees that vote with their leaves' class shares, each tree alike."""

    trees: tuple[Node, ...]
    classes: int = 2

    def features(self) -> list[str]:
        """The features that some split reads."""
        found: dict[str, None] = {}
        nodes = list(self.trees)
        while nodes:
            node = nodes.pop()
            if isinstance(node, Split):
                found[node.feature] = None
                nodes += [node.right, node.left]
        return sorted(found)

    def votes(self, which: int, columns: Mapping[str, Column] | None = None) -> Column:
        """Sum over the trees of the share of class ``which``."""
        columns = columns or {}

        def compiled(node: Node) -> Column:
            if isinstance(node, Leaf):
                return F.lit(node.shares()[which])
            feature = columns.get(node.feature, F.col(f"`{node.feature}`"))
            return F.when(node.goes_left(feature), compiled(node.left)).otherwise(compiled(node.right))

        votes = [compiled(tree) for tree in self.trees]
        return sum(votes[1:], votes[0])

    def probability(self, which: int = 1, columns: Mapping[str, Column] | None = None) -> Column:
        """Probability of class ``which``; null where a feature that some tree reads is null.

        ``columns`` gives the expression of a feature, by default the column of its name.
        """
        known = F.lit(True)
        for name in self.features():
            known = known & (columns or {}).get(name, F.col(f"`{name}`")).isNotNull()
        return F.when(known, self.votes(which, columns) / F.lit(float(len(self.trees))))


def two_class_prediction(probability: Column) -> Column:
    """The class of greater probability, 0 where they are equal; null stays null."""
    return F.when(probability > 0.5, 1.0).when(probability.isNotNull(), 0.0)


def read_forest(spark: SparkSession, path: str, stage: str = "RandomForestClassifier") -> Forest:
    """The forest of a pipeline saved at ``path``, by Spark's model format.

    Read are the nodes of the stage whose folder name holds ``stage`` and, of the pipeline's
    vector stage, the feature names.  A forest is a model: its nodes, a few thousand rows,
    are what reaches the driver.
    """
    from .learning import load_model

    model = load_model(path)
    names = next(s for s in reversed(model.stages) if isinstance(s, VectorAssembler)).getInputCols()
    classes = model.stages[-1].numClasses
    nodes = spark.read.parquet(f"{path.rstrip('/')}/stages/*{stage}*/data")
    trees: dict[int, dict[int, object]] = {}
    for row in nodes.select("treeID", "nodeData.*").toLocalIterator():
        trees.setdefault(row.treeID, {})[row.id] = row

    def built(tree: dict, number: int) -> Node:
        row = tree[number]
        if row.leftChild < 0:
            return Leaf(tuple(row.impurityStats))
        left, right = built(tree, row.leftChild), built(tree, row.rightChild)
        feature, limits = names[row.split.featureIndex], tuple(row.split.leftCategoriesOrThreshold)
        if row.split.numCategories < 0:
            return Split(feature, left, right, threshold=limits[0])
        return Split(feature, left, right, values=limits)

    return Forest(tuple(built(trees[number], 0) for number in sorted(trees)), classes)


#: Rows among which a feature's values change places, about.
_MIX_ROWS = 1_000
#: Rows of a bucket that one list holds, about.
_RANGE_ROWS = 5_000
#: Buckets whose first rows are copied to every task at most.
_FEW = 10_000


def permutation_importance(
    df: DataFrame,
    predict: Callable[[Mapping[str, Column]], Column],
    features: Sequence[str],
    label: str = "label",
    key: str = "id",
    buckets: int | None = None,
) -> DataFrame:
    """``feature``, ``correct`` and ``loss`` of accuracy when the feature's values are moved.

    ``predict`` turns feature expressions into a predicted label.  Rows are put into
    ``buckets`` (by default of a thousand rows) and into an order by hashes of their key;
    feature number j takes its value from the row j + 1 places on, in a circle.  So every
    feature keeps its values but loses its tie with the label, reruns move alike, and the
    table is shuffled once for all features.  The first row, with a null feature, is the
    unchanged accuracy.  Rows that lack label or key are left out; a bucket of one row
    moves nothing.
    """
    rows = df.select(F.col(key).alias("__key"), F.col(label).alias("__label"), *features)
    rows = rows.filter(F.col("__key").isNotNull() & F.col("__label").isNotNull())
    number = rows.count()
    if buckets is None:
        buckets = math.ceil(number / _MIX_ROWS) or 1
    digest = F.md5(F.col("__key").cast("string").cast("binary"))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    # A bucket is cut at fixed places of its order into ranges of some thousand rows.  What a
    # row takes from beyond its range stands in the heads of the ranges that follow.
    ranges = max(1, number // (buckets * _RANGE_ROWS))
    at = F.conv(F.substring(digest, 9, 8), 16, 10).cast("long")
    rows = rows.withColumns(
        {
            "__bucket": F.pmod(place, F.lit(buckets)),
            "__range": F.floor(at * ranges / (1 << 32)).cast("int"),
            "__place": F.substring(digest, 9, 24),
        }
    )
    together = F.sort_array(F.collect_list(F.struct("__place", "__key", "__label", *features)))
    grouped = rows.groupBy("__bucket", "__range").agg(together.alias("rows"))
    far = len(features)
    heads = grouped.select("__bucket", "__range", F.slice("rows", 1, far).alias("head"))
    heads = store(heads, "heads")
    # Every range that is there has a row, so as many ranges as rows are wanted are enough; the
    # bucket's first ranges follow its last, once or, in a small bucket, again and again.
    before = Window.partitionBy("__bucket").orderBy("__range")
    some = heads.withColumn("__number", F.row_number().over(before)).filter(F.col("__number") <= far)
    first = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("__number", "head"))), lambda x: x["head"]))
    first = some.groupBy("__bucket").agg(F.slice(first, 1, far).alias("first"))
    around = F.slice(F.flatten(F.array_repeat("first", far)), 1, far)
    first = first.select(F.col("__bucket").alias("__of"), around.alias("first"))
    following = F.flatten(F.collect_list("head").over(before.rowsBetween(1, far)))
    tails = heads.select("__bucket", "__range", following.alias("next"))
    tails = tails.join(F.broadcast(first) if buckets <= _FEW else first, F.col("__bucket") == F.col("__of"))
    tails = tails.select(
        F.col("__bucket").alias("__of"),
        F.col("__range").alias("__at"),
        F.slice(F.concat("next", "first"), 1, far).alias("next"),
    )
    same = (F.col("__bucket") == F.col("__of")) & (F.col("__range") == F.col("__at"))
    grouped = grouped.join(broadcast_if(tails, fits_in_memory(tails)), same)
    grouped = grouped.select("rows", F.concat("rows", "next").alias("reached"))

    def from_row(name: str, step: int) -> Column:
        return F.slice(F.col("reached").getField(name), step + 1, F.size("rows"))

    moved = grouped.select(
        F.explode(F.arrays_zip("rows", *[from_row(name, j + 1).alias(f"m{j}") for j, name in enumerate(features)])).alias("z")
    )
    # One row per case, the unchanged one first: a single small prediction then serves all.
    which = F.explode(F.sequence(F.lit(0), F.lit(len(features)))).alias("__which")
    cases = moved.select("z", which)
    shown = {
        name: F.when(F.col("__which") == j + 1, F.col(f"z.m{j}")).otherwise(F.col(f"z.rows.`{name}`"))
        for j, name in enumerate(features)
    }
    cases = cases.select("__which", F.col("z.rows.__label").alias("__label"), *[c.alias(n) for n, c in shown.items()])
    hit = predict({name: F.col(f"`{name}`") for name in features}) == F.col("__label")
    hits = cases.groupBy("__which").agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("hits"))
    of = lambda i, value: F.coalesce(F.max(F.when(F.col("__which") == i, F.col(value))), F.lit(0))
    counts = hits.agg(of(0, "n").alias("n"), *[of(i, "hits").alias(f"c{i}") for i in range(len(features) + 1)])
    right = [None, *features]
    listed = F.array(
        *[F.struct(F.lit(name).cast("string").alias("feature"), F.col(f"c{i}").alias("hits")) for i, name in enumerate(right)]
    )
    share = F.col("f.hits") / F.expr("nullif(n, 0)")
    return counts.select("n", "c0", F.explode(listed).alias("f")).select(
        F.col("f.feature").alias("feature"),
        share.alias("correct"),
        ((F.col("c0") - F.col("f.hits")) / F.expr("nullif(n, 0)")).alias("loss"),
    )
