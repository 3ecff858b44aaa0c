"""Forests as expressions, importances, category numbers and dirty rows."""

import random

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lanewise.functions import route_name
from lanewise.operators import learning
from lanewise.operators.forest import (
    Forest,
    Leaf,
    Split,
    permutation_importance,
    read_forest,
    two_class_prediction,
)
from lanewise.operators.ranking import FrequencyIndex, numbered
from lanewise.plans.standin import flights

SF = "/root/testdata/sf0.001"
NAN = float("nan")

SMALL = Forest(
    (
        Split("x", Leaf((1.0, 3.0)), Leaf((4.0, 0.0)), threshold=2.0),
        Split("c", Leaf((0.0, 5.0)), Split("x", Leaf((1.0, 1.0)), Leaf((0.0, 0.0)), threshold=5.0), values=("a", "b")),
    )
)


def walk(node, row):
    while isinstance(node, Split):
        value = row[node.feature]
        left = value <= node.threshold if node.values is None else value in node.values
        node = node.left if left else node.right
    return node.shares()[1]


class TestForest:
    def test_hand_made(self, spark):
        rows = [(x, c) for x in (1.0, 2.0, 2.5, 5.0, 6.0) for c in ("a", "b", "z")]
        df = spark.createDataFrame([*rows, (None, "a"), (1.0, None)], "x double, c string")
        got = df.select("x", "c", SMALL.probability().alias("p"), two_class_prediction(SMALL.probability()).alias("y")).collect()
        for r in got:
            if r.x is None or r.c is None:
                assert r.p is None and r.y is None
            else:
                want = sum(walk(tree, {"x": r.x, "c": r.c}) for tree in SMALL.trees) / 2
                assert r.p == want and r.y == float(want > 0.5)

    def test_reads_only_what_the_trees_read(self):
        assert SMALL.features() == ["c", "x"]

    def test_other_expressions_for_features(self, spark):
        df = spark.createDataFrame([(1.0, "z", 9.0)], "x double, c string, other double")
        assert df.select(SMALL.probability(columns={"x": F.col("other")})).first()[0] == 0.0

    def test_trained_forest_says_what_its_model_says(self, spark, folder):
        model, held = learning.train_and_hold_out(flights(spark, SF), trees=4, max_depth=6)
        learning.save_model(model, folder)
        forest = read_forest(spark, folder)
        assert len(forest.trees) == 4 and set(forest.features()) <= set(learning.FEATURES)
        scored = learning.score(model, held).select(
            vector_to_array("probability")[1].alias("p"), "prediction", forest.probability().alias("own")
        )
        rows = scored.withColumn("said", two_class_prediction(F.col("own"))).collect()
        assert rows and all(abs(r.p - r.own) < 1e-9 and r.prediction == r.said for r in rows)
        # Another forest is told apart.
        wrong = Forest(forest.trees[:-1])
        assert learning.score(model, held).filter(F.abs(vector_to_array("probability")[1] - wrong.probability()) > 1e-9).count()

    def test_scoring_is_native(self, spark):
        df = spark.range(5).select(F.col("id").cast("double").alias("x"), F.lit("a").alias("c"))
        assert "Python" not in df.select(SMALL.probability())._jdf.queryExecution().executedPlan().toString()


class TestPermutationImportance:
    def test_brute_force(self, spark):
        import hashlib

        rng = random.Random(2)
        rows = [(f"k{i}", float(rng.randrange(4)), rng.choice("abz"), float(rng.random() < 0.5)) for i in range(80)]
        df = spark.createDataFrame([*rows, (None, 1.0, "a", 1.0), ("lost", 1.0, "a", None)], "id string, x double, c string, label double")
        predict = lambda columns: two_class_prediction(SMALL.probability(columns=columns))
        got = {r.feature: r for r in permutation_importance(df, predict, ["x", "c"], buckets=5).collect()}
        digest = lambda key: hashlib.md5(key.encode()).hexdigest()
        by = {}
        for row in rows:
            by.setdefault(int(digest(row[0])[:8], 16) % 5, []).append(row)
        hits = {None: 0, "x": 0, "c": 0}
        for bucket in by.values():
            bucket.sort(key=lambda r: (digest(r[0])[8:], r[0]))
            for i, row in enumerate(bucket):
                for j, moved in ((None, None), (0, "x"), (1, "c")):
                    values = {"x": row[1], "c": row[2]}
                    if moved:
                        values[moved] = bucket[(i + j + 1) % len(bucket)][1 + j]
                    p = sum(walk(t, values) for t in SMALL.trees) / 2
                    hits[moved] += float(p > 0.5) == row[3]
        assert {f: round(r.correct * 80) for f, r in got.items()} == hits
        assert got["x"].loss == pytest.approx((hits[None] - hits["x"]) / 80)

    def test_a_feature_that_tells_all(self, spark):
        df = spark.range(3000).select(
            F.col("id").cast("string"), (F.col("id") % 2).cast("double").alias("x"), F.lit("q").alias("c"),
            (F.col("id") % 2 == 0).cast("double").alias("label"),
        )
        known = Forest((Split("x", Leaf((0.0, 1.0)), Leaf((1.0, 0.0)), threshold=0.5),))
        predict = lambda columns: two_class_prediction(known.probability(columns=columns))
        got = {r.feature: r for r in permutation_importance(df, predict, ["x", "c"]).collect()}
        assert got[None].correct == 1.0 and got["c"].loss == 0.0 and 0.4 < got["x"].loss < 0.6


class TestNumbers:
    @pytest.mark.parametrize("run", [7, 20_000])
    def test_numbered(self, spark, run):
        rng = random.Random(4)
        rows = [(rng.choice([None, "hot", "hot", "b"]), rng.randrange(40), i) for i in range(200)]
        df = spark.createDataFrame(rows, "g string, v long, `a.b` long")
        got = numbered(df, [F.desc("v"), "`a.b`"], ["g"], run_rows=run).collect()
        for group in (None, "hot", "b"):
            want = sorted((r for r in rows if r[0] == group), key=lambda r: (-r[1], r[2]))
            have = sorted((tuple(r) for r in got if r.g == group), key=lambda r: r[3])
            assert [r[:3] for r in have] == want and [r[3] for r in have] == list(range(len(want)))
        whole = numbered(df, ["v", "`a.b`"], run_rows=run).collect()
        assert sorted(r.rank for r in whole) == list(range(200))

    def test_empty(self, spark):
        assert numbered(spark.range(0), ["id"]).isEmpty()

    def test_same_numbers_as_the_indexer(self, spark):
        rng = random.Random(6)
        df = spark.createDataFrame([(rng.choice("aabbbcde"), rng.randrange(12)) for _ in range(300)], "c string, n int")
        got = FrequencyIndex.fit(df, ["c", "n"]).transform(df)
        model = StringIndexer(inputCols=["c", "n"], outputCols=["wc", "wn"]).fit(df)
        assert model.transform(got).filter("wc <> cIndexed or wn <> nIndexed").isEmpty()

    def test_unseen(self, spark, no_broadcast):
        index = FrequencyIndex.fit(spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string"), ["c"])
        df = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
        number = lambda unseen: sorted(r.cIndexed for r in index.transform(df, unseen).collect())
        assert number("keep") == [0.0, 2.0, 2.0]
        assert index.transform(df, "null").filter("cIndexed is null").count() == 2
        with pytest.raises(Exception, match="unseen value of c"):
            index.transform(df, "error").collect()
        with pytest.raises(ValueError):
            index.transform(df, "other")


@pytest.fixture(scope="module")
def dirty(spark):
    """Real flights, of which some lack a feature, have NaN, or left early."""
    df = flights(spark, SF)
    kind = F.pmod(F.xxhash64("id"), F.lit(40))
    return df.withColumns(
        {
            "depdelay": F.when(kind == 0, -4.0).when(kind == 1, None).when(kind == 2, NAN).otherwise(F.col("depdelay")),
            "dist": F.when(kind == 3, None).when(kind == 4, NAN).otherwise(F.col("dist")),
            "carrier": F.when(kind != 5, F.col("carrier")),
            "crsdephour": F.when(kind != 6, F.col("crsdephour")),
            "src": F.when(kind != 7, F.col("src")),
        }
    ).withColumn("kind", kind)


class TestDirtyRows:
    def test_training_sets_them_aside(self, spark, dirty):
        model, held = learning.train_and_hold_out(dirty, trees=2, max_depth=3)
        kept = learning.trainable(dirty.withColumn("orig_dest", route_name()))
        assert kept.count() == dirty.filter("kind > 7").count()
        clean, _ = learning.train_and_hold_out(dirty.filter("kind > 7"), trees=2, max_depth=3)
        assert clean.stages[-1].toDebugString.split("\n", 1)[1] == model.stages[-1].toDebugString.split("\n", 1)[1]

    def test_scoring_keeps_every_row(self, spark, dirty):
        model, _ = learning.train_and_hold_out(dirty, trees=2, max_depth=3)
        rows = dirty.withColumn("orig_dest", route_name()).withColumn("label", F.lit("old"))
        got = learning.score_rows(model, rows, keep=["probability"])
        assert got.count() == dirty.count()
        lacking, early = got.filter("kind between 3 and 7"), got.filter("kind <= 2")
        assert lacking.filter("prediction is not null or probability is not null").isEmpty()
        assert lacking.filter("label is null").isEmpty()
        assert early.filter("label is not null").isEmpty() and early.filter("prediction is null").isEmpty()
        whole = got.filter("kind > 7").select("id", "prediction", "label")
        plain = learning.score(model, dirty.filter("kind > 7").withColumn("orig_dest", route_name())).select(
            "id", F.col("prediction").alias("p"), F.col("label").alias("l")
        )
        assert whole.join(plain, "id").filter("prediction <> p or label <> l or p is null").isEmpty()
        assert dict(got.select("dist", "carrier").dtypes) == {"dist": "double", "carrier": "string"}
        assert got.filter("kind = 5 and carrier is not null").isEmpty()


@pytest.mark.parametrize("rows_of_range", [1, 3, 1000])
def test_importance_over_ranges(spark, monkeypatch, rows_of_range):
    """Large buckets are cut into ranges: what a row takes from the next range, from ranges
    after that and from the bucket's beginning is what one list of the bucket gives."""
    from lanewise.operators import forest as module

    rng = random.Random(2)
    rows = [(f"k{i}", float(rng.randrange(4)), rng.choice("abz"), float(rng.random() < 0.5)) for i in range(60)]
    df = spark.createDataFrame(rows, "id string, x double, c string, label double")
    predict = lambda columns: two_class_prediction(SMALL.probability(columns=columns))
    monkeypatch.setattr(module, "_RANGE_ROWS", 1 << 40)
    want = {r.feature: r.correct for r in permutation_importance(df, predict, ["x", "c"], buckets=3).collect()}
    small = {r.feature: r.correct for r in permutation_importance(df.limit(2), predict, ["x", "c"], buckets=2).collect()}
    monkeypatch.setattr(module, "_RANGE_ROWS", rows_of_range)
    got = {r.feature: r.correct for r in permutation_importance(df, predict, ["x", "c"], buckets=3).collect()}
    assert got == want and len(small) == 3
