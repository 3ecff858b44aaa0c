"""Buckets, text columns, reports, ratios and samples on hand-made rows."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer
from pyspark.sql import functions as F

from lanewise.functions import as_message, bucketize, route_name
from lanewise.functions.buckets import CLASS_SPLITS, REPORT_SPLITS
from lanewise.operators.quality import area_under_roc, confusion
from lanewise.operators.reports import (
    count_report,
    first_per_group,
    group_report,
    rows_where,
    top_rows,
)
from lanewise.operators.sampling import hash_split, random_split, stratified_sample
from lanewise.schemas import FLIGHTS, SCORED_FLIGHTS
from lanewise.sources import keep_in_memory, read_json, read_json_inferred
from lanewise.streaming import decode

NAN = float("nan")
DELAYS = [0.0, 39.9, 40.0, 40.5, 41.0, None, NAN, -1.0]


@pytest.fixture(scope="module")
def delays(spark):
    rows = list(enumerate(DELAYS))
    return spark.createDataFrame(rows, "n int, depdelay double").coalesce(1)


def values(df, expression):
    return [r[0] for r in df.orderBy("n").select(expression).collect()]


class TestBuckets:
    def test_default(self, delays):
        got = values(delays, bucketize("depdelay", REPORT_SPLITS))
        assert got == [0.0, 0.0, 1.0, 1.0, 1.0, None, None, None]

    def test_class_splits_differ(self, delays):
        got = values(delays, bucketize("depdelay", CLASS_SPLITS))
        assert got == [0.0, 0.0, 0.0, 0.0, 1.0, None, None, None]

    def test_nan_kept(self, delays):
        assert values(delays, bucketize("depdelay", REPORT_SPLITS, keep_nan=True))[6] == 2.0

    @pytest.mark.parametrize("row", [6, 7])
    def test_strict_raises(self, delays, row):
        bad = delays.filter(F.col("n") == row)
        with pytest.raises(PySparkException):
            bad.select(bucketize("depdelay", REPORT_SPLITS, strict=True)).collect()

    def test_strict_passes_good_values_and_null(self, delays):
        good = delays.filter("n < 6")
        got = values(good, bucketize("depdelay", REPORT_SPLITS, strict=True))
        assert got == [0.0, 0.0, 1.0, 1.0, 1.0, None]

    def test_last_bucket_is_closed(self, spark):
        df = spark.createDataFrame([(0, 2.0), (1, 2.1), (2, 1.0)], "n int, x double")
        assert values(df, bucketize("x", [0, 1, 2])) == [1.0, None, 1.0]

    def test_same_as_the_stage(self, spark):
        df = spark.range(200).select(F.col("id").alias("n"), (F.col("id") / 3).alias("x"))
        splits = [0.0, 10.0, 33.0, 50.0, math.inf]
        stage = Bucketizer(inputCol="x", outputCol="b", splits=splits)
        both = stage.transform(df).withColumn("mine", bucketize("x", splits))
        assert both.filter("not (b <=> mine)").count() == 0

    def test_bad_splits(self, spark):
        with pytest.raises(ValueError):
            bucketize("x", [0.0, 0.0, 1.0])


def test_filter_and_bucket_disagree_at_forty(delays):
    assert delays.filter("depdelay > 40 and not isnan(depdelay)").count() == 2
    assert delays.filter(bucketize("depdelay", REPORT_SPLITS) == 1.0).count() == 3


def test_route_is_null_when_an_end_is(spark):
    df = spark.createDataFrame([("A", "B"), (None, "B"), ("A", None)], "src string, dst string")
    assert [r[0] for r in df.select(route_name()).collect()] == ["A_B", None, None]


class TestJson:
    def test_malformed_bad_field_and_extra_field(self, spark):
        lines = [
            ('{"id":"x","depdelay":1.5,"other":1}',),
            ('{"id":"y","depdelay":"late"}',),
            ("not json",),
            (None,),
        ]
        got = decode(spark.createDataFrame(lines, "value string"), FLIGHTS, raw="raw")
        rows = [(r.id, r.depdelay, r.raw) for r in got.collect()]
        assert rows == [("x", 1.5, lines[0][0]), ("y", None, lines[1][0]), (None, None, "not json"), (None, None, None)]

    def test_binary_value(self, spark):
        df = spark.createDataFrame([(bytearray(b'{"id":"x"}'),)], "value binary")
        assert decode(df, FLIGHTS).first().id == "x"

    def test_round_trip_keeps_nulls(self, spark):
        row = ("a", None, 1, None, "c", "s", None, 5, 500, 0.5, None, NAN, 3.0, None)
        df = spark.createDataFrame([row], FLIGHTS)
        back = decode(df.select(as_message(df).alias("value")), FLIGHTS)
        assert repr(back.collect()) == repr(df.collect())

    def test_scans(self, spark, folder):
        spark.createDataFrame([("ORD", "Chicago"), ("LGA", "New York")], "id string, City string").write.json(folder)
        assert read_json_inferred(spark, folder).columns == ["City", "id"]
        assert read_json(spark, folder, FLIGHTS).filter("src is null").count() == 2


def test_schemas():
    assert len(FLIGHTS) == 14 and all(f.nullable for f in FLIGHTS)
    assert SCORED_FLIGHTS.names[14:] == ["orig_dest", "label", "prediction"]


class TestReports:
    def test_count_of_column_skips_nulls(self, spark):
        df = spark.createDataFrame([("a", 1.0), ("a", None), (None, None)], "k string, v double")
        rows = {r.k: r["count"] for r in count_report(df, ["k"], of="v").collect()}
        assert rows == {"a": 1, None: 0}
        assert {r.k: r["count"] for r in count_report(df, ["k"]).collect()} == {"a": 2, None: 1}

    def test_top_rows_break_ties_and_put_nulls_last(self, spark):
        df = spark.createDataFrame(
            [("c", 5.0), ("a", 5.0), ("n", None), ("b", 9.0)], "id string, d double"
        ).repartition(3)
        order = [F.desc("d"), F.asc("id")]
        assert [r.id for r in top_rows(df, order, 3).collect()] == ["b", "a", "c"]
        assert [r.id for r in top_rows(df, order, 4, columns=["id"]).collect()][-1] == "n"

    def test_group_report(self, spark):
        df = spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
        got = group_report(df, ["k"], {"top": F.max("v")}, where="v < 9", order_by=[F.desc("top")], limit=2)
        assert [(r.k, r.top) for r in got.collect()] == [(2, 8), (1, 7)]

    @pytest.mark.parametrize("n", [1, 7, 1200])
    def test_first_per_group(self, spark, n):
        hot = F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 9).cast("string"))
        df = spark.range(4000).select(hot.alias("k"), ((F.col("id") * 7919) % 4001).alias("v"))
        got = first_per_group(df, ["k"], [F.desc("v")], n)
        want = {}
        for r in df.collect():
            want.setdefault(r.k, []).append(r.v)
        want = {k: sorted(v, reverse=True)[:n] for k, v in want.items()}
        have = {}
        for r in got.orderBy(F.desc("v")).collect():
            have.setdefault(r.k, []).append(r.v)
        assert have == want and got.columns == ["k", "v"]

    def test_rows_where_takes_text_and_columns(self, spark):
        df = spark.range(5)
        assert rows_where(df, "id > 2", ["id"]).count() == rows_where(df, F.col("id") > 2).count() == 2

    def test_keep_in_memory(self, spark):
        cached = keep_in_memory(spark.range(5), view="kept")
        assert cached.storageLevel.useMemory and spark.table("kept").count() == 5
        cached.unpersist()


class TestConfusion:
    ROWS = [(1.0, 1.0)] * 4 + [(0.0, 0.0)] * 3 + [(0.0, 1.0)] * 2 + [(1.0, 0.0)] + [(None, 1.0), (1.0, None), (None, None)]

    @pytest.mark.parametrize("by", ["prediction", "label"])
    def test_cells(self, spark, by):
        df = spark.createDataFrame(self.ROWS, "label double, prediction double")
        r = confusion(df, by=by).first()
        assert (r.total, r.correct, r.wrong) == (13, 7, 3)
        assert r.true_positive == 4 / 13 and r.true_negative == 3 / 13
        assert r.false_positive == 2 / 13 and r.false_negative == 1 / 13
        cells = r.true_positive + r.true_negative + r.false_positive + r.false_negative
        assert abs(cells * 13 + 3 - 13) < 1e-9

    def test_other_values_follow_the_chosen_column(self, spark):
        df = spark.createDataFrame([(0.0, 2.0), (2.0, 1.0)], "label double, prediction double")
        by_prediction, by_label = confusion(df).first(), confusion(df, by="label").first()
        assert by_prediction.false_positive == 0.5 and by_prediction.false_negative == 0.0
        assert by_label.false_positive == 0.5 and by_label.false_negative == 0.0

    def test_empty(self, spark):
        r = confusion(spark.createDataFrame([], "label double, prediction double")).first()
        assert r.total == 0 and r.ratio_correct is None


class TestAuc:
    def brute(self, rows):
        wins = pairs = 0
        for s, y in rows:
            for t, z in rows:
                if y == 1.0 and z == 0.0:
                    pairs += 1
                    wins += 1.0 if s > t else 0.5 if s == t else 0.0
        return wins / pairs

    @pytest.mark.parametrize("ranges", [2, 7, 256])
    @pytest.mark.parametrize("distinct", [1, 5, 1000])
    def test_brute_force(self, spark, ranges, distinct):
        rows = [(float((i * 7919) % distinct), float((i * 31) % 7 < 3)) for i in range(150)]
        df = spark.createDataFrame(rows + [(None, 1.0), (NAN, 0.0), (3.0, None)], "score double, label double")
        got = area_under_roc(df, ranges=ranges).first()
        assert got.auc == pytest.approx(self.brute(rows), abs=1e-12)
        assert got.positives + got.negatives == 150

    def test_one_score_holds_most_rows(self, spark):
        rows = [(0.5, float(i % 2)) for i in range(100)] + [(0.1, 0.0), (0.9, 1.0)]
        df = spark.createDataFrame(rows, "score double, label double")
        assert area_under_roc(df).first().auc == pytest.approx(self.brute(rows))

    def test_missing_class_is_null(self, spark):
        df = spark.createDataFrame([(1.0, 1.0)], "score double, label double")
        assert area_under_roc(df).first().auc is None

    def test_close_to_the_evaluator(self, spark):
        from pyspark.ml.functions import array_to_vector

        df = spark.range(500).select(
            ((F.col("id") * 7919) % 83 / 83.0).alias("score"), (F.col("id") % 3 == 0).cast("double").alias("label")
        )
        raw = df.withColumn("rawPrediction", array_to_vector(F.array(-F.col("score"), F.col("score"))))
        assert area_under_roc(df).first().auc == pytest.approx(BinaryClassificationEvaluator().evaluate(raw), abs=1e-6)


class TestSamples:
    def test_hash_split_is_a_partition_whatever_the_layout(self, spark):
        df = spark.range(2000).select(F.col("id").cast("string"))
        first, second = hash_split(df, 0.7, seed=1)
        again, _ = hash_split(df.repartition(7), 0.7, seed=1)
        ids = lambda part: {r.id for r in part.collect()}
        assert ids(first) == ids(again)
        assert not ids(first) & ids(second) and len(ids(first) | ids(second)) == 2000
        assert 1300 < first.count() < 1500
        assert ids(hash_split(df, 0.7, seed=2)[0]) != ids(first)

    def test_null_key_is_in_exactly_one_part(self, spark):
        df = spark.createDataFrame([(None,), ("a",)], "id string")
        parts = hash_split(df, 0.7)
        assert sum(p.filter("id is null").count() for p in parts) == 1

    def test_stratified(self, spark):
        df = spark.range(3000).select(F.col("id").cast("string"), (F.col("id") % 3).cast("double").alias("c"))
        counts = {r.c: r["count"] for r in count_report(stratified_sample(df, "c", {0.0: 0.13, 1.0: 1.0}), ["c"]).collect()}
        assert counts[1.0] == 1000 and 90 < counts[0.0] < 170 and 2.0 not in counts

    def test_random_split_is_a_partition(self, spark):
        first, second = random_split(spark.range(1000))
        assert first.count() + second.count() == 1000
