"""Messages of changing shape, reports kept by a stream, and the first of many groups."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lanewise.operators import heavy
from lanewise.operators.heavy import top_groups
from lanewise.operators.reports import count_report
from lanewise.sources import read_json_variant, variant_field, variant_schema
from lanewise.streaming import read_report, row_changes, start_report


class TestVariant:
    LINES = [
        '{"id": 1, "dist": 5}',
        '{"id": 2, "dist": "6.5"}',
        '{"id": 3, "dist": {"value": 7, "unit": "km"}}',
        '{"id": 4, "dist": null}',
        '{"id": 5}',
        "not json",
        '{"id": 6, "dist": [1]}',
    ]

    def test_every_line_is_kept(self, spark, folder):
        spark.createDataFrame([(x,) for x in self.LINES], "value string").coalesce(1).write.text(folder)
        rows = read_json_variant(spark, folder)
        got = rows.select(
            variant_field("message", "int", "$.id").alias("id"),
            variant_field("message", "double", "$.dist", "$.dist.value").alias("dist"),
        )
        found = sorted((tuple(r) for r in got.collect()), key=lambda r: (r[0] is None, r[0]))
        assert found == [(1, 5.0), (2, 6.5), (3, 7.0), (4, None), (5, None), (6, None), (None, None)]

    def test_schema_tells_drift(self, spark, folder):
        spark.createDataFrame([(x,) for x in self.LINES[:3]], "value string").write.text(folder)
        schema = variant_schema(read_json_variant(spark, folder)).first().schema
        assert "dist: VARIANT" in schema and "id: BIGINT" in schema


class TestKeptReport:
    SCHEMA = "id string, place long, src string, late double"
    SUMS = {"minutes": "late"}

    def brute(self, sent):
        last = {}
        for row in sent:
            if row[0] is not None and (row[0] not in last or row[1] > last[row[0]][1]):
                last[row[0]] = row
        report = {}
        for _, _, src, late in last.values():
            n, minutes, m = report.get(src, (0, 0.0, 0))
            report[src] = (n + 1, minutes + (late or 0.0), m + (late is not None))
        return report

    def test_equal_to_the_recomputed_report_after_every_batch(self, spark, folder):
        rng = random.Random(8)
        sent, schema = [], spark.createDataFrame([], self.SCHEMA).schema
        for step in range(4):
            # Distinct places, so that the latest row of a key is one row.  Some rows come late.
            batch = [
                (rng.choice([None, *(f"k{i}" for i in range(12))]), rng.choice([step, step, step - 2]) * 1000 + 7 * i + step,
                 rng.choice(["a", "b", None]), rng.choice([None, 1.5, -2.25, 40.0]))
                for i in range(25)
            ]
            sent += batch
            spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
            rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(f"{folder}/in")
            changes = row_changes(rows, "id", F.col("place"), ["src", "late"])
            start_report(changes, f"{folder}/out", ["src"], self.SUMS, f"{folder}/check", True).awaitTermination()
            got = read_report(spark, f"{folder}/out", ["src"], self.SUMS, schema).collect()
            assert {r.src: (r.rows, float(r.minutes), r.minutes_rows) for r in got} == self.brute(sent)

    def test_a_repeated_batch_changes_nothing(self, spark, folder):
        """The last batch's commit is lost, as in a failure after its sums were written."""
        from lanewise.sources.folders import remove_folder

        schema = spark.createDataFrame([], self.SCHEMA).schema
        spark.createDataFrame([(f"k{i}", i, "a", 1.0) for i in range(9)], schema).coalesce(1).write.parquet(f"{folder}/in")

        def run():
            rows = spark.readStream.schema(schema).parquet(f"{folder}/in")
            changes = row_changes(rows, "id", F.col("place"), ["src", "late"])
            start_report(changes, f"{folder}/out", ["src"], self.SUMS, f"{folder}/check", True).awaitTermination()
            [row] = read_report(spark, f"{folder}/out", ["src"], self.SUMS, schema).collect()
            return tuple(row)

        first = run()
        remove_folder(spark, f"{folder}/check/commits")
        assert run() == first and first[1] == 9

    def test_groups_can_vanish(self, spark, folder):
        schema = spark.createDataFrame([], self.SCHEMA).schema
        for part, rows in enumerate([[("k", 1, "old", 5.0)], [("k", 2, "new", 7.0)]]):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(f"{folder}/in")
            changes = row_changes(stream, "id", F.col("place"), ["src", "late"])
            start_report(changes, f"{folder}/out", ["src"], self.SUMS, f"{folder}/check", True).awaitTermination()
            got = read_report(spark, f"{folder}/out", ["src"], self.SUMS, schema).collect()
            assert [r.src for r in got] == [("old", "new")[part]]


class TestTopGroups:
    def data(self, spark, seed, heavy_rows=400):
        rng = random.Random(seed)
        rows = [(f"h{rng.randrange(6)}", rng.randrange(2)) for _ in range(heavy_rows)]
        rows += [(f"s{i}", None) for i in range(3000)]
        rng.shuffle(rows)
        return rows, spark.createDataFrame(rows, "who string, day int").repartition(5)

    @pytest.mark.parametrize("counters", [5, 40, 10_000])
    def test_exact_whatever_the_sketch(self, spark, counters):
        """Too few counters decide nothing and all groups are counted; the result is one."""
        rows, df = self.data(spark, counters)
        want = sorted(Counter(rows).items(), key=lambda x: (-x[1], x[0][0], x[0][1] or 0))[:8]
        got = [((r.who, r.day), r["count"]) for r in top_groups(df, ["who", "day"], 8, counters=counters).collect()]
        assert got == want

    def test_only_candidates_are_counted(self, spark, monkeypatch):
        counted = []
        real = count_report

        def seen(df, *args, **options):
            counted.append(df.count())
            return real(df, *args, **options)

        monkeypatch.setattr(heavy, "count_report", seen)
        rows, df = self.data(spark, 1, heavy_rows=4000)
        got = top_groups(df, ["who"], 3, counters=200).collect()
        assert [r["count"] for r in got] == sorted(Counter(w for w, _ in rows).values(), reverse=True)[:3]
        assert counted[0] <= 4200 < df.count()

    def test_nulls_and_few_groups(self, spark):
        df = spark.createDataFrame([(None,), (None,), ("null",), ("",)], "who string")
        got = [(r.who, r.n) for r in top_groups(df, ["who"], 9, name="n").collect()]
        assert got == [(None, 2), ("", 1), ("null", 1)]
        assert top_groups(df.limit(0), ["who"], 3).isEmpty()
        assert top_groups(df, ["who"], 1, where="who = ''").first()["count"] == 1


def test_a_report_takes_many_keys_at_once(spark, folder):
    """Keys of one group, some new, some replaced, some late, over two batches; a group of
    keys is one row of state, so few groups serve many keys."""
    schema = spark.createDataFrame([], TestKeptReport.SCHEMA).schema
    first = [(f"k{i}", 10, "old", 1.0) for i in range(500)]
    later = [(f"k{i}", 20 if i % 2 else 5, "new", 2.0) for i in range(300, 700)]
    for part in (first, later):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(f"{folder}/in")
        changes = row_changes(rows, "id", F.col("place"), ["src", "late"], groups=2)
        start_report(changes, f"{folder}/out", ["src"], {"minutes": "late"}, f"{folder}/check", True).awaitTermination()
    got = read_report(spark, f"{folder}/out", ["src"], {"minutes": "late"}, schema).collect()
    # Of the 200 keys sent again 100 are later; 200 keys are new.
    assert {r.src: (r.rows, float(r.minutes)) for r in got} == {"old": (400, 400.0), "new": (300, 600.0)}


def test_a_report_writes_its_keys_a_few_times_and_lets_shuffles_go(spark, folder, monkeypatch):
    """Every micro-batch writes the rows of its keys anew: a backlog takes few of them, and what
    they shuffle is gone when they end."""
    import glob

    from lanewise.plans import streams

    rows = spark.range(3000).selectExpr("cast(id as string) id", "concat('s', id % 3) src", "1.0D depdelay")
    lines = rows.selectExpr("to_json(struct(*)) AS value").repartition(30)
    lines.write.text(f"{folder}/in/part=1", compression="gzip")
    ended, start = [], streams.start_report
    monkeypatch.setattr(streams, "_repeated_folder", lambda *_: f"{folder}/in")
    monkeypatch.setattr(streams, "flights", lambda *_: rows)
    monkeypatch.setattr(streams, "BATCH_BYTES", 1)
    monkeypatch.setattr(streams, "start_report", lambda *a: ended.append(start(*a)) or ended[0])
    dirs = list(spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString())
    seen = lambda: {f for d in dirs for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}
    before = seen()
    report = streams._kept_report(spark, "own")
    assert seen() <= before
    assert {(r.src, r.rows, r.minutes) for r in report.collect()} == {(f"s{i}", 1000, 1000.0) for i in range(3)}
    batches = [p for p in ended[0].recentProgress if p["numInputRows"]]
    assert 3 <= len(batches) <= streams.REPORT_BATCHES + 2 and sum(p["numInputRows"] for p in batches) == 3000
