"""The streaming job over text files, and the topic options it would use instead."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lanewise.operators import learning
from lanewise.operators.quality import area_under_roc
from lanewise.operators.sampling import hash_split

from lanewise.operators.learning import (
    FEATURES,
    MODEL_COLUMNS,
    evaluate_auc,
    feature_importance,
    load_model,
    save_model,
    score,
    train,
    train_and_hold_out,
)
from lanewise.plans.standin import flights
from lanewise.schemas import FLIGHTS, SCORED_FLIGHTS
from lanewise.sources import KeyedTable, file_messages, kafka_options
from lanewise.sources.folders import child_folders
from lanewise.session import ROWS_PER_SPLIT
from lanewise.streaming import (
    decode,
    publish_files,
    run_for,
    score_stream,
    start_keyed_sink,
    start_tail,
    with_route,
)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def trained(spark):
    return train_and_hold_out(flights(spark, SF), trees=3, max_depth=4)


def test_kafka_options():
    options = kafka_options("host:9092", "flights")
    assert options == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "flights",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    assert kafka_options("h", "t", max_per_trigger=9)["maxOffsetsPerTrigger"] == "9"


def test_publish_and_tail(spark, folder):
    df = flights(spark, SF)
    publish_files(df, f"{folder}/in", rows_per_file=300)
    assert len(spark.read.text(f"{folder}/in").inputFiles()) >= 4
    start_tail(file_messages(spark, f"{folder}/in"), f"{folder}/c", f"{folder}/out", True).awaitTermination()
    back = decode(spark.read.text(f"{folder}/out"), FLIGHTS)
    assert back.exceptAll(df).isEmpty() and back.count() == df.count()


def test_restart_and_rejects(spark, folder):
    """New files after a restart are added once; text that is not JSON is set aside."""
    df = flights(spark, SF)
    publish_files(df.filter("month <= 6"), f"{folder}/in/one")
    table = KeyedTable(spark, f"{folder}/table", with_route(df).schema).create()

    def run():
        messages = file_messages(spark, f"{folder}/in/*", max_files_per_trigger=1)
        rows = with_route(decode(messages, FLIGHTS, raw="raw"))
        start_keyed_sink(
            rows,
            table,
            f"{folder}/c",
            rejects=f"{folder}/bad",
            raw="raw",
            compact_every=2,
            available_now=True,
        ).awaitTermination()

    run()
    assert table.read().count() == df.filter("month <= 6").count()
    publish_files(df.filter("month > 6"), f"{folder}/in/two")
    spark.createDataFrame([("oops",), ("{",)], "value string").coalesce(1).write.text(f"{folder}/in/three")
    run()
    run()
    stored = table.read()
    assert stored.exceptAll(with_route(df)).isEmpty() and stored.count() == df.count()
    assert len([f for f in child_folders(spark, table.path) if f.startswith("base")]) >= 2
    assert sorted(r.raw for r in spark.read.parquet(f"{folder}/bad").collect()) == ["oops", "{"]


def test_bounded_run_of_a_live_stream(spark, folder):
    publish_files(flights(spark, SF), f"{folder}/in")
    query = start_tail(file_messages(spark, f"{folder}/in"), f"{folder}/c", f"{folder}/out")
    query.processAllAvailable()
    assert not run_for(query, 1) and not query.isActive
    assert spark.read.text(f"{folder}/out").count() == flights(spark, SF).count()


def test_the_last_message_of_a_key_wins(spark, folder):
    """Within a file by line, among files by time; whatever the values."""
    schema = "id string, v int"
    lines = [f'{{"id": "k", "v": {v}}}' for v in (5, 9, 1)]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{folder}/in/one")
    again = spark.createDataFrame([(lines[0],)], "value string").coalesce(1)
    table = KeyedTable(spark, f"{folder}/table", StructType.fromDDL(schema)).create()

    def run():
        rows = decode(file_messages(spark, f"{folder}/in/*"), StructType.fromDDL(schema), raw="raw")
        start_keyed_sink(
            rows, table, f"{folder}/c", rejects=f"{folder}/bad", raw="raw", available_now=True
        ).awaitTermination()
        return [tuple(r) for r in table.read().collect()]

    assert run() == [("k", 1)]
    again.write.text(f"{folder}/in/two")
    assert run() == [("k", 5)]


def test_rows_without_a_key_need_a_place(spark, folder):
    spark.createDataFrame([("oops",)], "value string").write.text(f"{folder}/in")
    table = KeyedTable(spark, f"{folder}/table", FLIGHTS).create()
    rows = decode(file_messages(spark, f"{folder}/in"), FLIGHTS)
    query = start_keyed_sink(rows, table, f"{folder}/c", available_now=True)
    with pytest.raises(StreamingQueryException, match="rejects"):
        query.awaitTermination()


def test_sink_needs_a_table(spark, folder):
    missing = KeyedTable(spark, folder, FLIGHTS)
    with pytest.raises(ValueError):
        start_keyed_sink(None, missing, f"{folder}/c")


class TestModel:
    def test_saved_model_scores_the_stream_like_the_batch(self, spark, folder, trained):
        model, held_out = trained
        save_model(model, f"{folder}/model")
        save_model(model, f"{folder}/model")
        loaded = load_model(f"{folder}/model")

        publish_files(held_out.drop("orig_dest"), f"{folder}/in")
        rows = score_stream(file_messages(spark, f"{folder}/in"), FLIGHTS, loaded)
        assert not set(MODEL_COLUMNS) & set(rows.columns)
        table = KeyedTable(spark, f"{folder}/table", SCORED_FLIGHTS).create()
        start_keyed_sink(rows, table, f"{folder}/c", available_now=True).awaitTermination()
        want = score(loaded, held_out).select(*SCORED_FLIGHTS.names)
        assert table.read().exceptAll(want).isEmpty() and table.read().count() == want.count()

    def test_unseen_category_is_scored(self, spark, trained):
        model, held_out = trained
        strange = held_out.limit(5).withColumn("carrier", F.lit("nobody"))
        assert score(model, strange).filter("prediction is not null").count() == 5

    def test_importance_and_auc(self, trained):
        model, held_out = trained
        listed = feature_importance(model).collect()
        assert {r.feature for r in listed} == set(FEATURES)
        assert sum(r.importance for r in listed) == pytest.approx(1.0)
        assert [r.importance for r in listed] == sorted((r.importance for r in listed), reverse=True)
        assert 0.0 <= evaluate_auc(score(model, held_out)) <= 1.0

    def test_too_many_categories_is_said_before_the_fit(self, spark, monkeypatch):
        monkeypatch.setattr(learning, "MAX_CATEGORIES", 3)
        with pytest.raises(ValueError, match="too many"):
            train(with_route(flights(spark, SF)))

    def test_bins_grow_with_the_widest_category(self, spark):
        model = train(with_route(flights(spark, SF)), max_bins=5, trees=1, max_depth=1)
        assert model.stages[-1].getMaxBins() > 5

    def test_training_rows_lie_in_bounded_parts(self, spark, monkeypatch):
        sizes, fit = [], learning.RandomForestClassifier.fit

        def seen(forest, rows):
            sizes.extend(r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect())
            return fit(forest, rows)

        monkeypatch.setattr(learning.RandomForestClassifier, "fit", seen)
        rows = spark.range(4000).coalesce(1).select(
            F.concat(F.lit("c"), F.col("id") % 3).alias("carrier"),
            F.lit(7.0).alias("dist"),
            (F.col("id") % 80).cast("double").alias("depdelay"),
        )
        spark.conf.set(ROWS_PER_SPLIT, "500")
        try:
            train(rows, ("carrier",), ("carrierIndexed", "dist"), trees=1, max_depth=1)
        finally:
            spark.conf.unset(ROWS_PER_SPLIT)
        assert sum(sizes) == 4000 and max(sizes) <= 500

    def test_balanced_training(self, spark, monkeypatch):
        seen = {}
        monkeypatch.setattr(learning, "train", lambda df, **_: seen.update(df=df))
        train_and_hold_out(flights(spark, SF), balance={0.0: 0.3, 1.0: 1.0})
        whole, _ = hash_split(flights(spark, SF), 0.7, "id", 5043)
        for late, share in (("depdelay >= 41", 1.0), ("depdelay < 41", 0.3)):
            kept = seen["df"].filter(late).count() / whole.filter(late).count()
            assert kept == pytest.approx(share, abs=0.03)

    def test_exact_auc_agrees_with_the_evaluator(self, trained):
        model, held_out = trained
        scored = score(model, held_out)
        exact = area_under_roc(scored.withColumn("p", vector_to_array("probability")[1]), "p").first().auc
        assert exact == pytest.approx(evaluate_auc(scored), abs=1e-3)


def test_a_backlog_takes_a_bounded_number_of_batches(spark, folder):
    """The limit of a micro-batch grows with what waits, and packed messages are read as sent."""
    from lanewise.plans import streams

    df = flights(spark, SF)
    publish_files(df, f"{folder}/in", 100, "gzip")
    total = streams.folder_bytes(spark, f"{folder}/in")
    assert streams._batch_bytes(spark, f"{folder}/in", 10) == total // streams.MOST_BATCHES
    assert streams._batch_bytes(spark, f"{folder}/in") == streams.BATCH_BYTES
    assert spark.read.text(f"{folder}/in").count() == df.count()
    messages = file_messages(spark, f"{folder}/in")
    start_tail(messages, f"{folder}/c", f"{folder}/out", True, "gzip").awaitTermination()
    sent, got = spark.read.text(f"{folder}/in"), spark.read.text(f"{folder}/out")
    assert sent.exceptAll(got).isEmpty() and got.exceptAll(sent).isEmpty()
    assert streams.folder_bytes(spark, f"{folder}/out") < sent.select(F.sum(F.length("value"))).first()[0] / 3


def test_a_run_that_was_cut_short_is_no_result(spark, folder, monkeypatch):
    """A stream that its time limit stopped has read some messages only: that is said."""
    from lanewise.plans import streams

    lines = spark.createDataFrame([(f'{{"id": "{i}"}}',) for i in range(20)], "value string")
    lines.repartition(4).write.text(f"{folder}/in")
    monkeypatch.setattr(streams, "messages_folder", lambda *_: f"{folder}/in")
    assert [tuple(r) for r in streams._bounded(spark, "own").collect()] == [(20, True)]
    monkeypatch.setattr(streams, "run_for", lambda query, seconds: run_for(query, seconds) and False)
    with pytest.raises(TimeoutError, match="messages"):
        streams._bounded(spark, "own")


def _flight_rows(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("f"), "id").alias("id"),
        *[F.lit("x" if f.dataType.typeName() == "string" else 1).cast(f.dataType).alias(f.name) for f in FLIGHTS.fields[1:]],
    )


def test_kept_rows_come_in_bounded_batches(spark, folder, monkeypatch):
    """The upsert works off its messages in several micro-batches, and the later still wins."""
    from lanewise.plans import streams

    rows = _flight_rows(spark, 600)
    publish_files(rows, f"{folder}/in/part=1", 100, "gzip")
    publish_files(rows.filter("id < 'f3'").withColumn("depdelay", F.lit(50.0)), f"{folder}/in/part=2", 100, "gzip")
    tables, start = [], streams.start_keyed_sink
    monkeypatch.setattr(streams, "_repeated_folder", lambda *_: f"{folder}/in")
    monkeypatch.setattr(streams, "flights", lambda *_: rows)
    monkeypatch.setattr(streams, "BATCH_BYTES", 100)
    monkeypatch.setattr(streams, "start_keyed_sink", lambda r, t, *a, **o: tables.append(t) or start(r, t, *a, **o))
    got = streams._upserted(spark, "own")
    assert len(tables[0]._folders()[1]) > 2
    assert got.count() == 600 and got.filter("(id < 'f3') = (depdelay = 50.0)").count() == 600


def test_damaged_messages_are_scored_in_bounded_batches(spark, folder, monkeypatch):
    from lanewise.plans import streams

    class Asked(Exception):
        pass

    def asked(spark, path, **options):
        raise Asked(options)

    publish_files(_flight_rows(spark, 50), folder)
    monkeypatch.setattr(streams, "once", lambda *_: folder)
    monkeypatch.setattr(streams, "file_messages", asked)
    with pytest.raises(Asked, match=f"'max_bytes_per_trigger': {4 * streams.BATCH_BYTES}"):
        streams._damaged(spark, "own")
