"""The keyed table: replacement, repeats, failed writes, compaction."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lanewise.sources import KeyedTable
from lanewise.sources.folders import child_folders
from lanewise.sources.keyed import latest_per_key

SCHEMA = StructType().add("id", "string").add("v", "integer").add("at", "integer")


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.fixture
def table(spark, folder):
    return KeyedTable(spark, folder, SCHEMA).create()


def test_latest_per_key(spark):
    df = frame(spark, ("a", 1, 5), ("a", 2, 7), ("b", 3, None), ("b", 4, 0), ("c", 9, 1), ("c", 8, 1))
    assert rows_of(latest_per_key(df, "id", ["at"])) == [("a", 2, 7), ("b", 4, 0), ("c", 9, 1)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(10_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("id"), F.col("id").alias("v")
    )
    best = latest_per_key(df, "id", ["v"])
    assert best.filter("id = 'hot'").first().v == 9998 and best.count() == 3335
    plan = best._jdf.queryExecution().executedPlan().toString()
    before, after = plan.index("row_number(), 1, Partial"), plan.index("Exchange")
    assert before > after  # nearer to the scan


def test_table_must_exist(spark, folder):
    missing = KeyedTable(spark, folder, SCHEMA)
    with pytest.raises(ValueError):
        missing.upsert(frame(spark, ("a", 1, 1)))
    with pytest.raises(ValueError):
        missing.read()
    assert not missing.exists()


def test_insert_replace_and_duplicate_keys(spark, table):
    assert rows_of(table.read()) == []
    table.upsert(frame(spark, ("a", 1, 1), ("b", 1, 1)))
    table.upsert(frame(spark, ("b", 3, 3), ("b", 2, 2), ("c", 1, 1), (None, 7, 7)), order_by=["at"])
    want = [("a", 1, 1), ("b", 3, 3), ("c", 1, 1)]
    assert rows_of(table.read()) == want
    table.compact()
    assert rows_of(table.read()) == want
    assert rows_of(table.without_key(frame(spark, (None, 7, 7), ("a", 1, 1)))) == [(None, 7, 7)]


def test_create_keeps_an_existing_table(spark, table):
    table.upsert(frame(spark, ("a", 1, 1)))
    assert rows_of(table.create().read()) == [("a", 1, 1)]


def test_repeated_batch_changes_nothing(spark, table):
    assert table.upsert(frame(spark, ("a", 1, 1)), writer="w", epoch=0)
    assert table.upsert(frame(spark, ("a", 2, 2)), writer="w", epoch=1)
    assert not table.upsert(frame(spark, ("a", 1, 1)), writer="w", epoch=0)
    assert rows_of(table.read()) == [("a", 2, 2)]
    assert table.upsert(frame(spark, ("a", 9, 9)), writer="other", epoch=0)
    assert rows_of(table.read()) == [("a", 9, 9)]


@pytest.mark.parametrize("remove_old", [False, True])
def test_repeat_after_compaction(spark, table, remove_old):
    for epoch in range(3):
        table.upsert(frame(spark, ("a", epoch, 0), (f"k{epoch}", 0, 0)), writer="w", epoch=epoch)
    table.compact(remove_old)
    assert not table.upsert(frame(spark, ("a", 1, 0)), writer="w", epoch=1)
    assert not table.upsert(frame(spark, ("a", 2, 0)), writer="w", epoch=2)
    assert rows_of(table.read()) == [("a", 2, 0), ("k0", 0, 0), ("k1", 0, 0), ("k2", 0, 0)]
    if remove_old:
        assert len(child_folders(spark, table.path)) == 2
    assert table.upsert(frame(spark, ("a", 5, 0)), writer="w", epoch=3)
    assert table.read().filter("id = 'a'").first().v == 5


def test_uncommitted_write_is_ignored_and_can_be_repeated(spark, table):
    table.upsert(frame(spark, ("a", 1, 1)), writer="w", epoch=0)
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        with pytest.raises(RuntimeError, match="_SUCCESS"):
            table.upsert(frame(spark, ("a", 2, 2)), writer="w", epoch=1)
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert rows_of(table.read()) == [("a", 1, 1)]
    assert table.upsert(frame(spark, ("a", 3, 3)), writer="w", epoch=1)
    assert rows_of(table.read()) == [("a", 3, 3)]


def test_extra_columns_survive_and_readers_project(spark, table):
    table.upsert(frame(spark, ("a", 1, 1)))
    table.upsert(frame(spark, ("b", 2, 2)).withColumn("extra", F.lit("x")))
    table.compact()
    assert rows_of(table.read()) == [("a", 1, 1), ("b", 2, 2)]
    wide = StructType(list(SCHEMA.fields)).add("extra", "string")
    assert rows_of(table.read(wide)) == [("a", 1, 1, None), ("b", 2, 2, "x")]
    table.upsert(frame(spark, ("b", 5, 5)))
    assert rows_of(table.read(StructType().add("v", "integer"))) == [(1,), (5,)]


def test_bare_scan_takes_filters_without_deltas(spark, table):
    table.upsert(frame(spark, ("a", 1, 1)))
    table.compact()
    plan = table.read().filter("v > 0")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(v,0)" in plan and "Exchange" not in plan


def test_load_is_a_base_at_once(spark, folder):
    loaded = KeyedTable(spark, folder, SCHEMA).load(frame(spark, ("a", 1, 1), ("a", 2, 2), (None, 3, 3)), ["at"])
    assert rows_of(loaded.read()) == [("a", 2, 2)]
    assert child_folders(spark, folder) == ["base-000000000000"]
    with pytest.raises(ValueError):
        loaded.load(frame(spark, ("b", 1, 1)))


def test_compaction_keeps_the_generations_asked_for(spark, folder, table):
    for i in range(8):
        table.upsert(frame(spark, ("a", i, i), (f"k{i}", i, i)), writer="w", epoch=i)
        if i % 2:
            table.compact(remove_old=True, generations=2)
    folders = child_folders(spark, folder)
    assert sum(f.startswith("base") for f in folders) == 2 and len(folders) <= 5
    assert len(rows_of(table.read())) == 9
    assert not table.upsert(frame(spark, ("a", 0, 0)), writer="w", epoch=7)


def test_latest_per_key_in_parts(spark):
    """Rows beyond one part are dealt by key; keys of a hot bucket go the other way."""
    from lanewise.session import ROWS_PER_SPLIT

    rows = [(f"k{i % 40}", i) for i in range(200)] + [("hot", i) for i in range(300)] + [(None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "id string, v int").repartition(4)
    before = spark.conf.get(ROWS_PER_SPLIT, None)
    spark.conf.set(ROWS_PER_SPLIT, "100")
    try:
        best = latest_per_key(df, "id", ["v"])
        plan = best._jdf.queryExecution().executedPlan().toString()
        got = {r.id: r.v for r in best.collect()}
    finally:
        spark.conf.unset(ROWS_PER_SPLIT) if before is None else spark.conf.set(ROWS_PER_SPLIT, before)
    assert got == {**{f"k{i}": 160 + i for i in range(40)}, "hot": 299, None: 2} and best.count() == 42
    assert "REPARTITION_BY_NUM" in plan


def test_a_table_in_parts_is_read_without_moving_rows(spark, folder, no_broadcast):
    """Base and deltas in the same buckets, written in several steps; the folder counts from
    the last step on, and what the steps shuffle is let go."""
    df = spark.range(400).select(
        F.concat(F.lit("k"), F.col("id") % 150).alias("id"), F.col("id").cast("int").alias("v"), F.lit(0).alias("at")
    )
    df = df.unionByName(frame(spark, (None, 1, 1)))
    table = KeyedTable(spark, folder, SCHEMA, parts=5)
    with pytest.raises(ValueError):
        table.upsert(df)
    table.load(df, ["v"])
    want = {f"k{i}": max(v for v in range(400) if v % 150 == i) for i in range(150)}
    assert {r.id: r.v for r in table.read().collect()} == want and table.read().count() == 150
    more = frame(spark, *[(f"k{i}", v, 1) for i in (0, 7, 149, 200) for v in (1, 3, 2)], (None, 9, 9))
    assert table.upsert(more, ["v"], writer="w", epoch=0)
    assert not table.upsert(more, ["v"], writer="w", epoch=0)
    table.upsert(frame(spark, ("k7", -5, 2)))
    want |= {"k0": 3, "k7": -5, "k149": 3, "k200": 3}
    read = table.read()
    assert {r.id: r.v for r in read.collect()} == want and read.count() == len(want)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan
    assert {r.at for r in table.read(StructType().add("at", "integer")).collect()} == {0, 1, 2}
    # Whoever reads with another number of parts sees the same rows.
    other = KeyedTable(spark, folder, SCHEMA, parts=3)
    other.upsert(frame(spark, ("k1", 77, 3)))
    want["k1"] = 77
    assert {r.id: r.v for r in other.read().collect()} == want
    other.compact(remove_old=True)
    assert {r.id: r.v for r in table.read().collect()} == want and table.read().count() == len(want)
    assert not table.upsert(more, ["v"], writer="w", epoch=0)


def test_shuffled_files_of_a_write_are_let_go(spark, folder):
    """A write in parts keeps no shuffle once its job has ended."""
    import glob

    seen = lambda: {f for d in local for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}
    blocks = spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    local, before = list(blocks), None
    before = seen()
    KeyedTable(spark, folder, SCHEMA, parts=4).load(
        spark.range(5000).selectExpr("cast(id as string) id", "cast(id as int) v", "0 at"), ["v"]
    )
    assert seen() <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_a_step_that_fails_leaves_no_table(spark, folder, no_broadcast, monkeypatch):
    """Of a write in several steps none is seen before the last."""
    from lanewise.sources import keyed

    df = spark.range(300).selectExpr("cast(id as string) id", "cast(id as int) v", "0 at")
    real, calls = keyed._latest_in_parts, []

    def failing(*args):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("full")
        return real(*args)

    monkeypatch.setattr(keyed, "_latest_in_parts", failing)
    table = KeyedTable(spark, folder, SCHEMA, parts=6)
    with pytest.raises(OSError):
        table.load(df)
    assert not table.exists()
    monkeypatch.setattr(keyed, "_latest_in_parts", real)
    assert table.load(df).read().count() == 300
