"""The registered queries on the given tables, and the pipeline against brute force."""

import re
from itertools import combinations

import duckdb
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F
from test_operators import brute_distance, brute_print, find_roots

import corpus_pipeline
from lanewise.llm import decontaminate, stages
from lanewise.llm.queries import ORACLES, QUERIES

SF = f"{TESTDATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twins(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    result = con.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    df = QUERIES[name](spark, SF)
    assert sorted(names) == sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*names).collect())
    assert got == sorted(map(repr, result.fetchall()))


def test_mix_twin_with_odd_rows(spark, monkeypatch):
    """Null sources, texts and doc_ids, ties, and many small buckets."""
    from lanewise.llm import mixing

    monkeypatch.setattr(mixing, "_BUCKET_ROWS", 10)
    con = duckdb.connect()
    con.execute(
        """CREATE TABLE documents AS SELECT CASE WHEN i % 50 = 0 THEN NULL ELSE i END AS doc_id,
           CASE WHEN i % 31 = 0 THEN NULL ELSE repeat('w$ ', (i * 7) % 41) || i END AS text,
           CASE WHEN i % 3 = 0 THEN 'hot' WHEN i % 17 = 0 THEN NULL ELSE 's' || i % 5 END AS source
           FROM range(700) r(i)"""
    )
    rows = con.execute("SELECT * FROM documents").fetchall()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    expected = sorted(map(repr, con.execute(mixing.duckdb_mix("documents")).fetchall()))
    got = mixing.Mix(docs).taken().select("doc_id", "size", "source_size", "target", "taken")
    assert sorted(repr(tuple(r)) for r in got.collect()) == expected


#: Collocations are rows of phrases, not of documents.
@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op11_phrase_streams"}))
def test_queries_cover_all_documents(spark, name):
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert sorted(r.doc_id for r in QUERIES[name](spark, SF).select("doc_id").collect()) == ids


def test_held_out_accuracy(spark):
    sf = f"{TESTDATA}/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    named = QUERIES["op6_language_network"](spark, sf).filter("held_out").join(docs, "doc_id")
    assert named.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
    scored = QUERIES["op4_toxicity_machine"](spark, sf).filter("held_out").join(labels, "doc_id")
    counts = {(r.toxic, r.predicted): r["count"] for r in scored.groupBy("toxic", "predicted").count().collect()}
    assert counts.get((0, 1), 0) <= 1 and counts[1, 1] >= counts[1, 0]
    model = QUERIES["op8_suffix_tree"](spark, sf).filter("held_out")
    base, score = model.agg(F.sum("base_score"), F.sum("score")).first()
    assert base < score < 0


def test_stages(spark, folder):
    """Each stage on what the one before kept, against brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near duplicates", "decontamination", "mixing", "sharding",
    ]
    kept = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{i}")
        before, docs = docs, spark.read.parquet(f"{folder}/{i}")
        if name != "sharding":
            assert docs.columns == before.columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        assert set(kept[name]) <= {r.doc_id for r in before.collect()}

    texts = kept["toxicity"]
    ids = sorted(texts)
    prints = [brute_print(texts[i], 3) for i in ids]
    close = [
        (a, b) for a, b in combinations(range(len(ids)), 2) if (prints[a] ^ prints[b]).bit_count() <= 3
    ]
    roots = find_roots(len(ids), close)
    assert sorted(kept["near duplicates"]) == sorted({ids[r] for r in roots})

    items = [decontaminate.plain_text(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for i, text in kept["near duplicates"].items():
        whole = decontaminate.plain_text(text)
        if any(item in whole for item in items):
            assert i not in kept["decontamination"]
    for i in set(kept["near duplicates"]) - set(kept["decontamination"]):
        whole = decontaminate.plain_text(kept["near duplicates"][i])
        assert any(brute_distance(item, whole) <= 0.07 * len(item) for item in items)

    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in kept["decontamination"].items()}
    words = sum(sizes[r.doc_id] for r in docs.collect())
    assert words == pytest.approx(sum(sizes.values()), rel=0.05)
    assert docs.select("shard").distinct().count() == stages.SHARDS


def test_stages_with_odd_columns(spark, folder):
    """Columns of names that stages use themselves, and a dot in a name, come back untouched."""
    odd = {c: f"{c} of the input" for c in ("label", "score", "id", "a.b", "size", "key", "print", "edge")}
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({c: F.lit(v) for c, v in odd.items()})
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/odd-{i}")
        before, docs = docs, spark.read.parquet(f"{folder}/odd-{i}")
        if name != "sharding":
            assert docs.columns == before.columns
        assert docs.select(*[F.col(f"`{c}`") for c in odd]).distinct().collect() == [tuple(odd.values())]
        empty = stage(spark, before.limit(0), SF)
        assert empty.count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "text", "shard"} <= set(out.columns) and out.count() > 0
