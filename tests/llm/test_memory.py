"""What operators hold at once: bounded batches for Python workers, broadcasts let go."""

import pytest
from pyspark import Broadcast
from pyspark.sql import functions as F
from test_operators import odd_texts, table  # noqa: F401

from lanewise.llm import collocations, common, jaccard_join, runs, suffix_tree

common_store = collocations.store
KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def suffix_scores(docs):
    return suffix_tree.score_texts(docs, suffix_tree.fit_model(docs))


def phrases(docs):
    return collocations.mine_collocations(docs.withColumn("lang", F.lit("x")))


@pytest.mark.parametrize(
    "run, bounded",
    [
        (suffix_scores, {"suffix-words", "run-counts", "suffix-scores"}),
        (phrases, {"phrase-counts"}),
        (jaccard_join.jaccard_groups, {"join-rows", "join-live", "join-members"}),
    ],
)
def test_batches_are_bounded_and_broadcasts_let_go(spark, odd_texts, monkeypatch, run, bounded):  # noqa: F811
    written, sent, gone = {}, [], []

    def stored(df, name, store=common_store):
        written[name] = spark.conf.get(KEY, None)
        return store(df, name)

    for module in (collocations, jaccard_join, runs, suffix_tree):
        monkeypatch.setattr(module, "store", stored)
    send, let_go = type(spark.sparkContext).broadcast, Broadcast.unpersist
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda sc, x: sent.append(b := send(sc, x)) or b)
    monkeypatch.setattr(Broadcast, "unpersist", lambda b, *a: gone.append(b) or let_go(b, *a))
    before = spark.conf.get(KEY, None)
    run(table(spark, odd_texts))
    assert {written[name] for name in bounded} == {str(common._BATCH_BYTES)}
    assert spark.conf.get(KEY, None) == before
    assert sent and {id(b) for b in sent} == {id(b) for b in gone}


def test_batches_of_long_texts(spark):
    docs = spark.range(3000, numPartitions=1).select(F.repeat(F.lit("abcdefgh "), 1000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield common.pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})

    with common.bounded_batches(spark):
        most = docs.mapInArrow(sizes, "bytes long").agg(F.max("bytes"), F.count("*")).first()
    assert most[0] < 2 * common._BATCH_BYTES and most[1] > 5
