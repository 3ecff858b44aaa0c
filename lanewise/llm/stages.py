"""The stages of the corpus pipeline: (spark, docs, sf_dir) to the next stage's documents.

Each stage works on all documents that the one before kept, as written; all but the last
return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import read
from .decontaminate import drop_leaks
from .mixing import Mix
from .sharding import assign_shards
from .simhash import drop_near_duplicates
from .toxicity import fit_toxicity, score_toxicity

SHARDS = 24
REJECTED = 0.7


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, taught by all labels, scores below 0.7.

    Null and wordless texts score as the bias does and stay; equal texts go or stay
    together; an empty table stays empty.  Columns of any name are returned as they were.
    """
    model = fit_toxicity(docs, read(spark, sf_dir, "labels"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    scored = score_toxicity(docs.select(row.alias("row"), "text"), model)
    return scored.filter(F.col("score") < REJECTED).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of smallest doc_id, of each component of fingerprints that differ
    in at most 3 bits (three-word shingles).

    Texts without words are one component.  A null doc_id stays only where its component
    has no other; repeated rows stay once; an empty table stays empty.
    """
    return drop_near_duplicates(docs, radius=3, width=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item; texts without words have none and stay.

    Each row is judged alone, so repeated rows, null ids and empty tables need no rule.
    """
    return drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    A null source is a source of its own and a null text has size 0; rows equal in doc_id
    and text are taken together; an empty table gives an empty mix.
    """
    return Mix(docs).documents()


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the shard that holds them.

    Equal texts share a shard, null and empty ones too; an empty table stays empty.
    """
    return assign_shards(docs, SHARDS)
