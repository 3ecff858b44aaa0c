"""A corpus pipeline: each stage works on all documents that the one before kept."""

from pyspark.sql import DataFrame, SparkSession

from lanewise.llm import stages
from lanewise.session import store

STAGES = [
    ("toxicity", stages.toxicity),
    ("near duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("mixing", stages.mixing),
    ("sharding", stages.sharding),
]

#: The stages score with trained models, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each result written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
