"""The quality ratio counts all trusted documents."""

import numpy as np
from pyspark.sql import functions as F

from lanewise.llm import quality


def ratios(spark):
    docs = spark.range(50_300).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id").cast("string")).alias("text")
    )
    raw = quality._counts(docs, F.col("text"), quality.BITS)
    return quality.fit_ratio(docs, docs.select("doc_id"))[raw > 0]


def test_all_trusted_is_all(spark):
    """Where every document is trusted, both multinomials are the same."""
    assert np.abs(ratios(spark)).max() < 1e-6


def test_all_trusted_is_all_without_broadcast(spark, no_broadcast):
    assert np.abs(ratios(spark)).max() < 1e-6
