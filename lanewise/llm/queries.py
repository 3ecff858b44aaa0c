"""The registered queries of this package and their SQL twins."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from .collocations import duckdb_collocations, mine_collocations
from .common import held_out, read
from .decontaminate import find_items
from .jaccard_join import duckdb_groups, jaccard_groups
from .langid import fit_languages, predict_languages
from .licenses import duckdb_scan, scan_licences
from .merkle import duckdb_manifest, manifest, without_newlines
from .mixing import Mix, duckdb_mix
from .pseudonyms import pseudonymise
from .quality import fit_ratio, judge
from .sharding import shard_slots
from .simhash import hex_print, simhash_groups
from .suffix_tree import fit_model, score_texts
from .toxicity import fit_toxicity, score_toxicity


#: For reruns that agree; a real job takes its key from its own secret store.
_KEY = b"reproducible-demonstration-key"


def op1_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, _KEY).select(
        "doc_id", "text", F.size("pii").cast("long").alias("n_found"), F.col("pii.kind").alias("kinds")
    )


def op2_pigeonhole_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return find_items(docs, items).select(
        "doc_id",
        (F.size("leaks") > 0).alias("leaked"),
        F.size("leaks").cast("long").alias("n_leaks"),
        F.col("leaks.item_id").alias("item_ids"),
        F.col("leaks.errors").alias("errors"),
    )


def op3_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_slots(read(spark, sf_dir, "documents"), 24).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_toxicity_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"), 3, 1))
    return score_toxicity(docs, fit_toxicity(docs, labels)).select(
        "doc_id",
        held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op5_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(read(spark, sf_dir, "documents")).select(
        "doc_id", hex_print(F.col("print")).alias("fingerprint"), "component_id"
    )


def op6_language_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = held_out(F.col("doc_id"), 4, 2)
    network = fit_languages(docs.filter(~out))
    return predict_languages(docs.select("doc_id", "text"), network).select(
        "doc_id", out.alias("held_out"), "lang_pred", "score"
    )


def op7_sentence_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licences(docs).select(
        "doc_id",
        F.array_join("sentences", ",").alias("sentences"),
        F.array_join("licences", ",").alias("licences"),
    )


def op8_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 7, 2)
    return score_texts(docs, fit_model(docs.filter(~out))).withColumn("held_out", out)


def op9_quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = read(spark, sf_dir, "labels").filter("quality = 1")
    return judge(docs, fit_ratio(docs, trusted)).drop("text")


def op10_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = Mix(read(spark, sf_dir, "documents"))
    return mix.taken().select("doc_id", "size", "source_size", "target", "taken")


def op11_phrase_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of each language from count streams merged in prefix and suffix order.

    Null texts are empty, a null lang is ``und``; equal scores are ordered by count and
    phrase; repeated rows count again; an empty table gives no rows.
    """
    return mine_collocations(read(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and check against the manifest's root.

    A null field is ``-``; a null source is a source of its own; repeated rows are leaves of
    their own, equal doc_ids in the order of their leaves; an empty table gives no rows.
    """
    docs = read(spark, sf_dir, "documents")
    changed = without_newlines(F.col("doc_id"), F.col("text"))
    return manifest(docs, tampered=changed).drop("source")


def op13_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose four-word shingle sets overlap by 0.85 or more.

    Null and wordless texts link with nothing; equal sets and repeated rows link; an empty
    table gives no rows.
    """
    return jaccard_groups(read(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_feistel_pseudonyms,
        op2_pigeonhole_leaks,
        op3_minimax_shards,
        op4_toxicity_machine,
        op5_simhash_components,
        op6_language_network,
        op7_sentence_licences,
        op8_suffix_tree,
        op9_quality_ratio,
        op10_weighted_mix,
        op11_phrase_streams,
        op12_merkle_manifest,
        op13_jaccard_components,
    )
}
ORACLES = {
    "op7_sentence_licences": duckdb_scan("documents"),
    "op10_weighted_mix": duckdb_mix("documents"),
    "op11_phrase_streams": duckdb_collocations("documents"),
    "op12_merkle_manifest": duckdb_manifest("documents"),
    "op13_jaccard_components": duckdb_groups("documents"),
}
