"""Quality rules and a hashed n-gram log-likelihood ratio for every document.

Two multinomials over hashed word and word-pair buckets are counted: one from trusted
documents, one from the whole corpus.  A document's verdict is the mean log ratio of its
n-grams under the two, compared with a fixed threshold.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.skew import broadcast_if, fits_in_memory
from .flat import SPACE, Flat, flat_slices

BITS = 16
#: Characters counted as symbols: fixed values.
_SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.isin(np.arange(256), list(_SYMBOLS))
_WINDOW = 8
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.array([(0x9E3779B97F4A7C15 * (2 * i + 1) | 1) & (2**64 - 1) for i in range(_WINDOW)], np.uint64)


def repeated_places(words: list[bytes]) -> int:
    """Words that lie in a window of eight words found twice or more, exactly."""
    if len(words) <= _WINDOW:
        return 0
    numbers: dict[bytes, int] = {}
    ranks = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    span = 1
    while span < _WINDOW:
        pairs = ranks[:-span] * (int(ranks.max()) + 1) + ranks[span:]
        ranks, span = np.unique(pairs, return_inverse=True)[1], span * 2
    repeated = np.flatnonzero(np.bincount(ranks)[ranks] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    edges[repeated] += 1
    edges[repeated + _WINDOW] -= 1
    return int((np.cumsum(edges[:-1]) > 0).sum())


def _repeats(flat: Flat, starts: np.ndarray, ends: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """``repeated_places`` of every text; only texts in which hashes repeat are looked at."""
    found = np.zeros(len(flat.texts), np.int64)
    places = len(starts) - _WINDOW + 1
    if places < 2:
        return found
    words = flat.hashes(starts, ends)
    mixed = owners[:places].astype(np.uint64) * _PAIR
    for i in range(_WINDOW):
        mixed += words[i : i + places] * _ODD[i]
    inside = owners[:places] == owners[_WINDOW - 1 :]
    owner, mixed = owners[:places][inside], mixed[inside]
    order = np.argsort(mixed)
    equal = mixed[order][1:] == mixed[order][:-1]
    for i in np.unique(owner[order[1:][equal]]):
        found[i] = repeated_places(flat.texts[i].split())
    return found


def _repeated_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def base_counts(flat: Flat) -> list[np.ndarray]:
    """Per text: words, characters in words, symbols, repeated lines, words in repeated
    windows."""
    starts, ends, owners = flat.runs(np.minimum(flat.kinds, 1))
    begins = np.concatenate([[0], flat.stops[:-1]])
    visible = (flat.kinds != SPACE) & ((flat.data & 0xC0) != 0x80)
    return [
        flat.per_text(owners),
        np.add.reduceat(visible, begins, dtype=np.int64),
        np.add.reduceat(_IS_SYMBOL[flat.data], begins, dtype=np.int64),
        np.fromiter(map(_repeated_lines, flat.texts), np.int64, len(flat.texts)),
        _repeats(flat, starts, ends, owners),
    ]


def grams(flat: Flat, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each text, and the text numbers they belong to.

    Tokens are runs of letters and digits (bytes above 127 among them) and runs of other
    visible characters, as written; n-grams are tokens and pairs of neighbours.
    """
    starts, ends, owners = flat.runs(flat.kinds)
    one = flat.hashes(starts, ends)
    same = owners[1:] == owners[:-1]
    two = (one[:-1] * _PAIR + (one[1:] ^ (one[1:] >> np.uint64(31))))[same]
    mixed = np.concatenate([one, two]) * _PAIR
    buckets = (mixed >> np.uint64(64 - bits)).astype(np.int64)
    return buckets, np.concatenate([owners, owners[1:][same]])


def _counts(docs: DataFrame, text: Column, bits: int) -> np.ndarray:
    """n-grams of all ``docs`` per bucket: one array per task, added up by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for flat in flat_slices(batch.column(0)):
                total += np.bincount(grams(flat, bits)[0], minlength=1 << bits)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    parts = docs.select(text.alias("text")).mapInArrow(count, "bucket long, n long")
    total = np.zeros(1 << bits)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        total[row.bucket] = row.n
    return total


def log_ratio(target: np.ndarray, raw: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """log of trusted over raw probability per bucket.

    The trusted counts are smoothed towards the raw multinomial, so a bucket about which
    the trusted sample says nothing weighs nothing.
    """
    raw_p = (raw + 1e-9) / (raw.sum() + 1e-9 * len(raw))
    target_p = (target + smoothing * len(raw) * raw_p) / (target.sum() + smoothing * len(raw))
    return np.log(target_p / raw_p)


def fit_ratio(
    docs: DataFrame,
    trusted: DataFrame,
    bits: int = BITS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> np.ndarray:
    """Log ratios per bucket from all of ``docs`` and the trusted ones among them.

    ``trusted`` has the ids of trusted documents; all of these make the target counts.  The
    ids are copied to every executor where they are measured to fit, and meet the documents
    in a shuffle otherwise.  The raw counts cover all documents.  Without trusted documents
    all ratios are 0.
    """
    ids = trusted.select(F.col(doc_id).alias("__id")).filter("__id is not null").distinct()
    ids = broadcast_if(ids, fits_in_memory(ids))
    raw = _counts(docs, F.col(text), bits)
    target = _counts(docs.join(ids, F.col(doc_id) == F.col("__id"), "semi"), F.col(text), bits)
    if not target.sum():
        return np.zeros(1 << bits)
    return log_ratio(target, raw)


def judge(
    docs: DataFrame,
    ratios: np.ndarray,
    threshold: float = -0.15,
    least_words: int = 20,
    text: str = "text",
) -> DataFrame:
    """All rows and columns of ``docs`` with the base counts, ``llr`` and ``kept``.

    New columns (existing ones of the same name are replaced): n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words (long), llr (double, mean log ratio of the
    n-grams; 0 without any), base_failed (fewer than ``least_words`` words, or over 30 % of
    the words in repeated windows of eight) and kept (not failed and llr at least
    ``threshold``).  Null and empty texts have zero counts and fail.  Whole texts count,
    however long; rows are judged one by one, so repeated rows agree.
    """
    spark, bits = docs.sparkSession, len(ratios).bit_length() - 1
    sent = spark.sparkContext.broadcast(ratios.astype(np.float64))
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    @F.arrow_udf("struct<" + ", ".join(f"{f}: long" for f in fields) + ", llr: double>")
    def measured(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = [[np.zeros(0, np.int64)] for _ in fields] + [[np.zeros(0)]]
            for flat in flat_slices(column):
                buckets, owners = grams(flat, bits)
                number = np.maximum(flat.per_text(owners), 1)
                mean = flat.per_text(owners, sent.value[buckets]) / number
                for part, values in zip(parts, [*base_counts(flat), mean], strict=True):
                    part.append(values)
            arrays = [pa.array(np.concatenate(part)) for part in parts]
            yield pa.StructArray.from_arrays(arrays, [*fields, "llr"])

    out = docs.withColumn("__measured", measured(F.col(text)))
    out = out.withColumns({f: F.col(f"__measured.{f}") for f in [*fields, "llr"]}).drop("__measured")
    few = F.col("n_words") < least_words
    repeats = F.col("n_repeat_words") * 100 > F.col("n_words") * 30
    return out.withColumn("base_failed", few | repeats).withColumn(
        "kept", ~F.col("base_failed") & (F.col("llr") >= threshold)
    )
