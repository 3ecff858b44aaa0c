"""Runs of tokens that stand often enough, as tables: a suffix tree that grows with its corpus.

A text is its tokens (words and one end) after one end that stands for its beginning; a run
is up to ``LONGEST`` tokens of it in a row, known by a 64-bit hash.  A run of two or more is a
context (all but its last token) with a continuation.  Runs that stand ``least`` times are
kept, whatever the size of the corpus.  They are found level by level: hashes of the runs
whose two parts one shorter may stand often enough are counted into a bitmap of fixed size,
which may let rare runs through and keeps no frequent one out; what passes is counted exactly.

A text's score needs each run's value only once for each time that it stands there, so the
values of the most frequent runs are copied to every task, and the others meet theirs in a join.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from ..session import store
from .collocations import _bitmap, _joined, often_bits, passes
from .common import binary_values, bounded_batches
from .flat import SPACE, Flat

LONGEST = 4
END_WORD = b"\n"
_END = np.uint64(0x6C8E9CF570932BD5)
_BYTES = 1 << 19
#: Hashes that a task holds before it sends them on.
_HASHES = 2_000_000


class Runs:
    """The runs of some texts (lower-cased bytes): ``tokens`` are the hashes of all tokens,
    ``place`` their places in their texts (0 is the beginning), ``owner`` the texts' numbers."""

    def __init__(self, texts: list[bytes]):
        flat = Flat(texts)
        starts, ends, owners = flat.runs((flat.kinds != SPACE).astype(np.uint8))
        lengths = np.bincount(owners, minlength=len(texts)) + 2
        stops = np.cumsum(lengths)
        self.tokens = np.full(stops[-1], _END, np.uint64)
        if len(starts):
            self.tokens[np.arange(len(starts)) + 2 * owners + 1] = flat.hashes(starts, ends)
        self.owner = np.repeat(np.arange(len(texts)), lengths)
        self.last = stops - 1
        self.place = np.arange(stops[-1]) - np.repeat(stops - lengths, lengths)

    def levels(self, bits: list[np.ndarray], count: int) -> Iterator[tuple[np.ndarray, ...]]:
        """For runs of 1, 2, ... ``count`` tokens where they end, their hashes and those of
        all but the last and all but the first token, where both of these pass ``bits``."""
        at, codes = np.arange(len(self.tokens)), self.tokens
        heads = tails = codes
        for length in range(1, count + 1):
            yield at, codes, heads, tails
            if length == count:
                return
            may = passes(codes, bits[length - 1])
            at, codes = at[may], codes[may]
            near = np.flatnonzero((at[1:] == at[:-1] + 1) & (self.place[at[1:]] >= length))
            at, heads, tails = at[near + 1], codes[near], codes[near + 1]
            codes = _joined(heads, self.tokens[at])


def _runs(column: pa.Array) -> Iterator[Runs]:
    held, size = [], 0
    for value in binary_values(column):
        held.append((value or b"").lower())
        size += len(held[-1])
        if size > _BYTES:
            yield Runs(held)
            held, size = [], 0
    if held:
        yield Runs(held)


class Held:
    """Numbers (``columns``) of some hashes, held in memory."""

    def __init__(self, codes: np.ndarray, *columns: np.ndarray):
        order = np.argsort(codes)
        self.codes, self.columns = codes[order], [column[order] for column in columns]
        bits = max(len(codes), 2).bit_length()
        self.shift = np.uint64(64 - bits)
        firsts = np.arange((1 << bits) + 1, dtype=np.uint64)
        self.starts = np.searchsorted(self.codes >> self.shift, firsts).astype(np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Where the wanted hashes stand, -1 for those that are not held."""
        first = (wanted >> self.shift).astype(np.int64)
        at, stop = self.starts[first], self.starts[first + 1]
        places = np.full(len(wanted), -1, np.int64)
        left = np.flatnonzero(at < stop)
        while len(left):
            same = self.codes[at[left]] == wanted[left]
            places[left[same]] = at[left[same]]
            left = left[~same]
            at[left] += 1
            left = left[at[left] < stop[left]]
        return places


def token_codes(words: list[bytes]) -> np.ndarray:
    """The hash of each token."""
    if not words:
        return np.zeros(0, np.uint64)
    runs = Runs([b"" if w == END_WORD else w for w in words])
    return runs.tokens[runs.place == 1]


def word_codes(word: Column) -> Column:
    """The hash of each token."""

    @F.arrow_udf("long")
    def coded(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array(token_codes(column.to_pylist()).view(np.int64))

    return coded(word)


def sieve(texts: DataFrame, sent: list[Broadcast], least: int) -> np.ndarray:
    """The bitmap of the runs of one token more than there are bitmaps ``sent``: the bit of
    every run that stands ``least`` times or more."""
    length = len(sent) + 1

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        known = [bits.value for bits in sent]
        for batch in batches:
            for runs in _runs(batch.column(0)):
                *_, (_, codes, _, _) = runs.levels(known, length)
                yield codes

    return often_bits(texts, hashes, least)


def count_runs(texts: DataFrame, sent: list[Broadcast], least: int) -> DataFrame:
    """length, code, head (all but the last token), tail (all but the first) and n of the runs
    of 2 to ``LONGEST`` tokens that stand ``least`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, size = [bits.value for bits in sent], {}, 0

        def rows() -> Iterator[pa.RecordBatch]:
            while held:
                length, parts = held.popitem()
                codes, heads, tails = map(np.concatenate, zip(*parts, strict=True))
                codes, first, n = np.unique(codes, return_index=True, return_counts=True)
                columns = [np.full(len(codes), length, np.int32), codes, heads[first], tails[first], n]
                columns = [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns]
                yield pa.RecordBatch.from_arrays(columns, ["length", "code", "head", "tail", "n"])

        for batch in batches:
            for runs in _runs(batch.column(0)):
                for length, (_, codes, *parts) in enumerate(runs.levels(known, LONGEST), 1):
                    if length > 1:
                        may = passes(codes, known[length - 1])
                        held.setdefault(length, []).append((codes[may], *(part[may] for part in parts)))
                        size += may.sum()
                if size >= _HASHES:
                    yield from rows()
                    size = 0
        yield from rows()

    counted = texts.mapInArrow(run, "length int, code long, head long, tail long, n long")
    counted = counted.groupBy("length", "code").agg(
        F.sum("n").alias("n"), F.first("head").alias("head"), F.first("tail").alias("tail")
    )
    return counted.filter(F.col("n") >= least)


def run_values(words: DataFrame, runs: DataFrame, tokens: int, discount: float, divergence: float) -> DataFrame:
    """``code``, ``n`` and ``value``: what a run adds to a text's log10 probability each time.

    A context is kept when its continuations (those that stand often enough, and all others
    as one) are distributed otherwise than after its suffix one shorter, by ``divergence``
    nats.  A kept context adds the share that it leaves to its suffix; a continuation kept with
    it what its chance differs from that.  ``words``: code, n of the frequent words and the end.
    """
    sizes = words.unionByName(runs.select("code", "n")).select(F.col("code").alias("head"), F.col("n").alias("total"))
    before = words.select(
        F.col("code").alias("tail"), (F.col("n") / tokens).alias("q"), ((F.col("n") - discount) / tokens).alias("low")
    )
    values = []
    for length in range(2, LONGEST + 1):
        level = runs.filter(F.col("length") == length).drop("length").join(sizes, "head").join(before, "tail")
        share, n = F.col("n") / F.col("total"), F.col("n")
        level = level.withColumn("p", share)
        left, left_before = 1.0 - F.sum("p"), F.greatest(1.0 - F.sum("q"), F.lit(1e-12))
        others = F.when(F.sum("n") < F.max("total"), left * F.log(left / left_before)).otherwise(0.0)
        contexts = level.groupBy("head").agg(
            F.sum("n").alias("stored"),
            F.max("total").alias("total"),
            (F.max("total") - F.sum("n") + F.count(F.lit(1))).alias("weight"),
            (F.sum(F.col("p") * F.log(F.col("p") / F.col("q"))) + others).alias("apart"),
        )
        contexts = contexts.filter(F.col("apart") >= divergence)
        back = F.col("weight") / (F.col("stored") + F.col("weight"))
        contexts = contexts.select(F.col("head").alias("context"), "stored", "weight", "total", F.log10(back).alias("back"))
        contexts = store(contexts, "run-contexts")
        kept = F.col("context").isNotNull()
        chance = (n + contexts["weight"] * F.col("low")) / (F.col("stored") + contexts["weight"])
        level = level.join(contexts, F.col("head") == F.col("context"), "left").select(
            "code",
            "n",
            "p",
            kept.alias("kept"),
            F.when(kept, chance).otherwise(F.col("low")).alias("chance"),
            F.when(kept, F.log10(chance / F.col("low")) - F.col("back")).alias("value"),
        )
        level = store(level, "run-chances")
        values.append(level.filter("kept").select("code", "n", "value"))
        values.append(contexts.select(F.col("context").alias("code"), F.col("total").alias("n"), F.col("back").alias("value")))
        before = level.select(F.col("code").alias("tail"), F.col("p").alias("q"), F.col("chance").alias("low"))
    every = values[0]
    for rows in values[1:]:
        every = every.unionByName(rows)
    return every.groupBy("code").agg(F.max("n").alias("n"), F.sum("value").alias("value"))


@dataclass
class RunTree:
    """The values of all runs (``values``: code, n, value) and the bitmaps they were found with."""

    values: DataFrame
    bits: list[np.ndarray]

    #: No word needs another model here: all are tokens of their own.
    numbers = {}


class HeldRuns:
    """What a task holds of a ``RunTree``: the values of the most frequent runs, and a bitmap of
    the others, if there are any."""

    def __init__(self, bits: list[np.ndarray], codes: np.ndarray, values: np.ndarray, rest: np.ndarray | None):
        self.bits, self.held, self.rest = bits, Held(codes, values), rest

    def scores(self, texts: list[list[bytes]], runs: Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text the sum of the values held and the number of other runs that may have
        one; these runs, text by text."""
        ends, codes = [], []
        for length, (at, own, _, _) in enumerate(runs.levels(self.bits, LONGEST), 1):
            # The end is a context at the beginning only.
            some = np.delete(at, runs.last) if length == 1 else slice(None)
            ends.append(at[some])
            codes.append(own[some])
        owner, codes = runs.owner[np.concatenate(ends)], np.concatenate(codes)
        place = self.held.find(codes)
        found = place >= 0
        sums = np.bincount(owner[found], self.held.columns[0][place[found]], len(texts))
        if self.rest is None:
            return sums, np.zeros(len(texts), np.int64), codes[:0].view(np.int64)
        owner, codes = owner[~found], codes[~found]
        may = passes(codes, self.rest)
        owner, codes = owner[may], codes[may]
        order = np.argsort(owner, kind="stable")
        return sums, np.bincount(owner, minlength=len(texts)), codes[order].view(np.int64)


def fit_runs(
    texts: DataFrame, counts: DataFrame, tokens: int, discount: float, least: int, divergence: float
) -> RunTree:
    """The tree of all runs of ``texts`` (one column) that stand ``least`` times or more.

    ``counts`` has ``word`` and ``n`` of all tokens.
    """
    words = counts.filter((F.col("n") >= least) | (F.col("word") == F.lit(END_WORD)))
    words = store(words.select(word_codes(F.col("word")).alias("code"), "n"), "run-words")
    sc, sent = texts.sparkSession.sparkContext, []
    try:
        sent.append(sc.broadcast(_bitmap(words.select(F.col("code").alias("hash")))))
        with bounded_batches(texts.sparkSession):
            while len(sent) < LONGEST:
                sent.append(sc.broadcast(sieve(texts, sent, least)))
            runs = store(count_runs(texts, sent, least), "run-counts")
        # The last bitmap is of no use to longer runs.
        bits = [one.value for one in sent[:-1]]
    finally:
        # Workers hold every bitmap until they are told to let it go.
        for one in sent:
            one.unpersist()
    return RunTree(store(run_values(words, runs, max(tokens, 1), discount, divergence), "run-values"), bits)


def rest_bits(rest: DataFrame) -> np.ndarray:
    """The bitmap of the codes of ``rest``."""
    return _bitmap(rest.select(F.col("code").alias("hash")))
