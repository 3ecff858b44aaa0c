"""Scoring texts by a probabilistic suffix tree over words.

A text is its words (A-Z in lower case) and one end token.  The tree's symbols are the
frequent words, the end, and one class for all other words.  Its contexts are runs of up
to ``DEPTH`` frequent words.  A context is kept when it is frequent enough and the symbols
after it are distributed differently from those after its suffix one word shorter.  A token
is predicted by the longest kept context before it, smoothed by the shorter ones down to
the empty context; a word of the other class then by its share of that class, where all
words never seen in training count as one.

Which contexts and continuations enter is a matter of how often they stand, whatever the size
of the corpus: every word is then a symbol, and the tree is a table that grows with the corpus
(``runs.py``).  A tree of bounded size, to be held in memory, asks for fixed shares of all
training tokens instead (``Shares``).  Counting covers the whole corpus in both.  Beside that
score stands a base score from word counts alone.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import settle, store
from .common import binary_values, bounded_batches, plain_words
from .runs import Held, HeldRuns, Runs, RunTree, fit_runs, rest_bits, token_codes

DEPTH = 3
#: How often a continuation must stand after its context to enter.
LEAST = 10
#: Bits of a symbol; 1 / ``Shares.symbol`` symbols must fit.
_BITS = 14
#: The end token; no word contains it.
END = b"\n"
_SLICE_WORDS = 1 << 16
_HELD_CODES = 1 << 20
_HELD_WORDS = 200_000


@dataclass(frozen=True)
class Shares:
    """What shares of all training tokens symbols, contexts and continuations need."""

    symbol: float = 1e-4
    context: float = 1e-4
    continuation: float = 1e-6
    divergence: float = 0.01


def _word_lists(column: pa.Array) -> Iterator[list[bytes]]:
    for value in binary_values(column):
        yield plain_words(value.lower() if value else None)


def _slices(column: pa.Array) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for words in _word_lists(column):
        held.append(words)
        size += len(words) + 1
        if size > _SLICE_WORDS:
            yield held
            held, size = [], 0
    if held:
        yield held


def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """``word`` (binary) and ``n``: how often each token stands in all of ``texts``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def rows():
            columns = [pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            for words in _word_lists(batch.column(0)):
                held.update(words)
                held[END] += 1
                if len(held) > _HELD_WORDS:
                    yield rows()
                    held.clear()
        yield rows()

    parts = texts.select(text).mapInArrow(count, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


class Symbols:
    """Numbers of the frequent words (1 and up, 0 for all others)."""

    def __init__(self, words: list[bytes]):
        if len(words) >= 1 << _BITS:
            raise ValueError("too many frequent words for the symbol width")
        self.numbers = {word: i + 1 for i, word in enumerate(words)}

    def stream(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all tokens in order, their contexts, and where each text begins.

        A context has the symbol just before in its lowest bits.  It reaches back to the
        nearest word of the other class, and before a text stand ends.
        """
        number, end = self.numbers.get, self.numbers.get(END, 0)
        gap = [end] * DEPTH
        every: list[int] = list(gap)
        starts = []
        for words in texts:
            starts.append(len(every))
            every += [number(w, 0) for w in words]
            every += gap
        symbols = np.array(every, np.int64)
        context, whole = np.zeros(len(symbols), np.int64), np.ones(len(symbols), bool)
        for back in range(1, DEPTH + 1):
            before = np.zeros_like(symbols)
            before[back:] = symbols[:-back]
            whole &= before > 0
            context |= np.where(whole, before, 0) << (_BITS * (back - 1))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        starts = np.array(starts, np.int64)
        firsts = np.cumsum(lengths) - lengths
        places = np.arange(lengths.sum()) + np.repeat(starts - firsts, lengths)
        return symbols[places], context[places], firsts


def gram_counts(texts: DataFrame, symbols: Symbols, text: str = "text") -> DataFrame:
    """``code`` and ``n``: every token's symbol with its context, over all of ``texts``.

    The symbol is in the lowest bits of the code, the context above it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, numbers, fresh, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def merged():
            every = np.concatenate([codes, *fresh])
            weight = np.concatenate([numbers, np.ones(len(every) - len(numbers), np.int64)])
            order = np.argsort(every, kind="stable")
            every, weight = every[order], weight[order]
            first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]][: len(every)])
            return every[first], np.add.reduceat(weight, first) if len(first) else weight

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(numbers)], ["code", "n"])

        for batch in batches:
            for part in _slices(batch.column(0)):
                symbol, context, _ = symbols.stream(part)
                fresh.append(context << _BITS | symbol)
                size += len(symbol)
                if size > _HELD_CODES:
                    codes, numbers = merged()
                    fresh, size = [], 0
                    if len(codes) > _HELD_CODES:
                        yield rows()
                        codes, numbers = codes[:0], numbers[:0]
        codes, numbers = merged()
        yield rows()

    parts = texts.select(text).mapInArrow(count, "code long, n long")
    return parts.groupBy("code").agg(F.sum("n").alias("n"))


def _mask(symbols: int) -> int:
    return (1 << (_BITS * symbols)) - 1


def kept_contexts(grams: DataFrame, shares: Shares) -> DataFrame:
    """``depth``, ``context``, ``total``, ``symbol``, ``n`` of the contexts to keep.

    A context is kept when it precedes the share ``context`` of all tokens and the
    Kullback-Leibler divergence of its next symbols from those of its suffix one shorter
    is at least ``divergence`` nats.  Continuations below the share ``continuation`` are
    left to smoothing.
    """
    levels = [settle(grams)]
    for depth in range(DEPTH - 1, -1, -1):
        short = F.col("code").bitwiseAND(F.lit(_mask(depth + 1)))
        levels.insert(0, settle(levels[0].groupBy(short.alias("code")).agg(F.sum("n").alias("n"))))
    tokens = levels[0].agg(F.sum("n")).first()[0] or 0
    context, symbol = F.shiftright("code", _BITS), F.col("code").bitwiseAND(F.lit(_mask(1)))
    kept, shorter = [], None
    for depth, level in enumerate(levels):
        rows = level.select(context.alias("context"), symbol.alias("symbol"), "n")
        if depth:
            rows = rows.filter(F.shiftright("context", _BITS * (depth - 1)) > 0)
        totals = rows.groupBy("context").agg(F.sum("n").alias("total"))
        rows = rows.join(totals.filter(F.col("total") >= shares.context * tokens), "context")
        if depth:
            suffix = F.col("context").bitwiseAND(F.lit(_mask(depth - 1)))
            p = F.col("n") / F.col("total")
            before = shorter.select(
                F.col("context").alias("suffix"),
                F.col("symbol").alias("also"),
                (F.col("n") / F.col("total")).alias("q"),
            )
            both = rows.join(before, (suffix == F.col("suffix")) & (F.col("symbol") == F.col("also")))
            apart = both.groupBy("context").agg(F.sum(p * F.log(p / F.col("q"))).alias("apart"))
            chosen = rows.join(apart.filter(F.col("apart") >= shares.divergence), "context")
            chosen = chosen.filter(F.col("n") >= shares.continuation * tokens)
            kept.append(chosen.select(F.lit(depth).alias("depth"), "context", "total", "symbol", "n"))
        shorter = rows
    result = kept[0]
    for rows in kept[1:]:
        result = result.unionByName(rows)
    return result


def _find(ordered: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(ordered, wanted), max(len(ordered) - 1, 0))
    return at, ordered[at] == wanted if len(ordered) else np.zeros(len(wanted), bool)


class SuffixTree:
    """The kept contexts, by depth: context numbers, totals, and continuations with counts."""

    def __init__(self, symbols: Symbols, root: np.ndarray, rows: pa.Table):
        self.symbols, self.root, self.levels = symbols, root, []
        depth, context, total, symbol, n = (
            rows[c].to_numpy() for c in ("depth", "context", "total", "symbol", "n")
        )
        for level in range(1, DEPTH + 1):
            own = depth == level
            contexts, first, back = np.unique(context[own], return_index=True, return_inverse=True)
            stored = np.bincount(back, n[own], len(contexts))
            # What smoothing gets: continuations left out, and one per different symbol.
            weight = total[own][first] - stored + np.bincount(back, minlength=len(contexts))
            pairs = back.astype(np.int64) << _BITS | symbol[own]
            order = np.argsort(pairs)
            self.levels.append((contexts, stored, weight, pairs[order], n[own][order].astype(np.float64)))

    def chances(self, symbol: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Probability of each symbol by the longest kept context that its context ends with."""
        chance = self.root[symbol]
        for depth, (contexts, stored, weight, pairs, numbers) in enumerate(self.levels, 1):
            if not len(contexts):
                continue
            at, there = _find(contexts, context & _mask(depth))
            there &= context >> (_BITS * (depth - 1)) > 0
            at, own = at[there], np.flatnonzero(there)
            place, seen = _find(pairs, at << _BITS | symbol[own])
            number = np.where(seen, numbers[place], 0.0)
            chance[own] = (number + weight[at] * chance[own]) / (stored[at] + weight[at])
        return chance

    @property
    def numbers(self) -> dict[bytes, int]:
        return self.symbols.numbers

    def scores(self, texts: list[list[bytes]], runs: Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 probability of the symbols of each text; nothing is left to a join."""
        symbol, context, firsts = self.symbols.stream(texts)
        logs = np.add.reduceat(np.log10(self.chances(symbol, context)), firsts)
        return logs, np.zeros(len(texts), np.int64), np.zeros(0, np.int64)


@dataclass
class Model:
    """The tree with the word counts it rests on (``counts``: columns word, n)."""

    tree: SuffixTree | RunTree
    counts: DataFrame
    tokens: int
    distinct: int
    discount: float
    other: float  # share of the other class
    frequent_least: int  # the least count of a frequent word other than the end

    @property
    def unseen(self) -> float:
        """Share of all words never seen in training, as one word."""
        return self.discount * self.distinct / self.tokens if self.tokens else 1.0


def fit_model(
    texts: DataFrame,
    shares: Shares | None = None,
    discount: float = 0.4,
    text: str = "text",
    least: int = LEAST,
    divergence: float = 0.01,
) -> Model:
    """Learn from all of ``texts``.

    A context enters with the continuations that stand ``least`` times after it, if what
    follows differs by ``divergence`` nats from what follows its suffix; ``shares`` asks for
    a bounded tree instead.  Every known word gives ``discount`` of its count to the words
    never seen.  Without texts nothing is known, and every token is the unseen word.
    """
    with bounded_batches(texts.sparkSession):
        counts = store(word_counts(texts, text), "suffix-words")
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    if shares is None:
        tree = fit_runs(texts.select(text), counts, tokens, discount, least, divergence)
        return Model(tree, counts, tokens, distinct, discount, 1.0, 0)
    frequent = counts.filter((F.col("n") >= shares.symbol * tokens) | (F.col("word") == F.lit(END)))
    chosen = sorted(((r.n, bytes(r.word)) for r in frequent.collect()), reverse=True)
    symbols = Symbols([word for _, word in chosen])
    share = [(n - discount) / tokens for n, _ in chosen]
    other = max(1.0 - sum(share), 1e-12) if tokens else 1.0
    grams = store(gram_counts(texts, symbols, text), "suffix-grams")
    tree = SuffixTree(symbols, np.array([other, *share]), kept_contexts(grams, shares).toArrow())
    fewest = min((n for n, word in chosen if word != END), default=0)
    return Model(tree, counts, tokens, distinct, discount, other, fewest)


def _common_least(counts: DataFrame, most: int) -> int:
    """A count ``n`` that at most ``most`` rows reach."""
    step = F.floor(F.log2("n") * 8)
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("n"))
    least, words = 1 << 62, 0
    for row in sorted(sizes.collect(), key=lambda r: -r.step):
        words += row.words
        if words > most:
            break
        least = row.n
    return least


def _common_words(model: Model, most: int) -> tuple[int, dict[bytes, int]]:
    """A count that at most ``most`` words or all frequent ones reach, and those words."""
    counts = model.counts
    least = _common_least(counts, most)
    if model.frequent_least:
        least = min(least, model.frequent_least)
    common = counts.filter((F.col("n") >= least) | (F.col("word") == F.lit(END))).toArrow()
    return least, dict(zip(common["word"].to_pylist(), common["n"].to_pylist(), strict=True))


def _held_runs(tree: RunTree, most: int) -> tuple[HeldRuns, DataFrame | None]:
    """The values of at most ``most`` runs for every task, and the table of the others."""
    least = _common_least(tree.values, most)
    held, rest = tree.values.filter(F.col("n") >= least).toArrow(), tree.values.filter(F.col("n") < least)
    none = rest.isEmpty()
    codes, values = held["code"].to_numpy().view(np.uint64), held["value"].to_numpy()
    return HeldRuns(tree.bits, codes, values, None if none else rest_bits(rest)), None if none else rest


def score_texts(
    docs: DataFrame,
    model: Model,
    doc_id: str = "doc_id",
    text: str = "text",
    most_common: int = 200_000,
    most_runs: int = 300_000,
) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    The counts of at most ``most_common`` words are copied to every task; other words are
    added up per document and meet their counts in a join, and so do the values of all but
    ``most_runs`` runs of a tree that is a table.  Null and empty texts have the
    end token only; repeated rows stay repeated; other columns are not looked at.
    """
    least, common = _common_words(model, most_common)
    discount, other, frequent = model.discount, model.other * max(model.tokens, 1), model.tree.numbers
    held, rest = _held_runs(model.tree, most_runs) if isinstance(model.tree, RunTree) else (model.tree, None)
    times = np.fromiter(common.values(), np.float64, len(common))
    own = np.fromiter((word in frequent for word in common), bool, len(common))
    table = Held(token_codes(list(common)), np.log10(times + 1.0), np.where(own, 0.0, np.log10((times - discount) / other)))
    sent = docs.sparkSession.sparkContext.broadcast((held, table))
    kind = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))

    @F.arrow_udf(
        "struct<n_tokens: long, known: long, base: double, score: double,"
        " rare: array<struct<word: binary, times: long>>, runs: array<long>>"
    )
    def scored(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tree, table = sent.value
        for column in columns:
            tokens, known, base, score = ([np.zeros(0)] for _ in range(4))
            rare, many, left = [], [np.zeros(1, np.int64)], [np.zeros(0, np.int64)]
            for texts in _slices(column):
                runs = Runs([b" ".join(words) for words in texts])
                logs, others, codes = tree.scores(texts, runs)
                many.append(others)
                left.append(codes)
                at = np.flatnonzero(runs.place)
                owner, place = runs.owner[at], table.find(runs.tokens[at])
                there = place >= 0
                whose, place = owner[there], place[there]
                added, first = (np.bincount(whose, values[place], len(texts)) for values in table.columns)
                tokens.append(np.bincount(owner, minlength=len(texts)))
                known.append(np.bincount(whose, minlength=len(texts)))
                base.append(added)
                score.append(logs + first)
                unknown: list[Counter] = [Counter() for _ in texts]
                at = at[~there]
                for text, word in zip(owner[~there].tolist(), (runs.place[at] - 1).tolist(), strict=True):
                    words = texts[text]
                    unknown[text][words[word] if word < len(words) else END] += 1
                rare += [[{"word": word, "times": n} for word, n in counter.items()] for counter in unknown]
            arrays = [
                pa.array(np.concatenate(tokens).astype(np.int64)),
                pa.array(np.concatenate(known).astype(np.int64)),
                pa.array(np.concatenate(base)),
                pa.array(np.concatenate(score)),
                pa.array(rare, kind),
                pa.ListArray.from_arrays(np.cumsum(np.concatenate(many)).astype(np.int32), np.concatenate(left)),
            ]
            yield pa.StructArray.from_arrays(arrays, ["n_tokens", "known", "base", "score", "rare", "runs"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), scored(F.col(text)).alias("s"))
    try:
        with bounded_batches(docs.sparkSession):
            rows = store(rows.select("doc_id", "s.*", F.monotonically_increasing_id().alias("row")), "suffix-scores")
    finally:
        # Workers hold the values until they are told to let them go.
        sent.unpersist()
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.times")
    times, n = F.col("times"), F.col("n")
    added = (
        rare.join(model.counts.filter((n < least) & (F.col("word") != F.lit(END))), "word")
        .groupBy("row")
        .agg(
            F.sum("times").alias("more"),
            F.sum(times * F.log10(n + 1.0)).alias("more_base"),
            F.sum(times * F.log10((n - discount) / other)).alias("more_score"),
        )
    )
    if rest is not None:
        others = rows.select("row", F.explode("runs").alias("code")).join(rest.select("code", "value"), "code")
        others = others.groupBy("row").agg(F.sum("value").alias("more_runs"))
        rows = rows.join(others, "row", "left").withColumn("score", F.col("score") + F.coalesce("more_runs", F.lit(0.0)))
    more = F.coalesce("more", F.lit(0))
    never = F.col("n_tokens") - F.col("known") - more
    unseen = F.log10(F.lit(model.unseen / model.other))
    all_tokens = F.lit(float(model.tokens + model.distinct + 1))
    return rows.drop("rare", "runs").join(added, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + more).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * F.log10(all_tokens)).alias(
            "base_score"
        ),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0)) + never * unseen).alias("score"),
    )
