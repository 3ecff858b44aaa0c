"""Toxicity by a factorization machine over hashed terms.

The score of a document is a logistic function of a bias, a weight for each of its terms
and, for each pair of its terms, the inner product of their factors; so a pair such as an
insult with a group's name can weigh more than both alone.
"""

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import store
from .common import bounded_sample, text_values

BITS = 20
_TERM = re.compile(r"[^\W_]+")
_CACHE = 200_000


class Terms(dict):
    """Hashed term of each word, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHE:
            self.clear()
        value = self[word] = zlib.crc32(word.encode("utf-8", "replace")) >> (32 - BITS)
        return value

    def of(self, text: str | None) -> list[int]:
        """The distinct hashed terms of a whole text: lower-case runs of letters and digits."""
        return sorted(map(self.__getitem__, set(_TERM.findall(text.lower())))) if text else []


@dataclass
class FactorizationMachine:
    """``terms`` (sorted) have weights and factors; all other terms weigh nothing."""

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def columns(self, found: list[int]) -> np.ndarray:
        """Places of a document's terms among ``terms``."""
        if not found or not len(self.terms):
            return np.zeros(0, np.int64)
        values = np.array(found)
        at = np.minimum(np.searchsorted(self.terms, values), len(self.terms) - 1)
        return np.unique(at[self.terms[at] == values])

    def logit(self, columns: np.ndarray) -> float:
        if not len(columns):
            return self.bias
        v = self.factors[columns]
        pairs = 0.5 * float((v.sum(0) ** 2 - (v * v).sum(0)).sum())
        return self.bias + float(self.weights[columns].sum()) + pairs

    def score(self, columns: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.logit(columns), -40, 40))))


def train(
    rows: list[np.ndarray],
    labels: np.ndarray,
    terms: np.ndarray,
    factors: int = 8,
    rounds: int = 60,
    rate: float = 0.1,
    shrink: float = 1e-3,
    batch: int = 256,
    seed: int = 7,
) -> FactorizationMachine:
    """Fit by AdaGrad on the logistic loss; ``rows`` are places among ``terms``.

    Without rows of both labels, or without terms, the machine has only a bias.
    """
    share = (labels.sum() + 0.5) / (len(labels) + 1.0)
    model = FactorizationMachine(
        terms,
        float(np.log(share / (1 - share))),
        np.zeros(len(terms)),
        np.random.default_rng(seed).normal(0, 0.05, (len(terms), factors)),
    )
    if not len(terms) or labels.min(initial=1) == labels.max(initial=0):
        return model
    flat = np.concatenate(rows)
    stops = np.cumsum([len(r) for r in rows])
    squares = [1e-8, np.full(len(terms), 1e-8), np.full(model.factors.shape, 1e-8)]
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        for part in np.array_split(order.permutation(len(rows)), max(1, len(rows) // batch)):
            owner = np.repeat(np.arange(len(part)), [len(rows[i]) for i in part])
            at = np.concatenate([flat[stops[i] - len(rows[i]) : stops[i]] for i in part])
            v = model.factors[at]
            sums = np.zeros((len(part), factors))
            np.add.at(sums, owner, v)
            own = np.bincount(owner, (v * v).sum(1), len(part))
            linear = np.bincount(owner, model.weights[at], len(part))
            logits = model.bias + linear + 0.5 * ((sums * sums).sum(1) - own)
            error = 1 / (1 + np.exp(-np.clip(logits, -40, 40))) - labels[part]
            pull = error[owner] / len(part)
            slope_w = np.bincount(at, pull, len(terms)) + shrink * model.weights / len(rows) * len(part)
            slope_v = np.zeros_like(model.factors)
            np.add.at(slope_v, at, pull[:, None] * (sums[owner] - v))
            slope_v += shrink * model.factors / len(rows) * len(part)
            slope_b = float(error.mean())
            for i, slope in enumerate((slope_b, slope_w, slope_v)):
                squares[i] = squares[i] + slope**2
            model.bias -= rate * slope_b / np.sqrt(squares[0])
            model.weights -= rate * slope_w / np.sqrt(squares[1])
            model.factors -= rate * slope_v / np.sqrt(squares[2])
    return model


def _hashed(text: Column) -> Column:
    @F.arrow_udf("array<int>")
    def terms(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Terms()
        for column in columns:
            yield pa.array([known.of(v) for v in text_values(column)], pa.list_(pa.int32()))

    return terms(text)


def _telling(rows: DataFrame, least: float, most_terms: int) -> DataFrame:
    """Terms whose share among toxic rows differs clearly (likelihood ratio statistic of at
    least ``least``), the clearest ``most_terms`` of them."""
    total, toxic = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not toxic or toxic == total:
        return rows.sparkSession.createDataFrame([], "term int")
    counts = (
        rows.select("label", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("t"))
    )

    def part(seen: Column, share: float) -> Column:
        return F.when(seen > 0, seen * F.log(seen / (F.col("n") * share))).otherwise(0.0)

    share = toxic / total
    ratio = 2 * (part(F.col("t"), share) + part(F.col("n") - F.col("t"), 1 - share))
    return counts.filter(ratio >= least).orderBy(ratio.desc(), "term").limit(most_terms).select("term")


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = 20_000,
    max_terms: int = 2_000,
    least: float = 25.0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> FactorizationMachine:
    """Learn from the rows of ``labels`` (columns ``doc_id``, ``toxic``).

    At most ``max_rows`` labelled documents are learnt from, those of smallest hash; their
    ids are small enough to copy to every executor.  Terms enter the machine when they tell
    toxic from other documents, or do so among the documents that have such a term (the
    other half of a telling pair); at most ``max_terms`` each way.  Rows with a null label
    or doc_id teach nothing, equal documents teach once; of several labels for one document the highest counts.
    """
    marked = labels.select(F.col(f"`{doc_id}`").alias("__id"), F.col("toxic").cast("int").alias("label"))
    marked = marked.dropna().groupBy("__id").agg(F.max("label").alias("label"))
    marked = F.broadcast(bounded_sample(marked, max_rows, "__id"))
    chosen = docs.select(F.col(f"`{doc_id}`").alias("__doc"), F.col(f"`{text}`").alias("text"))
    chosen = chosen.join(marked, F.col("__doc") == F.col("__id")).select("label", "text")
    hashed = chosen.select("label", _hashed(F.col("text")).alias("terms"))
    rows = store(hashed.dropDuplicates(["label", "terms"]), "toxicity-terms")

    def first_of(found: DataFrame) -> list[int]:
        return sorted(r.term for r in found.collect())

    single = first_of(_telling(rows, least, max_terms))
    hit = F.size(F.array_intersect("terms", F.array(*[F.lit(t) for t in single]).cast("array<int>"))) > 0
    paired = first_of(_telling(rows.filter(hit), least, max_terms)) if single else []
    terms = np.array(sorted({*single, *paired}), np.int64)
    wanted = F.array(*[F.lit(int(t)) for t in terms]).cast("array<int>")
    kept = rows.select("label", F.array_intersect("terms", wanted).alias("terms"))
    found = [(r.label, r.terms) for r in kept.toLocalIterator()]
    found.sort()
    places = [np.searchsorted(terms, np.array(sorted(t), np.int64)) for _, t in found]
    return train(places, np.array([label for label, _ in found], float), terms)


def score_toxicity(docs: DataFrame, model: FactorizationMachine, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``score`` (double, 0 to 1; replaced if present).

    Whole texts are scored, and the text alone decides, so repeated rows agree.  Null,
    empty and term-less texts get the score of the bias.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, machine = Terms(), sent.value
        for column in columns:
            values = [machine.score(machine.columns(known.of(v))) for v in text_values(column)]
            yield pa.array(values, pa.float64())

    return docs.withColumn("score", scores(F.col(text)))
