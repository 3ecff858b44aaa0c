"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read the bytes of a piece of text forwards and backwards; at
every byte both states together give the probability of each language.  A document's
probability is pooled over all its byte positions.

Pieces are the lower-cased runs of letters, at most ``PIECE`` bytes long (longer runs are
several pieces).  Equal pieces have equal outputs, so each task computes a piece once.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.skew import broadcast_if, fits_in_memory
from ..session import store
from .common import text_values

PIECE = 24
_LETTERS = re.compile(r"[^\W\d_]+")
_CACHE = 100_000
_BATCH = 2048
UNKNOWN = "und"


def pieces(text: str | None) -> Counter:
    """How often each piece occurs in a whole text."""
    if not text:
        return Counter()
    found = Counter()
    for run, number in Counter(_LETTERS.findall(text.lower())).items():
        data = run.encode("utf-8", "replace")
        if len(data) <= PIECE:
            found[data] += number
        else:
            for start in range(0, len(data), PIECE):
                found[data[start : start + PIECE]] += number
    return found


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Layer:
    """One direction: per byte the inputs of update gate, reset gate and candidate."""

    table: np.ndarray  # 257 x 3H, the last row for padding
    gates: np.ndarray  # H x 2H
    candidate: np.ndarray  # H x H

    def forward(self, codes: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (steps x pieces x H) of ``codes`` (steps x pieces); padding holds still."""
        size = self.candidate.shape[0]
        state = np.zeros((codes.shape[1], size), self.table.dtype)
        states = np.empty((*codes.shape, size), self.table.dtype)
        for t, code in enumerate(codes):
            inputs = self.table[code]
            gates = _sigmoid(inputs[:, : 2 * size] + state @ self.gates)
            update, reset = gates[:, :size], gates[:, size:]
            fresh = np.tanh(inputs[:, 2 * size :] + (reset * state) @ self.candidate)
            there = (code < 256)[:, None]
            after = np.where(there, update * state + (1 - update) * fresh, state)
            if keep is not None:
                keep.append((code, state, update, reset, fresh, there))
            state = states[t] = after
        return states

    def backward(self, keep: list, slopes: np.ndarray) -> list[np.ndarray]:
        """Gradients of table, gates and candidate by backpropagation through time."""
        size = self.candidate.shape[0]
        d_table, d_gates, d_cand = (np.zeros_like(x) for x in (self.table, self.gates, self.candidate))
        later = np.zeros_like(slopes[0])
        for t in range(len(keep) - 1, -1, -1):
            code, state, update, reset, fresh, there = keep[t]
            slope = slopes[t] + later
            active = slope * there
            d_update = active * (state - fresh) * update * (1 - update)
            d_fresh = active * (1 - update) * (1 - fresh * fresh)
            back = d_fresh @ self.candidate.T
            d_reset = back * state * reset * (1 - reset)
            d_both = np.concatenate([d_update, d_reset], 1)
            d_cand += (reset * state).T @ d_fresh
            d_gates += state.T @ d_both
            np.add.at(d_table, code, np.concatenate([d_both, d_fresh], 1))
            later = slope * ~there + active * update + back * reset + d_both @ self.gates.T
        d_table[256] = 0
        return [d_table, d_gates, d_cand]


@dataclass
class Network:
    languages: list[str]
    forwards: Layer
    backwards: Layer
    output: np.ndarray  # 2H x languages
    bias: np.ndarray
    _known: dict = field(default_factory=dict, repr=False)

    def parameters(self) -> list[np.ndarray]:
        a, b = self.forwards, self.backwards
        return [a.table, a.gates, a.candidate, b.table, b.gates, b.candidate, self.output, self.bias]

    def label(self, codes: np.ndarray, keep: tuple[list, list] | None = None):
        """Log probabilities of the languages at every position, and the joined states."""
        first, second = keep or (None, None)
        there = self.forwards.forward(codes, first)
        back = self.backwards.forward(codes[::-1], second)[::-1]
        states = np.concatenate([there, back], 2)
        scores = states @ self.output + self.bias
        scores -= scores.max(2, keepdims=True)
        return scores - np.log(np.exp(scores).sum(2, keepdims=True)), states

    def pooled(self, found: list[bytes]) -> np.ndarray:
        """Sum of log probabilities over the positions of each piece."""
        result = np.zeros((len(found), len(self.languages)), np.float32)
        order = sorted(range(len(found)), key=lambda i: len(found[i]))
        for start in range(0, len(order), _BATCH):
            part = order[start : start + _BATCH]
            codes = encode([found[i] for i in part])
            logs, _ = self.label(codes)
            result[part] = (logs * (codes < 256)[:, :, None]).sum(0)
        return result

    def probabilities(self, texts: list[Counter]) -> np.ndarray:
        """Pooled probabilities of documents given as counted pieces."""
        known = self._known
        if len(known) > _CACHE:
            known.clear()
        new = list({p for pieces_ in texts for p in pieces_ if p not in known})
        for start in range(0, len(new), 16 * _BATCH):
            part = new[start : start + 16 * _BATCH]
            known.update(zip(part, self.pooled(part), strict=True))
        result = np.zeros((len(texts), len(self.languages)))
        for i, counted in enumerate(texts):
            if counted:
                rows = np.array([known[p] for p in counted])
                number = np.fromiter(counted.values(), np.float64, len(counted))
                total = float(sum(len(p) * c for p, c in counted.items()))
                # Neighbouring positions repeat each other: longer documents are surer, but
                # by the root of their length only.
                result[i] = number @ rows / np.sqrt(total)
        result -= result.max(1, keepdims=True)
        result = np.exp(result)
        return result / result.sum(1, keepdims=True)


def encode(found: list[bytes]) -> np.ndarray:
    """Bytes as (steps x pieces), padded with 256."""
    steps = max(map(len, found), default=0)
    codes = np.full((len(found), steps), 256, np.int64)
    for i, piece in enumerate(found):
        codes[i, : len(piece)] = np.frombuffer(piece, np.uint8)
    return codes.T


def train(
    found: list[bytes],
    languages: list[int],
    names: list[str],
    hidden: int = 16,
    rounds: int = 8,
    batch: int = 512,
    rate: float = 0.01,
    seed: int = 11,
) -> Network:
    """Fit by Adam; every position is taught its piece's language, languages weigh alike."""
    random = np.random.default_rng(seed)

    def layer() -> Layer:
        scale = 1 / np.sqrt(hidden)
        table = random.normal(0, 0.3, (257, 3 * hidden))
        table[256] = 0
        return Layer(
            table.astype(np.float32),
            random.normal(0, scale, (hidden, 2 * hidden)).astype(np.float32),
            random.normal(0, scale, (hidden, hidden)).astype(np.float32),
        )

    network = Network(
        names,
        layer(),
        layer(),
        random.normal(0, 0.3, (2 * hidden, len(names))).astype(np.float32),
        np.zeros(len(names), np.float32),
    )
    wanted = np.array(languages)
    sizes = np.bincount(wanted, [len(p) for p in found], len(names)) if found else np.ones(len(names))
    weights = (sizes.sum() / np.maximum(sizes, 1) / len(names)).astype(np.float32)
    first = [np.zeros_like(p) for p in network.parameters()]
    second = [np.zeros_like(p) for p in network.parameters()]
    step = 0
    total_steps = rounds * max(1, len(found) // batch)
    for _ in range(rounds if len(names) > 1 else 0):
        for part in np.array_split(random.permutation(len(found)), max(1, len(found) // batch)):
            step += 1
            codes = encode([found[i] for i in part])
            keep: tuple[list, list] = ([], [])
            logs, states = network.label(codes, keep)
            there = codes < 256
            slopes = np.exp(logs)
            slopes[:, np.arange(len(part)), wanted[part]] -= 1
            slopes *= (there * weights[wanted[part]])[:, :, None] / there.sum()
            d_states = slopes @ network.output.T
            half = hidden
            gradients = network.forwards.backward(keep[0], d_states[:, :, :half])
            gradients += network.backwards.backward(keep[1], d_states[::-1, :, half:])
            gradients += [np.einsum("tbh,tbl->hl", states, slopes), slopes.sum((0, 1))]
            length = np.sqrt(sum(float((g * g).sum()) for g in gradients))
            pace = rate * (1 - step / (total_steps + 1)) * min(1.0, 1.0 / max(length, 1e-9))
            for p, g, m, v in zip(network.parameters(), gradients, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return network


def training_pieces(
    docs: DataFrame, per_language: int, per_document: int, doc_id: str, text: str, lang: str
) -> tuple[list[bytes], list[str]]:
    """Pieces of at most ``per_language`` documents of each language, of each at most
    ``per_document`` distinct pieces spread evenly over the whole text."""
    ranked = Window.partitionBy("lang").orderBy(F.xxhash64("id", "lang"), "id")
    keys = docs.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang")).dropna()
    # Some of each language's least hashes suffice, so no language is ranked whole.
    found = store(keys.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "language-counts")
    found = broadcast_if(found, fits_in_memory(found))
    share = F.lit(4.0 * per_language) / F.col("n")
    least = (F.xxhash64("id", "lang") / F.lit(2.0**64) + 0.5) < share
    keys = keys.join(found, "lang").filter(least).drop("n")
    keys = keys.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= per_language)
    keys = F.broadcast(keys.select(F.col("id").alias("__id"), F.col("lang").alias("__lang")).distinct())
    both = (F.col(doc_id) == F.col("__id")) & (F.col(lang) == F.col("__lang"))
    rows = docs.join(keys, both).select("__lang", F.col(text).alias("text"))

    @F.arrow_udf("array<binary>")
    def spread(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            found = [sorted(pieces(v)) for v in text_values(column)]
            every = [x[:: -(-len(x) // per_document)] if x else [] for x in found]
            yield pa.array(every, pa.list_(pa.binary()))

    chosen = rows.select(F.col("__lang").alias("lang"), spread(F.col("text")).alias("found"))
    chosen = store(chosen, "language-pieces").collect()
    found = sorted((r.lang, bytes(p)) for r in chosen for p in r.found)
    return [p for _, p in found], [lang for lang, _ in found]


def fit_languages(
    docs: DataFrame,
    per_language: int = 400,
    per_document: int = 40,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> Network:
    """Learn from the texts and languages of ``docs``; rows with a null in any of doc_id,
    text and language teach nothing.  The sample is bounded by ``per_language`` documents
    for each language and ``per_document`` pieces for each document."""
    usable = docs.filter(F.col(text).isNotNull())
    found, labels = training_pieces(usable, per_language, per_document, doc_id, text, lang)
    names = sorted(set(labels))
    number = {name: i for i, name in enumerate(names)}
    return train(found, [number[x] for x in labels], names)


def predict_languages(docs: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred`` and ``score`` (replaced if present).

    ``score`` is the pooled probability of the predicted language.  Null texts, texts
    without a letter, and all texts if nothing was learnt, are ``und`` with score 0.
    """
    sent = docs.sparkSession.sparkContext.broadcast(network)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predicted(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value
        for column in columns:
            names, scores = [], []
            for start in range(0, len(column), 256):
                counted = [pieces(v) for v in text_values(column.slice(start, 256))]
                if not model.languages:
                    counted = [Counter() for _ in counted]
                chances = model.probabilities(counted) if model.languages else [()] * len(counted)
                for own, p in zip(counted, chances, strict=True):
                    names.append(model.languages[int(np.argmax(p))] if own else UNKNOWN)
                    scores.append(float(np.max(p)) if own else 0.0)
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
            )

    out = docs.withColumn("__predicted", predicted(F.col(text)))
    return out.withColumns({c: F.col(f"__predicted.{c}") for c in ("lang_pred", "score")}).drop("__predicted")
