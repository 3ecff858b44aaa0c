"""Collocations from count streams that are merged in order.

Only phrases that are frequent are ever counted by their text.  Before that a sieve counts
64-bit hashes level by level, a longer phrase only where both its shorter parts may be
frequent; what it finds frequent is one bit each in a bitmap of fixed size, which may let
rare phrases through and never keeps a frequent one out.  The phrases that pass are counted
exactly and form one stream in prefix order (by their words from the left) and one in suffix
order (from the right).  In such a stream the counts of a phrase's beginnings stand right
before it, so one pass in lockstep gives every phrase its left counts, the other its right
counts, and both tell which phrases are most of a longer one.  These counts are never looked
up in a hash table.

A stream is dealt into ranges by cut points of its own order; a beginning is copied to all
ranges that its continuations reach, so a word with a third of all phrases is many tasks.
"""

from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.reports import first_per_group
from ..operators.skew import broadcast_if, fits_in_memory
from ..session import store
from .common import binary_values, bounded_batches, bounded_sample
from .flat import Flat

#: Bits of a bitmap of frequent phrases: 8 MB however large the corpus.
FILTER_BITS = 26
_BORDERS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)
_SLICE = 1 << 19
#: Hashes, and places of phrases and bytes of text, that a task holds before it sends their
#: counts on.
_HASHES = 2_000_000
_HELD, _HELD_BYTES = 500_000, 8 << 20
#: Hashes are dealt by their first bits; of each the next 32 are compared.
_DEAL_BITS = 10
#: Phrases whose texts are made, and sent on, at once.
_MADE = 20_000
#: Phrases per range of a stream, about, and cut points drawn for each range.
_RANGE_ROWS = 50_000
_DRAWN = 30
#: A scale of scores; a whole cohesion of 1 scores this much.
SCALE = 1_000_000


def plain(text: bytes) -> bytes:
    """The text in lower case (A-Z only), every border between pieces a newline."""
    return text.lower().translate(_BORDERS)


def parts(text: bytes) -> Iterator[bytes]:
    """A plain text, cut at borders where it is long; no piece is cut."""
    start = 0
    while len(text) - start > _SLICE:
        end = text.rfind(b"\n", start, start + _SLICE)
        if end < 0:
            end = text.find(b"\n", start + _SLICE)
        if end < 0:
            break
        yield text[start:end]
        start = end + 1
    yield text[start:]


class Phrases:
    """The words and phrases of some plain texts, as numpy arrays of hashes and places."""

    def __init__(self, texts: list[bytes]):
        self.flat = Flat(texts)
        border = self.flat.data == 0x0A
        inside = ~border & (self.flat.data != 0x20) & (self.flat.data != 0x09)
        self.starts, self.ends, _ = self.flat.runs(inside.astype(np.uint8))
        self.pieces = np.cumsum(border)[self.starts]
        self.words = self.flat.hashes(self.starts, self.ends) if len(self.starts) else np.zeros(0, np.uint64)

    def levels(self, filters: list[np.ndarray], count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For phrases of 1, 2, ... ``count`` words the number of their first word and their
        hash, of those whose shorter parts pass the ``filters``."""
        first, hashes = np.arange(len(self.words)), self.words
        for length in range(1, count + 1):
            yield first, hashes
            if length == count:
                return
            may = passes(hashes, filters[length - 1])
            first, hashes = first[may], hashes[may]
            # Neighbours in the list that are neighbours in the piece: both parts may be.
            near = np.flatnonzero(
                (first[1:] == first[:-1] + 1)
                & (self.pieces[first[:-1]] == self.pieces[np.minimum(first[:-1] + length, len(self.pieces) - 1)])
                & (first[:-1] + length < len(self.pieces))
            )
            first = first[near]
            hashes = _joined(hashes[near], self.words[first + length])

    def spans(self, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Where phrases begin and end."""
        return self.starts[first], self.ends[first + length - 1]


def phrase_texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Phrases as they stand in ``data``, their words joined by one space each."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    taken = data[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)]
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(taken)]
    texts = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).cast(pa.large_string()).cast(pa.string())
    # A phrase begins and ends with a word, so two spaces are always inside one.
    raw = taken.tobytes()
    return pc.replace_substring_regex(texts, "[ \t]+", " ") if b"\t" in raw or b"  " in raw else texts


def _joined(hashes: np.ndarray, word: np.ndarray) -> np.ndarray:
    mixed = hashes * np.uint64(0x9FB21C651E98DF25) + (word ^ (word >> np.uint64(33)))
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)


def _places(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def passes(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether the bits of the hashes are set."""
    at = _places(hashes)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Phrases]]:
    """Language and phrases of some hundred kilobytes of text at a time."""
    for batch in batches:
        held: dict[str, list[bytes]] = {}
        sizes: Counter = Counter()
        for name, value in zip(batch.column("lang").to_pylist(), binary_values(batch.column("text")), strict=True):
            for part in parts(plain(value or b"")):
                held.setdefault(name, []).append(part)
                sizes[name] += len(part)
                if sizes[name] > _SLICE:
                    yield name, Phrases(held.pop(name))
                    del sizes[name]
        for name, texts in held.items():
            yield name, Phrases(texts)


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    named = F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und"))
    return docs.select(named.alias("lang"), F.col(f"`{text}`").alias("text"))


def sieve(texts: DataFrame, sent: list[Broadcast], least: int) -> np.ndarray:
    """The bitmap of phrases of one word more than there are bitmaps ``sent``: the bit of every
    phrase that stands ``least`` times or more, in all languages together."""
    length = len(sent) + 1

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        known = [bits.value for bits in sent]
        for _, slice_ in _slices(batches):
            *_, (_, found) = slice_.levels(known, length)
            yield found

    return often_bits(texts, hashes, least)


def often_bits(
    texts: DataFrame, hashes: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], least: int
) -> np.ndarray:
    """The bitmap of the ``hashes`` made from ``texts`` that stand ``least`` times or more.

    What travels is four bytes of each hash, dealt by its first bits; a task sends one
    ``least`` times at most for all that it holds at once.
    """

    def dealt(held: list[np.ndarray]) -> pa.RecordBatch:
        codes = np.concatenate(held)
        held.clear()
        codes.sort()
        few = np.ones(len(codes), bool)
        few[least:] = codes[least:] != codes[:-least]
        codes = codes[few]
        firsts = np.arange(1 << _DEAL_BITS, dtype=np.uint64) << np.uint64(64 - _DEAL_BITS)
        cuts = np.r_[np.searchsorted(codes, firsts), len(codes)]
        rest = (codes >> np.uint64(32 - _DEAL_BITS)).astype(np.uint32)
        parts = [rest[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        deals = pa.array(np.arange(len(parts), dtype=np.int32))
        return pa.RecordBatch.from_arrays([deals, pa.array(parts, pa.binary())], ["deal", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for found in hashes(batches):
            held.append(found)
            size += len(found)
            if size >= _HASHES:
                yield dealt(held)
                size = 0
        if size:
            yield dealt(held)

    def frequent(group: pa.Table) -> pa.Table:
        parts = [np.frombuffer(part, np.uint32) for part in group["codes"].to_pylist()]
        codes = np.sort(np.concatenate(parts))
        last = codes[least - 1 :]
        often = last[last == codes[: len(last)]]
        bits = np.zeros(1 << (FILTER_BITS - _DEAL_BITS), bool)
        bits[often >> np.uint32(32 - FILTER_BITS + _DEAL_BITS)] = True
        packed = pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())
        return pa.table({"deal": group["deal"][:1], "bits": packed})

    found = texts.mapInArrow(run, "deal int, codes binary").groupBy("deal").applyInArrow(frequent, "deal int, bits binary")
    result = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in found.toLocalIterator():
        start = row.deal * len(row.bits)
        result[start : start + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    return result


def _bitmap(frequent: DataFrame) -> np.ndarray:
    """The bits of ``hash``es; a fixed number of bits reaches the driver."""
    at = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    # Positions from 1 on, as Spark's bitmap functions number buckets from there.
    chunks = frequent.select((at + 1).alias("at")).groupBy(F.bitmap_bucket_number("at").alias("chunk"))
    bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in chunks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).toLocalIterator():
        start = (row.chunk - 1) * len(row.bits)
        bits[start : start + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    return bits


def count_phrases(texts: DataFrame, sent: list[Broadcast]) -> DataFrame:
    """lang, phrase (space-joined) and n of the phrases whose bits are set, one bitmap for
    each number of words; with a null phrase all words of the language.

    Texts are counted; of what a task holds phrases are told apart by 64-bit hashes, so that
    their text is made once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [bits.value for bits in sent]
        found: dict[tuple[str, int], list[tuple[np.ndarray, ...]]] = {}
        held: dict[str, list[np.ndarray]] = {}
        places, size, words = 0, 0, Counter()

        def batch(lang: str, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array([lang] * len(n), pa.string()), phrases, pa.array(n, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "n"])

        def rows() -> Iterator[pa.RecordBatch]:
            data = {lang: np.concatenate(own) for lang, own in held.items()}
            for (lang, _), parts in found.items():
                hashes, starts, ends = map(np.concatenate, zip(*parts, strict=True))
                order = np.argsort(hashes)
                hashes = hashes[order]
                first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)])
                at, n = order[first], np.diff(first, append=len(hashes))
                starts, ends = starts[at], ends[at]
                for i in range(0, len(n), _MADE):
                    some = slice(i, i + _MADE)
                    yield batch(lang, phrase_texts(data[lang], starts[some], ends[some]), n[some])
            found.clear()
            held.clear()

        for lang, slice_ in _slices(batches):
            words[lang] += len(slice_.words)
            own = held.setdefault(lang, [])
            before = sum(map(len, own))
            own.append(slice_.flat.data)
            size += len(slice_.flat.data)
            for length, (first, hashes) in enumerate(slice_.levels(known, len(known)), 1):
                may = passes(hashes, known[length - 1])
                starts, ends = slice_.spans(first[may], length)
                found.setdefault((lang, length), []).append((hashes[may], starts + before, ends + before))
                places += len(starts)
            if places > _HELD or size > _HELD_BYTES:
                yield from rows()
                places = size = 0
        yield from rows()
        for lang, number in words.items():
            yield batch(lang, pa.nulls(1, pa.string()), np.array([number]))

    counted = texts.mapInArrow(run, "lang string, phrase string, n long")
    return counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


# The streams.  A row: lang, words (in the stream's direction) and n, further columns as met.

_TOP = "\U0010ffff" * 2


def _key(words: list[str]) -> list[bytes]:
    return [w.encode("utf-8", "surrogatepass") for w in words]


def _ranges(lang: Column, words: Column, cuts: list[list[bytes]], longest: int) -> Column:
    """The ranges of a stream in which a phrase or a continuation of it can stand."""

    @F.arrow_udf("array<int>")
    def reached(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for langs, lists in columns:
            found = []
            for name, phrase in zip(langs.to_pylist(), lists.to_pylist(), strict=True):
                key = _key([name, *phrase])
                first = last = bisect_right(cuts, key)
                if len(phrase) < longest:
                    last = bisect_right(cuts, [*key, _TOP.encode()])
                found.append(list(range(first, last + 1)))
            yield pa.array(found, pa.list_(pa.int32()))

    return reached(lang, words)


def merged_stream(rows: DataFrame, longest: int) -> DataFrame:
    """Give every phrase of two or more words the counts of its beginnings.

    ``rows`` (lang, words, n, seen) in any order; returned are lang, words, n, seen, heads
    (counts of the first word, the first two, ...) and ``covers``: whether the phrase
    without its last word (when that has two words or more) is seen inside it half of the
    time or more.  The stream is read once, in order, in lockstep with its own beginnings.
    """
    total = rows.count()
    ranges = total // _RANGE_ROWS + 1
    drawn = bounded_sample(rows.select("lang", "words"), ranges * _DRAWN if ranges > 1 else 1, "lang", "words")
    keys = sorted(_key([r.lang, *r.words]) for r in drawn.collect())
    cuts = keys[_DRAWN::_DRAWN] if ranges > 1 else []
    placed = rows.withColumn("ranges", _ranges(F.col("lang"), F.col("words"), cuts, longest))
    placed = placed.select("*", F.posexplode("ranges").alias("copy", "range")).drop("ranges")
    ordered = placed.repartitionByRange(len(cuts) + 1, "range").sortWithinPartitions("range", "lang", "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, path = None, []  # the place in the stream, the open beginnings with their counts
        for batch in batches:
            out = {"lang": [], "words": [], "n": [], "seen": [], "heads": [], "covers": []}
            for row in batch.to_pylist():
                words = row["words"]
                if (row["range"], row["lang"]) != at:
                    at, path = (row["range"], row["lang"]), []
                while path and (len(path[-1][0]) >= len(words) or words[: len(path[-1][0])] != path[-1][0]):
                    path.pop()
                if row["copy"] == 0 and len(words) > 1:
                    heads = [n for _, n in path]
                    for name, value in zip(
                        out, (row["lang"], words, row["n"], row["seen"], heads, None), strict=True
                    ):
                        out[name].append(value)
                    out["covers"][-1] = len(words) > 2 and 2 * row["n"] >= heads[-1]
                path.append((words, row["n"]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["lang"], pa.string()),
                    pa.array(out["words"], pa.list_(pa.string())),
                    pa.array(out["n"], pa.int64()),
                    pa.array(out["seen"], pa.list_(pa.int64())),
                    pa.array(out["heads"], pa.list_(pa.int64())),
                    pa.array(out["covers"], pa.bool_()),
                ],
                list(out),
            )

    kinds = "lang string, words array<string>, n long, seen array<long>, heads array<long>, covers boolean"
    return ordered.mapInArrow(run, kinds)


def weakest_cut(n: int, lefts: list[int], rights: list[int]) -> tuple[int, int, int]:
    """Score, left and right count of the cut that scores least, the earliest of such.

    ``lefts[k]`` counts the first k + 1 words, ``rights[k]`` the last k + 1.
    """
    cuts = zip(lefts, reversed(rights), strict=True)
    scored = [(SCALE * n * n // (left * right), k, left, right) for k, (left, right) in enumerate(cuts)]
    score, _, left, right = min(scored)
    return score, left, right


def _weakest(n: Column, lefts: Column, rights: Column) -> Column:
    kind = pa.struct([("score", pa.int64()), ("l", pa.int64()), ("r", pa.int64())])

    @F.arrow_udf("struct<score: long, l: long, r: long>")
    def cut(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for each in columns:
            rows = map(weakest_cut, *(column.to_pylist() for column in each))
            yield pa.array([dict(zip(("score", "l", "r"), row, strict=True)) for row in rows], kind)

    return cut(n, lefts, rights)


def mine_collocations(
    docs: DataFrame,
    least: int = 10,
    longest: int = 3,
    first: int = 2000,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Each language's first phrases by score: lang, rank, phrase, a, l, r, n, score.

    Phrases of 2 to ``longest`` words that stand at least ``least`` times within pieces of
    the texts; a null lang is ``und``.  The score is exact (whole numbers of any size).
    Phrases that stand inside a longer one half of the time or more are left out.  Equal
    scores are in the order of count and phrase, so reruns agree.  Null, empty and wordless
    texts have no phrases; repeated rows count again; an empty table gives no rows; other
    columns are not looked at.
    """
    texts, sent = _texts(docs, text, lang), []
    try:
        with bounded_batches(docs.sparkSession):
            for _ in range(longest):
                sent.append(docs.sparkSession.sparkContext.broadcast(sieve(texts, sent, least)))
            counts = count_phrases(texts, sent).filter((F.col("n") >= least) | F.col("phrase").isNull())
            counts = store(counts, "phrase-counts")
    finally:
        # Workers hold every bitmap until they are told to let it go.
        for bits in sent:
            bits.unpersist()
    totals = counts.filter("phrase is null").select("lang", F.col("n").alias("total"))
    frequent = counts.filter("phrase is not null")
    nothing = F.array().cast("array<long>")
    words = F.split("phrase", " ")
    prefix = merged_stream(frequent.select("lang", words.alias("words"), "n", nothing.alias("seen")), longest)
    prefix = store(prefix, "phrase-prefixes")
    # In suffix order the phrases bring their left counts along; words alone are heads only.
    singles = frequent.filter(F.instr("phrase", " ") == 0).select("lang", words.alias("words"), "n", nothing.alias("seen"))
    others = prefix.select("lang", F.reverse("words").alias("words"), "n", F.col("heads").alias("seen"))
    suffix = store(merged_stream(singles.unionByName(others), longest), "phrase-suffixes")

    whole = F.array_join(F.reverse("words"), " ")
    inner = suffix.filter("covers").select("lang", F.array_join(F.reverse(F.slice("words", 1, F.size("words") - 1)), " ").alias("phrase"))
    outer = prefix.filter("covers").select("lang", F.array_join(F.slice("words", 1, F.size("words") - 1), " ").alias("phrase"))
    parts = store(inner.unionByName(outer).distinct(), "phrase-parts")
    scored = suffix.select("lang", whole.alias("phrase"), F.col("n").alias("a"), _weakest(F.col("n"), F.col("seen"), F.col("heads")).alias("cut"))
    scored = scored.select("lang", "phrase", "a", "cut.*")
    scored = scored.join(broadcast_if(parts, fits_in_memory(parts)), ["lang", "phrase"], "anti")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    top = first_per_group(scored, ["lang"], order, first)
    ranked = top.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.join(broadcast_if(totals, fits_in_memory(totals)), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def duckdb_collocations(table: str, least: int = 10, first: int = 2000) -> str:
    """``mine_collocations`` for phrases of two and three words as DuckDB SQL."""
    return f"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws
  FROM (SELECT coalesce(lang::VARCHAR, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                            '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM {table})
), w AS (SELECT lang, unnest(ws) AS w FROM p),
g AS (
  SELECT lang, w AS p1, NULL AS p2, NULL AS p3, 1 AS k FROM w
  UNION ALL
  SELECT lang, ws[i], ws[i + 1], NULL, 2 FROM (SELECT lang, ws, unnest(range(1, len(ws))) AS i FROM p)
  UNION ALL
  SELECT lang, ws[i], ws[i + 1], ws[i + 2], 3 FROM (SELECT lang, ws, unnest(range(1, len(ws) - 1)) AS i FROM p)
), f AS (SELECT lang, concat_ws(' ', p1, p2, p3) AS phrase, p1, p2, p3, k, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= {least}),
cuts AS (
  SELECT c.lang, c.phrase, c.k, c.f AS a, 1 AS cut, l.f AS l, r.f AS r FROM c
  JOIN f l ON l.lang = c.lang AND l.phrase = c.p1
  JOIN f r ON r.lang = c.lang AND r.phrase = concat_ws(' ', c.p2, c.p3)
  UNION ALL
  SELECT c.lang, c.phrase, c.k, c.f, 2, l.f, r.f FROM c
  JOIN f l ON l.lang = c.lang AND l.phrase = concat_ws(' ', c.p1, c.p2)
  JOIN f r ON r.lang = c.lang AND r.phrase = c.p3
  WHERE c.k = 3
), scored AS (
  SELECT *, ({SCALE}::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), kept AS (
  SELECT * FROM weakest s WHERE NOT EXISTS (
    SELECT 1 FROM c t WHERE t.k = 3 AND s.k = 2 AND t.lang = s.lang AND 100 * t.f >= 50 * s.a
    AND (concat_ws(' ', t.p1, t.p2) = s.phrase OR concat_ws(' ', t.p2, t.p3) = s.phrase))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM kept JOIN n USING (lang)
QUALIFY rank <= {first}"""
