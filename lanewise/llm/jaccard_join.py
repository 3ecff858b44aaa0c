"""Exact Jaccard join of shingle sets by partitioning the universe of shingles.

Two sets of similarity at least s differ in a bounded number H of shingles, which follows
from their sizes.  All shingles are dealt by their hash into m = H + 1 segments; then two
such sets are equal in one segment at least, so sets that share a segment's subset are the
candidates.  Sizes are cut into bands, each with its own m; a set is indexed for its own
band and the next, since its partners are in the same band or one beside it.

Subsets that very many sets share (a common passage) are not worth probing.  A set may skip
them if it makes up for each elsewhere: the pigeonhole asks that its allowances sum to m,
where a segment probed for equal subsets counts one, and one probed with its
one-deletion neighbourhood (equal but for one shingle) counts two.  Every set takes the
cheapest such allocation, by counts over all sets; a few spare segments of every scheme serve
for that, and all segments among sets with very many common subsets.  Candidates are
verified exactly.

Equal sets are one set throughout.  In a first round every set is compared with one other
only; sets so joined need no other link between them, so a group of copies costs about one
comparison per copy.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.skew import broadcast_if, fits_in_memory
from ..session import store
from .common import binary_values, bounded_batches
from .components import components
from .flat import Flat

#: Bits of the bitmap of subsets that are shared: 16 MB however large the corpus.
FILTER_BITS = 27
#: Sets of a shared subset of which all pairs are compared; longer lists go by allocation.
LIST_ROWS = 16
#: Least bits of the parity sketch that bounds the difference of two sets from below.
_SKETCH = 512
#: First rounds in which every set is compared with one other that it shares most subsets with.
_STARS = 1
_ROWS = 4096
_TEXTS = 256
_PART = 1 << 19
_SPACES = frozenset(b" \t\n\v\f\r")

_ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _ODD[1]
    values = (values ^ (values >> np.uint64(27))) * _ODD[2]
    return values ^ (values >> np.uint64(31))


@dataclass(frozen=True)
class Bands:
    """Bands of set sizes for a similarity of at least ``percent`` / 100."""

    percent: int

    def least(self, band: int) -> int:
        """The least size of a band: partners of a set are at most one band away."""
        size = 1
        for _ in range(band):
            size = max(size + 1, -(-size * 100 // self.percent))
        return size

    def of(self, size: int) -> tuple[int, int]:
        """Band of a size, and the greatest size of that band."""
        band, low = 0, 1
        while (high := max(low + 1, -(-low * 100 // self.percent))) <= size:
            band, low = band + 1, high
        return band, high - 1

    def differ(self, sizes: int) -> int:
        """The most shingles by which two linked sets of so many shingles together differ."""
        return sizes * (100 - self.percent) // (100 + self.percent)

    def segments(self, size: int) -> list[tuple[int, int]]:
        """(scheme, m) for the set's own band and the next; where equal sets alone can be
        linked (m = 1) there is no scheme."""
        band, high = self.of(size)
        higher = max(high + 1, -(-(high + 1) * 100 // self.percent) - 1)
        found = ((band, self.differ(2 * high) + 1), (band + 1, self.differ(2 * higher) + 1))
        return [(scheme, m) for scheme, m in found if m > 1]


def _borders(hashes: np.ndarray, m: int) -> np.ndarray:
    """Where each of m equal ranges of hash values starts in the sorted hashes."""
    at = np.array([(i << 64) // m for i in range(m)], np.uint64)
    return np.r_[np.searchsorted(hashes, at, "left"), len(hashes)]


def _named(sums: np.ndarray, scheme: int, segments: np.ndarray) -> np.ndarray:
    names = (segments.astype(np.uint64) + np.uint64(scheme << 32)) * _ODD[0]
    return _mixed(sums + _mixed(names + np.uint64(1)))


def subsets(hashes: np.ndarray, scheme: int, m: int) -> np.ndarray:
    """A 64-bit name for the subset of each of m segments, empty ones included."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(_mixed(hashes), out=sums[1:])
    borders = _borders(hashes, m)
    return _named(sums[borders[1:]] - sums[borders[:-1]], scheme, np.arange(m))


def deletions(hashes: np.ndarray, scheme: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment and name of each subset without one of its shingles."""
    values = _mixed(hashes)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    borders = _borders(hashes, m)
    segments = np.repeat(np.arange(m), np.diff(borders))
    whole = (sums[borders[1:]] - sums[borders[:-1]])[segments]
    return segments, _named(whole - values, scheme, segments)


def _cut(text: bytes) -> list[bytes]:
    """A text in parts of bounded size; no word is cut."""
    found, start = [], 0
    while len(text) - start > _PART:
        end = next((i for i in range(start + _PART, len(text)) if text[i] in _SPACES), len(text))
        found.append(text[start:end])
        start = end
    return [*found, text[start:]]


def _word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """The hashes of the words of each text, in order."""
    flat = Flat(texts)
    starts, ends, owners = flat.runs(np.minimum(flat.kinds, 1))
    words = flat.hashes(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return np.split(words, np.searchsorted(owners, np.arange(1, len(texts))))


def _set_of(words: np.ndarray, width: int) -> np.ndarray:
    """The different shingle hashes of a text, sorted, from its words' hashes."""
    if not len(words):
        return words
    length = min(width, len(words))
    runs = np.full(len(words) - length + 1, np.uint64(length))
    for i in range(length):
        runs = _mixed(runs * _ODD[0] + words[i : len(words) - length + 1 + i])
    return np.unique(runs)


def shingle_sets(texts: Iterable[bytes | None], width: int) -> Iterator[np.ndarray]:
    """The set of each text: the 64-bit hashes of its different shingles, sorted.

    Shingles are of ``width`` words (A-Z in lower case); fewer words are one shingle, none
    give an empty set.  Words are hashed some hundred kilobytes of text at a time.
    """
    parts, owners, size = [], [], 0

    def done() -> Iterator[np.ndarray]:
        words: dict[int, list[np.ndarray]] = {}
        start, bytes_ = 0, 0
        for end, part in enumerate(parts, 1):
            bytes_ += len(part)
            if bytes_ >= _PART or end == len(parts):
                for owner, found in zip(owners[start:end], _word_hashes(parts[start:end]), strict=True):
                    words.setdefault(owner, []).append(found)
                start, bytes_ = end, 0
        for owner in sorted(words):
            yield _set_of(np.concatenate(words[owner]), width)

    for number, text in enumerate(texts):
        cut = _cut(text.lower()) if text else [b""]
        parts += cut
        owners += [number] * len(cut)
        size += sum(map(len, cut))
        if size >= _PART:
            yield from done()
            parts, owners, size = [], [], 0
    yield from done()


def _whole(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.astype("<u8").tobytes())


def _parities(hashes: np.ndarray, differ: int) -> bytes:
    """Parities of the shingles in each of some power of two of places, eight or more for
    each shingle by which linked sets may differ."""
    bits = max(_SKETCH, 1 << (8 * differ - 1).bit_length())
    places = (_mixed(hashes ^ _ODD[0]) & np.uint64(bits - 1)).astype(np.int64)
    ones = np.bincount(places, minlength=bits) & 1
    return np.packbits(ones.astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """In how many shingles two sets differ at least, from their parities.

    The places of the longer sketch are folded onto those of the shorter one.
    """
    x, y = (np.frombuffer(s, np.uint64) for s in (a, b))
    if len(x) < len(y):
        x, y = y, x
    folded = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(folded ^ y).sum())


def _rows(text: Column, width: int, bands: Bands) -> Column:
    """Size, name (128 bits), parity sketch and subset names of a text's set."""
    kinds = {"n": pa.int64(), "whole": pa.binary(), "parities": pa.binary(), "subsets": pa.binary()}

    @F.arrow_udf("struct<n: long, whole: binary, parities: binary, subsets: binary>")
    def made(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts: dict[str, list] = {name: [] for name in kinds}
            for hashes in shingle_sets(binary_values(column), width):
                names = [subsets(hashes, k, m) for k, m in bands.segments(len(hashes))] if len(hashes) else []
                parts["n"].append(len(hashes))
                parts["whole"].append(_whole(hashes))
                parts["parities"].append(_parities(hashes, bands.differ(2 * len(hashes))))
                parts["subsets"].append(np.concatenate(names).astype("<u8").tobytes() if names else b"")
            arrays = [pa.array(parts[name], kind) for name, kind in kinds.items()]
            yield pa.StructArray.from_arrays(arrays, list(kinds))

    return made(text)


def _subset_rows(sets: DataFrame, kept: Broadcast | None = None) -> DataFrame:
    """subset (long) and whole, a row per subset; with a bitmap ``kept`` only those whose
    bit is set.

    Without ``kept`` whole is left out: there the rows are only counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                found = part.column("subsets").to_pylist()
                names = np.frombuffer(b"".join(found), "<u8")
                if kept is None:
                    yield pa.RecordBatch.from_arrays([pa.array(names.view("<i8"))], ["subset"])
                    continue
                owners = np.repeat(np.arange(len(found)), [len(f) // 8 for f in found])
                at = names & np.uint64((1 << FILTER_BITS) - 1)
                bits = kept.value[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)
                keep = np.flatnonzero(bits & 1)
                wholes = part.column("whole").take(pa.array(owners[keep]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[keep].view("<i8")), wholes], ["subset", "whole"]
                )

    kind = "subset long" if kept is None else "subset long, whole binary"
    return sets.select("whole", "subsets").mapInArrow(run, kind)


def _live_bits(live: DataFrame) -> np.ndarray:
    """The bitmap of the subsets of ``live``; a fixed number of bits reaches the driver."""
    at = F.col("subset").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    # Positions from 1 on, as Spark's bitmap functions number buckets from there.
    chunks = live.select((at + 1).alias("at")).groupBy(F.bitmap_bucket_number("at").alias("chunk"))
    bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in chunks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).toLocalIterator():
        start = (row.chunk - 1) * len(row.bits)
        bits[start : start + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    return bits


class _Verifier:
    """Exact comparison of pairs of sets; only the sets of likely pairs are moved."""

    def __init__(self, docs: DataFrame, rows: DataFrame, bands: Bands, width: int, doc_id: str, text: str):
        self.docs, self.rows, self.bands, self.width = docs, rows, bands, width
        self.doc_id, self.text = doc_id, text

    def sets(self, wholes: DataFrame, keep: bool = True) -> DataFrame:
        """whole and set (sorted hashes) of each of ``wholes``; stored unless read once only."""
        width = self.width

        # Not a function in an expression: the planner would run that on every document, to
        # test its result for null before the joins that leave few documents.
        def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, _TEXTS):
                    found = list(shingle_sets(binary_values(batch.column(0).slice(start, _TEXTS)), width))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([_whole(h) for h in found], pa.binary()),
                            pa.array([h.astype("<u8").tobytes() for h in found], pa.binary()),
                        ],
                        ["whole", "set"],
                    )

        wholes = store(wholes.distinct(), "join-needed")
        needed = broadcast_if(wholes, fits_in_memory(wholes))
        # One document for each set: no more than that are read again.
        chosen = self.rows.join(needed, "whole", "semi").groupBy("whole", "doc_id").count()
        first = chosen.groupBy("whole").agg(F.min(F.struct("doc_id", "count")).alias("f"))
        ids = store(first.select(F.col("f.doc_id").alias("__id"), F.col("f.count").alias("rows")), "join-ids")
        texts = self.docs.select(F.col(f"`{self.doc_id}`").alias("id"), F.col(f"`{self.text}`").alias("text"))
        met = F.col("id").eqNullSafe(F.col("__id"))
        small = broadcast_if(ids.select("__id").distinct(), fits_in_memory(ids))
        sets = texts.join(small, met, "semi").select("text").mapInArrow(made, "whole binary, set binary")
        sets = sets.join(needed, "whole", "semi")
        if not ids.filter("rows > 1 or __id is null").isEmpty():
            sets = sets.dropDuplicates(["whole"])
        if not keep:
            return sets
        with bounded_batches(self.docs.sparkSession):
            return store(sets, "join-sets")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets are similar enough."""
        percent = self.bands.percent

        @F.arrow_udf("boolean")
        def may(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for each in columns:
                rows = zip(*(column.to_pylist() for column in each), strict=True)
                found = [
                    min(n, m) * 100 >= max(n, m) * percent
                    and least_difference(a, b) <= (n + m) * (100 - percent) // (100 + percent)
                    for n, m, a, b in rows
                ]
                yield pa.array(found, pa.bool_())

        @F.arrow_udf("boolean")
        def alike(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for firsts, seconds in columns:
                found = []
                for a, b in zip(binary_values(firsts), binary_values(seconds), strict=True):
                    found.append(similar(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"), percent))
                yield pa.array(found, pa.bool_())

        needed = store(pairs.select(F.col("a").alias("whole")).union(pairs.select("b")).distinct(), "join-paired")
        marks = self.rows.select("whole", "n", "parities")
        marks = marks.join(broadcast_if(needed, fits_in_memory(needed)), "whole", "semi")
        marks = store(marks.dropDuplicates(["whole"]), "join-marks")
        first, second = (marks.toDF(c, f"n_{c}", f"parities_{c}") for c in "ab")
        near = pairs.join(first, "a").join(second, "b")
        near = near.filter(may("n_a", "n_b", "parities_a", "parities_b")).select("a", "b")
        near = store(near, "join-near")
        sets = self.sets(near.select(F.col("a").alias("whole")).union(near.select("b")))
        whole = broadcast_if(near, fits_in_memory(near)).join(sets.toDF("a", "set_a"), "a")
        whole = whole.join(sets.toDF("b", "set_b"), "b")
        with bounded_batches(self.docs.sparkSession):
            return store(whole.filter(alike("set_a", "set_b")).select("a", "b"), "join-links")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


def _ordered(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) once, the lesser name first."""
    a, b = F.col("a"), F.col("b")
    return pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def spare(m: int) -> int:
    """How many segments of a scheme make up for common subsets: the first so many."""
    return min(m, 4 + m // 32)


def _entries(sets: DataFrame, bands: Bands) -> DataFrame:
    """whole, scheme, segment, subset and ``gone`` of what sets index and may probe.

    ``sets`` has whole, set and ``common``: the common subsets of the set.  All sets have
    the subsets (gone false) and one-deletion neighbourhoods (gone true) of the spare
    segments.  A set that has more common subsets than there are spare segments has those of
    all segments.  Of two linked sets one can make up in the spare segments, where the other
    is indexed, or both are indexed in all.
    """
    names_ = ["whole", "scheme", "segment", "subset", "gone"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(start, _TEXTS)
                commons, found = part.column("common").to_pylist(), []
                for row, value in enumerate(binary_values(part.column("set"))):
                    hashes, common = np.frombuffer(value, "<u8").astype(np.uint64), np.array(commons[row], np.int64)
                    for scheme, m in bands.segments(len(hashes)):
                        own = subsets(hashes, scheme, m).view(np.int64)
                        is_common = np.isin(own, common)
                        last = spare(m) if is_common.sum() <= spare(m) else m
                        few = hashes[: _borders(hashes, m)[last]]
                        segments, without = deletions(few, scheme, m)
                        full = np.flatnonzero(is_common | (np.arange(m) < last))
                        gone = np.arange(len(full) + len(segments)) >= len(full)
                        names = np.r_[own[full], without.view(np.int64)]
                        found.append((np.full(len(gone), row), np.full(len(gone), scheme), np.r_[full, segments], names, gone))
                if found:
                    row, scheme, segment, subset, gone = map(np.concatenate, zip(*found, strict=True))
                    columns = [
                        part.column("whole").take(pa.array(row)),
                        pa.array(scheme.astype(np.int32)),
                        pa.array(segment.astype(np.int32)),
                        pa.array(subset),
                        pa.array(gone),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names_)

    kinds = "whole binary, scheme int, segment int, subset long, gone boolean"
    return sets.select("whole", "set", "common").mapInArrow(run, kinds)


def _met(entries: DataFrame) -> DataFrame:
    """The entries that another can meet, a whole subset one without a shingle or the other
    way round, with ``cost``: how many it would meet."""
    counts = entries.groupBy("subset").agg(
        F.count_if(~F.col("gone")).alias("full"), F.count_if("gone").alias("near")
    )
    counts = store(counts.filter("full > 0 and near > 0"), "join-counts")
    met = entries.join(broadcast_if(counts, fits_in_memory(counts)), "subset")
    return store(met.withColumn("cost", F.when(F.col("gone"), F.col("full")).otherwise(F.col("near"))), "join-met")


def _allocated(entries: DataFrame, met: DataFrame, hot: DataFrame) -> DataFrame:
    """The segments that sets probe: those of the cheapest allocation of every set.

    ``hot`` has the subsets (``subset``, ``size``) that are too common to be compared for
    everyone.  A set that has K of them in a scheme has K allowances to make up for: each is
    either a hot subset probed all the same (cost: its size), or another segment probed
    with its neighbourhood as well (cost: the sets that this meets).  The K cheapest are
    taken; there are at least K, so the allowances sum to m.
    """
    common = broadcast_if(hot, fits_in_memory(hot))
    costs = met.groupBy("whole", "scheme", "segment").agg(F.sum("cost").alias("cost"))
    segments = entries.filter("not gone").select("whole", "scheme", "segment", "subset").join(common, "subset", "left")
    options = segments.join(costs, ["whole", "scheme", "segment"], "left").select(
        "whole", "scheme", "segment", F.coalesce("size", "cost", F.lit(0)).alias("cost"), F.col("size").isNotNull().alias("hot")
    )
    own = Window.partitionBy("whole", "scheme")
    order = own.orderBy("cost", F.col("hot").cast("int"), "segment")
    return (
        options.withColumns({"missing": F.count_if("hot").over(own), "place": F.row_number().over(order)})
        .filter(F.col("place") <= F.col("missing"))
        .select("whole", "scheme", "segment", "hot")
    )


def _meetings(probes: DataFrame, index: DataFrame, kept: Column) -> DataFrame:
    """Pairs (a, b) of sets of different components that meet in a subset."""
    a = probes.select("subset", F.col("whole").alias("a"), F.col("comp").alias("comp_a"), *[F.col(c).alias(f"{c}_a") for c in probes.columns if c in ("gone", "n")])
    b = index.select("subset", F.col("whole").alias("b"), F.col("comp").alias("comp_b"), *[F.col(c).alias(f"{c}_b") for c in index.columns if c in ("gone", "n")])
    return a.join(b, "subset").filter((F.col("comp_a") != F.col("comp_b")) & kept).select("a", "b").distinct()


def _stars(members: DataFrame) -> DataFrame:
    """Pairs (a, b), at most one for each set b: of the sets of other components that are the
    least of a subset of b, the one that is so for most subsets of b.

    ``members`` has subset, whole and comp.  Copies of one text have many subsets in common,
    and the least of them in most, so a few such rounds join a group of copies.
    """
    least = members.groupBy("subset").agg(F.min(F.struct("whole", "comp")).alias("least"))
    met = members.join(least, "subset").filter(F.col("comp") != F.col("least.comp"))
    shared = met.groupBy(F.col("whole").alias("b"), F.col("least.whole").alias("a")).agg(F.count(F.lit(1)).alias("n"))
    return shared.groupBy("b").agg(F.max_by("a", F.struct("n", "a")).alias("a")).select("a", "b")


def set_links(docs: DataFrame, rows: DataFrame, bands: Bands, width: int, list_rows: int, doc_id: str, text: str):
    """Links (a, b) between sets of ``rows`` that join all sets that are similar enough,
    directly or by a chain of such links."""
    verifier = _Verifier(docs, rows, bands, width, doc_id, text)
    # Of equal sets one row stays; the others are told by their number, so that subsets of
    # the rows that stay do not move.
    copies = rows.groupBy("whole").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("copies"))
    copies = store(copies.filter("copies > 1").select(F.col("whole").alias("__whole"), "first"), "join-copies")
    same = rows.select("whole", "row").join(broadcast_if(copies, fits_in_memory(copies)), F.col("whole") == F.col("__whole"))
    extra = store(same.filter("row <> first").select("row"), "join-extra")
    sets = rows.filter("length(subsets) > 0").join(broadcast_if(extra, fits_in_memory(extra)), "row", "anti")
    spark = docs.sparkSession
    with bounded_batches(spark):
        counted = _subset_rows(sets).groupBy("subset").agg(F.count(F.lit(1)).alias("size"))
        live = store(counted.filter("size > 1"), "join-live")
        kept = spark.sparkContext.broadcast(_live_bits(live))
        try:
            members = _subset_rows(sets, kept).join(live, "subset")
            members = store(members.select("subset", "whole"), "join-members")
        finally:
            # Workers hold the bitmap until they are told to let it go.
            kept.unpersist()

    links = tried = None
    named = store(sets.select("whole", "n", F.col("whole").alias("comp")), "join-named")
    for _ in range(_STARS):
        # What is joined so far needs no more links.
        stars = store(_stars(members.join(named, "whole")), "join-stars")
        found = verifier.linked(stars)
        links = found if links is None else store(links.unionByName(found), "join-links")
        tried = _ordered(stars) if tried is None else tried.unionByName(_ordered(stars))
        roots = components(links)
        named = named.select("whole", "n").join(roots, F.col("whole") == F.col("node"), "left")
        named = store(named.select("whole", "n", F.coalesce("root", "whole").alias("comp")), "join-named")
    # Subsets that different components share.
    joined = members.join(named, "whole")
    lists = joined.groupBy("subset").agg(
        F.count(F.lit(1)).alias("size"), F.min("comp").alias("low"), F.max("comp").alias("high")
    )
    lists = store(lists.filter("low <> high").select("subset", "size"), "join-lists")
    if lists.isEmpty():
        return links
    lists_small = broadcast_if(lists, fits_in_memory(lists))
    opened = store(joined.join(lists_small, "subset"), "join-open")
    low, high = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    sized = low * 100 >= high * bands.percent
    few = opened.filter(F.col("size") <= list_rows)
    pairs = _ordered(_meetings(few, few, (F.col("a") < F.col("b")) & sized))

    hot = lists.filter(F.col("size") > list_rows)
    if not hot.isEmpty():
        many = opened.filter(F.col("size") > list_rows)
        # At most two subsets for each segment of a set.
        flagged = store(many.groupBy("whole").agg(F.collect_list("subset").alias("common")), "join-flagged")
        small = broadcast_if(flagged, fits_in_memory(flagged))
        with bounded_batches(spark):
            entries = _entries(verifier.sets(flagged.select("whole"), keep=False).join(small, "whole"), bands)
            entries = store(entries, "join-entries")
        met = _met(entries)
        taken = store(_allocated(entries, met, hot), "join-allocation")
        spent = ["whole", "scheme", "segment"]
        places = named.join(small.select("whole"), "whole", "semi")
        index = store(met.join(places, "whole"), "join-index")
        # Equal but for one shingle: a whole subset meets one without a shingle.
        probes = index.join(taken.filter("not hot"), spent)
        found = _meetings(probes, index, (F.col("gone_a") != F.col("gone_b")) & sized)
        # Hot subsets that are probed all the same: two of one component need not meet, so
        # each list's largest component is only compared with the rest of the list.
        held = many.groupBy("subset", "comp").count().groupBy("subset").agg(F.max_by("comp", "count").alias("most"))
        held = store(held, "join-most")
        every = many.join(broadcast_if(held, fits_in_memory(held)), "subset")
        asked = entries.filter("not gone").join(taken.filter("hot"), spent).join(places, "whole")
        asked = asked.join(broadcast_if(held, fits_in_memory(held)), "subset")
        rest = F.col("comp") != F.col("most")
        found = found.unionByName(_meetings(asked.filter(rest), every, sized))
        found = found.unionByName(_meetings(asked.filter(~rest), every.filter(rest), sized))
        pairs = _ordered(pairs.unionByName(found))
    pairs = store(pairs.join(tried, ["a", "b"], "anti"), "join-pairs")
    return store(links.unionByName(verifier.linked(pairs)), "join-all-links")


def jaccard_groups(
    docs: DataFrame,
    percent: int = 85,
    width: int = 4,
    list_rows: int = LIST_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id.

    A document's set has its different shingles of ``width`` words (A-Z in lower case), the
    whole sequence if it has fewer words.  Documents link where 100 * intersection >=
    ``percent`` * union; component_id is the smallest doc_id reachable, itself included.
    Null, empty and wordless texts have no set, n_shingles 0 and link with nothing.  Equal
    sets link; repeated rows stay repeated, and a doc_id that stands in several rows is as
    many documents.  A null doc_id names a component only where it has no other.  An empty
    table gives an empty result; other columns are not looked at.  Shingles are told apart
    by 64-bit hashes.
    """
    bands = Bands(percent)
    made = _rows(F.col(f"`{text}`"), width, bands)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), made.alias("s"), F.monotonically_increasing_id().alias("row"))
    with bounded_batches(docs.sparkSession):
        rows = store(rows.select("doc_id", "row", "s.*"), "join-rows")
    links = set_links(docs, rows, bands, width, list_rows, doc_id, text)
    roots = components(links)
    full = rows.filter("n > 0").select("doc_id", "n", "whole")
    rooted = full.join(roots, F.col("whole") == F.col("node"), "left")
    rooted = store(rooted.select("doc_id", "n", F.coalesce("root", "whole").alias("root")), "join-rooted")
    names = store(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "join-names")
    some = rooted.join(names, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    none = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return some.unionByName(none)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def duckdb_groups(table: str, percent: int = 85, width: int = 4) -> str:
    """``jaccard_groups`` as DuckDB SQL: every pair that shares a shingle is compared."""
    run = " || ' ' || ".join(f"ws[i + {k}]" if k else "ws[i]" for k in range(width))
    return f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS ws
  FROM {table}
), s AS (
  SELECT DISTINCT row, {run} AS shingle FROM (SELECT row, ws, unnest(range(1, len(ws) - {width - 2})) AS i FROM d)
  UNION ALL
  SELECT row, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND {width - 1}
), n AS (SELECT row, count(*) AS n FROM s GROUP BY row),
links AS (
  SELECT a, b FROM (
    SELECT x.row AS a, y.row AS b, count(*) AS shared FROM s x JOIN s y ON x.shingle = y.shingle AND x.row <> y.row
    GROUP BY ALL)
  JOIN n p ON p.row = a JOIN n q ON q.row = b
  WHERE 100 * shared >= {percent} * (p.n + q.n - shared)
), reach AS (
  SELECT row AS a, row AS b FROM d
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(e.doc_id) AS component_id
FROM d JOIN reach ON reach.a = d.row JOIN d e ON e.row = reach.b LEFT JOIN n ON n.row = d.row
GROUP BY d.row, d.doc_id"""
