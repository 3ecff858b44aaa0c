"""Benchmark decontamination by pigeonhole edit matching.

A test item of which at most k symbols are edited is cut into k + 1 pieces; one of them
must stand unedited in the text.  All pieces of a block of items are looked for at once.
Around each piece found Myers' bit-parallel distance decides, first about the section of
the item that the piece belongs to, with that section's share of the errors, then about
the whole item.
"""

from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import store
from .common import text_values

#: ASCII letters and digits stay (in lower case); everything else ASCII is a space.
_PLAIN = bytes(
    ord(chr(c).lower()) if chr(c).isalnum() or c > 127 else 0x20 for c in range(128)
) + bytes(range(128, 256))


def plain_text(text: str | None) -> str:
    """Lower case, with every run of other ASCII characters than letters and digits as one
    space."""
    if not text:
        return ""
    data = text.lower().encode("utf-8", "replace").translate(_PLAIN)
    return b" ".join(data.split()).decode("utf-8", "replace")


class Pattern:
    """Myers' bit-parallel distance of one pattern to the nearest part of a text."""

    def __init__(self, text: str):
        self.length, self.masks = len(text), {}
        for i, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def nearest(self, text: str) -> int:
        """The least edit distance between the pattern and any substring of ``text``."""
        full, top, masks = (1 << self.length) - 1, 1 << (self.length - 1), self.masks
        plus, minus, score = full, 0, self.length
        best = score
        for c in text:
            equal = masks.get(c, 0)
            vertical = equal | minus
            diagonal = (((equal & plus) + plus) ^ plus) | equal
            up = minus | (full & ~(diagonal | plus))
            down = plus & diagonal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
                if score < best:
                    best = score
            up, down = up << 1 & full, down << 1 & full
            plus = down | (full & ~(vertical | up))
            minus = up & vertical
        return best


def _sections(budget: int) -> tuple[int, int]:
    """Sections of an item and pieces of each, as few pieces as the budget allows.

    With ``budget`` errors in all, some section has at most its even share of them, and
    then one of its pieces (one more than that share) has none.
    """
    return min(
        ((s, budget // s + 1) for s in range(1, min(budget + 1, 8) + 1)),
        key=lambda cut: (cut[0] * cut[1], -cut[0]),
    )


class Matcher:
    """Finds a block of items in texts; ``items`` are plain, not empty."""

    def __init__(self, items: list[str], error: float):
        self.items = [Pattern(item) for item in items]
        self.budget = [int(len(item) * error) for item in items]
        self.sections: list[tuple[Pattern, int, int]] = []  # pattern, offset, errors
        places: dict[str, list[tuple[int, int, int]]] = {}
        for number, item in enumerate(items):
            sections, pieces = _sections(self.budget[number])
            cuts = [len(item) * i // (sections * pieces) for i in range(sections * pieces + 1)]
            for first in range(0, sections * pieces, pieces):
                low, high = cuts[first], cuts[first + pieces]
                own = len(self.sections)
                self.sections.append((Pattern(item[low:high]), low, pieces - 1))
                for start, stop in zip(cuts[first : first + pieces], cuts[first + 1 :], strict=False):
                    places.setdefault(item[start:stop], []).append((number, own, start))
        self.machine = ahocorasick.Automaton()
        for piece, where in places.items():
            self.machine.add_word(piece, (len(piece), where))
        self.machine.make_automaton()

    def find(self, text: str) -> list[tuple[int, int]]:
        """(item, errors) of the items found in a plain text."""
        if not len(self.machine):
            return []
        tried, found = set(), {}
        for last, (length, where) in self.machine.iter(text):
            for item, section, offset in where:
                if found.get(item) == 0:
                    continue
                begin, k = last + 1 - length - offset, self.budget[item]
                pattern, at, few = self.sections[section]
                part = text[max(begin + at - few, 0) : begin + at + pattern.length + few]
                if pattern.nearest(part) > few:
                    continue
                # Hits of neighbouring diagonals share a window around both.
                low = begin // (k + 1) * (k + 1)
                if (item, low) in tried:
                    continue
                tried.add((item, low))
                part = text[max(low - k, 0) : max(low + self.items[item].length + 2 * k + 1, 0)]
                errors = self.items[item].nearest(part)
                if errors <= k and errors <= found.get(item, errors):
                    found[item] = errors
        return sorted(found.items())


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list]:
    """Items as (item_id, text), no block larger than about ``block_bytes``."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = size // block_bytes + 1
    for block in range(count):
        yield items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block).collect()


def _found(items, error: float):
    """A function from texts to (number of the item, errors); ``items`` are broadcast."""
    kinds = pa.list_(pa.struct([("item", pa.int32()), ("errors", pa.int32())]))

    @F.arrow_udf("array<struct<item: int, errors: int>>")
    def found(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher([t for _, t in items.value], error)
        for column in columns:
            rows = [
                [{"item": i, "errors": e} for i, e in matcher.find(plain_text(v))]
                for v in text_values(column)
            ]
            yield pa.array(rows, kinds)

    return found


def find_items(
    docs: DataFrame,
    items: DataFrame,
    error: float = 0.07,
    block_bytes: int = 4 << 20,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id and ``leaks``, an array of (item_id, errors).

    ``items`` has columns item_id and text.  An item is found when some part of the whole
    text differs from it in at most the share ``error`` of its characters (both compared
    in lower case, runs of punctuation and space as one space).  Items go to the tasks in
    blocks of bounded size, one pass over the documents for each block; benchmarks of a
    few megabytes are one block.  The blocks do not change the result: every row has its
    own leaks, also where doc_ids are null or repeated.  Null and empty texts and items
    match nothing; repeated documents and items are each reported; without items all
    arrays are empty.
    """
    kind = items.schema["item_id"].dataType.simpleString()
    plain = items.filter(F.col("text").isNotNull()).select("item_id", "text")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    blocks = _blocks(plain, block_bytes)

    def leaks(block: list) -> Column:
        texts = [(row.item_id, plain_text(row.text)) for row in block]
        texts = [(name, t) for name, t in texts if t]
        sent = docs.sparkSession.sparkContext.broadcast(texts)
        names = F.array(*[F.lit(name) for name, _ in texts]).cast(f"array<{kind}>")
        return F.transform(
            _found(sent, error)(F.col("text")),
            lambda leak: F.struct(F.get(names, leak["item"]).alias("item_id"), leak["errors"].alias("errors")),
        )

    first, second = next(blocks), next(blocks, None)
    if second is None:
        return rows.select("doc_id", leaks(first).alias("leaks"))
    # Rows are numbered once: a doc_id may be null or stand in several rows.
    rows = store(rows.withColumn("row", F.monotonically_increasing_id()), "leak-rows")
    every = None
    for number, block in enumerate(chain([first, second], blocks)):
        hits = rows.select("row", F.lit(number).alias("block"), leaks(block).alias("leaks"))
        hits = store(hits.filter(F.size("leaks") > 0), "leaks")
        every = hits if every is None else every.unionByName(hits)
    in_order = F.sort_array(F.collect_list(F.struct("block", "leaks")))
    joined = every.groupBy("row").agg(F.flatten(F.transform(in_order, lambda b: b["leaks"])).alias("leaks"))
    empty = F.array().cast(joined.schema["leaks"].dataType)
    return (
        rows.select("row", "doc_id")
        .join(joined, "row", "left")
        .select("doc_id", F.coalesce("leaks", empty).alias("leaks"))
    )


def drop_leaks(
    docs: DataFrame, items: DataFrame, error: float = 0.07, block_bytes: int = 4 << 20, text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` in whose text no item is found, as ``find_items`` finds them.

    No join is needed: each row is judged where it is read, block after block of items.
    """
    plain = items.filter(F.col("text").isNotNull()).select("item_id", "text")
    for number, block in enumerate(_blocks(plain, block_bytes)):
        texts = [(None, t) for t in (plain_text(row.text) for row in block) if t]
        sent = docs.sparkSession.sparkContext.broadcast(texts)
        docs = store(docs, "leak-free") if number else docs
        docs = docs.filter(F.size(_found(sent, error)(F.col(text))) == 0)
    return docs
