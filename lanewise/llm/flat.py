"""Many texts as one byte array, so that numpy finds and hashes their words at once."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import binary_values

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = 1 << 19

SPACE, LETTER, SYMBOL = 0, 1, 2
_KINDS = np.full(256, SYMBOL, np.uint8)
_KINDS[[0x20, *range(0x09, 0x0E)]] = SPACE
_KINDS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), 0x5F, *range(0x80, 0x100)]] = LETTER
_VALUES = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ np.uint64(0xA5A5A5A5A5A5)


class Flat:
    """Texts laid end to end with a newline after each.

    ``texts`` are the values (None as empty), ``kinds`` the kind of every byte.
    """

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.stops = np.cumsum(lengths)
        self.kinds = _KINDS[self.data]
        n = len(self.data)
        powers = np.full(n, _BASE, np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUES[self.data] * powers, out=sums[1:])
        self._sums = sums

    def runs(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Longest runs of equal kind other than space: starts, ends and text numbers."""
        change = np.flatnonzero(kinds[1:] != kinds[:-1]) + 1
        borders = np.concatenate([[0], change, [len(kinds)]])
        starts, ends = borders[:-1], borders[1:]
        seen = kinds[starts] != SPACE
        starts, ends = starts[seen], ends[seen]
        return starts, ends, np.searchsorted(self.stops, starts, "right")

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit number for each piece that depends on its bytes only."""
        back = np.full(len(self.data), _INVERSE, np.uint64)
        back[0] = 1
        np.cumprod(back, out=back)
        mixed = (self._sums[ends] - self._sums[starts]) * back[starts]
        mixed ^= mixed >> np.uint64(29)
        return mixed * np.uint64(0xBF58476D1CE4E5B9)

    def per_text(self, owners: np.ndarray, weights=None) -> np.ndarray:
        return np.bincount(owners, weights, len(self.texts))


def flat_slices(column: pa.Array) -> Iterator[Flat]:
    """The values of a string column in order, some hundred kilobytes of text at a time.

    A longer text is a slice of its own; a slice takes about 50 bytes of memory per byte.
    """
    texts, size = [], 0
    for value in binary_values(column):
        if texts and size + len(value or b"") > _BYTES:
            yield Flat(texts)
            texts, size = [], 0
        texts.append(value or b"")
        size += len(texts[-1])
    if texts:
        yield Flat(texts)
