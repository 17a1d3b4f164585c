"""Words of many texts at once: token bounds and 64-bit hashes in numpy, without a Python object per word.

A word is a longest run of bytes other than space and 0x09-0x0D of the UTF-8 text; A-Z count as a-z. A null
text has no words. Texts are worked on in slices of about SLICE bytes, so memory does not grow with a batch;
one longer text is one slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, dtype=bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
#: Another kind of word: a run of ASCII letters and digits and of bytes beyond ASCII.
PLAIN = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = np.uint64(0xD1342543DE82EF95)


def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One hash of two, in order."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def number(text: str) -> np.uint64:
    """The hash that `Texts.hashes` gives the one word `text`."""
    return next(slices(pa.array([text]))).hashes[0]


class Texts:
    """The words of some consecutive texts.

    `first`: number of the first text in its batch; `count`: number of texts; `starts`, `ends`: byte bounds of the
    words in `data`; `doc`: text of each word, from 0; `bounds`: first word of each text, and the end.
    """

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray, word: np.ndarray = _WORD):
        self.first, self.count, self.data = first, len(offsets) - 1, _LOWER[data]
        self.word = word[data]
        begins = self.word.copy()
        begins[1:] &= ~self.word[:-1]
        edge = offsets[:-1][offsets[:-1] < len(data)]
        begins[edge] |= self.word[edge]
        self.starts = np.flatnonzero(begins)
        closes = np.ones(len(data), dtype=bool)
        closes[:-1] = ~self.word[1:]
        edge = offsets[1:][(offsets[1:] > 0)] - 1
        closes[edge] = True
        self.ends = np.flatnonzero(closes & self.word) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.doc = np.repeat(np.arange(self.count), np.diff(self.bounds))
        self._hashes: np.ndarray | None = None

    def fold(self, value: np.ndarray) -> np.ndarray:
        """A hash per word of one 64-bit number per byte; where it is 0, the byte does not count."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        counted = np.cumsum(value != 0)
        place = np.zeros(len(value), dtype=np.int64)
        lead = self.starts[0]
        place[lead:] = counted[lead:] - np.repeat(counted[self.starts] - 1, np.diff(np.append(self.starts, len(value))))
        power = np.ones(int(place.max()) + 2, dtype=np.uint64)
        power[1:] = _STEP
        power = np.cumprod(power, dtype=np.uint64)
        return mix(np.add.reduceat(value * power[place], self.starts))

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = self.fold(np.where(self.word, _BYTE[self.data], np.uint64(0)))
        return self._hashes


def slices(column: pa.Array | pa.ChunkedArray, word: np.ndarray = _WORD) -> Iterator[Texts]:
    """The texts of an Arrow column, in order, some at a time."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, side="right")) - 1)
        yield Texts(at, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at], word)
        at = to
