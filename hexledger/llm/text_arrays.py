"""Word, line and window hashes over Arrow text columns, without a Python loop per word.

Every function works on one `Texts`: the UTF-8 bytes of some documents end to end, and the offset at which
each document starts. Hashes are 64-bit polynomial hashes over a random byte table, so equal bytes give equal
hashes wherever they stand; different bytes collide with a probability of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked on in slices of about so many bytes, which bounds a task's memory. A longer text is a slice.
SLICE_BYTES = 1 << 18

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits of `x`."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
_POWERS = {"n": 0}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The multiplier's and its inverse's powers from 0 to n."""
    if n > 16 * SLICE_BYTES:  # a very long text: made for the occasion
        return _power_row(_MULTIPLIER, n), _power_row(_INVERSE, n)
    if _POWERS["n"] < n:
        size = max(n, SLICE_BYTES)
        _POWERS.update(n=size, up=_power_row(_MULTIPLIER, size), down=_power_row(_INVERSE, size))
    return _POWERS["up"], _POWERS["down"]


def _power_row(base: int, n: int) -> np.ndarray:
    row = np.full(n + 1, base, dtype=np.uint64)
    row[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(row)


@dataclass
class Texts:
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than documents

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def per_document(self, flags: np.ndarray) -> np.ndarray:
        """How many flagged bytes each document has."""
        total = np.concatenate(([0], np.cumsum(flags)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def prefix(self) -> np.ndarray:
        """Prefix sums for `segment_hash`."""
        up, _ = _powers(len(self.data))
        with np.errstate(over="ignore"):
            values = _BYTE[self.data]
            values *= up[: len(values)]
            out = np.zeros(len(values) + 1, dtype=np.uint64)
            np.cumsum(values, out=out[1:])
        return out

    def segment_hash(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        _, down = _powers(len(self.data))
        with np.errstate(over="ignore"):
            return mix((prefix[ends] - prefix[starts]) * down[starts])

    def window_hash(self, prefix: np.ndarray, width: int) -> np.ndarray:
        """The hash of the `width` bytes from each byte on; those that cross documents are not left out."""
        _, down = _powers(len(self.data))
        with np.errstate(over="ignore"):
            out = prefix[width:] - prefix[:-width]
            out *= down[: len(out)]
        return mix(out)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of bytes that are not ASCII white space."""
        if not len(self.data):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        ink = ~WHITE[self.data]
        first = np.ones(len(ink), dtype=bool)
        first[1:] = ~ink[:-1]
        edges = self.offsets[:-1]
        first[edges[edges < len(ink)]] = True
        last = np.ones(len(ink), dtype=bool)
        last[:-1] = first[1:] | ~ink[1:]
        return np.flatnonzero(ink & first), np.flatnonzero(ink & last) + 1

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the parts between line feeds; a document has one more than line feeds."""
        feeds = np.flatnonzero(self.data == 0x0A)
        starts = np.sort(np.concatenate((self.offsets[:-1], feeds + 1)), kind="stable")
        ends = np.sort(np.concatenate((self.offsets[1:], feeds)), kind="stable")
        return starts, ends

    def document_of(self, starts: np.ndarray) -> np.ndarray:
        """The document in which each start lies (for words: starts of runs with a byte)."""
        return np.searchsorted(self.offsets, starts, side="right") - 1


def word_ngrams(words: np.ndarray, document: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of `n` consecutive words of a document, and the index of the first word of each."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    with np.errstate(over="ignore"):
        out = words[: len(words) - n + 1].copy()
        for k in range(1, n):
            out = out * np.uint64(_MULTIPLIER) + words[k : len(words) - n + 1 + k]
    whole = document[: len(out)] == document[n - 1 :]
    return mix(out[whole]), np.flatnonzero(whole)


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's bigint."""
    return x.view(np.int64)


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The batch in slices of about `SLICE_BYTES`, each with its texts; null is an empty text."""
    text = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    if not len(text):
        return
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
    data = text.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(text):
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(text))
        yield (
            batch.slice(first, last - first),
            Texts(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]),
        )
        first = last
