"""Words of many texts at once, as 64-bit hashes, with numpy over Arrow buffers.

A word is a longest run of bytes outside 0x20 and 0x09-0x0D; A-Z are lower-cased.  Words are
found and hashed for a whole record batch without a Python step per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACES = (0x20, *range(0x09, 0x0E))
_FACTOR = 0x9E3779B97F4A7C15 | 1
_CHUNK = 1 << 20


@dataclass
class Words:
    """``data`` lower-cased bytes of all texts; word i is data[starts[i]:ends[i]] with hash
    ``hashes[i]``; text d owns words first[d]:first[d + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def word(self, i: int) -> str:
        return self.data[self.starts[i]:self.ends[i]].tobytes().decode("utf-8", "replace")


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over 64 bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (null: empty) and their len + 1 offsets."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _powers(n: int, factor: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Polynomial hash modulo 2**64 from prefix sums, finalized; tables grow on demand."""

    def __init__(self) -> None:
        self.up = _powers(1 << 12, _FACTOR)
        self.down = _powers(1 << 12, pow(_FACTOR, -1, 1 << 64))

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            lo = int(starts[i])
            j = max(i + 1, int(np.searchsorted(ends, lo + _CHUNK, "right")))
            hi = int(ends[j - 1])
            if hi - lo + 1 > len(self.up):
                n = max(hi - lo + 1, min(2 * len(self.up), _CHUNK + 1))
                self.up = _powers(n, _FACTOR)
                self.down = _powers(n, pow(_FACTOR, -1, 1 << 64))
            sums = np.zeros(hi - lo + 1, np.uint64)
            piece = data[lo:hi].astype(np.uint64)
            piece += np.uint64(1)
            piece *= self.up[:hi - lo]
            np.cumsum(piece, out=sums[1:])
            s, e = starts[i:j] - lo, ends[i:j] - lo
            out[i:j] = (sums[e] - sums[s]) * self.down[s] + (e - s).astype(np.uint64)
            i = j
        return mixed(out)


def words_of(texts: pa.Array, hasher: Hasher) -> Words:
    """Words of every text of the array; a null text has none."""
    raw, offsets = buffers(texts)
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    data = lower[raw]
    solid = np.ones(256, bool)
    solid[list(SPACES)] = False
    inside = solid[raw]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    first = np.searchsorted(starts, offsets)
    return Words(data, starts, ends, hasher(data, starts, ends), first)


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words; order matters."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out *= np.uint64(_FACTOR)
        out += hashes[k:len(hashes) - n + 1 + k]
    return mixed(out)


def shingle_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingles; fewer than n words are one shingle, no words are none."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    return np.unique(shingles(hashes, min(n, len(hashes))))


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``most`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = buffers(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
