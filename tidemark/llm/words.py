"""Word hashes of Arrow text batches, vectorised over bytes.

A word is a maximal run of bytes other than space and 0x09-0x0D; A-Z count as
a-z. Words get 64-bit hashes (a polynomial over random byte values, then mixed), so equal words agree on every executor and unequal ones collide with
a probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_BYTES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
FOLDED = _BYTES[LOWER]
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(_BASE)
#: Bytes hashed at a time (a longer word is one block).
BLOCK = 1 << 17


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP, _DOWN = _powers(_BASE, BLOCK + 1), _powers(pow(_BASE, -1, 2**64), BLOCK + 1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ascending byte spans, A-Z folded; empty spans give 0.

    The sum of byte value times base**position, from running sums, moved back to
    the span's own start (the base is odd, so it has an inverse modulo 2**64).
    """
    out = np.zeros(len(starts), np.uint64)
    full = np.flatnonzero(ends > starts)
    s, e = starts[full], ends[full]
    i = 0
    while i < len(full):
        j = max(i + 1, int(np.searchsorted(e, s[i] + BLOCK, "right")))
        lo, n = s[i], int(e[j - 1] - s[i])
        up, down = powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(FOLDED[data[lo:lo + n]] * up[:n], out=sums[1:])
        a, b = s[i:j] - lo, e[i:j] - lo
        out[full[i:j]] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) * _STEP)
        i = j
    return out


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's first n powers at least, and their inverses."""
    global _UP, _DOWN
    if n > len(_UP):
        _UP, _DOWN = _powers(_BASE, 2 * n), _powers(pow(_BASE, -1, 2**64), 2 * n)
    return _UP, _DOWN


def member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which 64-bit values are among the sorted `known`; a bit table answers for most."""
    low = np.uint64((1 << 20) - 1)
    sieve = np.zeros(1 << 20, bool)
    sieve[(known & low).astype(np.int64)] = True
    out = sieve[(values & low).astype(np.int64)]
    out[out] = np.isin(values[out], known)
    return out


class Words:
    """Words of a batch of texts: byte `starts`/`ends` in `data`, `hashes`, and `ptr` (first word of each text)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, trim: bool = False) -> None:
        self.data, self.offsets = data, offsets
        solid = ~SEPARATOR[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True  # texts lie side by side: a boundary ends a word
        before, after = np.ones(len(data), bool), np.ones(len(data), bool)
        before[1:] = ~solid[:-1]
        after[:-1] = ~solid[1:]
        self.starts = np.flatnonzero(solid & (before | first[:-1]))
        self.ends = np.flatnonzero(solid & (after | first[1:])) + 1
        self.ptr = np.searchsorted(self.starts, offsets)
        self.hashes = hash_spans(data, *(trimmed(self) if trim else (self.starts, self.ends)))

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def of(self, i: int) -> np.ndarray:
        """Hashes of the words of text i, in order."""
        return self.hashes[self.ptr[i]:self.ptr[i + 1]]

    def text(self, a: int, b: int) -> str:
        """Words a to b (exclusive) of the batch, as they stand in the text."""
        return bytes(self.data[self.starts[a]:self.ends[b - 1]]).decode("utf-8", "replace") if b > a else ""


_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[0x21:0x30] = _PUNCTUATION[0x3A:0x41] = _PUNCTUATION[0x5B:0x61] = _PUNCTUATION[0x7B:0x7F] = True


def trimmed(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words' spans without ASCII punctuation at either end (a word of punctuation alone becomes empty)."""
    starts, ends = words.starts.copy(), words.ends.copy()
    left = np.arange(len(starts))
    while len(left):
        left = left[_PUNCTUATION[words.data[ends[left] - 1]]]
        ends[left] -= 1
        left = left[ends[left] > starts[left]]
    left = np.flatnonzero(ends > starts)
    while len(left):
        left = left[_PUNCTUATION[words.data[starts[left]]]]
        starts[left] += 1
        left = left[ends[left] > starts[left]]
    return starts, ends


def text_words(column: pa.Array, trim: bool = False) -> Words:
    """The words of a string column (without nulls); `trim`: hashed without punctuation at their ends."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return Words(data, offsets.astype(np.int64) - int(offsets[0]), trim)


def slices(batch: pa.RecordBatch, column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most `most` bytes of `column` (a longer text stands alone)."""
    i = batch.schema.get_field_index(column)
    n = batch.num_rows
    if not n:
        return
    col = batch.column(i)
    offsets = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield batch.slice(a, b - a)
        a = b


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for t in range(k):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + words[t:t + n]
    return mix(acc)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of k-word shingles; fewer words make one shingle; none make none."""
    if 0 < len(words) < k:
        return grams(words, len(words)) ^ np.uint64(len(words))
    return np.unique(grams(words, k))
