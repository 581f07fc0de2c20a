"""Words and word shingles of whole texts as 64-bit hashes, computed on the UTF-8 bytes of Arrow batches.

All separators in use are ASCII, so splitting bytes is splitting code points. A word's hash is a polynomial over its
bytes, taken from prefix sums, hence independent of where the word stands and of how a text is cut for computation.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SEGMENT_BYTES = 1 << 20
SLICE_BYTES = 1 << 21

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (the public splitmix64 step)."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U64(27))
    x = x * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def _fold(table: np.ndarray) -> np.ndarray:
    folded = table.copy()
    folded[65:91] = table[97:123]
    return folded


def _space_separated() -> np.ndarray:
    word = np.ones(256, bool)
    word[[0x20, *range(0x09, 0x0E)]] = False
    return word


def _alphanumeric() -> np.ndarray:
    word = np.zeros(256, bool)
    word[0x30:0x3A] = True
    word[0x41:0x5B] = True
    word[0x61:0x7B] = True
    word[0x80:] = True
    return word


#: Words are runs of these bytes: anything but ASCII white space; or ASCII letters, digits and all that is not ASCII.
SPACED, ALPHANUMERIC = _space_separated(), _alphanumeric()
#: A random value for each byte; and with A-Z valued as a-z.
BYTE_VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * _U64(_BASE))
_FOLDED_VALUE = _fold(BYTE_VALUE)


class _Powers:
    """Powers of the base and of its inverse, as many as the longest segment needs."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (
                np.multiply.accumulate(np.concatenate(([_U64(1)], np.full(n - 1, _U64(b)))))
                for b in (_BASE, _BASE_INVERSE)
            )
        return self.up, self.down


_POWERS = _Powers()


@dataclass(frozen=True)
class Words:
    """Hashes of the words of several texts; the words of text i are ``hashes[offsets[i]:offsets[i + 1]]``."""

    hashes: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text each; a longer text stands alone."""
    if not batch.num_rows:
        return
    ends = text_ends(batch.column(column))
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_ends(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))


def hashed_words(texts: pa.Array, word_bytes: np.ndarray) -> Words:
    """Hash the words of every text, A-Z as a-z; null has none."""
    ends = text_ends(texts)
    bounds = np.concatenate(([0], ends))
    data = text_bytes(texts)
    if not len(data):
        return Words(np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64))
    first, last = word_runs(data, bounds, word_bytes)
    return Words(run_hashes(data, first, last, _FOLDED_VALUE), np.searchsorted(first, bounds))


def run_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Hashes of the byte runs from ``first`` to ``last``, both included, in order and apart; ``values`` by byte."""
    hashes = np.empty(len(first), np.uint64)
    at = 0
    while at < len(first):  # segments end between runs
        stop = max(at + 1, int(np.searchsorted(last, first[at] + SEGMENT_BYTES)))
        origin, end = first[at], last[stop - 1] + 1
        up, down = _POWERS.upto(int(end - origin))
        sums = np.cumsum(values[data[origin:end]] * up[: end - origin])
        begin = first[at:stop] - origin
        before = np.where(begin > 0, sums[begin - 1], _U64(0))
        hashes[at:stop] = (sums[last[at:stop] - origin] - before) * down[begin]
        at = stop
    return mixed(hashes)


def chain_hashes(hashes: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n values from ``starts`` on, by prefix sums, however long they are."""
    up, down = _POWERS.upto(len(hashes) + 1)
    sums = np.concatenate((np.zeros(1, _U64), np.cumsum(hashes * up[: len(hashes)])))
    return mixed((sums[starts + n] - sums[starts]) * down[starts])


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = np.arange(97, 123)


def fold_bytes(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z."""
    return _LOWER[data]


def text_bytes(texts: pa.Array) -> np.ndarray:
    """The bytes of all texts one after another."""
    if texts.null_count:
        texts = texts.fill_null("")
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if data is None or not len(texts):
        return np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, np.int64 if large else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]]


def word_runs(data: np.ndarray, bounds: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first and the last byte of each word; no word goes beyond its text."""
    inside = word_bytes[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    heads = bounds[:-1][bounds[:-1] < len(data)]
    starts[heads] = inside[heads]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    tails = bounds[1:][bounds[1:] > 0] - 1
    stops[tails] = inside[tails]
    return np.flatnonzero(starts), np.flatnonzero(stops)


def _chained(words: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    out = np.full(len(starts), _U64(k))
    for j in range(k):
        out = out * _U64(_BASE) + words[starts + j]
    return mixed(out)


def shingles(words: Words, k: int = 5) -> Words:
    """Hashes of each text's runs of k words; a text of fewer words, but not none, has one, its whole sequence."""
    counts = words.counts
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    offsets = np.concatenate(([0], np.cumsum(n)))
    out = np.empty(offsets[-1], np.uint64)
    place = np.arange(offsets[-1]) + np.repeat(words.offsets[:-1] - offsets[:-1], n)
    length = np.repeat(np.minimum(counts, k), n)
    for m in range(1, k + 1):
        these = slice(None) if m == k and (counts >= k).all() else length == m
        out[these] = _chained(words.hashes, place[these], m)
    return Words(out, offsets)


def word_places(data: bytes, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first and the last byte of each word of one text."""
    return word_runs(np.frombuffer(data, np.uint8), np.array([0, len(data)]), word_bytes)
