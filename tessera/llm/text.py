"""Vectorised words of UTF-8 text, straight from Arrow's buffers.

Words are runs of bytes other than 0x20 and 0x09-0x0D. A word's identity is a
64-bit hash: a polynomial over its bytes, made by one running sum over the
buffer, so no Python object is made for a word or a document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_PIECE = 1 << 15  # its running sums stay in a core's cache
_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finaliser)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x = x * U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = U(base)
    return np.multiply.accumulate(out)


_POW = _powers(_BASE, _PIECE + 1)
_INV = _powers(pow(_BASE, -1, 2**64), _PIECE + 1)


def buffers(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.cast(pa.large_string()).chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = 1 << 21):
    """(first, last) runs of documents of about `most` bytes; a longer document stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return np.frombuffer(data.tobytes().translate(LOWER.tobytes()), np.uint8)


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and each document's bounds among them."""
    n = len(data)
    solid = np.frombuffer(data.tobytes().translate((~space).tobytes()), bool)
    first, last = solid.copy(), solid.copy()
    np.greater(solid[1:], solid[:-1], out=first[1:])
    np.greater(solid[:-1], solid[1:], out=last[:-1])
    inner = offsets[(offsets > 0) & (offsets < n)]
    first[inner], last[inner - 1] = solid[inner], solid[inner - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, never 0."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + _PIECE, "right")))
        part = np.take(_TABLE, data[base : int(ends[j - 1])], mode="clip")  # any byte is within the table
        if len(part) > _PIECE:  # one very long word
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * _powers(_BASE, len(part)), out=sums[1:])
            out[i] = sums[-1]
        else:
            sums = np.zeros(len(part) + 1, np.uint64)
            part *= _POW[: len(part)]
            np.cumsum(part, out=sums[1:])
            s = starts[i:j] - base
            out[i:j] = (sums[ends[i:j] - base] - sums[s]) * _INV[s]
        i = j
    return np.maximum(mix(out), U(1))


def owners(bounds: np.ndarray) -> np.ndarray:
    """The document of each word."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words, across documents too: one for each start."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    odd = _powers(0xD6E8FEB86659FD93, k + 1)[1:]
    out = hashes[:n] * odd[0]
    for t in range(1, k):
        out += hashes[t : t + n] * odd[t]
    return mix(out)


def shingle_sets(hashes: np.ndarray, bounds: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Each document's distinct k-word shingles, sorted, and their bounds.

    A document of fewer than k words, but one at least, has its whole sequence as its only shingle.
    """
    counts = np.diff(bounds)
    n = np.where(counts < k, counts > 0, counts - k + 1)
    at = np.append(0, np.cumsum(n))
    g = grams(hashes, k)
    inside = np.ones(len(g), bool)
    for t in range(1, k):
        cut = bounds[1:-1] - t
        inside[cut[(cut >= 0) & (cut < len(g))]] = False
    g = g[inside]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        own = np.zeros(len(short), np.uint64)
        odd = _powers(0xD6E8FEB86659FD93, k + 1)[1:]
        for t in range(k - 1):
            has = counts[short] > t
            own[has] += hashes[bounds[short[has]] + t] * odd[t]
        every = np.empty(at[-1], np.uint64)
        alone = np.zeros(at[-1], bool)
        alone[at[short]] = True
        every[alone] = mix(own ^ (counts[short].astype(np.uint64) * U(0xA0761D6478BD642F)))
        every[~alone] = g
        g = every
    sort_runs(g, at)
    if len(g):
        fresh = np.ones(len(g), bool)
        np.not_equal(g[1:], g[:-1], out=fresh[1:])
        fresh[at[:-1][n > 0]] = True
        if not fresh.all():
            g, at = g[fresh], np.append(0, np.cumsum(fresh))[at]
    return g, at


def sort_runs(x: np.ndarray, at: np.ndarray) -> None:
    """Sorts each run x[at[i] : at[i + 1]] in place: runs of one length at a time, as values, without an order of indices."""
    n = np.diff(at)
    order = np.argsort(n, kind="stable")
    order = order[np.searchsorted(n[order], 2) :]
    sizes, first = np.unique(n[order], return_index=True)
    for size, a, z in zip(sizes.tolist(), first.tolist(), np.append(first, len(order))[1:].tolist(), strict=True):
        if z - a == 1:
            x[at[order[a]] : at[order[a]] + size].sort()
            continue
        where = at[order[a:z], None] + np.arange(size)
        x[where] = np.sort(x[where], axis=1)
