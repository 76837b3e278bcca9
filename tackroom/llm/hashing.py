"""Vectorised word, shingle and MinHash hashing over Arrow string columns (numpy, inside tasks).

A word's 64-bit hash is a polynomial over a random byte table, taken from one
running sum over the whole buffer: sum(table[byte_i] * P**-i) between two
offsets, shifted back by P**start. All arithmetic is modulo 2**64, where the
odd base P has an inverse, so the sums are exact and no per-word Python runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BLOCK = 1 << 20  # bytes hashed at once; longer texts are cut at white space

_rng = np.random.Generator(np.random.PCG64(20240611))
_TABLE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
for _c in range(ord("A"), ord("Z") + 1):  # lower-cases A-Z, nothing else
    _TABLE[_c] = _TABLE[_c + 32]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_GRAM = _rng.integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n + 1, base, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


_POW = _powers(_BASE, 0)
_INV = _powers(_BASE, 0)


def _need(n: int) -> None:
    global _POW, _INV
    if len(_POW) <= n:
        size = max(n, 1 << 16)
        _POW = _powers(_BASE, size)
        _INV = _powers(pow(_BASE, -1, 1 << 64), size)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> _U(32))
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    return h


def _words(block: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of the words of one block; ``cuts`` are offsets where a text begins."""
    n = len(block)
    _need(n)
    solid = ~_SPACE[block]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = solid[:-1]
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = solid[1:]
    inner = cuts[(cuts > 0) & (cuts < n)]
    before[inner] = False
    after[inner - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_TABLE[block] * _INV[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * _POW[starts]), starts


def _blocks(offsets: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut [offsets[0], offsets[-1]) into blocks that end at a text's end or at white space."""
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        stop = min(end, at + _BLOCK)
        if stop < end:
            k = int(np.searchsorted(offsets, stop, side="right")) - 1
            if offsets[k] > at:
                stop = int(offsets[k])
            else:  # inside one long text: go on to the next white space
                limit = int(offsets[k + 1])
                while stop < limit:
                    space = np.flatnonzero(_SPACE[data[stop:min(limit, stop + _BLOCK)]])
                    if len(space):
                        stop += int(space[0])
                        break
                    stop = min(limit, stop + _BLOCK)
        yield at, stop
        at = stop


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of a string column (null: empty)."""
    column = column.fill_null("").cast(pa.large_string())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column, and per text the offset of its first word (one more at the end)."""
    data, offsets = string_buffers(column)
    hashes, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, b in _blocks(offsets, data):
        h, s = _words(data[a:b], offsets - a)
        hashes.append(h)
        starts.append(s + a)
    first = np.searchsorted(np.concatenate(starts), offsets, side="left")
    return np.concatenate(hashes), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word shingles of each text in order, repeats kept, and per text its first one.

    A text of fewer than ``k`` words, but not none, has one shingle: all its words.
    """
    if not 1 <= k <= 31:
        raise ValueError("shingles of 1 to 31 words")
    n_texts = len(first) - 1
    count = np.diff(first)
    n = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    out_first = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(int(out_first[-1]), dtype=np.uint64)
    total = len(words) - k + 1
    if total > 0:
        s = np.zeros(total, dtype=np.uint64)
        for j in range(k):
            s += words[j:j + total] * _GRAM[j]
        text = np.repeat(np.arange(n_texts), count)
        whole = text[:total] == text[k - 1:]
        long_texts = np.repeat(count >= k, n)
        out[long_texts] = mix(s[whole])
    for t in np.flatnonzero((count > 0) & (count < k)):
        w = words[first[t]:first[t + 1]]
        total_w = np.sum(w * _GRAM[32:32 + len(w)], dtype=np.uint64, keepdims=True)
        out[out_first[t]] = mix(total_w + _GRAM[63:] * _U(len(w)))[0]
    return out, out_first


class MinHasher:
    """``n_perm`` universal hash functions a*x+b modulo 2**64; the minimum of each over a text's shingles."""

    def __init__(self, n_perm: int, seed: int = 7):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.a = rng.integers(1, 2**63, n_perm, dtype=np.uint64) * _U(2) + _U(1)
        self.b = rng.integers(0, 2**63, n_perm, dtype=np.uint64)

    def minima(self, shingles: np.ndarray, first: np.ndarray, block: int = 1 << 15) -> np.ndarray:
        """Array (texts, n_perm); texts without shingles hold the largest value. Memory: block + result."""
        n = len(first) - 1
        out = np.full((len(self.a), n), np.iinfo(np.uint64).max, dtype=np.uint64)
        v = np.empty(block, dtype=np.uint64)
        for at in range(0, len(shingles), block):
            x = shingles[at:at + block]
            lo = int(np.searchsorted(first, at, side="right")) - 1
            hi = int(np.searchsorted(first, at + len(x), side="left"))
            own = np.arange(lo, hi)
            own = own[first[own + 1] > np.maximum(first[own], at)]  # texts with shingles in this block
            own = own[first[own] < at + len(x)]
            cuts = np.maximum(first[own] - at, 0)
            for j in range(len(self.a)):
                w = v[:len(x)]
                np.multiply(x, self.a[j], out=w)
                np.add(w, self.b[j], out=w)
                out[j, own] = np.minimum(out[j, own], np.minimum.reduceat(w, cuts))
        return out.T


def band_keys(minima: np.ndarray, rows: int) -> np.ndarray:
    """One int64 per band of ``rows`` minima, seeded by the band's number."""
    n, k = minima.shape
    bands = k // rows
    m = minima[:, :bands * rows].reshape(n, bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _U(0xA24BAED4963EE407), (n, bands)).copy()
    for r in range(rows):
        key = mix(key + m[:, :, r] * _GRAM[r])
    return key.view(np.int64)


def low_bits(minima: np.ndarray, bits: int = 2) -> np.ndarray:
    """b-bit signature: per bit plane, n_perm bits packed into int64 words; shape (texts, planes * n_perm / 64)."""
    low = mix(minima.copy()) >> _U(64 - bits)
    planes = []
    weights = _U(1) << np.arange(64, dtype=np.uint64)
    for b in range(bits):
        bit = (low >> _U(b)) & _U(1)
        planes.append((bit.reshape(len(minima), -1, 64) * weights).sum(axis=2, dtype=np.uint64))
    return np.concatenate(planes, axis=1).view(np.int64)


def parity_bits(distinct: np.ndarray, bits: int) -> np.ndarray:
    """Bitmap (int64 words) of the parities of a set's elements per bit.

    The bits in which two sets' bitmaps differ are at most as many as the
    elements that only one of the sets has: a bound that never errs.
    """
    odd = np.bincount((distinct >> _U(40)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)
