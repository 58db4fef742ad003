"""Vectorised word and shingle hashing over Arrow string columns.

All functions work on one Arrow batch inside a task.  Bytes of a batch are
handled in slices of whole texts (about ``SLICE_BYTES`` each, one text at
least), so the working set stays small whatever the batch size.  Null texts
count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_K = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_BYTE_CODES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd multiplier and of its inverse mod 2**64, at least n."""
    if len(_POW.get("p", ())) < n:
        size = max(n, SLICE_BYTES + (1 << 18))
        _POW["p"] = _powers(int(_K), size)
        _POW["q"] = _powers(pow(int(_K), -1, 1 << 64), size)
    return _POW["p"], _POW["q"]


#: masks of the first 0 .. 8 bytes of a little-endian integer
_LOW_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def byte_table(pred) -> np.ndarray:
    """Boolean table over the 256 byte values."""
    return np.array([bool(pred(b)) for b in range(256)])


LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
#: words of the shingle operators: anything but space and \t..\r
NOT_SPACE = byte_table(lambda b: not (b == 32 or 9 <= b <= 13))
#: words of the benchmark operator: letters, digits and all non-ASCII bytes
ALNUM = byte_table(lambda b: b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 or 65 <= b <= 90)


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, int64 offsets) of a string or binary array; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_null(col.type):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    large = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64 if large else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of whole texts with about ``limit`` bytes each."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


@dataclass
class Words:
    """Words of some consecutive texts: hashes and the text each stands in."""

    hashes: np.ndarray        # uint64 per word
    first: np.ndarray         # int64 per text + 1: word range of each text


def hash_words(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """Split ASCII-lower-cased texts into maximal runs of ``table`` bytes; hash each.

    A word is read eight bytes at a time, each mixed into the hash by a bijection: words
    of up to eight bytes and one length never collide, longer ones only by chance (no polynomial,
    whose collisions can be written down).
    """
    lo, hi = int(offsets[0]), int(offsets[-1])
    b = LOWER[raw[lo:hi]]
    n, k = hi - lo, len(offsets) - 1
    if n == 0:
        return Words(np.zeros(0, np.uint64), np.zeros(k + 1, np.int64))
    inside = table[b]
    bounds = offsets[:-1] - lo
    bounds = bounds[bounds < n]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    start[bounds] = inside[bounds]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    last = bounds[bounds > 0] - 1
    end[last] = inside[last]
    s = np.flatnonzero(start)
    e = np.flatnonzero(end) + 1
    # the eight bytes from every position on, as one integer
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = b
    eight = np.ndarray((n,), "<u8", padded.data, strides=(1,))
    length = e - s
    h = mix64(length.astype(np.uint64) + _K)
    part, at = np.arange(len(s)), s
    while len(part):
        left = np.minimum(e[part] - at, 8)
        h[part] = mix64(h[part] ^ (eight[at] & _LOW_BYTES[left]))
        more = e[part] - at > 8
        part, at = part[more], at[more] + 8
    return Words(h, np.searchsorted(s, offsets - lo))


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word shingles, with int64 ranges per text.

    A text with fewer words, but some, has one shingle: its whole sequence.
    """
    w, first = words.hashes, words.first
    counts = np.diff(first)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_first = np.concatenate(([0], np.cumsum(n)))
    if len(w) >= size:
        g = np.full(len(w) - size + 1, size, dtype=np.uint64)
        for j in range(size):
            g = g * _K + w[j:len(w) - size + 1 + j]
        g = mix64(g)
    else:
        g = np.zeros(0, np.uint64)
    total = int(out_first[-1])
    # positions of the shingles that stay inside one text
    pos = np.repeat(first[:-1] - out_first[:-1], n) + np.arange(total)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short) == 0:
        return g[pos], out_first
    out = np.zeros(total, np.uint64)
    ok = np.repeat(counts >= size, n)
    out[ok] = g[pos[ok]]
    for i in short:
        h = np.array([int(counts[i])], np.uint64)
        for x in w[first[i]:first[i + 1]]:
            h = h * _K + x
        out[out_first[i]] = mix64(h)[0]
    return out, out_first
