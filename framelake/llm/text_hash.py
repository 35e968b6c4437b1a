"""Words of UTF-8 texts and their 64-bit hashes, vectorised over Arrow buffers.

A text is cut at bytes, which is exact for word patterns that are sets of
ASCII characters plus everything outside ASCII: every byte of a longer code
point is 0x80 or above.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18          # bytes hashed at once; a longer text is a slice of its own

_B = np.arange(256)
LOWER = np.where((_B >= 65) & (_B <= 90), _B + 32, _B).astype(np.uint8)
#: words [^\x20\x09-\x0D]+
NOT_SPACE = ~((_B == 0x20) | ((_B >= 0x09) & (_B <= 0x0D)))
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
ALNUM = ((_B >= 0x30) & (_B <= 0x39)) | ((_B >= 0x61) & (_B <= 0x7A)) | (_B >= 0x80)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_POW = np.ones(1, np.uint64)
_INV = np.ones(1, np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse modulo 2**64."""
    global _POW, _INV
    if len(_POW) < n:
        n = max(n, SLICE_BYTES + 1024)
        _POW, _INV = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
    return _POW, _INV


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums whose differences, times an inverse power, hash any part."""
    pw, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * pw[:len(data)], out=out[1:])
    return out


def part_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for arrays of bounds; equal parts, equal hash."""
    _, inv = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * inv[start] + (end - start).astype(np.uint64))


@dataclass
class Slice:
    """Texts ``first .. first + len(bounds) - 1`` of a batch, as one run of bytes."""

    first: int
    data: np.ndarray       # uint8
    offsets: np.ndarray    # int64, one more than texts


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    bufs = column.buffers()
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    lo, n = 0, len(column)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield Slice(lo, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
        lo = hi


@dataclass
class Words:
    """Words of a slice in text order; text t has words first[t] .. first[t+1]-1."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def chained_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of data[start:end] for arrays of bounds, eight bytes at a time
    through a mixing step each.  Unlike a polynomial modulo 2**64, whose
    structure some pairs of long words share for every base, unequal parts
    collide by chance only."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
    out = mix((end - start).astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x51) % (1 << 64)))
    at, todo = start.copy(), np.arange(len(start))
    while len(todo):
        left = end[todo] - at[todo]
        value = np.ascontiguousarray(eights[at[todo]]).view("<u8")[:, 0]
        short = left < 8
        value[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        out[todo] = mix(out[todo] ^ mix(value + np.uint64(0x9E3779B97F4A7C15)))
        at[todo] += 8
        todo = todo[left > 8]
    return out


def words(s: Slice, table: np.ndarray = NOT_SPACE, seed: int | None = None) -> Words:
    """``seed``: hash by :func:`chained_hash`."""
    data = LOWER[s.data]
    is_word = table[data]
    n = len(data)
    before = np.zeros(n, bool)
    after = np.zeros(n, bool)
    if n:
        before[1:] = is_word[:-1]
        after[:-1] = is_word[1:]
        starts, ends = s.offsets[:-1], s.offsets[1:]
        before[starts[starts < n]] = False
        after[ends[ends > starts] - 1] = False
    start = np.flatnonzero(is_word & ~before)
    end = np.flatnonzero(is_word & ~after) + 1
    first = np.searchsorted(start, s.offsets).astype(np.int64)
    hashed = part_hash(prefix_hash(data), start, end) if seed is None else chained_hash(data, start, end, seed)
    return Words(start, end, hashed, first)


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive entries (empty if too few)."""
    m = len(h) - size + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j in range(size):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += h[j:j + m]
    return mix(out + np.uint64(size))
