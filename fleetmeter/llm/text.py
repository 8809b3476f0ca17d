"""Words and rolling hashes of whole texts, straight from Arrow buffers.

Texts are handled in slices of whole documents of about ``limit`` bytes, so memory follows the
slice, not the batch. A null text has no bytes. All positions are word or byte offsets in the slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
BLOCK = 1 << 20


def _class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words [^\x20\x09-\x0D]+.
BLANK_SEPARATED = ~_class((9, 13), (32, 32))
#: Bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, after lower-casing.
ALPHANUMERIC = ~_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


@dataclass
class Slice:
    """Rows lo..hi of a batch: their bytes, and where each text begins (one more entry than rows)."""

    lo: int
    hi: int
    data: np.ndarray
    starts: np.ndarray


def slices(column: pa.Array, limit: int = 4 << 20) -> Iterator[Slice]:
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Slice(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


@dataclass
class Words:
    """Words of a slice: byte bounds, and the first word of each text (one more entry than texts)."""

    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(data: np.ndarray, starts: np.ndarray, inside: np.ndarray) -> Words:
    """Maximal runs of ``inside`` bytes that lie in one text."""
    is_word = inside[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = is_word[:-1]
    cuts = starts[(starts > 0) & (starts < len(data))]
    before[cuts] = False
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = is_word[1:]
    after[cuts - 1] = False
    begin = np.flatnonzero(is_word & ~before)
    end = np.flatnonzero(is_word & ~after) + 1
    return Words(begin, end, np.searchsorted(begin, starts))


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(29))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(32))


@lru_cache(maxsize=8)
def _byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) | U64(1)


@lru_cache(maxsize=8)
def _powers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """r^i and r^-i for i < n, modulo 2^64."""
    r = (int(np.random.default_rng(seed + 1).integers(1, 2**62)) << 3) | 5
    inverse = pow(r, -1, 2**64)
    out = []
    for base in (r, inverse):
        p = np.ones(n, dtype=np.uint64)
        if n > 1:
            p[1:] = U64(base)
            p = np.cumprod(p, dtype=np.uint64)
        out.append(p)
    return out[0], out[1]


def _up(n: int) -> int:
    return 1 << max(10, int(n - 1).bit_length())


def _ranges(values: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """Hash of values[begin:end] for each pair, by differences of one weighted running sum."""
    power, inverse = _powers(_up(len(values) + 1), seed)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * power[: len(values)], dtype=np.uint64, out=total[1:])
    return mix((total[end] - total[begin]) * inverse[begin])


def word_hashes(data: np.ndarray, found: Words, seed: int = 11) -> np.ndarray:
    """64-bit hash of each word's bytes, in blocks of about a megabyte."""
    out = np.empty(len(found.begin), dtype=np.uint64)
    values = _byte_values(seed)
    i = 0
    while i < len(out):
        base = found.begin[i]
        j = max(i + 1, int(np.searchsorted(found.end, base + BLOCK, side="right")))
        block = values[data[base : found.end[j - 1]]]
        out[i:j] = _ranges(block, found.begin[i:j] - base, found.end[i:j] - base, seed)
        i = j
    return out


def window_hashes(hashes: np.ndarray, width: int, seed: int = 23) -> np.ndarray:
    """Hash of each run of ``width`` word hashes; entry p is the run that starts at p."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.empty(n, dtype=np.uint64)
    for i in range(0, n, BLOCK):
        j = min(i + BLOCK, n)
        at = np.arange(j - i)
        out[i:j] = _ranges(hashes[i : j + width - 1], at, at + width, seed)
    return out


def span_hashes(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 59) -> np.ndarray:
    """Hash of each run of word hashes from begin to end, of any length."""
    return mix(_ranges(hashes, begin, end, seed) + (end - begin).astype(np.uint64))


def whole_windows(first: np.ndarray, width: int) -> np.ndarray:
    """For each word position with a run of ``width`` words, whether the run lies in one text."""
    n = int(first[-1])
    if n < width:
        return np.zeros(0, dtype=bool)
    inside = np.zeros(n + 1, dtype=np.int64)
    counts = np.diff(first)
    long = counts >= width
    np.add.at(inside, first[:-1][long], 1)
    np.add.at(inside, first[1:][long] - width + 1, -1)
    return np.cumsum(inside)[: n - width + 1] > 0


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def covered(begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Whether each of n positions lies in one of the ranges."""
    depth = np.zeros(n + 1, dtype=np.int64)
    np.add.at(depth, begin, 1)
    np.add.at(depth, end, -1)
    return np.cumsum(depth[:n]) > 0


def joined(data: np.ndarray, found: Words, keep: np.ndarray) -> list[bytes]:
    """The kept words of each text, joined by one space."""
    raw = data.tobytes()
    out = []
    for lo, hi in zip(found.first[:-1], found.first[1:], strict=True):
        at = np.flatnonzero(keep[lo:hi]) + lo
        out.append(b" ".join(raw[b:e] for b, e in zip(found.begin[at].tolist(), found.end[at].tolist(), strict=True)))
    return out
