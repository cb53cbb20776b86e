"""Vectorised tokenising: byte-level words and their 64-bit hashes for whole
Arrow batches, without a Python loop over words.

A word is a run of bytes that the separator table does not name; text is
UTF-8, so non-ASCII characters are always part of words. A-Z fold to a-z.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_SEGMENT = 1 << 20
_RADIX = 0x9E3779B97F4A7C15 | 1


def _separators(chars: str) -> np.ndarray:
    out = np.ones(256, dtype=bool)
    out[[ord(c) for c in chars]] = False
    return out


#: Words as `[^\x20\x09-\x0D]+`.
SPACED = _separators(" \t\n\v\f\r")
#: Words of letters, digits and non-ASCII characters only.
ALNUM = _separators("".join(chr(i) for i in range(128) if not chr(i).isalnum()))


def mix(x: np.ndarray) -> np.ndarray:
    """Bit mixer: a bijection of 64-bit integers."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class _Powers:
    """Powers of the radix modulo 2^64 and their inverses, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, dtype=U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, _SEGMENT + 1)
            for name, base in (("up", _RADIX), ("down", pow(_RADIX, -1, 1 << 64))):
                steps = np.full(n, base, dtype=U64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_POWERS = _Powers()
#: A random number per (lower-cased) byte.
_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]


class Words(NamedTuple):
    hash: np.ndarray    # uint64 per word
    start: np.ndarray   # first byte, counted from the start of the buffer
    end: np.ndarray     # behind the last byte
    bounds: np.ndarray  # words of document d are bounds[d]:bounds[d + 1]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.cast(pc.fill_null(column, ""), pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def split(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray = SPACED) -> Words:
    """Words of the documents raw[offsets[d]:offsets[d + 1]]."""
    n = len(raw)
    inside = table[raw]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    begins = inside & cut[:-1]
    ends = inside & cut[1:]
    if n:
        begins[0] |= inside[0]
        begins[1:] |= inside[1:] & ~inside[:-1]
        ends[-1] |= inside[-1]
        ends[:-1] |= inside[:-1] & ~inside[1:]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = np.empty(len(start), dtype=U64)
    at = 0
    while at < len(start):  # segments of whole words
        stop = max(at + 1, int(np.searchsorted(end, start[at] + _SEGMENT, "right")))
        base = start[at]
        size = int(end[stop - 1] - base)
        up, down = _POWERS.get(size + 1)
        sums = np.zeros(size + 1, dtype=U64)
        np.cumsum(_BYTE[raw[base:base + size]] * up[:size], out=sums[1:])
        lo, hi = start[at:stop] - base, end[at:stop] - base
        hashes[at:stop] = (sums[hi] - sums[lo]) * down[lo]
        at = stop
    return Words(mix(hashes), start, end, np.searchsorted(start, offsets, "left"))


def chunks(batch: pa.RecordBatch, column: str, most: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with about ``most`` bytes of text each (one document at least)."""
    i, total = 0, batch.num_rows
    raw, offsets = texts(batch.column(column))
    while i < total:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        j = min(j, total)
        yield batch.slice(i, j - i), raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


_PLACE = mix(np.arange(11, 11 + 64, dtype=U64)) | U64(1)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words, and their bounds per document. A document
    of fewer words (but not none) has one: its whole sequence."""
    h, bounds = words.hash, words.bounds
    counts = np.diff(bounds)
    m = max(0, len(h) - k + 1)
    runs = np.zeros(m, dtype=U64)
    for j in range(k if m else 0):
        runs += h[j:j + m] * _PLACE[j]
    out_counts = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    out_bounds = np.concatenate(([0], np.cumsum(out_counts)))
    pick = np.arange(out_bounds[-1]) + np.repeat(bounds[:-1] - out_bounds[:-1], out_counts)
    short = np.flatnonzero((counts > 0) & (counts < k))
    out = np.empty(len(pick), dtype=U64)
    whole = np.ones(len(pick), dtype=bool)
    whole[out_bounds[short]] = False
    out[whole] = runs[pick[whole]]
    for d in short:
        part = h[bounds[d]:bounds[d + 1]]
        tagged = np.append(part * _PLACE[:len(part)], _PLACE[32 + len(part)])  # the length counts too
        out[out_bounds[d]] = tagged.sum(dtype=U64)
    return mix(out), out_bounds
