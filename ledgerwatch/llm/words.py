"""Exact word positions and codes for whole Arrow batches: no hashes, no Python loop over words."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa


class Spans(NamedTuple):
    inside: np.ndarray  # per byte: part of a word
    start: np.ndarray   # first byte of each word
    end: np.ndarray     # behind its last byte
    bounds: np.ndarray  # words of document d are bounds[d]:bounds[d + 1]

    @property
    def doc(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def spans(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Spans:
    """Words of the documents raw[offsets[d]:offsets[d + 1]]: maximal runs of bytes that the
    table marks, within one document."""
    inside = table[raw]
    cut = np.zeros(len(raw) + 1, dtype=bool)
    cut[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if len(raw) else inside
    after = np.concatenate((inside[1:], [False])) if len(raw) else inside
    start = np.flatnonzero(inside & (cut[:-1] | ~before))
    end = np.flatnonzero(inside & (cut[1:] | ~after)) + 1
    return Spans(inside, start, end, np.searchsorted(start, offsets, "left"))


def spelled(raw: np.ndarray, words: Spans) -> pa.Array:
    """The words' bytes. Words are all bytes inside, in order, so nothing is gathered."""
    ends = np.concatenate(([0], np.cumsum(words.end - words.start))).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(words.start), [None, pa.py_buffer(ends), pa.py_buffer(raw[words.inside])])


def coded(raw: np.ndarray, words: Spans) -> tuple[np.ndarray, pa.Array]:
    """A number per word, equal for equal words, and the word of each number."""
    found = spelled(raw, words).dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number per pair (a, b), equal for equal pairs, below the number of pairs."""
    if not len(a):
        return np.zeros(0, np.int64)
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1].astype(np.int64)
