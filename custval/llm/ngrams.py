"""Hashed n-gram counts of segments of text, as arrays."""

from __future__ import annotations

import numpy as np

from custval.llm.arrays import BYTE_VALUES, Words, mix64

_U = np.uint64


def unit(counts: np.ndarray) -> np.ndarray:
    """Square roots of counts, each row scaled to length one; an empty row stays zero."""
    x = np.sqrt(counts, dtype=np.float32)
    norm = np.sqrt(counts.sum(1, dtype=np.float32))
    return x / np.maximum(norm, 1)[:, None]


def byte_ngrams(data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray, n: int, dims: int) -> np.ndarray:
    """Counts of hashed ``n``-byte runs of texts at ``offsets`` (never across texts) by segment.

    ``cuts`` are the segments' bounds, at least those of the texts; a run
    counts where it begins.
    """
    rows, size = len(cuts) - 1, len(data) - n + 1
    if size <= 0:
        return np.zeros((rows, dims), np.int64)
    h = np.zeros(size, _U)
    for k in range(n):
        h = h * _U(0x9E3779B97F4A7C15) + BYTE_VALUES[data[k: k + size]]
    bucket = ((h ^ h >> _U(32)) * _U(0x94D049BB133111EB) >> _U(40)).astype(np.int64) % dims
    segment = np.repeat(np.arange(rows), np.diff(cuts))[:size]
    inside = np.ones(size, bool)
    for k in range(1, n):
        at = offsets[1:] - k
        inside[at[(at >= 0) & (at < size)]] = False
    # a short text's last positions may lie before it: those belong to earlier texts' ends and are cut there as well
    return np.bincount((segment * dims + bucket)[inside], minlength=rows * dims).reshape(rows, dims)


def char_ngrams(data: np.ndarray, offsets: np.ndarray, n: int, dims: int) -> np.ndarray:
    """Counts of hashed runs of ``n`` characters (code points of UTF-8) by text, never across texts."""
    rows, size = len(offsets) - 1, len(data)
    head = data & 0xC0 != 0x80
    begins = offsets[:-1]
    head[begins[begins < size]] = True                # a stray byte at the head of a text is a character
    starts = np.flatnonzero(head)
    m = len(starts) - n + 1
    if m <= 0:
        return np.zeros((rows, dims), np.int64)
    place = np.arange(size) - np.repeat(starts, np.diff(np.append(starts, size)))
    chars = np.add.reduceat(data.astype(_U) << (8 * np.minimum(place, 7)).astype(_U), starts)
    doc = np.searchsorted(offsets, starts, "right") - 1
    h = np.zeros(m, _U)
    for k in range(n):
        h = h * _U(0x9E3779B97F4A7C15) + chars[k: k + m]
    bucket = (mix64(h) >> _U(40)).astype(np.int64) % dims
    inside = doc[:m] == doc[n - 1:]
    return np.bincount((doc[:m] * dims + bucket)[inside], minlength=rows * dims).reshape(rows, dims)


def word_ngrams(words: Words, rows: int, sizes: tuple[int, ...], dims: int) -> np.ndarray:
    """Counts of hashed runs of so many words by text."""
    total = np.zeros(rows * dims, np.int64)
    for n in sizes:
        m = len(words.hash) - n + 1
        if m <= 0:
            continue
        h = np.zeros(m, _U)
        for k in range(n):
            h = h * _U(0xD1342543DE82EF95) + words.hash[k: k + m]
        inside = words.doc[:m] == words.doc[n - 1:]
        bucket = (mix64(h) >> _U(40)).astype(np.int64) % dims
        total += np.bincount((words.doc[:m] * dims + bucket)[inside], minlength=rows * dims)
    return total.reshape(rows, dims)
