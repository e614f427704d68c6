"""Suffix arrays by induced sorting, vectorised over buckets, and permuted common prefixes.

Suffixes are classified as smaller (S) or larger (L) than their right
neighbour.  The leftmost S suffixes of each rise (LMS) are sorted by their
substrings, the names of equal substrings are ranked, and from the sorted LMS
suffixes all others follow in two linear passes over the buckets.  A bucket is
handled in whole-array steps: all entries known so far induce their left
neighbours at once, and entries that land in the same bucket make the next
step.  The names form a text over an alphabet too large for bucket passes, so
they are ranked by doubling the number of names compared.
"""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its right neighbour (the end counts as smallest)."""
    n = len(t)
    ends = np.append(np.flatnonzero(t[1:] != t[:-1]), n - 1)
    rising = np.zeros(len(ends), bool)
    rising[:-1] = t[ends[:-1]] < t[ends[:-1] + 1]
    return np.repeat(rising, np.diff(ends, prepend=-1))


def _induce(t: np.ndarray, is_s: np.ndarray, lms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All suffixes in order, from LMS positions in the order to assume."""
    n = len(t)
    ends = np.cumsum(counts)
    heads = ends - counts
    by_char = lms[np.argsort(t[lms], kind="stable")]
    lms_ends = np.cumsum(np.bincount(t[lms], minlength=256))
    out = np.empty(n, np.int32)
    filled = heads.copy()

    def by_bucket(q):
        c = t[q]
        order = np.argsort(c, kind="stable")
        q, c = q[order], c[order]
        k = np.bincount(c, minlength=256)
        return q, c, k, np.arange(len(q)) - (np.cumsum(k) - k)[c]

    def append(q):
        q, c, k, rank = by_bucket(q)
        out[filled[c] + rank] = q
        np.add(filled, k, out=filled)

    append(np.array([n - 1], np.int32))
    chars = np.flatnonzero(counts)
    for c in chars:
        done = heads[c]
        while done < filled[c]:
            p, done = out[done: filled[c]], filled[c]
            q = p[p > 0] - 1
            q = q[~is_s[q]]
            if len(q):
                append(q)
        q = by_char[(lms_ends[c - 1] if c else 0): lms_ends[c]] - 1
        if len(q):
            append(q)

    lowest = ends.copy()

    def prepend(q):
        q, c, k, rank = by_bucket(q)
        out[lowest[c] - 1 - rank] = q
        np.subtract(lowest, k, out=lowest)

    for c in chars[::-1]:
        done = ends[c]
        while done > lowest[c]:
            p, done = out[lowest[c]: done][::-1], lowest[c]
            q = p[p > 0] - 1
            q = q[is_s[q]]
            if len(q):
                prepend(q)
        p = out[heads[c]: filled[c]][::-1]
        q = p[p > 0] - 1
        q = q[is_s[q]]
        if len(q):
            prepend(q)
    return out


def _words8(t: np.ndarray, pad: int) -> np.ndarray:
    """The eight bytes that start at each position, read as one little-endian number."""
    padded = np.concatenate([t, np.zeros(pad + 8, np.uint8)])
    return np.ndarray((len(t) + pad,), "<u8", padded, strides=(1,))


def common_prefix(t: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, up to ``limit``."""
    w = _words8(t, limit + 8)
    out = np.full(len(a), limit, np.int64)
    todo = np.arange(len(a))
    for at in range(0, limit, 8):
        x = w[a[todo] + at] ^ w[b[todo] + at]
        differ = x != 0
        low = x[differ]
        out[todo[differ]] = at + (np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)) >> 3)
        todo = todo[~differ]
        if not len(todo):
            break
    return np.minimum(np.minimum(out, limit), len(t) - np.maximum(a, b))


def suffix_array(t: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Suffixes of uint8 text ``t`` in order; with ``depth``, suffixes equal in so many bytes may stand in any order."""
    n = len(t)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    is_s = _types(t)
    counts = np.bincount(t, minlength=256)
    lms = (np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1).astype(np.int32)
    m = len(lms)
    if m > 1:
        number = np.full(n, -1, np.int32)
        number[lms] = np.arange(m, dtype=np.int32)
        first = _induce(t, is_s, lms, counts)
        order = number[first]
        order = order[order >= 0]                       # LMS substrings in order
        size = np.append(np.diff(lms) + 1, n - lms[-1] + 1)
        a, b = order[:-1], order[1:]
        same = size[a] == size[b]
        pair = np.flatnonzero(same)
        if len(pair):
            longest = int(size[a[pair]].max())
            same[pair] = common_prefix(t, lms[a[pair]].astype(np.int64), lms[b[pair]].astype(np.int64), longest) >= size[a[pair]]
        order = order.astype(np.int64)
        rank = np.empty(m, np.int64)
        head = np.where(np.concatenate([[False], same]), 0, np.arange(m))
        rank[order] = np.maximum.accumulate(head)
        k = 1
        while depth is None or 2 * k < depth + 2:       # k LMS substrings span 2 k bytes or more
            ranked = rank[order]
            tied = np.zeros(m, bool)
            tied[1:] = ranked[1:] == ranked[:-1]
            tied[:-1] |= tied[1:]
            at = np.flatnonzero(tied)
            if not len(at):
                break
            x = order[at]
            nxt = np.where(x + k < m, rank[np.minimum(x + k, m - 1)] + 1, 0)
            key = rank[x] * (m + 1) + nxt
            by = np.argsort(key, kind="stable")
            x, key = x[by], key[by]
            order[at] = x
            new = np.ones(len(at), bool)
            new[1:] = key[1:] != key[:-1]
            rank[x] = np.maximum.accumulate(np.where(new, at, 0))
            k *= 2
        lms = lms[order]
    return _induce(t, is_s, lms, counts)


def permuted_prefixes(t: np.ndarray, sa: np.ndarray, depth: int) -> np.ndarray:
    """In text order, the common prefix (up to ``depth``) of each suffix and the one before it in ``sa``.

    Every ``step``-th value is measured; as the value falls by one at most from
    one position to the next, a large one settles those that follow it.  That
    holds for a full suffix order only, not for one cut at a depth.
    """
    n = len(t)
    before = np.empty(n, np.int32)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    step = 16
    out = np.zeros(n, np.int32)
    probe = np.arange(0, n, step)
    probe = probe[before[probe] >= 0]
    far = common_prefix(t, probe, before[probe], depth + step)
    sure = np.zeros(-(-n // step), bool)
    sure[probe[far >= depth + step] // step] = True
    settled = np.repeat(sure, step)[:n]
    out[settled] = depth
    out[probe] = np.minimum(far, depth)
    settled[probe] = True
    rest = np.flatnonzero(~settled & (before >= 0))
    out[rest] = common_prefix(t, rest, before[rest], depth)
    return out
