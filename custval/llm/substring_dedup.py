"""Substring dedup over word windows.

Every window of ``window`` consecutive words gets a Rabin-Karp hash; Spark
counts in which documents each hash starts; windows that an earlier document
holds too merge into maximal removal intervals.

Hashes are 64 bits wide (for n windows about n**2 / 2**65 chance pairs: 5e-4
for 135 million windows).  Documents travel once, in doc_id ranges; each range
sends its distinct hashes (about six bytes each) to hash buckets and gets one
bit per hash back.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from custval.llm import chunks as C
from custval.llm.arrays import Words, binary_buffers, blocks, window_hashes

RESULT = "doc_id long, n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept_text string"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                     ("removed", _SPANS), ("kept_text", pa.string())])


def _windows(table: pa.Table, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a chunk in key order: window hashes, their row, their first word in the row, and words per row."""
    data, offsets = binary_buffers(table["data"])
    hashes, rows, firsts, counts = [], [], [], []
    for row, _, part, cut in blocks(data, offsets):
        words = Words(part, cut)
        first, h = window_hashes(words, window)
        doc = words.doc[first]
        hashes.append(h)
        rows.append((row + doc).astype(np.int32))
        firsts.append((first - words.first[doc]).astype(np.int32))
        counts.append(np.diff(words.first))
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(rows), np.concatenate(firsts), np.concatenate(counts)


def intervals(starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals covered by windows of ``size`` at the sorted ``starts``."""
    if len(starts) == 0:
        return starts, starts
    apart = np.flatnonzero(np.diff(starts) > size)
    return starts[np.concatenate([[0], apart + 1])], starts[np.concatenate([apart, [len(starts) - 1]])] + size


def _cut(table: pa.Table, bits: pa.Table, window: int, route: C.Route) -> pa.Table:
    table = table.sort_by("key")
    keys = table["key"].to_numpy()
    hashes, rows, firsts, counts = _windows(table, window)
    order = np.argsort(hashes, kind="stable")          # stable: the first of a hash is its earliest document here
    ranked = hashes[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    group = np.cumsum(new) - 1
    lead = order[new]
    elsewhere = C.received(bits, ranked[new], route)
    gone = np.empty(len(hashes), bool)
    gone[order] = elsewhere[group] | (keys[rows[order]] > keys[rows[lead]][group])
    rows, firsts = rows[gone], firsts[gone].astype(np.int64)
    edges = np.searchsorted(rows, np.arange(len(counts) + 1))
    removed, n_removed, kept = [], [], []
    for i, raw in enumerate(table["data"].to_pylist()):
        words = raw.split()
        a, b = intervals(firsts[edges[i]: edges[i + 1]], window)
        if len(a):
            keep = np.ones(len(words), bool)
            for x, y in zip(a, b):
                keep[x:y] = False
            words = list(compress(words, keep))
        removed.append([{"start": int(x), "end": int(y)} for x, y in zip(a, b)])
        n_removed.append(int((b - a).sum()))
        kept.append(b" ".join(words))
    return pa.table({"doc_id": table["id"], "n_words": pa.array(counts, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                     "removed": pa.array(removed, _SPANS), "kept_text": pa.array(kept, pa.binary()).view(pa.string())}, schema=_RESULT)


def remove_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13,
                            chunk_bytes: int = 8 << 20, buckets_per_chunk: float = 0.75, max_fan: int = 4096) -> DataFrame:
    """Remove each word covered by a window that also starts in a document with a smaller id.

    Returns per input row ``doc_id``, ``n_words``, ``n_removed``, ``removed``
    (maximal word intervals, end exclusive) and ``kept_text`` (kept words,
    joined by one space).  Windows are judged on the input.  A null or empty
    text has no words; rows that share an id do not remove each other's words;
    null ids count as one id behind all others; other columns are not read.
    Up to ``max_fan`` chunks their hashes travel once, up to its square twice.
    """
    base, n = C.chunked(docs, id_col, text_col, chunk_bytes)
    route = C.Route.over(n, buckets_per_chunk, max_fan)

    def entries(key, table):
        return C.send(key[0].as_py(), np.unique(_windows(table, window)[0]), route)

    def cut(key, table, bits):
        return _cut(table, bits, window, route) if table.num_rows else _RESULT.empty_table()

    by_chunk = C.grouped(base, n, "chunk")
    bits = C.seen_elsewhere(by_chunk.applyInArrow(entries, C.ENTRIES_DDL), route, n, earlier_only=True)
    return by_chunk.cogroup(C.grouped(bits, n, "chunk")).applyInArrow(cut, RESULT)
