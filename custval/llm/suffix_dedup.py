"""Byte-exact substring dedup with suffix arrays over content-routed shards.

Two equal strings of ``min_bytes`` share their anchor: the ``gram``-byte
window inside them with the smallest hash.  So the window starts of a text fall
into runs by anchor, and a run's slice of text need only meet slices with the
same anchor hash.

1. Each chunk of documents (a doc_id range) sends its distinct anchor hashes to
   hash buckets and learns by one bit each which other chunks hold too.
2. Slices of shared anchors go to their bucket, each distinct slice of a chunk
   once.  A bucket is a shard: a suffix array of its distinct slices (induced
   sorting) and the permuted common prefixes give the groups of equal strings,
   and all but the earliest start of a group are marked, one bit per start.
   On the way there (``chunks.Route``) neighbouring senders' equal slices merge.
3. The chunks lay the marks over their texts and cut the covered bytes.

Matches are compared byte by byte; hashes only route.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custval.llm import chunks as C
from custval.llm.arrays import BYTE_VALUES, binary_buffers, blocks, mix64
from custval.llm.substring_dedup import intervals
from custval.llm.suffix_arrays import permuted_prefixes, suffix_array

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, removed array<struct<start:long,end:long>>, kept binary"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                     ("removed", _SPANS), ("kept", pa.binary())])
_SLICES = pa.schema([("span", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int32()), ("slices", pa.binary()),
                     ("sizes", pa.binary()), ("places", pa.binary()), ("hashes", pa.binary())])
_SLICES_DDL = "span int, bucket int, chunk int, slices binary, sizes binary, places binary, hashes binary"
_U = np.uint64
_BASE = 0x5851F42D4C957F2D


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes (a power of two) that start at each position."""
    h, size, base = BYTE_VALUES[data], 1, _BASE
    while size < gram:
        h = h[:-size] * _U(base) + h[size:]
        base = base * base % (1 << 64)
        size *= 2
    h ^= h >> _U(29)
    return h * _U(0x94D049BB133111EB)


class Anchors:
    """Of texts in key order: per run of window starts with one anchor its hash and the first and last start."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, min_bytes: int, gram: int):
        span = min_bytes - gram + 1
        found: list[tuple[np.ndarray, ...]] = []
        for row, end, part, cut in blocks(data, offsets, 1 << 17):
            if len(part) < min_bytes:
                continue
            h = _gram_hashes(part, gram)
            bits = _U(int(len(part)).bit_length())
            low = h >> bits << bits | np.arange(len(h), dtype=_U)      # the leftmost of equal hashes is the smallest
            size = 1
            while 2 * size <= span:
                low = np.minimum(low[:-size], low[size:])
                size *= 2
            if size < span:
                low = np.minimum(low[:len(low) - (span - size)], low[span - size:])
            at = (low & ((_U(1) << bits) - _U(1))).astype(np.int64)
            last = np.repeat(cut[1:] - min_bytes, np.diff(cut))[:len(at)]
            starts = np.flatnonzero(np.arange(len(at)) <= last)
            at = at[starts]
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1]) | (np.diff(starts) != 1)
            heads = np.flatnonzero(new)
            tails = np.append(heads[1:], len(at)) - 1
            found.append((h[at[heads]], starts[heads] + offsets[row], starts[tails[:len(heads)]] + offsets[row]))
        empty = np.empty(0, np.int64)
        # mixed once more: as minima they are small numbers, and buckets are ranges
        self.hash = mix64(np.concatenate([f[0] for f in found])) if found else np.empty(0, _U)
        self.first = np.concatenate([f[1] for f in found]) if found else empty
        self.last = np.concatenate([f[2] for f in found]) if found else empty


def _ordered(table: pa.Table) -> pa.Table:
    """Texts by key; rows that share a key by their bytes."""
    return table.sort_by([("key", "ascending"), ("data", "ascending")])


def _shared(anchors: Anchors, bits: pa.Table, route: C.Route) -> np.ndarray:
    """The runs whose anchor hash occurs again, here or in another chunk, ordered by hash and then by place."""
    order = np.argsort(anchors.hash, kind="stable")
    ranked = anchors.hash[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    again = C.received(bits, ranked[new], route)
    heads = np.flatnonzero(new)
    again |= np.diff(np.append(heads, len(ranked))) > 1
    return order[again[np.cumsum(new) - 1]] if len(ranked) else order


def _by_bucket(anchors: Anchors, runs: np.ndarray, raw: bytes, min_bytes: int, route: C.Route):
    """(bucket, runs, {slice: its first run}) of the shared runs, bucket by bucket."""
    _, edges = route.cut(anchors.hash[runs], 0)
    firsts, ends = anchors.first[runs].tolist(), (anchors.last[runs] + min_bytes).tolist()
    for b in np.flatnonzero(np.diff(edges)).tolist():
        x, y = int(edges[b]), int(edges[b + 1])
        seen: dict[bytes, int] = {}
        which = [seen.setdefault(raw[firsts[i]: ends[i]], i) for i in range(x, y)]
        yield b, runs[x:y], seen, np.array(which) - x


def _slice_rows(sender: int, route: C.Route, rows: list[tuple]) -> pa.Table:
    """Rows of (bucket, slices, places, hashes): the places are 8 bytes with the chunk above level 0, 4 without it there;
    hashes travel only if another level follows."""
    press = zstandard.ZstdCompressor(level=1)
    return pa.table({
        "span": pa.array([sender // route.fan] * len(rows), pa.int32()), "bucket": pa.array([r[0] for r in rows], pa.int32()),
        "chunk": pa.array([sender] * len(rows), pa.int32()),
        "slices": pa.array([press.compress(b"".join(r[1])) for r in rows], pa.binary()),
        "sizes": pa.array([np.array([len(s) for s in r[1]], "<u4").tobytes() for r in rows], pa.binary()),
        "places": pa.array([r[2].tobytes() for r in rows], pa.binary()),
        "hashes": pa.array([b"" if r[3] is None else C.pack(r[3]) for r in rows], pa.binary())}, schema=_SLICES)


def _send_slices(chunk: int, table: pa.Table, bits: pa.Table, min_bytes: int, gram: int, route: C.Route) -> pa.Table:
    data, offsets = binary_buffers(_ordered(table)["data"])
    anchors = Anchors(data, offsets, min_bytes, gram)
    runs = _shared(anchors, bits, route)
    out: list[tuple] = []
    for b, _, seen, _ in _by_bucket(anchors, runs, data.tobytes(), min_bytes, route):
        first = runs[list(seen.values())]
        out.append((b, list(seen), anchors.first[first].astype("<u4"), anchors.hash[first] if route.levels > 1 else None))
    return _slice_rows(chunk, route, out)


class Merged:
    """The distinct slices that senders sent to one group, and whose they are."""

    def __init__(self, shard: pa.Table, level: int, min_bytes: int):
        shard = shard.sort_by("chunk")
        self.bucket, self.chunks = shard["bucket"][0].as_py(), shard["chunk"].to_pylist()
        texts: dict[bytes, int] = {}
        places, hashes = [], []
        self.sent: list[np.ndarray] = []             # per sender its slices, by their number here
        self.first: list[np.ndarray] = []            # and whether no earlier sender has them
        unpress = zstandard.ZstdDecompressor()
        for chunk, raw, sizes, where, packed in zip(self.chunks, *(shard[c].to_pylist() for c in ("slices", "sizes", "places", "hashes"))):
            raw = unpress.decompress(raw)
            ends = np.cumsum(np.frombuffer(sizes, "<u4")).tolist()
            old = len(texts)
            number = np.array([texts.setdefault(raw[x:y], len(texts)) for x, y in zip([0, *ends], ends)], np.int64)
            # within a sender slices are distinct, so the new ones are numbered in their order
            fresh = number >= old
            at = np.frombuffer(where, "<i8") if level else (chunk << 32) + np.frombuffer(where, "<u4").astype(np.int64)
            places.append(at[fresh])
            if packed:
                hashes.append(C.unpack(packed)[fresh])
            self.sent.append(number)
            self.first.append(fresh)
        self.texts = list(texts)
        self.places = np.concatenate(places)
        self.hashes = np.concatenate(hashes) if hashes else np.empty(0, _U)
        self.lengths = np.array([len(t) for t in self.texts], np.int64)
        self.starts = self.lengths - min_bytes + 1   # window starts of each slice

    def windows(self, which: np.ndarray) -> np.ndarray:
        """Positions of the window starts of some slices in the sequence of all slices' starts."""
        n = self.starts[which]
        begin = np.cumsum(self.starts) - self.starts
        return np.repeat(begin[which] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))

    def answers(self, later: np.ndarray) -> pa.Table:
        """Bits of each sender's slices; an earlier sender's copy marks every start of a slice."""
        bits = []
        for number, fresh in zip(self.sent, self.first):
            flags = later[self.windows(number)] | np.repeat(~fresh, self.starts[number])
            bits.append(np.packbits(flags).tobytes())
        return pa.table({"chunk": pa.array(self.chunks, pa.int32()), "bucket": pa.array([self.bucket] * len(bits), pa.int32()),
                         "bits": pa.array(bits, pa.binary())}, schema=C.BITS)

    def onward(self, route: C.Route, level: int):
        """(bucket of ``level``, slices by number) in the order of their hashes."""
        order = np.argsort(self.hashes, kind="stable")
        first, edges = route.cut(self.hashes[order], level, self.bucket)
        return [(first + int(b), order[edges[b]: edges[b + 1]]) for b in np.flatnonzero(np.diff(edges))]


def mark_later(shard: pa.Table, min_bytes: int, level: int = 0) -> pa.Table:
    """One bit per window start of each slice sent to a bucket: an earlier start of the same string exists."""
    merged = Merged(shard, level, min_bytes)
    text = np.frombuffer(b"".join(merged.texts), np.uint8)
    lengths = merged.lengths
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(len(text)) + np.repeat(merged.places - firsts, lengths)
    start = np.arange(len(text)) <= np.repeat(firsts + lengths - min_bytes, lengths)
    sa = suffix_array(text)                          # in full order, on which permuted_prefixes relies
    prefix = permuted_prefixes(text, sa, min_bytes)
    group = np.cumsum(prefix[sa] < min_bytes)
    real = start[sa]
    sa, group = sa[real], group[real]
    heads = np.flatnonzero(np.diff(group, prepend=-1))
    earliest = np.repeat(np.minimum.reduceat(place[sa], heads), np.diff(np.append(heads, len(sa)))) if len(sa) else place[sa]
    later = np.zeros(len(text), bool)
    later[sa] = place[sa] > earliest
    return merged.answers(later[start])


def _cut(table: pa.Table, replies: pa.Table, min_bytes: int, gram: int, route: C.Route) -> pa.Table:
    table = _ordered(table)
    data, offsets = binary_buffers(table["data"])
    anchors = Anchors(data, offsets, min_bytes, gram)
    told = replies["step"].to_numpy()
    runs = _shared(anchors, replies.filter(told == 1), route)
    marks = replies.filter(told == 2)
    by_bucket = dict(zip(marks["bucket"].to_pylist(), marks["bits"].to_pylist()))
    raw = data.tobytes()
    gone = []
    for b, mine, seen, which in _by_bucket(anchors, runs, raw, min_bytes, route):
        n = (anchors.last[mine] - anchors.first[mine] + 1)
        lead = which == np.arange(len(mine))
        n_lead = n[lead]
        bits = np.unpackbits(np.frombuffer(by_bucket[b], np.uint8), count=int(n_lead.sum())).astype(bool)
        first = anchors.first[mine]
        starts = np.repeat(first[lead] - (np.cumsum(n_lead) - n_lead), n_lead) + np.arange(len(bits))
        gone.append(starts[bits])
        m = n[~lead]                                 # a later copy of a slice of this chunk
        gone.append(np.repeat(first[~lead] - (np.cumsum(m) - m), m) + np.arange(int(m.sum())))
    starts = np.sort(np.concatenate(gone)) if gone else np.empty(0, np.int64)
    edges = np.searchsorted(starts, offsets)
    removed, n_removed, kept = [], [], []
    for i in range(len(offsets) - 1):
        a, b = intervals(starts[edges[i]: edges[i + 1]], min_bytes)
        keep = np.concatenate([[offsets[i]], b]), np.concatenate([a, [offsets[i + 1]]])
        kept.append(b"".join(raw[x:y] for x, y in zip(*keep)))
        removed.append([{"start": int(x - offsets[i]), "end": int(y - offsets[i])} for x, y in zip(a, b)])
        n_removed.append(int((b - a).sum()))
    return pa.table({"doc_id": table["id"], "n_bytes": pa.array(np.diff(offsets), pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                     "n_spans": pa.array([len(r) for r in removed], pa.int64()), "removed": pa.array(removed, _SPANS),
                     "kept": pa.array(kept, pa.binary())}, schema=_RESULT)


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 100,
                          chunk_bytes: int = 4 << 20, buckets_per_chunk: float = 1.0, max_fan: int = 4096) -> DataFrame:
    """Remove each byte covered by a ``min_bytes``-byte string that also starts earlier.

    Earlier means a smaller id, or the same document and an earlier start.
    Returns per input row ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``removed`` (maximal byte intervals, end exclusive) and ``kept`` (the other
    bytes).  Strings are judged on the input and never cross documents.  A null
    or empty text has no bytes; rows that share an id (null ids count as one,
    behind all others) are read as parts of one document, in the order of their
    texts; other columns are not read.  Up to ``max_fan`` chunks hashes and
    slices travel once, up to its square twice.
    """
    base, n = C.chunked(docs, id_col, text_col, chunk_bytes)
    route = C.Route.over(n, buckets_per_chunk, max_fan)
    gram = 1 << (max(1, min_bytes // 3).bit_length() - 1)

    def entries(key, table):
        anchors = Anchors(*binary_buffers(_ordered(table)["data"]), min_bytes, gram)
        return C.send(key[0].as_py(), np.unique(anchors.hash), route)

    def slices(key, table, bits):
        return _send_slices(key[0].as_py(), table, bits, min_bytes, gram, route) if table.num_rows else _SLICES.empty_table()

    def up(level, key, table):
        merged = Merged(table, level, min_bytes)
        more = level + 2 < route.levels
        return _slice_rows(key[0].as_py(), route, [
            (b, [merged.texts[i] for i in which], merged.places[which], merged.hashes[which] if more else None)
            for b, which in merged.onward(route, level + 1)])

    def top(key, table):
        return mark_later(table, min_bytes, route.levels - 1)

    def down(level, key, table, told):
        merged = Merged(table, level, min_bytes)
        later = np.zeros(int(merged.starts.sum()), bool)
        which = dict(merged.onward(route, level + 1))
        for b, blob in zip(told["bucket"].to_pylist(), told["bits"].to_pylist()):
            at = merged.windows(which[b])
            later[at] = np.unpackbits(np.frombuffer(blob, np.uint8), count=len(at)).astype(bool)
        return merged.answers(later)

    def cut(key, table, replies):
        return _cut(table, replies, min_bytes, gram, route) if table.num_rows else _RESULT.empty_table()

    by_chunk = C.grouped(base, n, "chunk")
    shared = C.seen_elsewhere(by_chunk.applyInArrow(entries, C.ENTRIES_DDL), route, n, earlier_only=False)
    sent = by_chunk.cogroup(C.grouped(shared, n, "chunk")).applyInArrow(slices, _SLICES_DDL)
    later = C.there_and_back(sent, route, n, _SLICES_DDL, up, top, down)
    replies = shared.withColumn("step", F.lit(1)).unionByName(later.withColumn("step", F.lit(2)))
    return by_chunk.cogroup(C.grouped(replies, n, "chunk")).applyInArrow(cut, RESULT)
