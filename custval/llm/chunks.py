"""Chunks of documents in doc_id order, and compact sorted hash lists between them.

A chunk holds the documents of one doc_id range, so "an earlier document has
it" is "an earlier chunk has it, or an earlier document of this chunk".  A
chunk sends each distinct hash once, cut into buckets by the hash's leading
bits; what comes back is one bit per entry.

The lists travel through as many levels as keep every exchange linear in the
input (``Route``): a group of one level merges the lists of neighbouring
senders, one bucket of them, and sends what is distinct on to the next level,
cut into finer buckets.  So a sender writes at most ``max_fan`` rows, and a
group holds one list of at most ``max_fan`` senders, also where a hash is in
every document.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_U = np.uint64
#: key of a document whose doc_id is null: behind all others
NULL_KEY = (1 << 63) - 1


def row_key(id_col: str, text_col: str) -> Column:
    """A row's id, or a hash of its text (null as empty) above 2**62 where it has none: rows without an id are told apart by text."""
    h = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return F.coalesce(F.col(id_col).cast("bigint"), h.bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62)))


def chunked(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int) -> tuple[DataFrame, int]:
    """(chunk int, key long, id, data binary) in doc_id ranges of about ``chunk_bytes``; the number of chunks.

    The range bounds (one long per chunk) come from one aggregate; equal ids
    share a chunk.  Null ids sort last, null texts are empty.
    """
    base = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_KEY)).alias("key"), F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("data"))
    total = base.agg(F.sum(F.octet_length("data")).alias("b")).head()["b"] or 0
    n = max(1, math.ceil(total / chunk_bytes))
    bounds = np.empty(0, np.int64)
    if n > 1:
        cuts = base.agg(F.percentile_approx("key", [i / n for i in range(1, n)], max(10_000, 20 * n)).alias("q")).head()["q"]
        bounds = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf(T.IntegerType())
    def chunk_of(key):
        import pandas as pd
        return pd.Series(np.searchsorted(bounds, key.to_numpy(), "left").astype(np.int32))

    chunk = chunk_of(F.col("key")) if n > 1 else F.lit(0)
    return base.select(chunk.alias("chunk"), "key", "id", "data"), len(bounds) + 1


def pack(values: np.ndarray) -> bytes:
    """Sorted distinct uint64 as differences of as many bytes as the largest needs."""
    steps = np.diff(values, prepend=_U(0))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    cut = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + np.ascontiguousarray(cut).tobytes()


def unpack(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(blob, np.uint8)
    width = int(raw[0])
    steps = np.zeros(((len(raw) - 1) // width, 8), np.uint8)
    steps[:, :width] = raw[1:].reshape(-1, width)
    return np.cumsum(steps.view("<u8").ravel(), dtype=_U)


@dataclass(frozen=True)
class Route:
    """Levels between chunks and buckets: spans of ``fan`` senders meet at each level, whose buckets part ``parts[level]``-fold."""

    fan: int
    parts: tuple[int, ...]

    @classmethod
    def over(cls, n_chunks: int, buckets_per_chunk: float, max_fan: int) -> Route:
        """The fewest levels in which ``n_chunks`` meet with at most ``max_fan`` senders a group, evenly wide."""
        levels = 1
        while max_fan ** levels < n_chunks:
            levels += 1
        fan = max(1, round(n_chunks ** (1 / levels)))
        while fan ** levels < n_chunks:
            fan += 1
        return cls(fan, (max(1, round(fan * buckets_per_chunk)), *[fan] * (levels - 1)))

    @property
    def levels(self) -> int:
        return len(self.parts)

    def buckets(self, level: int) -> int:
        """The number of buckets that the hash space has at a level."""
        return math.prod(self.parts[:level + 1])

    def cut(self, values: np.ndarray, level: int, parent: int = 0) -> tuple[int, np.ndarray]:
        """The first bucket of a level inside ``parent`` (a bucket of the level before), and where each begins in sorted ``values``."""
        first, n = parent * self.parts[level], self.buckets(level)
        cuts = np.array([(k << 64) // n for k in range(first + 1, first + self.parts[level])], _U)
        return first, np.concatenate([[0], np.searchsorted(values, cuts), [len(values)]]).astype(np.int64)


#: chunks or groups that one shuffle partition handles at most, one after the other
PER_TASK = 64


def grouped(df: DataFrame, n_groups: int, *keys: str):
    """``groupBy`` of about ``n_groups`` groups, with more shuffle partitions where the session's number would overfill them."""
    need = math.ceil(n_groups / PER_TASK)
    if need > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        df = df.repartition(need, *keys)
    return df.groupBy(*keys)


ENTRIES = pa.schema([("span", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int32()), ("hashes", pa.binary())])
ENTRIES_DDL = "span int, bucket int, chunk int, hashes binary"


def send(sender: int, values: np.ndarray, route: Route, level: int = 0, parent: int = 0) -> pa.Table:
    """The rows that carry a sender's sorted distinct hashes (of bucket ``parent``, above level 0) to a level's groups."""
    first, edges = route.cut(values, level, parent)
    full = np.flatnonzero(np.diff(edges))
    return pa.table({
        "span": pa.array([sender // route.fan] * len(full), pa.int32()), "bucket": pa.array(first + full, pa.int32()),
        "chunk": pa.array([sender] * len(full), pa.int32()),
        "hashes": pa.array([pack(values[edges[b]: edges[b + 1]]) for b in full], pa.binary())}, schema=ENTRIES)


BITS = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary())])
BITS_DDL = "chunk int, bucket int, bits binary"


def seen_bits(entries: pa.Table, earlier_only: bool, above: np.ndarray | None = None) -> pa.Table:
    """Per (sender, bucket) a bit for each entry: another sender (an earlier one, if ``earlier_only``) has it too.

    ``above`` tells the same of the group's sorted distinct hashes and the senders beyond this group.
    """
    entries = entries.sort_by("chunk")
    chunks = entries["chunk"].to_numpy()
    lists = [unpack(x) for x in entries["hashes"].to_pylist()]
    values = np.concatenate(lists)
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    same = ranked[1:] == ranked[:-1]
    hit = np.zeros(len(values), bool)
    hit[order[1:]] = same
    if not earlier_only:
        hit[order[:-1]] |= same
    if above is not None:
        hit[order] |= above[np.cumsum(np.append(True, ~same)) - 1]
    cuts = np.cumsum([len(x) for x in lists])[:-1]
    parts = np.split(hit, cuts)
    keep = [i for i, x in enumerate(parts) if x.any()]
    bucket = entries["bucket"][0].as_py()
    return pa.table({
        "chunk": pa.array(chunks[keep], pa.int32()), "bucket": pa.array([bucket] * len(keep), pa.int32()),
        "bits": pa.array([np.packbits(parts[i]).tobytes() for i in keep], pa.binary())}, schema=BITS)


def received(bits: pa.Table, values: np.ndarray, route: Route, level: int = 0, parent: int = 0) -> np.ndarray:
    """The bits that answer one sender's ``send``, laid out over its sorted distinct hashes."""
    first, edges = route.cut(values, level, parent)
    hit = np.zeros(len(values), bool)
    for bucket, blob in zip(bits["bucket"].to_pylist(), bits["bits"].to_pylist()):
        a, b = edges[bucket - first], edges[bucket - first + 1]
        hit[a:b] = np.unpackbits(np.frombuffer(blob, np.uint8), count=int(b - a)).astype(bool)
    return hit


def there_and_back(sent: DataFrame, route: Route, n_groups: int, ddl: str, up, top, down) -> DataFrame:
    """Rows (span, bucket, chunk, ...) through the levels of a route and the answers back: (chunk, bucket, bits) for level 0.

    ``up(level, key, table)`` sends a group's rows on, ``top(key, table)`` answers the last level's groups and
    ``down(level, key, table, answers)`` those of a level below, from the answers that the group got.
    """
    def sends(level):
        return lambda key, table: up(level, key, table)

    def answers_from_above(level):
        def answer(key, table, told):
            told = told.select(["part", "bits"]).rename_columns(["bucket", "bits"])
            return down(level, key, table, told) if table.num_rows else BITS.empty_table()
        return answer

    levels = [sent]
    for level in range(route.levels - 1):
        levels.append(grouped(levels[level], n_groups, "span", "bucket").applyInArrow(sends(level), ddl))
    answers = grouped(levels[-1], n_groups, "span", "bucket").applyInArrow(lambda key, table: top(key, table), BITS_DDL)
    for level in reversed(range(route.levels - 1)):
        home = F.expr(f"bucket div {route.parts[level + 1]}").cast("int")
        told = answers.select(F.col("chunk").alias("span"), home.alias("bucket"), F.col("bucket").alias("part"), "bits")
        answers = (grouped(levels[level], n_groups, "span", "bucket").cogroup(grouped(told, n_groups, "span", "bucket"))
                   .applyInArrow(answers_from_above(level), BITS_DDL))
    return answers


def seen_elsewhere(sent: DataFrame, route: Route, n_groups: int, earlier_only: bool) -> DataFrame:
    """``seen_bits`` of the hashes that all chunks have sent, over all levels."""
    def distinct(table):
        return np.unique(np.concatenate([unpack(x) for x in table["hashes"].to_pylist()]))

    def up(level, key, table):
        return send(key[0].as_py(), distinct(table), route, level + 1, key[1].as_py())

    def top(key, table):
        return seen_bits(table, earlier_only)

    def down(level, key, table, told):
        return seen_bits(table, earlier_only, received(told, distinct(table), route, level + 1, key[1].as_py()))

    return there_and_back(sent, route, n_groups, ENTRIES_DDL, up, top, down)
