"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

Node pairs of the trie are walked together from the root; a pair whose
prefixes already differ in more than the allowed bits is pruned.  The upper
levels are Spark joins of node tables (prefix, count), four bits at a time;
once both nodes of a pair hold few fingerprints, one task walks the rest of the
pair bit by bit.  Equal fingerprints are one row from the start, so a group of
exact copies costs as much as one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custval.llm.chunks import NULL_KEY, row_key
from custval.llm.components import components
from custval.operators.persist import materialize

_U = np.uint64
_STEP = 4
#: word pairs compared at once, and from which size of a node pair on its members are compared directly
_AT_ONCE, _DIRECT = 1 << 20, 256


def _hashes(text: bytes, shingle: int, seed: int) -> list[int]:
    words = text.lower().split()             # on bytes: A-Z only, white space \x20 \x09-\x0D
    if not words:
        return []
    line = b" ".join(words)
    xxh = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return [xxh(line, seed)]
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words])[:len(words) - shingle + 1].tolist()
    return [xxh(line[a:b], seed) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())]


def simhash(texts: list[bytes | None], shingle: int = 3, seed: int = 42) -> np.ndarray:
    """uint64 fingerprints: a bit is set if more than half of the shingles' hashes have it."""
    out = np.zeros(len(texts), _U)
    for i, text in enumerate(texts):
        h = np.array(_hashes(text or b"", shingle, seed), _U)
        if len(h):
            ones = np.zeros(64, np.int64)
            for a in range(0, len(h), 1 << 14):
                ones += np.unpackbits(h[a: a + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
            out[i] = np.packbits(2 * ones > len(h)).view(">u8")[0]
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(key long, fp long) per row; a null id becomes the key behind all others, a null text has fingerprint zero."""
    def of(batches):
        for batch in batches:
            fps = simhash(batch["data"].to_pylist(), shingle, seed)
            yield pa.record_batch({"key": batch["key"], "fp": pa.array(fps.view(np.int64))})

    return docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_KEY)).alias("key"),
                       F.col(text_col).cast("binary").alias("data")).mapInArrow(of, "key long, fp long")


def trie_pairs(a: np.ndarray, b: np.ndarray | None, depth: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted uint64 ``a`` and ``b`` (None: of ``a`` with itself) within ``budget`` bits.

    Walks the two tries together below ``depth`` common levels of prefix; the
    error so far is measured on the prefixes.
    """
    own = b is None
    b = a if own else b
    err = int(np.bitwise_count((a[0] ^ b[0]) >> _U(64 - depth))) if depth and not own else 0
    # alo, ahi, blo, bhi, error, both sides the same node
    todo = [(np.array([[0, len(a), 0, len(b), err, int(own)]], np.int64), depth)]
    while todo:
        pairs, at = todo.pop()
        na, nb = pairs[:, 1] - pairs[:, 0], pairs[:, 3] - pairs[:, 2]
        small = (na * nb <= _DIRECT) | (at == 64)
        for part in _split(pairs[small]):
            ra, rb = part[:, 1] - part[:, 0], part[:, 3] - part[:, 2]
            size = ra * rb
            k = np.repeat(np.arange(len(part)), size)
            j = np.arange(len(k)) - np.repeat(np.cumsum(size) - size, size)
            i = part[k, 0] + j // rb[k]
            j = part[k, 2] + j % rb[k]
            near = (np.bitwise_count(a[i] ^ b[j]) <= budget) & ((part[k, 5] == 0) | (i < j))
            if near.any():
                yield i[near], j[near]
        rest = pairs[~small]
        if not len(rest):
            continue
        bit = _U(63 - at)

        def middle(x, lo, hi):
            # the first member of lo..hi whose next bit is set; members share the bits above
            return np.clip(np.searchsorted(x, (x[lo] >> bit | _U(1)) << bit), lo, hi)

        am, bm = middle(a, rest[:, 0], rest[:, 1]), middle(b, rest[:, 2], rest[:, 3])
        alo, ahi, blo, bhi, e, self_ = rest.T
        sides = [np.stack([alo, am, blo, bm, e, self_], 1), np.stack([am, ahi, bm, bhi, e, self_], 1),
                 np.stack([alo, am, bm, bhi, e + 1, 0 * e], 1), np.stack([am, ahi, blo, bm, e + 1, 0 * e], 1)[self_ == 0]]
        nxt = np.concatenate(sides)
        nxt = nxt[(nxt[:, 0] < nxt[:, 1]) & (nxt[:, 2] < nxt[:, 3]) & (nxt[:, 4] <= budget)]
        todo += [(part, at + 1) for part in np.array_split(nxt, max(1, -(-len(nxt) // (1 << 16)))) if len(part)]


def _split(pairs: np.ndarray) -> Iterator[np.ndarray]:
    """Runs of small node pairs with about ``_AT_ONCE`` member pairs."""
    if len(pairs):
        size = np.cumsum((pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2]))
        cuts = np.flatnonzero(np.diff(size // _AT_ONCE)) + 1
        yield from np.split(pairs, cuts)


def _forest(a: np.ndarray, b: np.ndarray | None, depth: int, budget: int) -> list[tuple[int, int]]:
    """Links between the fingerprints of a node pair, reduced to a spanning forest."""
    a = np.sort(a.view(_U))
    b = np.sort(b.view(_U)) if b is not None else None
    other = a if b is None else b
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = x = parent.get(p, p)
        return x

    links = []
    for i, j in trie_pairs(a, b, depth, budget):
        for u, v in zip(a[i].view(np.int64).tolist(), other[j].view(np.int64).tolist()):
            x, y = root(u), root(v)
            if x != y:
                parent[x] = y
                links.append((u, v))
    return links


def _links(pairs: DataFrame, nodes: DataFrame, depth: int, budget: int) -> DataFrame:
    """Links within node pairs (a, b), each node with its members packed into one row."""
    def walk(batches):
        for batch in batches:
            for a, b, ma, mb in zip(*(batch[c] for c in ("a", "b", "ma", "mb"))):
                own = a.as_py() == b.as_py()
                found = _forest(ma.values.to_numpy(), None if own else mb.values.to_numpy(), depth, budget)
                if found:
                    u, v = zip(*found)
                    yield pa.record_batch({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    left = nodes.select(F.col("node").alias("a"), F.col("members").alias("ma"))
    right = nodes.select(F.col("node").alias("b"), F.col("members").alias("mb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ma", "mb").mapInArrow(walk, "u long, v long")


def near_links(fps: DataFrame, budget: int = 2, node_size: int = 2048) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints (fp long) within ``budget`` bits: a spanning forest per node pair."""
    links, members = [], fps
    open_pairs = fps.sparkSession.createDataFrame([(0, 0)], "a long, b long")
    for depth in range(_STEP, 65, _STEP):
        node = F.shiftrightunsigned("fp", 64 - depth)
        parent = F.shiftrightunsigned("node", _STEP) if depth > _STEP else F.lit(0).cast("bigint")
        nodes = materialize(members.groupBy(node.alias("node")).agg(F.count("*").alias("n")).withColumn("parent", parent))
        left = nodes.select(F.col("parent").alias("a"), F.col("node").alias("ca"), F.col("n").alias("na"))
        right = nodes.select(F.col("parent").alias("b"), F.col("node").alias("cb"), F.col("n").alias("nb"))
        pairs = materialize(
            open_pairs.join(left, "a").join(right, "b")
            .where((F.bit_count(F.col("ca").bitwiseXOR(F.col("cb"))) <= budget)
                   & ((F.col("a") != F.col("b")) | (F.col("ca") <= F.col("cb")))
                   & ((F.col("ca") != F.col("cb")) | (F.col("na") > 1)))
            .select(F.col("ca").alias("a"), F.col("cb").alias("b"),
                    ((F.col("na") <= node_size) & (F.col("nb") <= node_size)).alias("closed")))
        small = nodes.where(F.col("n") <= node_size).select("node")
        packed = (members.withColumn("node", node).join(small, "node")
                  .groupBy("node").agg(F.collect_list("fp").alias("members")))
        links.append(_links(pairs.where("closed").select("a", "b"), packed, depth, budget))
        open_pairs = pairs.where("not closed").select("a", "b")
        if open_pairs.isEmpty():
            break
        busy = open_pairs.select(F.col("a").alias("node")).union(open_pairs.select("b")).distinct()
        members = materialize(members.withColumn("node", node).join(busy, "node", "left_semi").select("fp"))
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, budget: int = 2,
                    seed: int = 42, node_size: int = 2048) -> DataFrame:
    """Group rows whose SimHash fingerprints are linked by chains of ``budget`` bits or fewer.

    Returns per input row ``doc_id``, ``fingerprint`` (16 lowercase hex digits)
    and ``component_id`` (the smallest id of its group).  Texts without a word
    have fingerprint zero and are linked like any other; rows that share an id
    are compared as separate texts; a null id is kept, counts as larger than
    any other, and as ``component_id`` stands for a group without ids; other
    columns are not read.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, shingle, seed))
    classes = materialize(rows.groupBy("fp").agg(F.min("key").alias("key")))
    roots = components(near_links(classes.select("fp"), budget, node_size))
    of_class = classes.join(roots, classes.fp == roots.u, "left").select("fp", "key", F.coalesce("root", "fp").alias("root"))
    least = of_class.groupBy("root").agg(F.min("key").alias("component"))
    named = of_class.join(least, "root").select("fp", "component")

    def real(c):
        return F.nullif(F.col(c), F.lit(NULL_KEY))

    return rows.join(named, "fp").select(
        real("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), real("component").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, budget: int = 2) -> DataFrame:
    """Rows of ``docs`` whose id is the smallest of their group, all columns.

    Rows that share an id stay or go together, and so do rows of equal text
    without an id, which count as larger than any row with one.
    """
    key = row_key(id_col, text_col)
    groups = near_duplicates(docs.select(key.alias("key"), F.col(text_col).alias("text")), "key", "text", shingle, budget)
    keep = groups.where("doc_id = component_id").select(F.col("doc_id").alias("__keep")).distinct()
    return docs.join(keep, key == keep["__keep"], "left_semi")
