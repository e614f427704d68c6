"""Exact duplicates: every distinct text has one owner, found in compressed radix tries.

Each task of the first pass puts its own texts into a Patricia trie, whose
terminal nodes collect the ids; so a text that a third of all rows hold leaves
a task once.  These partial groups are written once, dealt by length and content
hash, and inserted byte by byte into the trie of their partition, whose
terminals keep the owner.  A trie that outgrows its bound hands its heaviest
subtree back, and what belongs there goes through the next round, over more
partitions.  Hashes only deal texts out; equality is that of the bytes on the
way to a terminal.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custval.session import ensure_checkpoint_dir

#: bytes counted for a node besides its label
_NODE_BYTES = 400


class Node:
    __slots__ = ("label", "children", "terminal", "spilled")

    def __init__(self, label: bytes = b""):
        self.label, self.children, self.terminal, self.spilled = label, {}, None, False


def shared(text: bytes, pos: int, label: bytes) -> int:
    """Bytes that ``text`` from ``pos`` on has in common with ``label``, by halving."""
    low, high = 0, min(len(label), len(text) - pos)
    while low < high:
        middle = (low + high + 1) // 2
        if text[pos + low: pos + middle] == label[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A Patricia trie over byte strings: an edge is the longest run without a branch."""

    def __init__(self):
        self.root, self.bytes = Node(), 0

    def find(self, text: bytes) -> Node:
        """The node at which ``text`` ends, made if there is none; or the spilled node on its way."""
        node, pos = self.root, 0
        while pos < len(text) and not node.spilled:
            child = node.children.get(text[pos])
            if child is None:
                child = node.children[text[pos]] = Node(text[pos:])
                self.bytes += len(child.label) + _NODE_BYTES
                return child
            if not text.startswith(child.label, pos):
                k = shared(text, pos, child.label)
                middle = node.children[text[pos]] = Node(child.label[:k])
                child.label = child.label[k:]
                middle.children[child.label[0]] = child
                self.bytes += _NODE_BYTES
                child = middle
            node, pos = child, pos + len(child.label)
        return node

    def terminals(self, top: Node | None = None, head: bytes = b"") -> Iterator[tuple[bytes, object]]:
        """(text, terminal) of every text below ``top``, whose own text is ``head``."""
        stack = [(top or self.root, head)]
        while stack:
            node, text = stack.pop()
            if node.terminal is not None:
                yield text, node.terminal
            stack += [(c, text + c.label) for c in node.children.values()]

    def weights(self) -> dict[int, int]:
        """Bytes of the subtree of every node, by the node's id()."""
        order, out = [self.root], {}
        for node in order:
            order += node.children.values()
        for node in reversed(order):
            out[id(node)] = len(node.label) + _NODE_BYTES + sum(out[id(c)] for c in node.children.values())
        return out

    def spill(self) -> list[tuple[bytes, object]]:
        """Cut the heaviest subtree that leaves a quarter of the bytes, or a text, behind; its texts and terminals.

        Its top stays as a marker: ``find`` ends there.  Nothing is cut from a
        trie with a single text.
        """
        weight = self.weights()
        node, head = self.root, b""
        while node.children:
            child = max(node.children.values(), key=lambda c: (not c.spilled, weight[id(c)]))
            if child.spilled:
                return []
            head += child.label
            alone = len(node.children) == 1 and node.terminal is None
            if (alone or weight[id(child)] > 0.75 * self.bytes) and child.children:
                node = child
                continue
            if alone:
                return []
            out = list(self.terminals(child, head))
            self.bytes -= weight[id(child)] - len(child.label) - _NODE_BYTES
            child.children, child.terminal, child.spilled = {}, None, True
            return out
        return []


def content_hash(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def first_of(a, b, smallest: bool):
    """The better of two owners (id or None, partial); an id beats none, of equal ids the smaller partial wins."""
    def rank(x):
        return x[0] is None, 0 if x[0] is None else x[0] if smallest else -x[0], x[1]
    return min(a, b, key=rank)


_PARTIAL = pa.schema([("partial", pa.int64()), ("n_bytes", pa.int64()), ("hash", pa.int64()), ("sha", pa.string()), ("ids", pa.list_(pa.int64())),
                      ("owner_at", pa.int32()), ("owner_id", pa.int64()), ("n", pa.int64()), ("text", pa.binary())])
_PARTIAL_DDL = ("partial long, n_bytes long, hash long, sha string, ids array<long>, owner_at int, owner_id long, "
                "n long, text binary")


def partial_groups(docs: DataFrame, id_col: str, text_col: str, smallest: bool, trie_bytes: int) -> DataFrame:
    """The distinct texts of each task (or of each ``trie_bytes`` of it): ids, their owner, and the normalised text."""
    def run(batches):
        count = TaskContext.get().partitionId() << 33

        def flush(trie):
            nonlocal count
            rows = []
            size = 0
            for text, ids in trie.terminals():
                at = 0
                for k, i in enumerate(ids):           # of equal ids the first
                    if i is not None and (ids[at] is None or (i < ids[at] if smallest else i > ids[at])):
                        at = k
                rows.append((count, len(text), content_hash(text), hashlib.sha256(text).hexdigest(), ids, at, ids[at], len(ids), text))
                count += 1
                size += len(text)
                if size > 1 << 23:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PARTIAL.types)], schema=_PARTIAL)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PARTIAL.types)], schema=_PARTIAL)

        trie = Trie()
        for batch in batches:
            for i, text in zip(batch["id"].to_pylist(), batch["data"]):
                node = trie.find((text.as_py() or b"").lower())         # bytes.lower() changes A-Z only
                if node.terminal is None:
                    node.terminal = []
                node.terminal.append(i)
                trie.bytes += 40
                if trie.bytes > trie_bytes:
                    yield from flush(trie)
                    trie = Trie()
        yield from flush(trie)

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("data")).mapInArrow(run, _PARTIAL_DDL)


_OWNER = pa.schema([("n_bytes", pa.int64()), ("hash", pa.int64()), ("sha", pa.string()), ("owner_id", pa.int64()), ("partial", pa.int64()),
                    ("n", pa.int64()), ("text", pa.binary())])
_OWNER_DDL = "n_bytes long, hash long, sha string, owner_id long, partial long, n long, text binary"


def owners_of(partials: DataFrame, n_partitions: int, smallest: bool, trie_bytes: int) -> DataFrame:
    """One row per distinct text with its owner (``text`` null), and rows of spilled subtrees with their text."""
    def run(batches):
        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _OWNER.types)], schema=_OWNER)

        trie, out, size = Trie(), [], 0
        for batch in batches:
            for n_bytes, h, sha, owner, partial, n, text in zip(*(batch[c].to_pylist() for c in _OWNER.names[:-1]), batch["text"]):
                text = text.as_py()
                node = trie.find(text)
                if node.spilled:
                    out.append((n_bytes, h, sha, owner, partial, n, text))
                    size += n_bytes
                elif node.terminal is None:
                    node.terminal = (owner, partial, n, h, sha)
                else:
                    was = node.terminal
                    node.terminal = (*first_of((owner, partial), was[:2], smallest), n + was[2], h, sha)
                if trie.bytes > trie_bytes:
                    cut = trie.spill()
                    out += [(len(t), h, sha, owner, partial, n, t) for t, (owner, partial, n, h, sha) in cut]
                    size += sum(len(t) for t, _ in cut)
                if size > 1 << 23:
                    yield table(out)
                    out, size = [], 0
        if out:
            yield table(out)
        out = []
        for text, (owner, partial, n, h, sha) in trie.terminals():
            out.append((len(text), h, sha, owner, partial, n, None))
            if len(out) >= 1 << 16:
                yield table(out)
                out = []
        if out:
            yield table(out)

    return (partials.select(*_OWNER.names).repartition(n_partitions, "n_bytes", "hash").mapInArrow(run, _OWNER_DDL))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                 partition_bytes: int = 48 << 20, trie_bytes: int = 96 << 20) -> DataFrame:
    """The group of equal texts (identical once A-Z are lower-cased) of every row, and whether the row stays.

    Returns per input row ``doc_id``, ``keep_id`` (the smallest id of the
    group, or the largest), ``group_size`` (rows), ``kept`` and ``text_sha256``
    (of the normalised text's UTF-8).  Exactly one row of a group is kept: of
    rows that share the kept id and the text, one.  A null text counts as
    empty; a null id is kept only in a group without any other.  Texts of any
    length are compared whole.  An empty table gives no rows; other columns are
    not read.  ``partition_bytes`` sizes the second pass's partitions; a trie
    beyond ``trie_bytes`` spills by subtree (at least one text stays in it, so
    the rounds end).
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep: {keep}")
    spark, smallest = docs.sparkSession, keep == "smallest"
    folder = f"{ensure_checkpoint_dir(spark)}/exact-{uuid.uuid4().hex}"
    partial_groups(docs, id_col, text_col, smallest, trie_bytes // 2).write.parquet(f"{folder}/partials")
    partials = spark.read.parquet(f"{folder}/partials")
    todo, done, rounds = partials, None, 0
    while True:
        n_bytes = todo.agg(F.sum("n_bytes")).first()[0] or 0
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_bytes / partition_bytes)) << rounds
        owners_of(todo, n, smallest, trie_bytes).write.parquet(f"{folder}/owners-{rounds}")
        found = spark.read.parquet(f"{folder}/owners-{rounds}")
        ready = found.where("text is null").select("n_bytes", "sha", F.col("owner_id").alias("keep_id"), F.col("partial").alias("owner"), F.col("n").alias("group_size"))
        done = ready if done is None else done.unionByName(ready)
        todo, rounds = found.where("text is not null"), rounds + 1
        if todo.isEmpty():
            break
    # both sides are plain scans, so the skew rule may split a text that very many tasks held
    rows = partials.select("partial", "n_bytes", "sha", "ids", "owner_at").join(done, ["n_bytes", "sha"])
    return (rows.select("*", F.posexplode("ids").alias("at", "doc_id"))
            .select("doc_id", "keep_id", "group_size", ((F.col("partial") == F.col("owner")) & (F.col("at") == F.col("owner_at"))).alias("kept"),
                    F.col("sha").alias("text_sha256")))
