"""Ranked search of short items in all documents, by an automaton of the items' terms.

The distinct terms of a block of items, each between two guards, form an
Aho-Corasick automaton that is sent to every executor.  Documents are read as
they are, without an index of them: what separates terms becomes a guard, so
the automaton's outputs are whole terms, and each leads to the items that have
it.  A first scan counts documents per term, a second one scores every document
for every item and keeps the best of each task.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custval.llm.arrays import binary_buffers, blocks
from custval.llm.best import Best
from custval.session import ensure_checkpoint_dir

#: bytes of a text as the automaton reads them: A-Z lower-cased, what separates terms (all ASCII but letters and digits) is the guard NUL
GUARD = 0
_READ = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A or 0x30 <= c <= 0x39 else GUARD for c in range(256))
#: bytes scanned at once
_PIECE = 1 << 20


@dataclass
class Block:
    """Some items: their distinct terms, and by term the items that have it and how often."""

    terms: list[bytes]
    items: list                                   # item ids (or None) by place
    first: np.ndarray                             # postings of term t are first[t] .. first[t + 1]
    item: np.ndarray
    times: np.ndarray
    weight: np.ndarray | None = None
    n_docs: int = 0
    n_terms: int = 0
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    @classmethod
    def of(cls, rows) -> Block:
        """From (item_id, term, times) rows."""
        items = sorted({r[0] for r in rows}, key=lambda i: (i is None, i))
        terms = sorted({bytes(r[1]) for r in rows})
        place, number = {i: k for k, i in enumerate(items)}, {t: k for k, t in enumerate(terms)}
        t = np.array([number[bytes(r[1])] for r in rows], np.int64)
        order = np.argsort(t, kind="stable")
        return cls(terms, items, np.searchsorted(t[order], np.arange(len(terms) + 1)),
                   np.array([place[r[0]] for r in rows], np.int64)[order], np.array([r[2] for r in rows], np.int64)[order])


_AUTOMATA: dict[str, ahocorasick.Automaton] = {}


def automaton_of(block: Block) -> ahocorasick.Automaton:
    """The guarded automaton of a block's terms, built once per process; only the latest is kept."""
    if block.key not in _AUTOMATA:
        _AUTOMATA.clear()
        a = ahocorasick.Automaton()
        for k, term in enumerate(block.terms):
            a.add_word(f"\0{term.decode('latin-1')}\0", k)
        a.make_automaton()
        _AUTOMATA[block.key] = a
    return _AUTOMATA[block.key]


def outputs(automaton, text: bytes, longest: int, piece: int = _PIECE) -> Iterator[np.ndarray]:
    """Arrays of (end, term) pairs of guarded ``text``, scanned in pieces that end at guards.

    Where no guard comes within the longest term, the word is in no item and is passed over.
    """
    pos = 0
    while pos < len(text) - 1:
        stop = text.find(GUARD, pos + piece, pos + piece + longest + 2)
        end, follow = (stop + 1, stop) if stop >= 0 else (min(len(text), pos + piece), text.find(GUARD, pos + piece))
        found = np.fromiter(chain.from_iterable(automaton.iter(text[pos:end].decode("latin-1"))), np.int64).reshape(-1, 2)
        found[:, 0] += pos
        yield found
        if follow < 0:
            return
        pos = follow


def counts(block: Block, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: (text, term, occurrences) of every item term in them, and the number of all terms by text."""
    raw, cuts = data.tobytes(), offsets.tolist()
    text = b"\0".join([b"", *(raw[a:b] for a, b in zip(cuts, cuts[1:])), b""]).translate(_READ)
    at = offsets + np.arange(len(offsets))                 # text i begins behind the guard at at[i]
    solid = np.frombuffer(text, np.uint8) != GUARD
    heads = np.flatnonzero(solid[1:] & ~solid[:-1])        # the guard before each term
    n_terms = np.diff(np.searchsorted(heads, at))
    longest = max(map(len, block.terms), default=0)
    keys = [np.empty(0, np.int64)]
    for found in outputs(automaton_of(block), text, longest):
        keys.append((np.searchsorted(at, found[:, 0], "left") - 1) * len(block.terms) + found[:, 1])
    key, tf = np.unique(np.concatenate(keys), return_counts=True)
    return key // max(1, len(block.terms)), key % max(1, len(block.terms)), tf, n_terms


def scores(block: Block, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, n_terms: np.ndarray) -> np.ndarray:
    """Score of every text (rows) for every item of the block; 64-bit integers throughout."""
    m = 100 - 25 + (25 * n_terms * block.n_docs) // max(1, block.n_terms)
    part = block.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
    size = np.diff(block.first)[term]
    pair = np.repeat(np.arange(len(term)), size)
    at = block.first[term][pair] + np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
    out = np.zeros(len(n_terms) * len(block.items), np.int64)
    np.add.at(out, doc[pair] * len(block.items) + block.item[at], part[pair] * block.times[at])
    return out.reshape(len(n_terms), len(block.items))


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item_id, term binary, times) of every item."""
    def run(batches):
        for batch in batches:
            ids, terms = [], []
            for i, text in zip(batch["item_id"].to_pylist(), batch["data"].to_pylist()):
                found = [t for t in (text or b"").translate(_READ).split(b"\0") if t]
                ids += [i] * len(found)
                terms += found
            yield pa.record_batch({"item_id": pa.array(ids, pa.int64()), "term": pa.array(terms, pa.binary())})

    return (items.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(text_col).cast("binary").alias("data"))
            .mapInArrow(run, "item_id long, term binary").groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times")))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("data"))


def document_counts(docs: DataFrame, block: Block, id_col: str, text_col: str) -> Block:
    """``block`` with its terms' weights, the number of documents that have a term, and that of all terms."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        b = shared.value
        df, n_docs, n_terms = np.zeros(len(b.terms), np.int64), 0, 0
        for batch in batches:
            for _, _, data, cut in blocks(*binary_buffers(batch["data"])):
                _, term, _, n = counts(b, data, cut)
                df += np.bincount(term, minlength=len(df))
                n_docs, n_terms = n_docs + int((n > 0).sum()), n_terms + int(n.sum())
        some = np.flatnonzero(df)
        yield pa.record_batch({"term": pa.array(np.append(some, [-1, -2])), "n": pa.array(np.append(df[some], [n_docs, n_terms]))})

    # one row per term of the block, and two
    found = dict(_texts(docs, id_col, text_col).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect())
    n = block.n_docs = found.get(-1, 0)
    block.n_terms = found.get(-2, 0)
    block.weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * found.get(t, 0) + 1))) for t in range(len(block.terms))], np.int64)
    return block


def best_of_block(docs: DataFrame, block: Block, k: int, id_col: str, text_col: str) -> DataFrame:
    """(item, doc_id, score, task) of the best texts of each task."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        b = shared.value
        best = Best(k, np.ones(len(b.items), np.int64))       # scores above 0
        for batch in batches:
            null = np.asarray(batch["doc_id"].is_null())
            ids = batch["doc_id"].fill_null(0).to_numpy(zero_copy_only=False)
            for a, z, data, cut in blocks(*binary_buffers(batch["data"])):
                table = scores(b, *counts(b, data, cut))
                doc, item = np.nonzero(table >= best.least)
                best.add(item, table[doc, item], null[a:z][doc], ids[a:z][doc])
        item, score, null, ids = best.cut()
        yield pa.record_batch({"item": pa.array(item), "doc_id": pa.array(ids, mask=null.astype(bool)), "score": pa.array(score),
                               "task": pa.array(np.full(len(item), TaskContext.get().partitionId() % 64))})

    return _texts(docs, id_col, text_col).mapInArrow(run, "item long, doc_id long, score long, task long")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", block_items: int = 5_000, block_bytes: int = 8 << 20) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z
    lower-cased; an item's repeats count.  With N documents that have a term,
    L terms in all, n in the document, tf of the term and df documents that
    have it, a term adds ``w * (10**9 tf div (1000 tf + 12 m))``, where w is
    ``floor(1000 ln((2N + 2) / (2 df + 1)))`` and m is ``75 + 25 n N div L``.
    Only scores above 0 count; equal ones are ranked by ascending id, null ids
    last, and every row of a repeated id by itself.  Rows of items that share
    an id (or have none) are one item; null or empty texts have no terms, and
    an item without a hit has no rows.  Other columns are not read.

    Documents of any length are scanned whole, in pieces.  Items go in blocks
    of about ``block_items`` and ``block_bytes`` of terms, whose sizes are
    checked before they are sent; an item larger than that is a block of its own.
    """
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/lexical-{uuid.uuid4().hex}"
    item_terms(items, item_col, item_text_col).write.parquet(f"{folder}/terms")
    terms = spark.read.parquet(f"{folder}/terms")
    sizes = terms.groupBy("item_id").agg(F.sum(F.octet_length("term") + 32).alias("bytes"))
    # a stated query set in blocks: places in id order give items to blocks of bounded number and bytes
    whole = sizes.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).first()
    n_blocks = max(1, math.ceil(whole["n"] / block_items), math.ceil((whole["bytes"] or 0) / block_bytes))
    while n_blocks > 1:                                    # a block of one item may be larger
        dealt = sizes.groupBy(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)).alias("b")).agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
        if dealt.where((F.col("n") > 1) & ((F.col("bytes") > 2 * block_bytes) | (F.col("n") > 2 * block_items))).isEmpty():
            break
        n_blocks *= 2
    made = []
    for b in range(n_blocks):
        rows = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == b).select("item_id", "term", "times").collect()
        if not rows:
            continue
        block = document_counts(docs, Block.of(rows), id_col, text_col)
        best = best_of_block(docs, block, k, id_col, text_col)
        by = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        for keys in (["item", "task"], ["item"]):          # first within groups of tasks, so no item's rows meet all at once
            best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where(F.col("rank") <= k)
        named = spark.createDataFrame(list(enumerate(block.items)), "item long, item_id long")
        best = best.join(F.broadcast(named), "item")       # about block_items rows
        made.append(f"{folder}/best-{b}")
        best.select("item_id", "rank", "doc_id", "score").write.parquet(made[-1])
    schema = "item_id long, rank int, doc_id long, score long"
    return spark.read.schema(schema).parquet(*made) if made else spark.createDataFrame([], schema)
