"""Hard negatives of anchors, with score bounds carried along a spanning tree of the anchors.

Anchors come in blocks, each with a minimum spanning tree of their vectors.  A
row's score at an anchor lies within edge length times the row's norm of its
score at the anchor's parent.  So a task scores its rows at the root, walks
the tree downwards, carries an interval for every row, and scores only rows
whose interval reaches the window asked for: for positives what beats the best
so far, for negatives the share of a positive's score.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custval.llm.best import Best
from custval.session import ensure_checkpoint_dir

#: components count within so much after scaling
_LARGEST = float(1 << 27)
#: rows of a task that walk the tree together
_ROWS = 2048


@dataclass
class Tree:
    """A block's anchors in an order that has parents before children (the root is its own parent)."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    parent: np.ndarray
    edge: np.ndarray                              # distance to the parent


def spanning_tree(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Tree:
    """The minimum spanning tree by distance, grown from the shortest vector, one vertex at a time."""
    n = len(ids)
    square = (vectors * vectors).sum(1)
    todo, order, parent, edge = np.ones(n, bool), np.empty(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
    near, link = np.full(n, np.inf), np.zeros(n, np.int64)             # least distance to the tree, and from which place
    at = int(np.argmin(square)) if n else 0
    for k in range(n):
        order[k], parent[k], edge[k] = at, link[at], 0.0 if k == 0 else math.sqrt(max(near[at], 0.0))
        todo[at] = False
        away = square + square[at] - 2 * (vectors @ vectors[at])
        closer = todo & (away < near)
        near[closer], link[closer] = away[closer], k
        at = int(np.argmin(np.where(todo, near, np.inf)))
    # distances are rounded up: sums of squares err by far less than this
    return Tree(ids[order], labels[order], vectors[order], parent, edge * (1 + 1e-9) + 1e-3)


def matrix(batch: pa.RecordBatch, dims: int, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(integer vectors as doubles, label, id is null, id) of a batch's rows that take part.

    Rows with a null label or vector, or a null or non-finite component, do
    not; shorter vectors end in zeros.
    """
    lists = batch["vector"]
    flat = lists.flatten()
    values = flat.fill_null(math.nan).to_numpy(zero_copy_only=False).astype(np.float64)
    size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.cumsum(size) - size
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = np.asarray(batch["label"].is_valid()) & np.asarray(lists.is_valid()) & (bad[first + size] == bad[first])
    rows = np.flatnonzero(good)
    out = np.zeros((len(rows), dims))
    place = np.repeat(np.arange(len(rows)), size[rows])
    inner = np.arange(len(place)) - np.repeat(np.cumsum(size[rows]) - size[rows], size[rows])
    out[place, inner] = np.clip(np.floor(scale * values[first[rows][place] + inner]), -_LARGEST, _LARGEST)
    ids = batch["id"]
    return (out, batch["label"].fill_null(0).to_numpy(zero_copy_only=False)[rows], np.asarray(ids.is_null())[rows],
            ids.fill_null(0).to_numpy(zero_copy_only=False)[rows])


def exact_scores(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Integer inner products; doubles hold them unless the components are very large."""
    if x.size and np.abs(x).max() * np.abs(a).max(initial=0) * len(a) >= 1 << 53:
        return x.astype(np.int64) @ a.astype(np.int64)
    return (x @ a).astype(np.int64)


def walk(tree: Tree, x: np.ndarray, wanted) -> int:
    """Walk the tree with rows ``x``; returns how many scores were taken.

    ``wanted(k, low, high)`` names the rows to score at anchor k by their
    intervals and gives a function that takes their places and scores.
    """
    norm = np.sqrt((x * x).sum(1)) * (1 + 1e-9)
    low, high = np.empty((len(tree.ids), len(x))), np.empty((len(tree.ids), len(x)))
    taken = 0
    for k, (p, e) in enumerate(zip(tree.parent.tolist(), tree.edge.tolist())):
        if k == 0:
            s = exact_scores(x, tree.vectors[0])
            low[0] = high[0] = s
            taken += len(x)
            rows, take = wanted(k, low[0], high[0])
            take(rows, s[rows])
            continue
        # besides the distance, what a double may round a score by
        reach = norm * e + 1e-9 * np.maximum(np.abs(low[p]), np.abs(high[p])) + 1
        low[k], high[k] = low[p] - reach, high[p] + reach
        rows, take = wanted(k, low[k], high[k])
        s = exact_scores(x[rows], tree.vectors[k])
        low[k][rows] = high[k][rows] = s
        taken += len(rows)
        take(rows, s)
    return taken


def _highest(score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, all of the last one's ties included."""
    return np.arange(len(score)) if len(score) <= k else np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])


def positives_of(tree: Tree, parts, k: int) -> Best:
    """For each anchor the best ``k`` other rows of its label among (vectors, label, id is null, id) ``parts``."""
    best = Best(k, np.full(len(tree.ids), np.iinfo(np.int64).min))
    for x, label, null, ids in parts:
        def wanted(a, low, high):
            rows = np.flatnonzero((label == tree.labels[a]) & (null | (ids != tree.ids[a])) & (high >= best.least[a]))

            def take(rows, score):
                top = _highest(score, k)
                best.add(np.full(len(top), a), score[top], null[rows[top]], ids[rows[top]])
            return rows, take
        walk(tree, x, wanted)
    return best


def negatives_of(tree: Tree, windows: list[list[tuple[int, int, int]]], parts, k: int) -> Best:
    """For each window (number, lowest, highest score) of each anchor the best ``k`` rows of another label within."""
    least = np.array([w[1] for own in windows for w in own], np.int64)
    best = Best(k, least)
    for x, label, null, ids in parts:
        def wanted(a, low, high):
            reach = np.zeros(len(low), bool)
            for number, _, most in windows[a]:
                if best.least[number] <= most:
                    reach |= (high >= best.least[number]) & (low <= most)
            rows = np.flatnonzero(reach & (label != tree.labels[a]))

            def take(rows, score):
                for number, _, most in windows[a]:
                    inside = np.flatnonzero((score >= best.least[number]) & (score <= most))
                    top = inside[_highest(score[inside], k)]
                    best.add(np.full(len(top), number), score[top], null[rows[top]], ids[rows[top]])
            return rows, take
        walk(tree, x, wanted)
    return best


_FOUND = "group long, id long, score long, task long"


def _found(best: Best) -> pa.RecordBatch:
    group, score, null, ids = best.cut()
    task = np.full(len(group), TaskContext.get().partitionId() % 64)
    return pa.record_batch({"group": pa.array(group), "id": pa.array(ids, mask=null.astype(bool)), "score": pa.array(score), "task": pa.array(task)})


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each group over all tasks: first within groups of tasks, so a group's rows never meet all at once."""
    by = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    for keys in (["group", "task"], ["group"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where(F.col("rank") <= k)
    return found


def hard_negatives(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   positives: int = 5, negatives: int = 10, low_percent: int = 30, high_percent: int = 90, scale: float = 256.0,
                   block_anchors: int = 2048) -> DataFrame:
    """For each anchor and each of its positives, the rows of another label whose score is a given share of the positive's.

    Components become ``floor(scale * x)`` (within 2**27 either way); a score
    is the integer inner product with the anchor's vector, higher ones come
    first, ties by smaller id, null ids last.  Anchors are the rows that fulfil
    the condition ``anchor``; an anchor's positives are its best ``positives``
    rows of its label with another id.  Returned are, for each, the best
    ``negatives`` rows of another label with ``low_percent * positive_score <=
    100 * negative_score <= high_percent * positive_score``: ``anchor_id``,
    ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``,
    ``negative_score``.

    Rows with a null label or vector or a null or non-finite component take no
    part.  Rows without an id are candidates but no anchors; repeated rows are candidates
    each, and of rows that share an anchor's id the one of smallest label and
    vector is the anchor.  Vectors shorter than the longest end in zeros.  An
    anchor without positives, or a positive without negatives, has no rows.
    Other columns are not read.  Anchors are a query set against all rows, in
    blocks of about ``block_anchors`` (checked before a block is collected).
    """
    spark = vectors.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/negatives-{uuid.uuid4().hex}"
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    columns = (F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = vectors.select(*columns)
    asked = (vectors.where(anchor).select(*columns).where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
             .where(~F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
             .groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.*"))
    asked.write.parquet(f"{folder}/anchors")
    anchors = spark.read.parquet(f"{folder}/anchors")
    dims = rows.agg(F.max(F.size("vector"))).first()[0]
    n_blocks = max(1, math.ceil(anchors.count() / block_anchors))
    place = lambda: F.pmod(F.xxhash64("id"), F.lit(n_blocks))
    while n_blocks > 1 and not anchors.groupBy(place()).count().where(F.col("count") > 2 * block_anchors).isEmpty():
        n_blocks *= 2
    made = []
    for b in range(n_blocks):
        block = anchors.where(place() == b).toArrow().combine_chunks().to_batches()
        if not block or not block[0].num_rows:
            continue
        x, label, _, ids = matrix(block[0], dims, scale)
        tree = spanning_tree(ids, label, x)
        shared = spark.sparkContext.broadcast(tree)

        def parts(batches):
            for batch in batches:
                for k in range(0, batch.num_rows, _ROWS):
                    yield matrix(batch.slice(k, _ROWS), dims, scale)

        def best_positives(batches, shared=shared):
            yield _found(positives_of(shared.value, parts(batches), positives))

        # so many rows per anchor of the block
        chosen = _ranked(rows.mapInArrow(best_positives, _FOUND), positives).orderBy("group", "rank").collect()
        windows, known = [[] for _ in tree.ids], []
        for r in chosen:
            low, high = -(-low_percent * r["score"] // 100), high_percent * r["score"] // 100
            windows[r["group"]].append((len(known), low, high))
            known.append((len(known), int(tree.ids[r["group"]]), r["id"], r["score"]))
        if not known:
            continue
        shared_windows = spark.sparkContext.broadcast(windows)

        def best_negatives(batches, shared=shared, shared_windows=shared_windows):
            yield _found(negatives_of(shared.value, shared_windows.value, parts(batches), negatives))

        of = spark.createDataFrame(known, "group long, anchor_id long, positive_id long, positive_score long")
        out = (_ranked(rows.mapInArrow(best_negatives, _FOUND), negatives).join(F.broadcast(of), "group")
               .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
        made.append(f"{folder}/found-{b}")
        out.write.parquet(made[-1])
    return spark.read.schema(schema).parquet(*made) if made else spark.createDataFrame([], schema)
