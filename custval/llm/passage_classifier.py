"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages.  Every passage is encoded from hashed byte
n-grams and a few ratios; gated attention, learnt from document labels alone,
weighs the passages, and the weighted sum is scored.  The fit runs on a bounded
sample; scoring reads all passages of every text in Arrow batches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custval.llm.arrays import Words, binary_buffers, blocks
from custval.llm.labelled import labelled_sample
from custval.llm.ngrams import byte_ngrams, unit
from custval.operators.persist import materialize

#: words of a passage, hashed dimensions, and units of the encoder and of the attention
PASSAGE_WORDS, DIMS, HIDDEN, GATES = 64, 384, 32, 16
_RATIOS = 8
#: character classes whose share of the bytes is a feature
_SHARES = [np.isin(np.arange(256), list(chars)) for chars in (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b"!?", b".,;:", b"\n")]


def passages(data: np.ndarray, offsets: np.ndarray, words: Words, size: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(byte bounds, bag of each passage): runs of ``size`` words; a text without words is one passage."""
    counts = np.diff(words.first)
    n = np.maximum(1, -(-counts // size))
    bag = np.repeat(np.arange(len(counts)), n)
    k = np.arange(len(bag)) - np.repeat(np.cumsum(n) - n, n)
    begin = offsets[bag]
    later = k > 0
    begin[later] = words.starts[words.first[bag[later]] + k[later] * size]
    return np.append(begin, len(data)), bag


def encode(data: np.ndarray, offsets: np.ndarray, size: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(features, bag) of every passage of the texts of a block."""
    words = Words(data, offsets)
    cuts, bag = passages(data, offsets, words, size)
    length = np.maximum(1, np.diff(cuts))

    def per_passage(flag):
        total = np.concatenate([[0], np.cumsum(flag)])
        return total[cuts[1:]] - total[cuts[:-1]]

    of_word = np.searchsorted(cuts, words.starts, "right") - 1
    n_words = np.bincount(of_word, minlength=len(bag))
    order = np.lexsort((words.hash, of_word))
    new = np.ones(len(order), bool)
    new[1:] = (words.hash[order][1:] != words.hash[order][:-1]) | (of_word[order][1:] != of_word[order][:-1])
    distinct = np.bincount(of_word[order][new], minlength=len(bag))
    ratios = [per_passage(share[data]) / length for share in _SHARES]
    ratios += [1 - distinct / np.maximum(1, n_words), np.minimum(1, n_words / size)]
    return np.concatenate([unit(byte_ngrams(data, offsets, cuts, 3, DIMS)), np.stack(ratios, 1).astype(np.float32)], 1), bag


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Network:
    """tanh encoder, gated attention over a bag's passages, logistic score of the weighted sum."""

    def __init__(self, inputs: int, seed: int = 7):
        r = np.random.default_rng(seed)

        def start(a, b):
            return (r.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)

        self.p = {"w": start(inputs, HIDDEN), "b": np.zeros(HIDDEN, np.float32), "v": start(HIDDEN, GATES), "u": start(HIDDEN, GATES),
                  "a": start(GATES, 1)[:, 0], "c": start(HIDDEN, 1)[:, 0], "d": np.zeros(1, np.float32)}
        self.mean, self.scale = np.zeros(inputs, np.float32), np.ones(inputs, np.float32)

    def forward(self, x: np.ndarray, bag: np.ndarray):
        """Score of each bag (``bag`` ascending, none empty) and what the gradient needs."""
        p = self.p
        h = np.tanh(x @ p["w"] + p["b"])
        t, s = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        e = (t * s) @ p["a"]
        heads = np.flatnonzero(np.diff(bag, prepend=-1))
        k = np.cumsum(np.diff(bag, prepend=-1) > 0) - 1
        e = np.exp(e - np.maximum.reduceat(e, heads)[k])
        weight = e / np.add.reduceat(e, heads)[k]
        z = np.add.reduceat(weight[:, None] * h, heads, axis=0)
        return _sigmoid(z @ p["c"] + p["d"]), (h, t, s, weight, z, heads, k)

    def scores(self, x: np.ndarray, bag: np.ndarray) -> np.ndarray:
        return self.forward((x - self.mean) * self.scale, bag)[0]

    def fit(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray, steps: int = 160, rate: float = 0.01, ridge: float = 1e-4) -> None:
        """Adam on the log loss of all bags (classes weigh the same in sum)."""
        self.mean = x.mean(0)
        self.scale = (1 / np.maximum(x.std(0), 1e-2)).astype(np.float32)
        x = (x - self.mean) * self.scale
        each = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())).astype(np.float32)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        q = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            out, (h, t, s, weight, z, heads, k) = self.forward(x, bag)
            p = self.p
            dz_ = (each * (out - y)).astype(np.float32)
            g = {"c": z.T @ dz_, "d": dz_.sum(keepdims=True)}
            dz = dz_[:, None] * p["c"]
            dweight = (h * dz[k]).sum(1)
            de = weight * (dweight - np.add.reduceat(weight * dweight, heads)[k])
            ts = t * s
            g["a"] = ts.T @ de
            dts = de[:, None] * p["a"]
            dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
            g["v"], g["u"] = h.T @ dt, h.T @ ds
            dh = weight[:, None] * dz[k] + dt @ p["v"].T + ds @ p["u"].T
            da = dh * (1 - h * h)
            g["w"], g["b"] = x.T @ da, da.sum(0)
            for name, grad in g.items():
                grad = grad + ridge * p[name]
                m[name] = 0.9 * m[name] + 0.1 * grad
                q[name] = 0.999 * q[name] + 0.001 * grad * grad
                p[name] = (p[name] - rate * (m[name] / (1 - 0.9 ** step)) / (np.sqrt(q[name] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)


def held_out(doc_id):
    """Rows that no label may be learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          sample_rows: int = 2500, sample_passages: int = 50_000) -> Network | None:
    """Fit on at most ``sample_rows`` labelled documents outside the held-out part, with all their passages.

    Documents are taken whole, in hash order, as long as they have at most
    ``sample_passages`` passages together; one that would pass this bound is
    left out of the fit.  None without both labels.
    """
    def run(batches):
        for batch in batches:
            for a, b, data, cut in blocks(*binary_buffers(batch["data"])):
                x, bag = encode(data, cut)
                ends = np.searchsorted(bag, np.arange(b - a + 1))
                x = x.astype(np.float16)
                yield pa.record_batch({"doc_id": batch["doc_id"].slice(a, b - a), "label": batch["label"].slice(a, b - a),
                                       "n": pa.array(np.diff(ends), pa.int64()), "x": pa.array([x[i:j].tobytes() for i, j in zip(ends, ends[1:])], pa.binary())})

    sample = labelled_sample(docs, labels, sample_rows, id_col, text_col, label_col, lambda c: ~held_out(c))
    encoded = materialize(sample.mapInArrow(run, "doc_id long, label int, n long, x binary"))
    chosen, total = [], 0
    for r in encoded.select("doc_id", "n").orderBy(F.xxhash64("doc_id"), "doc_id").collect():         # sample_rows at most
        if total + r["n"] <= sample_passages:
            chosen.append((r["doc_id"],))
            total += r["n"]
    ids = F.broadcast(docs.sparkSession.createDataFrame(chosen, "doc_id long"))
    rows = encoded.join(ids, "doc_id", "left_semi").select("doc_id", "label", "x").orderBy("doc_id", "x").toArrow()
    y = rows["label"].to_numpy()
    if len(np.unique(y)) < 2:
        return None
    parts = [np.frombuffer(r, np.float16).reshape(-1, DIMS + _RATIOS) for r in rows["x"].to_pylist()]
    network = Network(DIMS + _RATIOS)
    network.fit(np.concatenate(parts).astype(np.float32), np.repeat(np.arange(len(parts)), [len(p) for p in parts]), y.astype(np.float32))
    return network


def score(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from a score of 0.5) per input row.

    A null or empty text is scored as one empty passage.  Without a network (no
    labels, or one only) every score is 0.5.  A row without an id is not held
    out; repeated rows are scored each; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        known = sent.value
        for batch in batches:
            for a, b, data, cut in blocks(*binary_buffers(batch["data"])):
                p = known.scores(*encode(data, cut)).astype(np.float64) if known is not None else np.full(b - a, 0.5)
                yield pa.record_batch({"doc_id": batch["doc_id"].slice(a, b - a), "score": pa.array(p)})

    scored = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("data")).mapInArrow(
        run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                   sample_rows: int = 2500) -> DataFrame:
    """``score`` by a network fitted on ``docs`` and ``labels``."""
    return score(docs, train(docs, labels, id_col, text_col, label_col, sample_rows), id_col, text_col)
