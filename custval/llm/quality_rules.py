"""Quality rules: counted base rules and a calibrated hashed n-gram classifier.

The classifier is a logistic regression over hashed word 1- and 2-gram and character
3-gram features, fitted on a bounded sample of labelled documents; Platt scaling on
the margins of folds that a fit has not seen turns them into probabilities.
All documents are scored in Arrow batches against fixed thresholds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custval.llm.arrays import Words, binary_buffers, blocks, mix64, window_hashes
from custval.llm.labelled import labelled_sample
from custval.llm.ngrams import char_ngrams, unit, word_ngrams

#: characters that count as symbols
SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
#: dimensions of the word and of the character half of the features
WORD_DIMS, CHAR_DIMS = 2048, 2048
#: texts whose features are dense at once
_ROWS = 512


@dataclass
class Thresholds:
    """Fixed limits: fewer words, or more words in repeated windows (per cent), fail; a lower probability is not kept."""
    min_words: int = 10
    repeat_window: int = 5
    max_repeat_percent: int = 20
    min_probability: float = 0.5


@dataclass
class Model:
    """Weights, and scale and shift of the calibrated margin."""
    weights: np.ndarray
    scale: float
    shift: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale * (x @ self.weights).astype(np.float64) + self.shift)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def base_counts(data: np.ndarray, offsets: np.ndarray, words: Words, window: int) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text of a block."""
    def per_text(flag):
        total = np.concatenate([[0], np.cumsum(flag)])
        return total[offsets[1:]] - total[offsets[:-1]]

    in_word = np.zeros(len(data) + 1, np.int64)
    np.add.at(in_word, words.starts, 1)
    np.add.at(in_word, words.ends, -1)
    in_word = np.cumsum(in_word[:-1])
    raw = data.tobytes()
    dup = []
    for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
        lines = [x for x in raw[a:b].split(b"\n") if x.strip()]
        dup.append(len(lines) - len(set(lines)))
    first, h = window_hashes(words, window)
    key = mix64(h + words.doc[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:]] = same
    again[order[:-1]] |= same
    cover = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(cover, first[again], 1)
    np.add.at(cover, first[again] + window, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(cover)[:-1] > 0)])
    return {"n_words": np.diff(words.first), "word_chars": per_text((in_word > 0) & (data & 0xC0 != 0x80)),
            "n_symbols": per_text(_IS_SYMBOL[data]), "n_dup_lines": np.array(dup, np.int64),
            "n_repeat_words": covered[words.first[1:]] - covered[words.first[:-1]]}


def features(data: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    """Unit-length hashed word 1- and 2-gram and character 3-gram counts, and a constant, of each text."""
    rows = len(offsets) - 1
    return np.concatenate([unit(word_ngrams(words, rows, (1, 2), WORD_DIMS)), unit(char_ngrams(data, offsets, 3, CHAR_DIMS)),
                           np.ones((rows, 1), np.float32)], 1)


def _parts(data: np.ndarray, offsets: np.ndarray):
    """Blocks of at most _ROWS texts with their words."""
    for a, b, part, cut in blocks(data, offsets):
        for r in range(0, b - a, _ROWS):
            own = cut[r: r + _ROWS + 1]
            bytes_ = part[own[0]: own[-1]]
            own = own - own[0]
            yield a + r, a + r + len(own) - 1, bytes_, own, Words(bytes_, own)


def _weights(x: np.ndarray, y: np.ndarray, use: np.ndarray, ridge: float, steps: int, rate: float) -> np.ndarray:
    """Balanced logistic regression of the rows ``use`` by accelerated gradient steps; the others weigh nothing, so no fold is copied."""
    weight = use * np.where(y == 1, 0.5 / max(1, (use & (y == 1)).sum()), 0.5 / max(1, (use & (y == 0)).sum())).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    ahead = w.copy()
    for k in range(steps):
        p = _sigmoid(x @ ahead).astype(np.float32)
        new = ahead - rate * (x.T @ (weight * (p - y)) + ridge * ahead)
        ahead = new + k / (k + 3) * (new - w)
        w = new
    return w


def fit(x: np.ndarray, y: np.ndarray, fold: np.ndarray, ridge: float = 1e-4, steps: int = 300, rate: float = 4.0) -> Model | None:
    """Weights from all rows, Platt-scaled on margins of folds that a fit has not seen; None without both labels."""
    if len(np.unique(y)) < 2:
        return None
    y = y.astype(np.float32)
    margin = np.zeros(len(y))
    for k in np.unique(fold):
        out = fold == k
        margin[out] = (x @ _weights(x, y, ~out, ridge, steps, rate))[out]
    # Platt's targets, then Newton steps on scale and shift
    pos, neg = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    design, ab = np.stack([margin, np.ones_like(margin)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(design @ ab)
        hess = design.T @ (design * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        move = np.linalg.solve(hess, design.T @ (p - target))
        ab = ab - move * min(1.0, 2.0 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-8:
            break
    return Model(_weights(x, y, np.ones(len(y), bool), ridge, steps, rate), float(ab[0]), float(ab[1]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          sample_rows: int = 3000) -> Model | None:
    """Fit and calibrate (in three folds by id hash) on at most ``sample_rows`` labelled documents."""
    def run(batches):
        for batch in batches:
            for a, b, data, cut, words in _parts(*binary_buffers(batch["data"])):
                x = features(data, cut, words).astype(np.float16)
                yield pa.record_batch({"doc_id": batch["doc_id"].slice(a, b - a), "label": batch["label"].slice(a, b - a),
                                       "x": pa.array([r.tobytes() for r in x], pa.binary())})

    sample = labelled_sample(docs, labels, sample_rows, id_col, text_col, label_col)
    rows = (sample.mapInArrow(run, "doc_id long, label int, x binary")
            .withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(3)).cast("int")).toArrow())
    if rows.num_rows == 0:
        return None
    # in the order of the ids, which are distinct; straight from the batches, as the driver should hold the sample once
    order = np.argsort(rows["doc_id"].to_numpy())
    place = np.argsort(order)
    label, fold = rows["label"].to_numpy()[order], rows["fold"].to_numpy()[order]
    x, at = np.empty((rows.num_rows, WORD_DIMS + CHAR_DIMS + 1), np.float32), 0
    for part in rows["x"].chunks:
        data, _ = binary_buffers(part)
        x[place[at: at + len(part)]] = data.view(np.float16).reshape(len(part), x.shape[1])
        at += len(part)
    del rows, data, part
    pa.default_memory_pool().release_unused()
    return fit(x, label, fold)


def judge(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", limits: Thresholds = Thresholds()) -> DataFrame:
    """Counts, ``base_failed``, ``probability`` and ``kept`` per input row, with its ``doc_id``.

    A null or empty text has no words and fails.  Without a model (no labelled
    rows, or one label only) ``probability`` is null and what passes the base
    rules is kept.  Repeated rows are judged each; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        known = sent.value
        for batch in batches:
            for a, b, data, cut, words in _parts(*binary_buffers(batch["data"])):
                n = base_counts(data, cut, words, limits.repeat_window)
                failed = (n["n_words"] < limits.min_words) | (100 * n["n_repeat_words"] > limits.max_repeat_percent * n["n_words"])
                p = known.probability(features(data, cut, words)) if known is not None else np.full(b - a, np.nan)
                yield pa.record_batch({
                    "doc_id": batch["doc_id"].slice(a, b - a), **{k: pa.array(v, pa.int64()) for k, v in n.items()},
                    "base_failed": pa.array(failed), "probability": pa.array(p, mask=np.isnan(p)),
                    "kept": pa.array(~failed & ~(p < limits.min_probability))})

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("data")).mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "base_failed boolean, probability double, kept boolean")


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                  sample_rows: int = 3000, limits: Thresholds = Thresholds()) -> DataFrame:
    """``judge`` by a model that is fitted on ``docs`` and ``labels``."""
    return judge(docs, train(docs, labels, id_col, text_col, label_col, sample_rows), id_col, text_col, limits)
