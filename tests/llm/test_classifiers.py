import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from custval.llm.labelled import labelled_sample
from custval.llm.ngrams import char_ngrams
from custval.llm.passage_classifier import DIMS, Network, _RATIOS, encode, quality_scores
from custval.llm.quality_rules import fit, quality_rules
from tests.llm.conftest import EDGE_DOCS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    w = WORD.findall(text or "")
    windows = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    cover = {k + j for k in range(len(w) - 4) if windows[tuple(w[k:k + 5])] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(cover),
            len(w) < 10 or 100 * len(cover) > 20 * len(w))


@pytest.fixture(scope="module")
def corpus(spark):
    random.seed(1)
    good = "the of and in thing with there water where other some time look write number people over".split()

    def text(bad):
        words = [random.choice(good) + random.choice(["", "s", "ing"]) for _ in range(random.randrange(15, 200))]
        return " ".join(w.upper() + "!!" if bad else w for w in words) if random.random() < 0.9 else " ".join(w + ("$$#" if bad else "") for w in words)

    rows = [(i, text(i % 5 == 0), "x") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(0, 400, 1) if i % 3] + [(None, 1, 0), (2, None, 0), (9999, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    return docs, labels


def test_base_rules_against_brute_force(spark, edge_docs, corpus):
    odd = [(100 + i, t) for i, t in enumerate(["a b c d e " * 6, "a\na\n\n \n \nb\na ", "#|<>" * 9, "é $ x" * 20, "w\x0bw\x0cw " * 9,
                                               " ".join(map(str, range(50))) + "\n" + " ".join(map(str, range(9)))])]
    docs = edge_docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    out = quality_rules(docs, corpus[1].where("false")).collect()
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in out), key=repr)
    rows = [r[:2] for r in EDGE_DOCS] + odd
    assert got == sorted(((i, *(b := brute_base(t)), not b[-1]) for i, t in rows), key=repr)
    assert all(r.probability is None for r in out)


def test_rules_keep_good_and_drop_bad(corpus, no_docs):
    docs, labels = corpus
    out = quality_rules(docs, labels).collect()
    clean = [r for r in out if r.doc_id % 5]
    assert sum(r.kept for r in clean) >= 0.97 * sum(not r.base_failed for r in clean)
    assert sum(r.kept for r in out if r.doc_id % 5 == 0) <= 2
    assert quality_rules(no_docs, labels).collect() == []


def test_fit_is_calibrated_and_needs_both_labels():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((4000, 6)).astype(np.float32)
    p = 1 / (1 + np.exp(-(x @ np.array([2, -1, 0, 0, 0, 0]) + 1.5)))
    y = (rng.random(4000) < p).astype(int)
    fold = np.arange(4000) % 3
    model = fit(x, y, fold, rate=1.0)
    assert np.abs(model.probability(x) - p).mean() < 0.05
    assert fit(x, np.ones(4000, int), fold) is None


def test_passage_scores(corpus, edge_docs, no_docs):
    docs, labels = corpus
    out = quality_scores(docs, labels).collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert np.mean([r.predicted == int(r.doc_id % 5 != 0) for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    edge = quality_scores(edge_docs, labels).collect()
    assert len(edge) == len(EDGE_DOCS) and all(0 <= r.score <= 1 for r in edge)
    assert {r.score for r in quality_scores(edge_docs, labels.where("quality = 1")).collect()} == {0.5}
    assert quality_scores(no_docs, labels).collect() == []


def test_held_out_labels_are_never_read(corpus):
    docs, labels = corpus
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - quality, quality) as quality", "toxic")
    a, b = ({r.doc_id: r.score for r in quality_scores(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_fit_lowers_the_loss():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((12, 9)).astype(np.float32)
    bag = np.array([0, 0, 0, 1, 2, 2, 2, 2, 3, 3, 4, 4])
    y = np.array([1, 0, 1, 1, 0], np.float32)
    net = Network(9)
    before = net.scores(x, bag)
    net.fit(x, bag, y, steps=300)
    after = net.scores(x, bag)
    loss = lambda p: -np.mean(y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))
    assert loss(after) < 0.1 < loss(before)


def test_passages_cover_whole_texts():
    texts = [b"", b" \n", b"w " * 200, b"one", b"a b"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    x, bag = encode(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))
    assert bag.tolist() == [0, 1, 2, 2, 2, 2, 3, 4] and x.shape == (8, DIMS + _RATIOS) and np.isfinite(x).all()


def test_a_sampled_id_has_one_row(spark):
    """A sampled id on many rows gives one document, the same however the rows are dealt."""
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(500)] + [(2, "two"), (2, None), (3, "three"), (None, "none")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (4, 1), (None, 0)], "doc_id long, quality int")
    got = [sorted((r.doc_id, bytes(r.data), r.label) for r in labelled_sample(docs.repartition(n), labels, 10).collect()) for n in (1, 7)]
    assert [(i, label) for i, _, label in got[0]] == [(1, 0), (2, 1)] and got[0] == got[1]


def test_character_ngrams_against_plain_counts():
    """Runs of characters, not bytes, within one text; equal runs share a bucket, others hardly ever."""
    random.seed(6)
    texts = ["", "ab", "日本語日本語", "aé日🙂aé日🙂aé日", "".join(random.choice("aбя日é ") for _ in range(300)), "abcabc"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int64)
    got = char_ngrams(np.frombuffer(b"".join(raw), np.uint8), offsets, 3, 1 << 18)
    for row, t in zip(got, texts):
        assert sorted(row[row > 0]) == sorted(Counter(t[k:k + 3] for k in range(len(t) - 2)).values())
    assert (got[2] > 0).sum() == 3 and set(np.flatnonzero(got[5])) == set(np.flatnonzero(char_ngrams(np.frombuffer(b"cabca", np.uint8), np.array([0, 5]), 3, 1 << 18)[0]))


def test_gradient_and_forward_pass_against_plain_bags():
    """The batched network equals a loop over bags, and its gradients numeric ones (Adam's first step goes by their signs)."""
    rng = np.random.default_rng(2)
    net = Network(5)
    net.p = {k: rng.normal(0, 0.4, v.shape).astype(np.float64) for k, v in net.p.items()}
    bag = np.array([0, 0, 0, 1, 2, 2])
    x, y = rng.normal(0, 1, (6, 5)), np.array([1.0, 0.0, 1.0])

    def plain(p):
        out = []
        for k in range(3):
            h = np.tanh(x[bag == k] @ p["w"] + p["b"])
            e = (np.tanh(h @ p["v"]) / (1 + np.exp(-(h @ p["u"])))) @ p["a"]
            a = np.exp(e - e.max())
            out.append(1 / (1 + np.exp(-((a / a.sum()) @ h @ p["c"] + p["d"][0]))))
        return np.array(out)

    assert np.allclose(net.forward(x, bag)[0], plain(net.p), atol=1e-6)
    each = np.where(y == 1, 0.5 / 2, 0.5 / 1)

    def loss(p):
        q = plain(p)
        return -(each * (y * np.log(q) + (1 - y) * np.log(1 - q))).sum()
    before = {k: v.copy() for k, v in net.p.items()}
    net.fit(x, bag, y, steps=1, ridge=0.0, rate=1e-3)
    x = (x - net.mean) * net.scale                    # as the fit sees it
    for name, v in before.items():
        flat = v.ravel()
        for i in range(0, flat.size, max(1, flat.size // 7)):
            up, down = {k: w.copy() for k, w in before.items()}, {k: w.copy() for k, w in before.items()}
            up[name].ravel()[i] += 1e-5
            down[name].ravel()[i] -= 1e-5
            slope = (loss(up) - loss(down)) / 2e-5
            if abs(slope) > 1e-4:
                assert net.p[name].ravel()[i] - flat[i] == pytest.approx(-1e-3 * np.sign(slope), rel=0.02), (name, i)
