import math
import random
import re

import numpy as np
import pytest

from custval.llm import lexical_search as S
from custval.llm.best import Best
from tests.llm.conftest import EDGE_DOCS, PASSAGE

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    bags = [(i, terms(t)) for i, t in docs]
    n_docs, n_all = sum(bool(b) for _, b in bags), sum(len(b) for _, b in bags)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, []).extend(terms(t))
    out = []
    for item, bag in wanted.items():
        found = []
        for doc, words in bags:
            m = 75 + 25 * len(words) * n_docs // max(1, n_all)
            score = 0
            for t in bag:
                df = sum(t in b for _, b in bags)
                tf = words.count(t)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 12 * m)) if tf else 0
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "alpha beta BETA"), (2, "no such thing as: omega"), (3, None), (4, ""), (5, "one"), (6, PASSAGE), (6, "é日本🙂, é日本🙂"),
         (None, "tail b a"), (7, "a"), (8, "?!"), (9, "x" * 400)]


def check(spark, docs, items, k=20, **how):
    d = docs if not isinstance(docs, list) else spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = docs if isinstance(docs, list) else [r[:2] for r in EDGE_DOCS]
    out = S.ranked_search(d, spark.createDataFrame(items, "item_id long, text string"), k, **how)
    assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.schema["rank"].dataType.simpleString() == "int"
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(rows, items, k)


def test_edge_documents(spark, edge_docs):
    check(spark, edge_docs, ITEMS)


@pytest.mark.parametrize("how", [{}, {"block_items": 2}, {"block_bytes": 100}])
def test_against_brute_force(spark, how):
    random.seed(4)
    words = [f"w{k}" for k in range(25)] + ["É", "日本", "Ab", "aB", "9"]
    docs = [(random.randrange(60), random.choice([" ", "-", "\x00", "\n ."]).join(random.choices(words, k=random.randrange(30)))) for _ in range(150)]
    docs += [(None, "w1 w2"), (None, "w1 w2"), (70, "w1 w2"), (71, "w1 w2")]
    items = [(i, " ".join(random.choices(words, k=random.randrange(1, 9)))) for i in range(7)]
    check(spark, docs, items, 5, **how)


def test_empty_tables(spark, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert S.ranked_search(no_docs, items).collect() == []
    assert S.ranked_search(no_docs, items.where("false")).collect() == []
    check(spark, [(1, "alpha")], [(3, None)])


def test_pieces_end_at_guards():
    """Texts longer than a piece, with words longer than any item's, lose no term and gain none."""
    random.seed(5)
    block = S.Block.of([(1, b"ab", 1), (1, b"b", 2), (2, b"ab", 1), (2, b"c", 1)])
    text = "".join(random.choice(["ab", "b", "abab" * 20, "c", "cb"]) + random.choice(" ,") for _ in range(3000))
    guarded = (b"\0" + text.encode() + b"\0").translate(S._READ)
    for piece in (1, 7, 64, 1 << 20):
        found = np.concatenate(list(S.outputs(S.automaton_of(block), guarded, 2, piece)))
        want = {t: terms(text).count(t.decode()) for t in block.terms}
        assert {t: int((found[:, 1] == k).sum()) for k, t in enumerate(block.terms)} == want
        assert len(set(found[:, 0].tolist())) == len(found)


def test_best_keeps_ties_by_id():
    rng = np.random.default_rng(3)
    best, rows = Best(4, np.ones(3)), []
    for _ in range(300):
        group, score, ids, null = rng.integers(0, 3, 500), rng.integers(1, 40, 500), rng.integers(-50, 50, 500), rng.random(500) < 0.1
        some = score >= best.least[group]
        best.add(group[some], score[some], null[some], ids[some])
        rows += list(zip(group.tolist(), (-score).tolist(), null.tolist(), ids.tolist()))
    want = [r for i in range(3) for r in sorted(x for x in rows if x[0] == i)[:4]]
    assert [(int(i), -int(s), bool(n), int(d)) for i, s, n, d in best.cut().T] == want
