import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from custval.llm import hard_negatives as H

NAN, INF = math.nan, math.inf
DDL = "vec_id long, embedding array<float>, label int, id string, rank string, score string, vector string, `group` string, task string"


def frame(spark, rows):
    """Rows of (id, vector, label) with extra columns whose names are used inside."""
    return spark.createDataFrame([(*r, *"abcdef") for r in rows], DDL).repartition(3)


def brute(rows, n_pos=5, n_neg=10, step=100):
    def key(r):
        return r[0] is None, 0 if r[0] is None else r[0]
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v], c) for i, v, c in rows
            if c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a in sorted({r[0] for r in good if r[0] is not None and r[0] % step == 0}):
        _, mine, label = min((r for r in good if r[0] == a), key=lambda r: (r[2], r[1]))
        scored = sorted(((sum(x * y for x, y in zip(mine, v)), r0, c) for r0, v, c in good), key=lambda s: (-s[0], key((s[1],))))
        for ps, p, _ in [s for s in scored if s[2] == label and s[1] != a][:n_pos]:
            hits = [s for s in scored if s[2] != label and 30 * ps <= 100 * s[0] <= 90 * ps][:n_neg]
            out += [(a, p, k, n, ps, ns) for k, (ns, n, _) in enumerate(hits, 1)]
    return sorted(out, key=repr)


def check(spark, rows, **how):
    out = H.hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0, **how)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == brute(rows)
    return got


def clustered(n, dims, seed):
    """Rows around a few centres, some of them equal; labels cut across the centres."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (6, dims))
    return [(i, [float(x) for x in centres[i % 6] + (0 if i % 5 == 0 else rng.normal(0, 0.05, dims))], int(rng.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("how", [{}, {"block_anchors": 4}])
def test_against_brute_force(spark, how, monkeypatch):
    monkeypatch.setattr(H, "_ROWS", 100)
    assert len(check(spark, clustered(1500, 8, 1), **how)) > 200


def test_awkward_rows(spark):
    rows = clustered(300, 3, 2)
    rows += [(None, [0.1, 0.2, 0.3], 1), (None, [0.1, 0.2, 0.3], 2), (301, None, 1), (302, [0.1, None, 0.2], 1), (303, [0.1, NAN, 0.2], 1),
             (304, [0.1, INF, 0.2], 1), (305, [0.5, 0.5, 0.5], None), (306, [], 1), (307, [0.3], 0), (308, [0.3, 0.1], 2), (400, None, 1),
             (500, [0.0, 0.0, 0.0], 1), (100, [0.2, 0.2, 0.2], 0), (100, [0.2, 0.2, 0.1], 2), (7, [0.1, 0.1, 0.1], 1), (7, [0.1, 0.1, 0.1], 1), (-100, [0.4, 0.1, -0.3], 9)]
    assert check(spark, rows)


def test_a_common_vector(spark):
    rows = [(i, [0.3, 0.2] if i % 3 else [0.1 + i / 900, 0.2], i % 2) for i in range(600)]
    assert check(spark, rows)


def test_empty_and_no_anchor(spark):
    assert H.hard_negatives(frame(spark, []), F.col("vec_id") % 100 == 0).collect() == []
    assert H.hard_negatives(frame(spark, [(1, [0.1], 1)]), F.col("vec_id") % 100 == 0).collect() == []
    assert H.hard_negatives(frame(spark, [(0, [0.1], 1), (2, [0.1], 2)]), F.col("vec_id") % 100 == 0).collect() == []


def test_spanning_tree_is_minimal_and_bounds_hold():
    rng = np.random.default_rng(7)
    v = np.floor(rng.normal(0, 200, (40, 6)))
    tree = H.spanning_tree(np.arange(40), np.zeros(40, np.int64), v)
    away = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
    edges, root = sorted((away[i, j], i, j) for i in range(40) for j in range(i)), list(range(40))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    total = 0.0
    for d, i, j in edges:
        if top(i) != top(j):
            root[top(i)] = top(j)
            total += d
    assert tree.edge[1:].sum() == pytest.approx(total, abs=0.1) and (tree.parent[1:] < np.arange(1, 40)).all()
    x = np.floor(rng.normal(0, 200, (50, 6)))

    def none_but_check(k, low, high):
        s = x @ tree.vectors[k]
        assert (low <= s).all() and (s <= high).all()
        return np.flatnonzero(rng.random(50) < 0.2), lambda rows, score: None
    assert H.walk(tree, x, none_but_check) < 40 * 50


def test_bounds_spare_scores():
    """Rows far from the window's scores are never scored where anchors lie close together."""
    rng = np.random.default_rng(8)
    anchors = np.floor(1000 + rng.normal(0, 2, (30, 4)))
    rows = np.floor(np.concatenate([rng.normal(0, 30, (900, 4)), rng.normal(1000, 30, (100, 4))]))
    tree = H.spanning_tree(np.arange(30), np.zeros(30, np.int64), anchors)
    count = H.walk(tree, rows, lambda k, low, high: (np.flatnonzero(high >= 3_000_000), lambda r, s: None))
    assert count < 1000 + 30 * 150
