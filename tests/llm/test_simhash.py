import re

import numpy as np
import xxhash

from custval.llm.components import components
from custval.llm.simhash import near_duplicates, near_links, one_of_each, simhash, trie_pairs
from tests.llm.conftest import EDGE_DOCS

LAST = (1 << 63) - 1


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps, budget=2):
    parent = list(range(len(fps)))

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= budget:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(fps))]


def test_groups_against_brute_force(edge_docs):
    rows = [r[:2] for r in EDGE_DOCS]
    fps = [brute_fingerprint(t) for _, t in rows]
    roots = brute_groups(fps)
    least = {}
    for (i, _), r in zip(rows, roots):
        least[r] = min(least.get(r, LAST), LAST if i is None else i)
    expected = sorted(((i, f"{f:016x}", None if least[r] == LAST else least[r]) for (i, _), f, r in zip(rows, fps, roots)), key=repr)
    assert sorted((tuple(r) for r in near_duplicates(edge_docs).collect()), key=repr) == expected
    kept = {r.doc_id for r in one_of_each(edge_docs).collect()}
    assert kept == {i for i, _, c in expected if i == c}


def test_no_documents(no_docs):
    assert near_duplicates(no_docs).collect() == [] and one_of_each(no_docs).collect() == []


def test_trie_finds_all_pairs_within_the_budget():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    a = np.unique(np.concatenate([base, base ^ np.uint64(1 << 7), base ^ np.uint64(1 << 63 | 4), rng.integers(0, 1 << 12, 900).astype(np.uint64)]))
    got = set()
    for i, j in trie_pairs(a, None, 0, 2):
        got |= set(zip(i.tolist(), j.tolist()))
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= 2
    assert got == {(int(i), int(j)) for i, j in zip(*np.nonzero(near)) if i < j}


def test_links_across_many_nodes(spark):
    """Small nodes force the Spark levels of the walk; chains must stay connected."""
    rng = np.random.default_rng(1)
    base = rng.integers(-(1 << 62), 1 << 62, 40)
    fps = np.unique(np.concatenate([base, base ^ 1, base ^ (1 << 61), base ^ 3 ^ (1 << 40), np.arange(64)]))
    df = spark.createDataFrame([(int(f),) for f in fps], "fp long")
    links = near_links(df, 2, node_size=4).collect()
    assert all((r.u ^ r.v & ((1 << 64) - 1)) != 0 and ((r.u ^ r.v) & ((1 << 64) - 1)).bit_count() <= 2 for r in links)
    roots = {r.u: r.root for r in components(spark.createDataFrame([(r.u, r.v) for r in links], "u long, v long")).collect()}
    groups = brute_groups([int(f) & ((1 << 64) - 1) for f in fps])
    ours = [roots.get(int(f), int(f)) for f in fps]
    assert len(set(zip(groups, ours))) == len(set(groups)) == len(set(ours))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7 + 200), (300, 301), (300, 301)]
    got = {r.u: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 31)}, 207: 0, **{100 + k: 100 for k in range(1, 50)}, 301: 300}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_fingerprint_of_ties_and_nothing():
    assert simhash([None, b"", b" \n"]).tolist() == [0, 0, 0]
    assert simhash([b"One two"])[0] == xxhash.xxh64_intdigest(b"one two", 42)
