import hashlib
import os
import random

import pytest

from custval.llm.exact_dedup import Trie, exact_groups, shared
from tests.llm.conftest import EDGE_DOCS


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()


def brute(rows, keep):
    """Sorted (id, keep id, size, sha) of (id, text) rows, and how many rows of each text are kept."""
    groups = {}
    for i, text in rows:
        groups.setdefault(lowered(text), []).append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = None if not known else min(known) if keep == "smallest" else max(known)
        out += [(i, best, len(ids), hashlib.sha256(text).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def check(df, rows, keep, **how):
    out = exact_groups(df, keep=keep, **how).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out), key=repr) == brute(rows, keep)
    kept = [r for r in out if r.kept]
    assert all(r.doc_id == r.keep_id for r in kept)
    assert sorted(r.text_sha256 for r in kept) == sorted({r.text_sha256 for r in out})       # one row of each text


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_edge_documents(edge_docs, keep):
    check(edge_docs, [r[:2] for r in EDGE_DOCS], keep)


def test_empty_table(no_docs):
    assert exact_groups(no_docs).collect() == []


def test_ties_nulls_and_prefixes(spark):
    rows = [(None, "same"), (None, "SAME"), (4, "Same"), (4, "same"), (9, "sam"), (8, "s"), (-3, "sam"), (1, None), (2, ""), (None, "alone"),
            (3, "ÄB"), (5, "Äb"), (6, "äb"), (7, "x" * 200_000), (10, "X" * 200_000), (11, "x" * 199_999 + "y"), (12, "\x00"), (13, "\x00\x00")]
    for keep in ("smallest", "largest"):
        check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows, keep)


@pytest.mark.parametrize("trie_bytes", [4_000, 20_000])
def test_spilling_by_subtree(spark, trie_bytes):
    """Tries far smaller than a partition hand subtrees on, round after round, with the same result."""
    random.seed(1)
    heads = ["", "a", "ab" * 30, "ab" * 31, "zz"]
    texts = [random.choice(heads) + "".join(random.choice("ab") for _ in range(random.randrange(12))) for _ in range(1500)] + ["hot Text"] * 700
    rows = list(enumerate(texts))
    random.shuffle(rows)
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows, "largest", partition_bytes=1 << 30, trie_bytes=trie_bytes)


def test_a_common_text_leaves_a_task_once(spark):
    rows = [(i, "the common text" if i % 3 else f"text {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    from custval.llm.exact_dedup import partial_groups
    parts = partial_groups(df, "doc_id", "text", True, 1 << 20).where("n > 1").collect()
    assert 1 <= len(parts) <= 6 and sum(r.n for r in parts) == 2000


def test_trie():
    random.seed(2)
    trie, seen = Trie(), {}
    for k in range(3000):
        text = bytes(random.choice(b"ab") for _ in range(random.randrange(9)))
        node = trie.find(text)
        node.terminal = (node.terminal or 0) + 1
        seen[text] = seen.get(text, 0) + 1
    assert dict(trie.terminals()) == seen
    cut = trie.spill()
    left = dict(trie.terminals())
    assert cut and left and dict(cut) | left == seen and not set(dict(cut)) & set(left)
    for text, _ in cut:
        assert trie.find(text).spilled
    for a, b in ((b"abcd", b"abxy"), (b"", b"a"), (b"abc", b"abc"), (b"xabc", b"abd")):
        assert shared(b"--" + a, 2, b) == len(os.path.commonprefix([a, b]))
