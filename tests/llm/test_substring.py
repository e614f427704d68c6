import hashlib
import random
import re

import numpy as np
import pytest

from custval.llm.arrays import Words
from custval.llm.chunks import Route
from custval.llm.substring_dedup import intervals, remove_repeated_windows
from custval.llm.suffix_arrays import permuted_prefixes, suffix_array
from custval.llm.suffix_dedup import remove_repeated_bytes
from tests.llm.conftest import EDGE_DOCS, PASSAGE

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 1 << 63


def brute_words(rows, window):
    """Multiset of (id, n_words, n_removed, kept) of (id, text) rows."""
    first = {}
    key = lambda i: LAST if i is None else i
    for i, text in rows:
        w = WORD.findall(text or "")
        for k in range(len(w) - window + 1):
            s = tuple(w[k:k + window])
            first[s] = min(first.get(s, LAST), key(i))
    out = []
    for i, text in rows:
        w = WORD.findall(text or "")
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < key(i):
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=repr)


def brute_bytes(rows, size):
    seen, out = set(), []
    key = lambda r: (LAST if r[0] is None else r[0], (r[1] or "").encode())
    for i, text in sorted(rows, key=key):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if b[k:k + size] in seen:
                gone[k:k + size] = b"\1" * size
            seen.add(b[k:k + size])
        spans = len(bytes(gone).replace(b"\0", b" ").split())
        out.append((i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk_bytes", [300, 1 << 20])
def test_windows_against_brute_force(edge_docs, chunk_bytes):
    out = remove_repeated_windows(edge_docs, chunk_bytes=chunk_bytes).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out), key=repr) == brute_words([r[:2] for r in EDGE_DOCS], 13)
    assert all(sum(s.end - s.start for s in r.removed) == r.n_removed for r in out)


@pytest.mark.parametrize("max_fan", [2, 3])
def test_levels_of_hash_lists_against_brute_force(edge_docs, max_fan):
    out = remove_repeated_windows(edge_docs, chunk_bytes=150, max_fan=max_fan).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out), key=repr) == brute_words([r[:2] for r in EDGE_DOCS], 13)


def repeats(n):
    """Documents with passages of others, one passage in all of them, exact copies."""
    random.seed(11)
    word = lambda: "".join(random.choice("abcdef") for _ in range(random.randrange(1, 9)))
    pool = [" ".join(word() for _ in range(random.randrange(5, 40))) for _ in range(25)]
    rows = [(k, " ".join([word(), *random.sample(pool, 2), word(), PASSAGE, word()])) for k in range(n)]
    return rows + [(n + k, rows[k % 7][1]) for k in range(20)]


@pytest.mark.parametrize("max_fan", [2, 4, 100])
def test_levels_give_the_same_as_brute_force(spark, max_fan):
    rows = repeats(60)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = remove_repeated_windows(docs, chunk_bytes=2000, max_fan=max_fan).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in words), key=repr) == brute_words(rows, 13)
    found = remove_repeated_bytes(docs, min_bytes=40, chunk_bytes=2000, max_fan=max_fan).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found), key=repr) == brute_bytes(rows, 40)


def test_routes_bound_the_rows_of_each_exchange():
    """Rows that a sender writes, senders that a group hears and groups of a level, as the chunks grow a million-fold."""
    for n in (1, 2, 102, 4096, 4097, 12_500_000):
        for per_chunk in (0.75, 1.0):
            route = Route.over(n, per_chunk, 4096)
            assert route.fan <= 4096 and route.fan ** route.levels >= n and max(route.parts) <= 4096
            for level in range(route.levels):
                spans = -(-n // route.fan ** (level + 1))
                assert spans * route.buckets(level) <= max(1, n) * 1.2 + route.fan
    assert Route.over(12_500_000, 1.0, 4096).levels == 2


def test_hashes_stay_in_the_bucket_of_their_parent():
    rng = np.random.default_rng(2)
    values = np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2))
    route = Route(5, (3, 5, 5))
    _, outer = route.cut(values, 0)
    fine = []
    for parent in range(3):
        mine = values[outer[parent]: outer[parent + 1]]
        first, edges = route.cut(mine, 1, parent)
        assert first == parent * 5
        for k in range(5):
            _, last = route.cut(mine[edges[k]: edges[k + 1]], 2, first + k)
            fine += np.diff(last).tolist()
    flat = Route(75, (75,)).cut(values, 0)[1]
    assert fine == np.diff(flat).tolist()


def test_windows_of_an_empty_table(no_docs):
    assert remove_repeated_windows(no_docs).collect() == []


def test_a_passage_stays_in_its_smallest_document(spark):
    rows = [(i, f"lead{i} {PASSAGE} tail{i}") for i in range(40)]
    out = {r.doc_id: r for r in remove_repeated_windows(spark.createDataFrame(rows, "doc_id long, text string"), chunk_bytes=500).collect()}
    assert out[0].n_removed == 0 and all(out[i].kept_text == f"lead{i} tail{i}" for i in range(1, 40))


@pytest.mark.parametrize("chunk_bytes", [600, 1 << 20])
def test_bytes_against_brute_force(edge_docs, chunk_bytes):
    out = remove_repeated_bytes(edge_docs, min_bytes=40, chunk_bytes=chunk_bytes).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out), key=repr)
    assert got == brute_bytes([r[:2] for r in EDGE_DOCS], 40)


def test_bytes_of_an_empty_table(no_docs):
    assert remove_repeated_bytes(no_docs).collect() == []


def test_bytes_overlapping_repeats(spark):
    rows = [(1, "ab" * 300), (2, "xy" + "ab" * 80 + "z"), (3, "q" * 99), (4, "q" * 99), (5, "q" * 101)]
    out = remove_repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out), key=repr) == brute_bytes(rows, 100)


@pytest.mark.parametrize("chunk_bytes", [20_000, 1 << 20])
def test_bytes_of_two_byte_scripts(spark, chunk_bytes):
    """Repeated passages longer than the names that min_bytes needs, each time in other surroundings."""
    random.seed(3)
    word = lambda n: "".join(random.choice("абвгдежзиклмн") for _ in range(n))
    rows = []
    for _ in range(60):
        base = word(84)
        rows += [(len(rows) + k, word(random.randrange(30)) + base[random.randrange(16): random.randrange(70, 85)] + word(random.randrange(30)))
                 for k in range(8)]
    out = remove_repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string"), chunk_bytes=chunk_bytes).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out), key=repr) == brute_bytes(rows, 100)


def test_suffix_arrays_against_sorting():
    rng = np.random.default_rng(5)
    for _ in range(150):
        t = rng.integers(0, int(rng.integers(1, 5)), int(rng.integers(0, 70))).astype(np.uint8)
        s = t.tobytes()
        sa = suffix_array(t)
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        if len(s) > 1:
            prefix = permuted_prefixes(t, sa, 6)
            for a, b in zip(sa, sa[1:]):
                n = 0
                while n < 6 and s[a + n:a + n + 1] == s[b + n:b + n + 1] != b"":
                    n += 1
                assert prefix[b] == n
            shallow = suffix_array(t, depth=4)
            assert [s[i:i + 4] for i in shallow] == sorted(s[i:i + 4] for i in range(len(s)))


def test_words_and_intervals():
    texts = [b"a  bc\n", b"", b"bc a", b"\t", b"bc"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    words = Words(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    raw = data.tobytes()
    assert [raw[a:b] for a, b in zip(words.starts, words.ends)] == [b"a", b"bc", b"bc", b"a", b"bc"]
    assert words.doc.tolist() == [0, 0, 2, 2, 4] and words.hash[0] == words.hash[3] and len(set(words.hash.tolist())) == 2
    a, b = intervals(np.array([0, 2, 5, 20]), 3)
    assert (a.tolist(), b.tolist()) == ([0, 20], [8, 23])
    assert hashlib.sha256(b"").hexdigest()


def test_long_words_that_a_polynomial_confuses(spark):
    """The Thue-Morse word and its complement have the same polynomial hash modulo 2**64, whatever the base."""
    bits = [bin(k).count("1") % 2 for k in range(1024)]
    a, b = ("".join("ab"[x ^ flip] for x in bits) for flip in (0, 1))
    lead = " ".join(f"w{k}" for k in range(12))
    rows = [(1, f"{lead} {a}"), (2, f"{lead} {b}"), (3, f"{lead} {a}")]
    out = remove_repeated_windows(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in out} == {1: 0, 2: 0, 3: 13}


def test_word_hashes_tell_places_and_letters_apart():
    rng = np.random.default_rng(9)
    words = {bytes(rng.choice([97, 98], int(rng.integers(1, 150))).astype(np.uint8)) for _ in range(4000)} | {b"a" * k for k in range(1, 300)}
    raw = b" ".join(sorted(words))
    found = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert len(found.hash) == len(words) == len(set(found.hash.tolist()))
    again = Words(np.frombuffer(b"  " + raw, np.uint8), np.array([0, len(raw) + 2]))
    assert (again.hash == found.hash).all()
