import itertools
import math
import random
import re

import pytest

from custval.llm.decontaminate import SIMILARITY, STRETCH, clean, contaminated, covering_masks
from custval.llm.line_dedup import candidate_lines, lines_of, spread_of, without_boilerplate
from tests.llm.conftest import EDGE_DOCS


def brute_lines(rows, min_sites):
    plain = lambda x: " ".join(w for w in re.split(r"[ \t\n\x0b\f\r]+", x) if w)
    sites, first = {}, {}
    for i, text, site in rows:
        if i is None:
            continue
        for k, line in enumerate((text if text is not None else "").split("\n")):
            if p := plain(line):
                sites.setdefault(p, set()).add(site or "")
                first[p] = min(first.get(p, (1 << 62, 0)), (i, k))
    gone = {(i, k) for i, text, _ in rows if i is not None and text is not None for k, line in enumerate(text.split("\n"))
            if (p := plain(line)) and len(sites[p]) >= min_sites and first[p] != (i, k)}
    out = []
    for i, text, _ in rows:
        cut = {k for d, k in gone if d == i}
        out.append((i, None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in cut), len(cut)))
    return sorted(out, key=repr)


def test_boilerplate_against_brute_force(spark):
    random.seed(2)
    lines = ["Terms of use", " Terms  of use ", "Home", "rare", "", "  ", "Éa b", "x" * 300]
    rows = [(i, "\n".join(random.choice(lines) for _ in range(random.randrange(6))), f"s{random.randrange(7)}") for i in range(60)]
    rows += [(70, None, "s1"), (71, "", "s2"), (72, "Home", None), (None, "Home\nHome", "s3"), (3, "Home\nonly here", "s4")]
    df = spark.createDataFrame([(*r, "n", "l") for r in rows], "doc_id long, text string, source string, n_removed string, lines string")
    for sites in (1, 3, 6):
        out = without_boilerplate(df, min_sites=sites)
        assert sorted(((r.doc_id, r.text, r.n_removed) for r in out.collect()), key=repr) == brute_lines(rows, sites)
    assert out.columns == ["doc_id", "text", "source", "lines", "n_removed"]


def test_edge_documents_and_empty_table(edge_docs, no_docs):
    out = without_boilerplate(edge_docs, min_sites=2)
    assert sorted(((r.doc_id, r.text, r.n_removed) for r in out.collect()), key=repr) == brute_lines(EDGE_DOCS, 2)
    assert without_boilerplate(no_docs).collect() == []


def test_near_threshold_lines_are_counted_exactly(spark):
    """Sketches err by some per cent at 200 sites; the counts around the threshold must be exact."""
    rows = [(i, f"line{n}", f"site{i}") for n in range(190, 211) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = spread_of(candidate_lines(lines_of(df, "doc_id", "text", "source"), 200)[0], 200).collect()
    assert len(got) == 11 and {r.sites for r in got if r.sites <= 209} >= set(range(200, 208))


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def variant(swaps, case=str, sep=" "):
    words = ITEM.split()
    for k in swaps:
        words[k] = f"other{k}"
    return "some lead words here " + case(sep.join(words)) + " and a tail of words"


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(7, ITEM), (4, ITEM), (1, "short item of words"), (2, None), (3, ""), (None, "no id " + ITEM[:40]),
            (9, "one two three four five six seven eight nine ten eleven")]
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "item_id long, text string, hash string, mask string")


def test_substituted_passages_are_found_and_clean_texts_left(spark, benchmark):
    docs = [(1, variant([])), (2, variant([9])), (3, variant([3, 12])), (4, variant([], str.upper, ", ")), (5, variant(range(0, 20, 2))),
            (6, " ".join(reversed(ITEM.split()))), (7, ITEM[:60]), (8, None), (9, ""), (None, ITEM), (10, variant([]) + " " + variant([5])),
            (10, variant([])), (11, "so one two three four five six seven eight nine ten eleven it is"), (12, "word " * 400)]
    df = spark.createDataFrame([(*d, "a", "b") for d in docs], "doc_id long, text string, around string, item_id string")
    got = {(r.doc_id, r.item_id) for r in contaminated(df, benchmark).collect()}
    assert got == {(1, 4), (2, 4), (3, 4), (4, 4), (10, 4), (11, 9)}
    left = clean(df, benchmark)
    assert left.columns == df.columns and sorted((r.doc_id for r in left.collect()), key=repr) == [12, 5, 6, 7, 8, 9]
    assert contaminated(df.where("false"), benchmark).collect() == []
    assert contaminated(df, benchmark.where("false")).collect() == []
    assert clean(df, benchmark.where("false")).count() == len(docs)


def test_hits_against_brute_force(spark):
    """Every alignment in which a masked window agrees and 11 of 13 words do is reported, no other."""
    random.seed(4)
    vocabulary = [f"w{k}" for k in range(6)]
    items = [[random.choice(vocabulary) for _ in range(random.randrange(10, 30))] for _ in range(6)]
    docs = [[random.choice(vocabulary) for _ in range(random.randrange(0, 120))] for _ in range(25)]
    docs += [d[:20] + i[:15] + d[20:] for d, i in zip(docs, items)]
    masks = ("1110110111", "1101011011", "1011101101")
    expected = set()
    for a, d in enumerate(docs):
        for b, item in enumerate(items):
            need = -(-8 * min(13, len(item)) // 10)
            for p in range(len(d) - 9):
                for q in range(len(item) - 9):
                    if any(all(d[p + k] == item[q + k] for k, m in enumerate(mask) if m == "1") for mask in masks):
                        same = [0 <= p + k < len(d) and 0 <= q + k < len(item) and d[p + k] == item[q + k] for k in range(-3, 13)]
                        if max(sum(same[k:k + 13]) for k in range(4)) >= need:
                            expected.add((a, b))
    text = lambda rows: [(k, " ".join(r)) for k, r in enumerate(rows)]
    out = contaminated(spark.createDataFrame(text(docs), "doc_id long, text string"), spark.createDataFrame(text(items), "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in out.collect()} == expected and len(expected) >= 6


def test_every_allowed_replacement_leaves_a_seed():
    for words in range(1, STRETCH + 1):
        replaced = words - math.ceil(SIMILARITY * words)
        masks = covering_masks(words, replaced)
        assert all(m[0] == m[-1] == "1" and len(m) <= words for m in masks)
        for n in range(replaced + 1):
            for gone in itertools.combinations(range(words), n):
                assert any(all(at + k not in gone for k, m in enumerate(mask) if m == "1")
                           for mask in masks for at in range(words - len(mask) + 1)), (words, gone)
    for words, replaced in ((20, 4), (9, 3), (3, 2), (30, 2)):
        for gone in itertools.combinations(range(words), replaced):
            assert any(all(at + k not in gone for k, m in enumerate(mask) if m == "1")
                       for mask in covering_masks(words, replaced) for at in range(words - len(mask) + 1)), (words, gone)


def agreeing_pairs(docs, items):
    """(document, item) with an alignment in which 11 of 13 words agree, for short items four fifths of all."""
    out = set()
    for (a, d), (b, item) in itertools.product(enumerate(docs), enumerate(items)):
        need = math.ceil(0.8 * min(13, len(item)))
        for shift in range(-len(item), len(d)):
            same = [0 <= shift + q < len(d) and d[shift + q] == w for q, w in enumerate(item)] + [False] * 12
            if max(sum(same[q:q + 13]) for q in range(len(item))) >= need:
                out.add((a, b))
    return out


def pairs_of(spark, docs, items):
    text = lambda rows: [(k, " ".join(r)) for k, r in enumerate(rows)]
    out = contaminated(spark.createDataFrame(text(docs), "doc_id long, text string"), spark.createDataFrame(text(items), "item_id long, text string"))
    return {(r.doc_id, r.item_id) for r in out.collect()}


def test_every_pair_of_replaced_words_and_every_agreeing_stretch(spark):
    """Two replaced words anywhere in 13, 15 and 20 words, pairs of neighbours all along a passage, random texts."""
    swap = lambda words, gone: [f"other{k}" if k in gone else w for k, w in enumerate(words)]
    items = [[f"i{n}w{k}" for k in range(n)] for n in (13, 15, 20, 60)]
    docs = [["lead"] + swap(item, gone) + ["tail"] for item in items[:3] for gone in itertools.combinations(range(len(item)), 2)]
    docs += [swap(items[3], {k for k in range(60) if (k + at) % period < 2}) for period in (8, 9, 10, 11) for at in range(period)]
    random.seed(9)
    vocabulary = [f"v{k}" for k in range(6)]
    drawn = [[random.choice(vocabulary) for _ in range(random.randrange(13, 30))] for _ in range(6)]
    docs += [[random.choice(vocabulary) for _ in range(random.randrange(20))] + swap(random.choice(drawn), random.sample(range(25), random.randrange(6)))
             for _ in range(60)]
    expected = agreeing_pairs(docs, items + drawn)
    assert pairs_of(spark, docs, items + drawn) == expected
    assert all(any(a == k for a, _ in expected) for k in range(78 + 105 + 190))


def test_short_items_are_searched_whole(spark):
    """Items of one to twelve words: verbatim ones of any length, those of five or more also with one word replaced (ten or more, two)."""
    swap = lambda words, gone: [f"other{k}" if k in gone else w for k, w in enumerate(words)]
    items = [[f"i{n}w{k}" for k in range(n)] for n in range(1, 13)]
    docs = [lead + item + tail for item in items for lead in ([], ["so"]) for tail in ([], ["then"])]
    docs += [swap(item, gone) for item in items[1:] for n in (1, 2, 3) for gone in itertools.combinations(range(len(item)), n)]
    expected = agreeing_pairs(docs, items)
    assert pairs_of(spark, docs, items) == expected and {(4 * k + j, k) for k in range(12) for j in range(4)} <= expected
    assert any(a >= 48 and len(items[b]) == 5 for a, b in expected)


def test_rows_without_an_id_and_short_items(spark):
    """A row without an id is searched as well; an item of one or two words is reported but removes nothing."""
    rows = [(None, "before " + ITEM + " after"), (None, "nothing of it"), (1, ITEM), (1, "shares its id"), (2, "the cat sat"), (3, None), (None, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, ITEM), (2, "the"), (3, None)], "item_id long, text string")
    left = sorted((tuple(r) for r in clean(docs, bench).collect()), key=repr)
    assert left == sorted([(None, "nothing of it"), (2, "the cat sat"), (3, None), (None, None), (4, "")], key=repr)
    assert {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()} == {(1, 1), (2, 2)}
    assert clean(docs, bench, min_words=1).where("doc_id = 2").count() == 0
    assert clean(docs, bench.where("false")).count() == len(rows)


def test_a_line_of_very_many_documents(spark):
    """Frequent lines are dealt over several tasks and cut like any other."""
    rows = [(i, f"the common line\nown line {i}\nrare {i % 700}", f"site{i % 9}") for i in range(4200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    lines = lines_of(df, "doc_id", "text", "source")
    candidates, hot = candidate_lines(lines, 3)
    assert len(hot) == 1 and min(hot.values()) > 1
    out = without_boilerplate(df, min_sites=3)
    assert sorted(((r.doc_id, r.text, r.n_removed) for r in out.collect()), key=repr) == brute_lines(rows, 3)
