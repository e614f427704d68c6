"""Every opN query on tables with nulls, ties, repeated rows and extra columns, and on empty tables."""

import pytest

from custval.llm import queries as Q
from tests.llm.conftest import EDGE_DOCS

EXTRA = ["id", "key", "sha", "data", "rank", "item", "group", "task", "__piece"]
PAGES = [(1, "http://a.org/x", "<p>"), (None, None, None), (None, "b", "<p>"), (2, "", ""), (2, "", ""), (3, "x://example.org/es/1", "y" * 70_000)]
TABLES = {
    "documents": ("doc_id long, text string, lang string, source string, n_chars long",
                  [(i, t, None, s, None if t is None else len(t)) for i, t, s in EDGE_DOCS]),
    "pages": ("page_id long, url string, html string", PAGES),
    "benchmark": ("item_id long, text string", [(1, EDGE_DOCS[1][1]), (None, "one"), (2, None), (2, ""), (3, "alpha")]),
    "labels": ("doc_id long, quality int, toxic int", [(i, k % 2, 0) for k, i in enumerate([1, 2, 3, 5, 7, 8, 10, 11, 12, None, 7])] + [(4, None, None)]),
    "embeddings": ("vec_id long, embedding array<float>, label int",
                   [(k, [k / 9.0, 0.3, -0.1], k % 3) for k in range(30)] + [(None, [0.1], 1), (100, None, 1), (200, [0.1, None, 0.2], 1), (300, [0.2, 0.2, 0.2], None)]),
}
ROWS = {"documents": len(EDGE_DOCS), "pages": len(PAGES)}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    out = {}
    for kind in ("edge", "empty"):
        out[kind] = str(tmp_path_factory.mktemp(kind))
        for name, (ddl, rows) in TABLES.items():
            extra = [c for c in EXTRA if c not in ddl.split()]
            df = spark.createDataFrame([(*r, *extra) for r in (rows if kind == "edge" else [])], ddl + "".join(f", `{c}` string" for c in extra))
            df.write.parquet(f"{out[kind]}/{name}.parquet")
    return out


@pytest.mark.parametrize("key", sorted(Q.QUERIES))
def test_edge_tables(spark, folders, key):
    rows = Q.QUERIES[key](spark, folders["edge"]).collect()
    table = "pages" if key.split("_")[0] in ("op3", "op4") else "documents"
    if key.split("_")[0] not in ("op8", "op12", "op13"):           # those return what they find
        assert len(rows) == ROWS[table]
    if key == "op3_warc":
        assert sorted((r.page_id is None, r.payload_bytes) for r in rows) == [(False, 0), (False, 0), (False, 3), (False, 70_000), (True, 0), (True, 3)]
        assert {(r.page_id, r.record_type, r.refers_to) for r in rows} == {
            (1, "response", None), (None, "revisit", 1), (None, "revisit", 2), (2, "response", None), (3, "response", None)}


@pytest.mark.parametrize("key", sorted(Q.QUERIES))
def test_empty_tables(spark, folders, key):
    assert Q.QUERIES[key](spark, folders["empty"]).collect() == []
