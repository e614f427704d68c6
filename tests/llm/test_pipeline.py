import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from custval.llm import queries as Q
from custval.llm.chunks import row_key
from tests.tables import SF_SMALL


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before the first stage and behind each."""
    folder = tmp_path_factory.mktemp("stages")
    out = [spark.read.parquet(f"{SF_SMALL}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SF_SMALL).write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return out


def test_columns_and_effect(stages):
    assert all(d.columns == stages[0].columns for d in stages[:-1])
    counts = [d.count() for d in stages]
    assert counts[0] > counts[1] == counts[2] >= counts[3] >= counts[4] == counts[5] > 0


def test_no_benchmark_passage_is_left(spark, stages):
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert not [1 for r in stages[4].collect() for t in items if t in r.text]


def test_labelled_clean_documents_stay(spark, stages):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    good = stages[0].join(labels.where("quality = 1"), "doc_id").count()
    assert stages[1].join(labels.where("quality = 1"), "doc_id").count() >= 0.93 * good
    assert stages[1].join(labels.where("quality = 0"), "doc_id").count() == 0


def test_run_equals_its_stages(spark, stages):
    assert sorted(corpus_pipeline.run(spark, SF_SMALL).collect()) == sorted(stages[-1].collect())


WORDS = [f"w{k}" for k in range(400)]
BODY = " ".join(WORDS[:60])
HEAVY = [
    (3, BODY, "a"), (2, BODY, "b"), (None, BODY, "c"),                                      # copies, one without an id
    (None, " ".join(WORDS[100:160]), "a"), (None, " ".join(WORDS[200:260]), "b"),           # apart, both without an id
    (5, " ".join(WORDS[300:360]) + " " + " ".join(WORDS[70:90]), "c"), (None, " ".join(WORDS[70:90]) + " z" * 3, "d"),   # a benchmark item
    (7, None, "a"), (8, "", None), (None, None, None), (None, "few words", "a"), (9, " \n\t", "b"),
    (42, " ".join(WORDS[160:200]), None), (11, "x" * 5000, "d"), (11, "x" * 5000, "d"),
]


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    """Folder with documents as above, clashing extra columns, an item and no labels; and one of empty tables."""
    out = {}
    for kind in ("edge", "empty"):
        out[kind] = folder = str(tmp_path_factory.mktemp(kind))
        rows = [(i, t, None, s, None if t is None else len(t), 1, "k", "h") for i, t, s in HEAVY] if kind == "edge" else []
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key int, `__kept` string, fp string").write.parquet(f"{folder}/documents.parquet")
        items = [(1, " ".join(WORDS[70:90])), (2, None)] if kind == "edge" else []
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return out


def test_stages_on_awkward_documents(spark, awkward):
    docs = spark.read.parquet(f"{awkward['edge']}/documents.parquet")
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, awkward["edge"])
        seen.append(sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr))
    plain = lambda rows: sorted(((i, t) for i, t, _ in rows), key=repr)
    assert seen[0] == plain(HEAVY[:7] + HEAVY[12:13]) and seen[1] == seen[0]       # under ten words: gone
    assert seen[2] == plain([HEAVY[1], *HEAVY[3:7], HEAVY[12]])                     # document 2 stands for its copies
    assert seen[3] == plain([HEAVY[1], HEAVY[3], HEAVY[4], HEAVY[12]])
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "key", "__kept", "fp"]


@pytest.mark.parametrize("kind, rows", [("edge", 4), ("empty", 0)])
def test_run_on_awkward_tables(spark, awkward, kind, rows):
    assert corpus_pipeline.run(spark, awkward[kind]).count() == rows


def test_no_text_and_no_id_is_nobody_elses_key(spark):
    """A hash of a null text is the hash's seed, 42; the key is not that of document 42."""
    rows = [(42, "a b c d"), (None, None), (None, ""), (None, "a b c d")]
    keys = [r[0] for r in spark.createDataFrame(rows, "doc_id long, text string").select(row_key("doc_id", "text")).collect()]
    assert keys[0] == 42 and keys[1] == keys[2] != keys[3] and min(keys[1:]) >= 1 << 62


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and {f"op{n}_" for n in range(1, 14)} <= {k[:k.index("_") + 1] for k in names if k.startswith("op") and k[2].isdigit()}


@pytest.mark.parametrize("key", sorted(Q.ORACLES))
def test_oracles(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    rel = con.execute(Q.ORACLES[key])
    names = [d[0] for d in rel.description]
    df = Q.QUERIES[key](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(rel.fetchall(), key=repr)
