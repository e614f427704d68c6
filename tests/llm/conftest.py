import pytest

#: documents with every awkward case: nulls, empty and blank texts, repeated rows, ties, odd bytes
PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
EDGE_DOCS = [
    (5, PASSAGE + " five", "s1"), (1, "start " + PASSAGE, "s2"), (9, None, "s3"), (2, "", "s4"), (3, " \t\n ", "s5"), (4, "one", None),
    (7, PASSAGE + " " + PASSAGE, "s6"), (7, PASSAGE, "s7"), (None, PASSAGE + " no id", "s8"), (8, "é日本🙂 " * 40, "s9"),
    (8, "é日本🙂 " * 40, "s9"), (10, "x" * 400, "s10"), (11, PASSAGE.upper(), "s11"), (12, "a\x00b " * 30, "s12"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """EDGE_DOCS with extra columns whose names the operators use inside."""
    names = "id key data chunk node removed kept fp host line_no n_removed around label __keep"
    rows = [(*r, *[str(i)] * len(names.split())) for i, r in enumerate(EDGE_DOCS)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names.split()))


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")
