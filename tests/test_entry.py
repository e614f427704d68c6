import __spark_entry__ as E


def test_entry_runs_and_has_stable_schema(spark):
    df = E.entry(spark)
    cols = df.columns
    assert "customer_id" in cols and "remaining_pltv" in cols
    assert df.count() >= 0
    assert E.entry(spark).columns == cols


def test_registry_shape():
    q, s = E.queries(), E.oracle_sql()
    assert len(q) >= 60
    assert set(s) <= set(q)
