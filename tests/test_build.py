"""The end-to-end build writes every table and the scores agree with the registered query."""

import tempfile
from dataclasses import replace

from pyspark.sql import functions as F

import __spark_entry__ as E
from custval.build import build, load_canonical
from custval.params import DEFAULT as P
from custval.sources.testdata import Inputs, load_inputs

from tests.tables import SF_SMALL


def test_build_writes_tables(spark):
    out = tempfile.mkdtemp(prefix="custval-build-")
    info = build(spark, SF_SMALL, out)
    for t in ("expected_aov", "curve", "multipliers", "scores", "live_scores", "reports"):
        assert spark.read.parquet(f"{out}/{t}").count() > 0, t
    written = spark.read.parquet(f"{out}/scores")
    assert written.count() == info["customers"] == E.queries()["pltv_scores"](spark, SF_SMALL).count()
    assert len(info["curve"]) == 8


def test_fallback_fills_missing_aov(spark):
    out = tempfile.mkdtemp(prefix="custval-build-")
    build(spark, SF_SMALL, out, fallback_aov=310.23)
    s = spark.read.parquet(f"{out}/scores")
    assert s.where(F.col("expected_aov").isNull()).count() == 0
    assert s.where(F.col("total_pltv").isNull()).count() == 0


def test_trained_build_on_canonical_tables_and_its_artifact(spark):
    """Canonical Parquet in, run date as an argument; scoring with the saved artifact repeats the trained scores."""
    src, out = tempfile.mkdtemp(prefix="custval-in-"), tempfile.mkdtemp(prefix="custval-build-")
    i = load_inputs(spark, SF_SMALL)
    for name, df in (("lines", i.lines), ("products", i.products), ("customers", i.customers)):
        df.write.parquet(f"{src}/{name}")
    inputs = load_canonical(spark, *[f"{src}/{n}" for n in ("lines", "products", "customers")])
    p = replace(P, as_of=P.as_of.replace(month=6))
    first = build(spark, inputs, f"{out}/a", p, train_model=True, max_iter=3)
    again = build(spark, inputs, f"{out}/b", p, artifact=f"{out}/a/artifact")
    assert first["curve"] == again["curve"] and again["unseen_categories"] >= 0
    a, b = (sorted(map(tuple, spark.read.parquet(f"{out}/{x}/scores").collect()), key=repr) for x in "ab")
    assert a == b and len(a) == first["customers"]
    dates = spark.read.parquet(f"{out}/a/panel").agg(F.max("order_date")).first()[0]
    assert dates <= p.maturity_cutoff


def test_orders_after_the_run_date_change_no_score(spark):
    i = load_inputs(spark, SF_SMALL)
    p = replace(P, as_of=P.as_of.replace(month=2))
    late = i.lines.where(F.col("order_date") > F.lit(p.as_of))
    assert late.count() > 0
    outs = []
    for lines in (i.lines, i.lines.where(F.col("order_date") <= F.lit(p.as_of))):
        out = tempfile.mkdtemp(prefix="custval-build-")
        build(spark, Inputs(lines, i.products, i.customers), out, p)
        outs.append(sorted(((r.customer_id, round(r.total_pltv, 6) if r.total_pltv is not None else None)
                            for r in spark.read.parquet(f"{out}/scores").collect()), key=repr))
    assert outs[0] == outs[1]
