"""Distributed ranking operators against direct computations."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from custval.operators.persist import materialize
from custval.operators.ranking import auc_of_counts, exact_auc, exact_quantiles, running_totals, scalar_quantiles
from custval.plans.pltv.validate import spearman


def test_exact_quantiles_match_numpy_linear(spark):
    rng = np.random.default_rng(3)
    vals = np.round(rng.normal(0, 1, 2000), 2)          # plenty of ties
    grp = rng.integers(0, 4, 2000)
    pdf = pd.DataFrame({"g": grp, "x": vals})
    pdf.loc[pdf.g == 3, "x"] = pdf.loc[pdf.g == 3, "x"].iloc[:1].tolist() + [None] * (int((pdf.g == 3).sum()) - 1)
    df = spark.createDataFrame(pdf)
    qs = [0.0, 0.1, 0.5, 0.9, 0.99, 1.0]
    got = exact_quantiles(df, {"x": F.col("x")}, [(f"q{i}", "x", q) for i, q in enumerate(qs)], ["g"]).toPandas()
    for g, sub in pdf.groupby("g"):
        x = sub.x.dropna().to_numpy()
        want = np.quantile(x, qs, method="linear")
        row = got[got.g == g].iloc[0]
        assert [row[f"q{i}"] for i in range(len(qs))] == pytest.approx(list(want), abs=1e-12)


def test_running_totals_positions_and_sums(spark):
    pdf = pd.DataFrame({"k": np.arange(500) % 7, "v": np.arange(500, dtype=float)})
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=1))
    r = running_totals(df, [F.col("v").asc()], ["v"], ["k"], total_col="n").toPandas()
    for k, sub in r.groupby("k"):
        sub = sub.sort_values("v")
        assert list(sub.row_pos) == list(range(1, len(sub) + 1))
        assert np.allclose(sub.cum_v, np.cumsum(sub.v))
        assert (sub.n == len(sub)).all()


def test_exact_auc_matches_pairwise_definition(spark):
    rng = np.random.default_rng(5)
    s = np.round(rng.random(300), 1)                      # ties on purpose
    y = (rng.random(300) < s).astype(int)
    got = exact_auc(spark.createDataFrame(pd.DataFrame({"s": s, "y": y})), "s", "y").first()["auc"]
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert got == pytest.approx(want, abs=1e-12)


def test_exact_quantiles_with_a_third_of_rows_tied(spark):
    x = np.concatenate([np.zeros(3000), np.linspace(1, 100, 6000)])
    df = spark.createDataFrame(pd.DataFrame({"x": x})).repartition(8)
    qs = [0.1, 0.33, 0.34, 0.5, 0.99]
    got = exact_quantiles(df, {"x": F.col("x")}, [(f"q{i}", "x", q) for i, q in enumerate(qs)]).first()
    want = np.quantile(x, qs, method="linear")
    assert [got[f"q{i}"] for i in range(len(qs))] == pytest.approx(list(want), abs=1e-9)


def test_half_of_the_values_tied(spark):
    """Ties are counted before they are ranked: quantiles and rank correlations stay exact."""
    rng = np.random.default_rng(2)
    a = np.where(rng.random(600) < 0.5, 0.0, rng.integers(1, 40, 600)).astype(float)
    b = np.where(a == 0, 0.0, a + rng.integers(0, 20, 600))
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(zip(a, b))], "i long, a double, b double").repartition(7)
    assert scalar_quantiles(df, F.col("a"), [0.1, 0.5, 0.77, 0.99]) == pytest.approx(np.quantile(a, [0.1, 0.5, 0.77, 0.99]))
    rho, same = spearman(df, "a", "b", "a")
    pdf = pd.DataFrame({"a": a, "b": b}).rank()
    assert rho == pytest.approx(pdf.a.corr(pdf.b)) and same == 1.0


def test_auc_of_more_pairs_than_a_long_holds(spark):
    n = 3_100_000_000
    df = spark.createDataFrame([(0.2, n, 2 * n), (0.7, 2 * n, n)], "s double, pos long, neg long")
    r = auc_of_counts(df, "s").first()
    assert (r.pos, r.neg) == (3 * n, 3 * n) and r.auc == pytest.approx((1 * (2 / 2) + 2 * (2 + 1 / 2)) / 9)


def test_running_sums_cross_partitions_and_groups(spark):
    rows = [(g, v, (v * 7 + ord(g)) % 5) for g in "abc" for v in range(200)] + [(None, 1, 3), (None, 0, 2)]
    df = spark.createDataFrame(rows, "g string, v long, w long").repartition(6)
    got = {(r.g, r.v): (r.p, r.cum_w, r.all_w) for r in running_totals(df, [F.col("v").asc()], ["w"], ["g"], row_col="p").collect()}
    for g in ("a", "b", "c", None):
        mine = sorted((v, w) for x, v, w in rows if x == g)
        total = 0
        for k, (v, w) in enumerate(mine, start=1):
            total += w
            assert got[(g, v)] == (k, total, sum(x for _, x in mine))


def test_hot_join_equals_plain_and_spreads_rows(spark):
    """One key with a third of the rows, and as many without a key: no task above three times the median, equal results."""
    from custval.operators import joins as J
    n = 60_000
    big = spark.range(0, n, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id") % 5000).alias("k"), (F.col("id") % 4).cast("string").alias("g"), "id")
    small = spark.range(0, 5000, 2).select(F.col("id").alias("k"), F.lit("x").alias("w")).union(spark.createDataFrame([(7, "a"), (7, "b"), (None, "n")], "k long, w string"))
    hot = J.pieces_of_hot_keys(big, ["k"])
    assert len(hot) == 2 and min(hot.values()) >= 4
    counts = big.groupBy("k").agg(F.count("*").alias("n"))
    assert set(J.hot_from_counts(counts.dropna(), ["k"], "n", n, always_null=True)) == set(hot)
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain, dealt = big.join(small, ["k"], how), J.join_hot(big, small, ["k"], how)
        assert dealt.columns == plain.columns
        assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()
    counted = materialize(big.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top")))          # of the same frame, some columns dropped
    for how in ("inner", "left"):
        assert J.join_hot(big, counted.drop("n"), ["k"], how, hot=hot).exceptAll(big.join(counted.drop("n"), ["k"], how)).isEmpty()
    again = materialize(J.join_hot(big, counted.drop("n"), ["k"], hot=hot))
    assert J.join_hot(again.select("k", "id"), again.groupBy("k").agg(F.max("top").alias("top")), ["k"], hot=hot).count() == again.count()
    with pytest.raises(ValueError, match="full"):
        J.join_hot(big, small, ["k"], "full")
    assert J.pieces_of_hot_keys(big.where("id < 0"), ["k"]) == {} and J.join_hot(big.where("id < 0"), small, ["k"], "left").count() == 0
    seen = {}
    kind = type(big)
    plain_join = kind.join

    def watch(self, other, on=None, how=None):
        if on == ["k", "__piece"]:
            seen["sizes"] = sorted(r["n"] for r in self.repartition(12, *on).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
        return plain_join(self, other, on, how)

    try:
        kind.join = watch
        J.join_hot(big, small, ["k"], "left", hot={h: 48 for h in hot})
    finally:
        kind.join = plain_join
    sizes = seen["sizes"]
    assert sum(sizes) == n and len(sizes) == 12 and sizes[-1] <= 3 * sizes[6]


def test_quantile_sketches_err_within_their_bound_and_merge(spark):
    """Large groups, a third of the values tied, nulls, a group of nulls; merged sketches answer for the union."""
    from custval.operators import sketches as SK
    df = spark.range(0, 120_000, 1, 6).select(
        F.when(F.col("id") % 2 == 0, "a").when(F.col("id") % 11 == 0, F.lit(None)).otherwise("b").alias("g"), (F.col("id") % 5).alias("h"),
        F.when(F.col("id") % 3 == 0, 5.0).when(F.col("id") % 17 == 0, F.lit(None)).otherwise(F.rand(3) * 100).alias("v"), F.lit(None).cast("double").alias("w"))
    out = SK.quantile_report(df, ["g"], {"v": F.col("v"), "w": F.col("w")}, (0.01, 0.5, 0.9), groups_max=3).collect()
    assert {(r.g, r.metric) for r in out} == {("a", "v"), ("b", "v")} and len(out) == 6      # null groups meet no estimate
    assert all(r.within_bound and 0 <= r.rank_error <= SK.RANK_ERROR + 1 / r.n for r in out)
    fine = SK.quantile_sketches(df.where("v is not null"), ["g", "h"], {"v": F.col("v")})
    whole = SK.estimates(SK.merged_quantiles(fine, [], ["v"]), [], ["v"], [0.5, 0.9]).collect()
    values = sorted(r.v for r in df.where("v is not null").select("v").collect())
    for r in whole:
        low, high = np.searchsorted(values, r.estimate, "left") / len(values), np.searchsorted(values, r.estimate, "right") / len(values)
        assert low - 0.03 <= r.q <= high + 0.03
    assert SK.quantile_report(df.where("false"), ["g"], {"v": F.col("v")}, (0.5,), groups_max=3).collect() == []


def test_distinct_sketches_roll_up(spark):
    from custval.operators import sketches as SK
    df = spark.range(0, 200_000, 1, 6).select(F.date_add(F.lit("2001-01-01").cast("date"), (F.col("id") % 200).cast("int")).alias("d"),
                                              (F.col("id") % 30_011).alias("many"), F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("few"))
    out = SK.distinct_report(df, "d", F.trunc("d", "month"), ["many", "few"]).collect()
    assert len(out) == 7 * 2 and all(r.within_bound and r.relative_error <= SK.COUNT_ERROR for r in out)
    assert {r.exact for r in out if r.counted == "few"} == {7} and all(r.estimate == 7 for r in out if r.counted == "few")
    assert SK.distinct_report(df.where("false"), "d", F.trunc("d", "month"), ["many"]).collect() == []
