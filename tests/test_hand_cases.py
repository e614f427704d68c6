"""Hand-made edge cases (FIXTURES.md section 8) on tiny frames."""

import datetime as dt
import json
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from custval.params import Params
from custval.plans.aov import cells as C
from custval.plans.hazard import curve as CV
from custval.plans.hazard import panel as PN
from custval.sources.tables import CUSTOMER_SCHEMA, ORDER_LINE_SCHEMA, PRODUCT_SCHEMA

P = Params(as_of=dt.date(2001, 8, 1), order_floor=dt.date(1995, 1, 1))
D0 = dt.date(1996, 1, 1)


def line(cust, order, day, dept="Men's Footwear", style="S/1", channel="eComm", store="000 - Website",
         value="100", exotic=False, line_no=1, qty="1", net="100", gross="110", disc="-10", ret="0", exch="0"):
    return (cust, order, line_no, 1, 1, D0 + dt.timedelta(days=day), channel, store, dept, style, exotic,
            Decimal(qty), Decimal(ret), Decimal(exch), Decimal(gross), Decimal(disc), Decimal(net), Decimal(value))


def frame(spark, rows):
    return spark.createDataFrame(rows, ORDER_LINE_SCHEMA)


def products(spark, rows=(("S/1", "Active"), ("S/2", "Active"), ("S/3", "Discontinued"))):
    return spark.createDataFrame(list(rows), PRODUCT_SCHEMA)


def customers(spark, rows=((1, " tx "), (2, "n/a"), (3, None), (4, "ca"))):
    return spark.createDataFrame(list(rows), CUSTOMER_SCHEMA)


def panel(spark, rows, matured=True, p=P):
    return PN.build_panel(frame(spark, rows), products(spark), customers(spark), p, matured).toPandas()


def test_label_is_inclusive_at_day_400(spark):
    rows = [line(1, 10, 0), line(1, 11, 400), line(2, 20, 0), line(2, 21, 401)]
    pn = panel(spark, rows).set_index(["customer_id", "order_seq"])
    assert pn.loc[(1, 1), "churned_400d"] == 0
    assert pn.loc[(2, 1), "churned_400d"] == 1
    assert pn.loc[(1, 2), "churned_400d"] == 1          # no later order
    assert pn.loc[(1, 1), "days_to_next_order"] == 400


def test_two_orders_one_day_are_one_purchase_day(spark):
    rows = [line(1, 10, 0, net="50"), line(1, 11, 0, net="70"), line(1, 12, 30)]
    pn = panel(spark, rows).sort_values("order_seq")
    assert list(pn.order_seq) == [1, 2]
    assert float(pn.iloc[0].this_order_spend) == 120.0
    assert pd.isna(pn.iloc[0].days_since_prev_order) and pd.isna(pn.iloc[0].avg_gap_so_far)
    assert pd.isna(pn.iloc[0].spend_velocity)            # day 0: NULL, not an error


def test_null_channel_and_excluded_channels_are_dropped(spark):
    rows = [line(1, 10, 0, channel=None), line(1, 11, 5, channel="Event"), line(1, 12, 9)]
    pn = panel(spark, rows)
    assert len(pn) == 1 and pn.iloc[0].days_since_first_order == 0


def test_invalid_or_missing_style_has_no_department(spark):
    rows = [line(1, 10, 0, style="S/3", dept="Accessories"), line(1, 10, 0, style="NOPE", dept="Kids' Footwear",
                                                                  line_no=2)]
    pn = panel(spark, rows)
    assert pn.iloc[0].this_order_department is None
    assert pn.iloc[0].cum_distinct_depts == 0


def test_null_slot_all_valid_gives_null_breadth(spark):
    rows = [line(1, 10, 0, dept=None)]
    pn = panel(spark, rows)
    assert pd.isna(pn.iloc[0].cum_distinct_depts)


def test_store_seen_twice_counts_once_and_prior_returns_exclude_current(spark):
    rows = [line(1, 10, 0, store="005 - Store", ret="2"), line(1, 11, 10, store="005 - Store", ret="3"),
            line(1, 12, 20, store="006 - Store")]
    pn = panel(spark, rows).sort_values("order_seq")
    assert list(pn.cum_distinct_physical_stores) == [1, 1, 2]
    assert [float(x) for x in pn.cum_return_qty_prior] == [0.0, 2.0, 5.0]
    assert list(pn.this_order_store) == ["005 - Store", "005 - Store", "006 - Store"]
    assert set(pn.acq_store) == {"005 - Store"}


def test_state_cleanup(spark):
    rows = [line(c, 10 + c, 0) for c in (1, 2, 3, 4)]
    pn = panel(spark, rows).set_index("customer_id")
    assert pn.loc[1, "customer_state"] == "TX" and not pn.loc[1, "state_missing"]
    assert pn.loc[2, "customer_state"] == "Unknown" and pn.loc[2, "state_missing"]
    assert pn.loc[3, "customer_state"] == "Unknown"


def test_features_do_not_change_when_future_rows_arrive(spark):
    base = [line(1, 10, 0), line(1, 11, 50, dept="Accessories"), line(1, 12, 90)]
    later = base + [line(1, 13, 300, dept="Kids' Footwear"), line(1, 14, 310)]
    a = panel(spark, base, matured=False).sort_values("order_seq").reset_index(drop=True)
    b = panel(spark, later, matured=False).sort_values("order_seq").reset_index(drop=True).iloc[:3]
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_primary_department_ties(spark):
    rows = [line(1, 10, 0, dept="Accessories", value="50", line_no=1),
            line(1, 10, 0, dept="Kids' Footwear", value="80", line_no=2),
            line(1, 11, 5, dept="Accessories", value="50", line_no=1),
            line(1, 11, 5, dept="Men's Apparel", value="50", line_no=2)]
    o = C.order_primary(frame(spark, rows), spark.createDataFrame([(1,)], "customer_id long"), P).toPandas()
    got = dict(zip(o.order_id, o.order_department))
    assert got[10] == "Kids' Footwear"          # same line count, more revenue
    assert got[11] == "Accessories"             # full tie -> name ascending


def test_non_positive_orders_drop_but_first_date_uses_all_lines(spark):
    rows = [line(1, 10, 0, value="-30"), line(1, 11, 20, value="40")]
    lines = frame(spark, rows)
    coh = C.acquisition_cohort(lines, P, P.join_ceiling).toPandas()
    assert coh.first_order_date.iloc[0] == D0
    cells = C.aov_cells(lines, P).toPandas()
    assert cells.first_order_date.iloc[0] == D0 + dt.timedelta(days=20)
    assert int(cells.n_orders.sum()) == 1


def test_curve_fills_empty_stages(spark):
    rows = [(i, 0.1, k, 0.0) for i, k in enumerate([1, 2, 2, 3, 4, 5, 7, 8, 9])]
    df = spark.createDataFrame(rows, "customer_id long, split_rand double, order_seq long, dsp double")
    sc = (df.withColumn("churn_prob", F.lit(1.0) - F.col("order_seq") / 10.0)
            .withColumn("p_repeat", 1 - F.col("churn_prob")).withColumn("split", F.lit("test"))
            .withColumn("seq_bucket", F.least("order_seq", F.lit(8))))
    cur = CV.hazard_curve(sc, P).orderBy("k").toPandas()
    assert cur.loc[cur.k == 6, "r"].iloc[0] == pytest.approx(cur.loc[cur.k == 5, "r"].iloc[0])
    assert cur.loc[cur.k == 6, "n"].iloc[0] == 0


def test_multipliers_match_the_recursion_and_tails():
    r = [0.3, 0.5, 0.6, 0.65, 0.7, 0.7, 0.72, 0.75]
    m = CV.multipliers(r, 15)
    assert m[16] == 1.0 and m[15] == pytest.approx(1 + 0.75)
    t = CV.tails(r, 15)
    # chained survival of a k = 2 customer with p = 1 equals the explicit loop
    s, e = 1.0, 1.0
    for step in range(1, 15):
        s *= r[min(2 + step, 8) - 1]
        e += s
    assert t[1] == pytest.approx(e)


def test_decile_formula_matches_pandas_qcut(spark):
    from custval.functions.exprs import decile_from_rank
    for n in (23, 1497, 10, 2):
        df = spark.range(1, n + 1).select(F.col("id").alias("r"))
        got = df.select("r", decile_from_rank("r", F.lit(n)).alias("d")).orderBy("r").toPandas().d.tolist()
        want = (pd.qcut(pd.Series(range(1, n + 1)).rank(method="first"), 10, labels=False) + 1).tolist()
        assert got == want, n


def test_fixed_bin_puts_upper_edge_in_last_bin(spark):
    from custval.functions.exprs import fixed_bin
    xs = [0.0, 0.5, 0.999, 1.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.b for r in df.select(fixed_bin("x", F.lit(0.0), F.lit(1.0), 30).alias("b")).collect()]
    want = np.histogram(xs, bins=30, range=(0, 1))[0]
    counts = np.bincount(got, minlength=30)
    assert (counts == want).all()


def test_right_closed_bins_exclude_lowest_edge(spark):
    from custval.functions.exprs import right_closed_bucket
    df = spark.createDataFrame([(0.0,), (30.0,), (30.5,), (400.0,), (401.0,)], "x double")
    got = [r.b for r in df.select(right_closed_bucket("x", [0, 30, 60, 120, 240, 400, 1e9],
                                                      ["a", "b", "c", "d", "e", "f"]).alias("b")).collect()]
    assert got == [None, "a", "b", "e", "f"]


def test_scorecard_sections_count_every_scored_customer(spark):
    """Zeros and missing values: the four sections count the scored customers, the totals all."""
    from custval.plans.pltv import scores as SC
    rows = [(i, 1 + i % 11, "High" if i % 3 else "Low", None if i % 10 == 0 else (0.0 if i % 4 == 0 else float(i)), float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "customer_id long, order_seq long, risk_tier string, remaining_pltv double, total_pltv double")
    card = SC.scorecard(df, P)
    per = {r.section: r.n for r in card.where("section <> 'totals'").groupBy("section").agg(F.sum("customers").alias("n")).collect()}
    assert per == {s: 180 for s in ("seq", "risk", "dec_pct", "hist")}
    totals = {r.bucket: r.customers for r in card.where("section = 'totals' and customers is not null").collect()}
    assert totals == {"n": 200, "scored": 180, "na": 20}
    doc = json.loads(SC.scorecard_json(card).first()["json"])
    assert sum(doc["hist"]["counts"]) == 180 and len(doc["dec_pct"]) == 10 and doc["totals"]["scored"] == 180
    assert [x["seq_b"] for x in doc["seq"]] == list(range(1, 9))


def test_state_by_increments_equals_a_full_rebuild(spark):
    """Any cut of the days into updates, lines of a stored day that arrive late, new customers, and an update without lines."""
    from custval.operators.persist import materialize
    from custval.params import DEFAULT
    from custval.plans.hazard import panel as PN
    from custval.plans.hazard import state as ST
    from custval.sources.testdata import load_inputs
    from tests.tables import SF_SMALL

    i = load_inputs(spark, SF_SMALL)
    lines = i.lines.where("customer_id <= 25").withColumn("_at", F.pmod(F.xxhash64("order_id"), F.lit(1000)) / 1000.0).cache()
    whole = lambda df: ST.state_of(PN.purchase_days(df, i.products, DEFAULT))
    want = whole(lines.drop("_at")).collect()
    assert len(want) > 5
    by_date = [lines.where(c).drop("_at") for c in ("order_date < '1996-01-01'", "order_date >= '1996-01-01' and order_date < '1998-06-01'", "order_date >= '1998-06-01'")]
    by_chance = [lines.where(c).drop("_at") for c in ("_at < 0.5", "_at >= 0.5 and _at < 0.9", "_at >= 0.9", "_at > 1")]
    for parts in (by_date, by_chance):
        state, seen = whole(parts[0]), parts[0]
        for part in parts[1:]:
            state = materialize(ST.update(state, part, seen, i.products, DEFAULT))
            seen = seen.unionByName(part)
        assert sorted(state.collect()) == sorted(want)
    empty = lines.where("false").drop("_at")
    assert whole(empty).collect() == [] and sorted(ST.update(whole(empty), seen, empty, i.products, DEFAULT).collect()) == sorted(want)
    direct = PN.latest_rows(PN.cohort_panel(lines.drop("_at"), i.products, i.customers, DEFAULT))
    kept = ST.latest_features(state, i.customers, DEFAULT)
    assert direct.exceptAll(kept.select(*[F.col(f.name).cast(f.dataType) for f in direct.schema])).isEmpty() and direct.count() == kept.count()
