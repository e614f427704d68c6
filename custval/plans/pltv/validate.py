"""Validation protocol for the combined score.

Temporal holdout: both phases are fitted on data up to the train cutoff
(hazard panel and curve as of the cutoff, order-value fit on TRAIN orders),
each customer's state is scored as of the cutoff, and projections are
compared with what the customer actually did in (cutoff, as_of].
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custval.functions.exprs import decile_from_rank, safe_div
from custval.operators.joins import join_small
from custval.operators.persist import materialize
from custval.operators.ranking import attach_quantiles, running_totals
from custval.params import Params
from custval.plans.aov.fit import AovFit
from custval.plans.hazard import curve as CV
from custval.plans.pltv import scores as SC

L = F.lit


def cutoff_params(p: Params) -> Params:
    return replace(p, as_of=p.train_cutoff)


def realized_after(lines: DataFrame, p: Params) -> DataFrame:
    """Per customer forward actuals in (cutoff, as_of]: net spend, purchase-days, orders.

    Lines are rolled up to (customer, order, day) first, so the distinct counts
    expand orders, not lines.
    """
    w = lines.where((F.col("customer_id") > 0) & ~F.col("channel_type").isin(*p.hazard_excluded)
                    & (F.col("order_date") > F.lit(p.train_cutoff)) & (F.col("order_date") <= F.lit(p.as_of)))
    orders = w.groupBy("customer_id", "order_id", "order_date").agg(F.sum("net_sales").alias("net"))
    return orders.groupBy("customer_id").agg(
        F.sum("net").cast("double").alias("realized_spend"),
        F.countDistinct("order_date").alias("realized_days"),
        F.countDistinct("order_id").alias("realized_orders"))


def orders_in_window(panel: DataFrame, p: Params) -> int:
    """How many future orders the realised window has room for: its days over the mean gap of repeat orders (1 at least)."""
    gap = panel.where(F.col("churned_400d") == 0).agg(F.avg("days_to_next_order").alias("g")).first()["g"]
    return max(1, round(p.holdout_days / gap)) if gap else 1


def window_orders(r: list[float], n: int, p: Params):
    """Expected orders within the realised window: the projection cut after ``n`` future orders."""
    arr = F.array(*[L(t) for t in CV.tails(r, n)])
    stage = F.least(F.col("order_seq"), L(len(r))).cast("int")
    return F.when(F.col("churn_prob") >= p.high_churn_cutoff, L(0.0)).otherwise(F.col("p_repeat") * F.element_at(arr, stage))


def holdout_frame(lines, latest: DataFrame, p: Params, aov_holdout: AovFit, r: list[float], m: dict, n_orders: int,
                  score=None) -> DataFrame:
    """Scores as of the cutoff joined to forward actuals (one row per scored customer).

    ``latest``, ``r`` and ``m`` are the scoring rows, curve and multipliers as of
    the cutoff.  ``window_pltv`` is the predicted value over the realised
    window: dollars are compared on that horizon, ranks on ``remaining_pltv``.
    """
    pc = cutoff_params(p)
    scores = SC.pltv_scores(latest, m, aov_holdout.customers, pc, score=score).withColumn(
        "window_pltv", window_orders(r, n_orders, pc) * F.col("expected_aov"))
    seg = latest.select("customer_id", "acq_channel", "entry_department", "customer_state")
    test = aov_holdout.customers.select("customer_id", "test_n_orders", "test_sum_value")
    real = realized_after(lines, p)
    return (scores.join(seg, "customer_id", "left").join(real, "customer_id", "left")
                  .join(test, "customer_id", "left")
                  .withColumn("realized_spend", F.coalesce("realized_spend", L(0.0)))
                  .withColumn("realized_days", F.coalesce("realized_days", L(0)).cast("bigint"))
                  .withColumn("realized_orders", F.coalesce("realized_orders", L(0)).cast("bigint")))


def _ranked_bins(df: DataFrame, col: str, parts: int) -> DataFrame:
    r = running_totals(df, [F.col(col).asc(), F.col("customer_id")], [], row_col="_r", total_col="_n")
    return r.withColumn("bucket", decile_from_rank(F.col("_r"), F.col("_n"), parts)).drop("_r", "_n")


def frequency_aov_interaction(vf: DataFrame) -> DataFrame:
    """V1: quintiles of projected orders; predicted vs realised AOV in each."""
    v = vf.where(F.col("expected_aov").isNotNull() & (F.col("test_n_orders") > 0)).withColumn(
        "realized_aov", F.col("test_sum_value") / F.col("test_n_orders"))
    b = _ranked_bins(v, "expected_future_orders", 5)
    return b.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("customers"), F.avg("expected_future_orders").alias("mean_expected_orders"),
        F.avg("expected_aov").alias("mean_predicted_aov"), F.avg("realized_aov").alias("mean_realized_aov"),
        (F.avg("realized_aov") / F.avg("expected_aov")).alias("realized_over_predicted"))


def orders_per_purchase_day(vf: DataFrame) -> DataFrame:
    """V2: order ids per purchase-day in the forward window; the grain correction."""
    v = vf.where(F.col("realized_days") > 0).withColumn("ratio", F.col("realized_orders") / F.col("realized_days"))
    agg = v.agg(F.count(F.lit(1)).alias("customers"), F.avg("ratio").alias("mean_ratio"),
                F.max("ratio").alias("max_ratio"), F.avg((F.col("ratio") == 1).cast("double")).alias("share_one"),
                (F.sum("realized_orders") / F.sum("realized_days")).alias("correction"))
    out = attach_quantiles(agg, v, {"r": F.col("ratio")}, [("median_ratio", "r", 0.5), ("p90_ratio", "r", 0.9)])
    return out.select("customers", "mean_ratio", "median_ratio", "p90_ratio", "max_ratio", "share_one", "correction")


def _scored(vf: DataFrame) -> DataFrame:
    return vf.where(F.col("remaining_pltv").isNotNull())


def decile_dollars(vf: DataFrame) -> DataFrame:
    """V3: deciles of predicted remaining value; predicted vs realised spend over the same window."""
    b = _ranked_bins(_scored(vf), "remaining_pltv", 10)
    return b.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("customers"), F.avg("window_pltv").alias("mean_predicted"),
        F.avg("realized_spend").alias("mean_realized"),
        safe_div(F.sum("realized_spend"), F.sum("window_pltv")).alias("realized_over_predicted"))


def aggregate_bias(vf: DataFrame, tolerance: float = 0.10) -> DataFrame:
    """V4: total predicted vs realised over the window, scored holdout population."""
    return _scored(vf).agg(F.count(F.lit(1)).alias("customers"),
                           F.sum("window_pltv").alias("predicted_total"),
                           F.sum("realized_spend").alias("realized_total")).select(
        "customers", "predicted_total", "realized_total",
        safe_div("realized_total", "predicted_total").alias("ratio"),
        (F.abs(safe_div("realized_total", "predicted_total") - 1) <= tolerance).alias("within_tolerance"))


def spearman(df: DataFrame, a: str, *others: str) -> list[float]:
    """Rank correlations (ties averaged) of ``a`` with each of ``others``.

    Rows are first counted by their values, so those that share all of them
    (non-returners at 0, 0) are one row; each column is ranked once.
    """
    cols = list(dict.fromkeys([a, *others]))
    out = materialize(df.groupBy(*cols).agg(F.count(F.lit(1)).alias("c")))
    for col in cols:
        d = out.groupBy(col).agg(F.sum("c").alias("_c"))
        run = running_totals(d, [F.col(col).asc()], ["_c"])
        ranks = run.select(F.col(col).alias("_v"), (F.col("cum__c") - (F.col("_c") - 1) / 2.0).alias(f"_r_{col}"))
        out = out.join(ranks, out[col].eqNullSafe(ranks["_v"])).drop("_v")
    n = F.sum("c")

    def cov(x, y):
        x, y, c = F.col(f"_r_{x}"), F.col(f"_r_{y}"), F.col("c")
        return F.sum(c * x * y) - F.sum(c * x) * F.sum(c * y) / n

    row = out.agg(*[(cov(a, o) / F.sqrt(cov(a, a) * cov(o, o))).alias(f"rho{i}") if o != a else L(1.0).alias(f"rho{i}")
                    for i, o in enumerate(others)]).first()
    return list(row)


def rank_quality(vf: DataFrame) -> DataFrame:
    """V5: Spearman correlation of predicted value and realised spend, top-decile lift."""
    s = _scored(vf)
    rho = spearman(s, "remaining_pltv", "realized_spend")[0]
    g = gains(vf).where(F.col("bucket") == 10)
    return g.select(L(rho).cast("double").alias("spearman"), F.col("lift").alias("top_decile_lift"),
                    F.col("realized_share").alias("top_decile_share"))


def gains(vf: DataFrame) -> DataFrame:
    """V5: share of realised spend and lift per predicted decile (10 = highest), and cumulated from the top."""
    b = _ranked_bins(_scored(vf), "remaining_pltv", 10)
    tot = b.agg(F.sum("realized_spend").alias("t"), F.count(F.lit(1)).alias("n")).first()
    share = safe_div(F.col("spend"), L(tot["t"]).cast("double"))
    from_top = Window.orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)   # ten rows
    per = b.groupBy("bucket").agg(F.count(F.lit(1)).alias("customers"), F.sum("realized_spend").alias("spend"))
    return per.select("bucket", "customers", share.alias("realized_share"),
                      F.sum(share).over(from_top).alias("cumulative_share"),
                      F.sum("customers").over(from_top).alias("_n")).select(
        "bucket", "customers", "realized_share", (F.col("realized_share") / (F.col("customers") / L(tot["n"]))).alias("lift"),
        "cumulative_share", (F.col("cumulative_share") / (F.col("_n") / L(tot["n"]))).alias("cumulative_lift"))


def segment_calibration(vf: DataFrame) -> DataFrame:
    """V6: predicted vs realised over the window by stage, acquisition channel, entry department, state value."""
    s = _scored(vf)
    st = s.groupBy("customer_state").agg(F.avg("expected_aov").alias("state_aov"))
    overall = s.agg(F.avg("expected_aov")).first()[0]
    s = join_small(s, st, "customer_state", "left")
    def seg(name, value):
        return F.struct(L(name).alias("segment"), value.alias("value"))
    segs = F.array(
        seg("stage", F.when(F.col("order_seq") == 1, "first").otherwise("repeat")),
        seg("acq_channel", F.coalesce("acq_channel", L("missing"))),
        seg("entry", F.when(F.col("entry_department").endswith("Footwear"), "footwear").otherwise("other")),
        seg("state_aov", F.when(F.col("state_aov") >= L(overall), "high").otherwise("low")))
    e = s.select("*", F.explode(segs).alias("g"))
    return e.groupBy("g.segment", "g.value").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("window_pltv").alias("predicted_total"),
        F.sum("realized_spend").alias("realized_total")).withColumn(
        "ratio", safe_div("realized_total", "predicted_total"))


def horizon_sensitivity(vf: DataFrame, r: list[float], p: Params, horizons=(10, 15, 20)) -> DataFrame:
    """V7: totals and rank agreement (vs H = 15) when the projection horizon changes."""
    s = _scored(vf)
    base = None
    cols = {}
    for h in horizons:
        m = CV.multipliers(r, h)
        arr = F.array(*[L(m[k]) for k in range(1, h + 2)])
        orders = F.when(F.col("churn_prob") >= p.high_churn_cutoff, L(0.0)).otherwise(
            F.col("p_repeat") * F.element_at(arr, F.least(F.col("order_seq"), L(h)).cast("int")))
        cols[h] = orders * F.col("expected_aov")
    s = s.select("customer_id", *[cols[h].alias(f"v{h}") for h in horizons])
    rows = list(zip(horizons, spearman(s, f"v{p.horizon}", *[f"v{h}" for h in horizons])))
    totals = s.agg(*[F.sum(f"v{h}").alias(f"t{h}") for h in horizons])
    return totals.select(F.explode(F.array(*[
        F.struct(L(h).cast("bigint").alias("horizon"), F.col(f"t{h}").alias("predicted_total"),
                 L(rho).cast("double").alias("spearman_vs_base")) for h, rho in rows])).alias("x")).select("x.*")


def fallback_share(scores: DataFrame) -> DataFrame:
    """V8: customers without their own expected AOV (they need the fallback)."""
    return scores.agg(F.count(F.lit(1)).alias("customers"),
                      F.count_if(F.col("expected_aov").isNull()).alias("on_fallback")).withColumn(
        "share", F.col("on_fallback") / F.col("customers"))


def extremes(scores: DataFrame) -> DataFrame:
    """V9: near-certain repeaters, negative values and the largest scores."""
    return scores.agg(
        F.count_if(F.col("p_repeat") >= 0.95).alias("p_repeat_ge_095"),
        F.count_if(F.col("remaining_pltv") < 0).alias("negative_remaining"),
        F.count_if(F.col("total_pltv") < 0).alias("negative_total"),
        F.max("remaining_pltv").alias("max_remaining"), F.max("total_pltv").alias("max_total"))


def top_customers(scores: DataFrame, n: int = 100) -> DataFrame:
    """V9: the top customers by total value (a top-k report)."""
    return SC.ranked(scores.where(F.col("total_pltv").isNotNull())).limit(n)


def score_stability(now: DataFrame, before: DataFrame) -> DataFrame:
    """The same customers scored at two dates; distribution of the change."""
    j = now.select("customer_id", F.col("remaining_pltv").alias("now")).join(
        before.select("customer_id", F.col("remaining_pltv").alias("before")), "customer_id").where(
        F.col("now").isNotNull() & F.col("before").isNotNull())
    d = F.col("now") - F.col("before")
    agg = j.agg(F.count(F.lit(1)).alias("customers"), F.avg(d).alias("mean_delta"),
                F.avg((F.abs(d) <= 0.1 * F.abs(F.col("before"))).cast("double")).alias("share_within_10pct"),
                F.corr("now", "before").alias("corr"))
    out = attach_quantiles(agg, j, {"d": d}, [("p10_delta", "d", 0.1), ("p50_delta", "d", 0.5),
                                             ("p90_delta", "d", 0.9)])
    return out.select("customers", "mean_delta", "p10_delta", "p50_delta", "p90_delta", "share_within_10pct", "corr")


#: smallest segment that a criterion looks at
MIN_SEGMENT = 30


def pass_criteria(fit: AovFit, aov_holdout: AovFit, vf: DataFrame, scores: DataFrame, before: DataFrame,
                  scored_panel: DataFrame, r: list[float], p: Params) -> DataFrame:
    """One row per pass criterion of the protocol -- value, threshold, verdict."""
    def row(df: DataFrame, name: str, value, threshold: float, ok) -> DataFrame:
        return df.select(L(name).alias("criterion"), value.cast("double").alias("value"),
                         L(float(threshold)).alias("threshold"), ok.alias("passed"))
    w5 = fit.weight(5)
    cust = fit.customers.agg(F.count(F.lit(1)).alias("n"))
    hv = aov_holdout.customers.where(F.col("test_n_orders") > 0).agg(
        (F.avg("expected_aov") / F.avg(F.col("test_sum_value") / F.col("test_n_orders"))).alias("v"))
    cal = CV.calibration_by_stage(scored_panel).agg(
        F.max(F.abs(F.col("pred_repeat") - F.col("actual_repeat"))).alias("v"))
    mean_ratio = F.sum(F.col("realized_over_predicted") * F.col("customers")) / F.sum("customers")
    inter = frequency_aov_interaction(vf)
    centre = inter.agg(mean_ratio).first()[0]
    inter = inter.agg(F.max(F.abs(F.col("realized_over_predicted") / L(centre) - 1)).alias("v"))
    grain = orders_per_purchase_day(vf).select(F.abs(F.col("correction") - 1).alias("v"))
    dec = decile_dollars(vf)
    steps = Window.orderBy("bucket")                      # ten rows
    drops = dec.select((F.col("mean_realized") < F.lag("mean_realized").over(steps)).cast("int").alias("d")).agg(
        F.coalesce(F.sum("d"), L(0)).alias("v"))
    diag = dec.agg((F.sum(F.col("customers") * F.abs(F.col("mean_realized") - F.col("mean_predicted")))
                    / F.sum(F.col("customers") * F.col("mean_realized"))).alias("v"))
    bias = aggregate_bias(vf).select(F.col("ratio").alias("v"))
    lift = gains(vf).where(F.col("bucket") == 10).select(F.col("lift").alias("v"))
    overall = bias.first()["v"]
    seg = segment_calibration(vf).where(F.col("customers") >= MIN_SEGMENT).agg(
        F.max(F.abs(F.col("ratio") / L(overall) - 1)).alias("v"))
    hor = horizon_sensitivity(vf, r, cutoff_params(p)).agg(F.min("spearman_vs_base").alias("v"))
    stab = score_stability(scores, before).select(F.col("corr").alias("v"))
    nul = scores.agg((F.count_if(F.col("expected_aov").isNull()) / F.count(F.lit(1))).alias("v"))
    rem = scores.agg((F.count_if(F.col("remaining_pltv").isNull()) / F.count(F.lit(1))).alias("v"))
    hc = scores.agg(F.coalesce(F.max(F.when(F.col("churn_prob") >= p.high_churn_cutoff,
                                            F.col("expected_future_orders"))), L(0.0)).alias("v"))
    v = F.col("v")
    rows = [row(cust, "tau2_positive", L(fit.tau2), 0.0, L(fit.tau2 > 0)),
            row(cust, "w5_above_0_4", L(w5), 0.4, L(w5 > 0.4)),
            row(hv, "aov_holdout_calibration", v, 1.0, F.abs(v - 1) <= 0.10),
            row(cal, "curve_calibration_max_gap", v, 0.03, v <= 0.03),
            row(inter, "interaction_max_drift", v, 0.10, v <= 0.10),
            row(grain, "grain_correction", v, 0.05, v <= 0.05),
            row(drops, "decile_drops", v, 0.0, v == 0),
            row(diag, "decile_mean_gap", v, 0.10, v <= 0.10),
            row(bias, "aggregate_dollar_bias", v, 1.0, F.abs(v - 1) <= 0.10),
            row(lift, "top_decile_lift", v, 1.0, v > 1),
            row(seg, "segment_max_drift", v, 0.25, v <= 0.25),
            row(hor, "horizon_min_spearman", v, 0.95, v >= 0.95),
            row(stab, "month_apart_correlation", v, 0.90, v >= 0.90),
            row(nul, "null_aov_share", v, 0.005, v < 0.005),
            row(rem, "null_remaining_share", v, 0.005, v < 0.005),
            row(hc, "high_churn_orders_zero", v, 0.0, v == 0)]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out
