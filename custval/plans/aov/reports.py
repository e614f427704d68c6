"""Order-value model reports (A7, A9-A16, A21-A23) and holdout checks.

Each report is a DataFrame over the fitted cell / customer tables; fitted
scalars enter as literals.  Nothing iterates over customers on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custval.functions.exprs import fixed_bin, right_closed_bucket, safe_div
from custval.operators.joins import join_small
from custval.operators.ranking import attach_quantiles, scalar_quantiles
from custval.plans.aov.fit import AovFit

L = F.lit


def _ape(pred: Column, actual: Column) -> Column:
    return F.abs(pred / actual - 1)


# --- fit-side reports ---------------------------------------------------------

def cell_moments_report(f: AovFit) -> DataFrame:
    return f.cells.select("customer_id", "order_department", "order_is_exotic", "n_orders",
                          "cell_mean_log", "cell_ss")


def cell_premiums(f: AovFit) -> DataFrame:
    return f.premiums.select("order_department", "order_is_exotic", "n_orders", "cell_logmean",
                             "gamma_cell", "premium")


def exotic_premium_by_dept(f: AovFit) -> DataFrame:
    """Exotic / normal multiplier per department, and the volume-weighted log premium."""
    ex = F.col("order_is_exotic")
    wide = f.premiums.groupBy("order_department").agg(
        F.max(F.when(~ex, F.col("premium"))).alias("normal_mult"),
        F.max(F.when(ex, F.col("premium"))).alias("exotic_mult"),
        F.max(F.when(~ex, F.col("gamma_cell"))).alias("g0"),
        F.max(F.when(ex, F.col("gamma_cell"))).alias("g1"),
        F.sum(F.when(ex, F.col("n_orders")).otherwise(0)).alias("exotic_orders"),
    ).where(F.col("g0").isNotNull() & F.col("g1").isNotNull())
    wide = wide.withColumn("log_premium", F.col("g1") - F.col("g0"))
    s = wide.agg((F.sum(F.col("log_premium") * F.col("exotic_orders")) /
                  F.sum("exotic_orders")).alias("d")).first()["d"]
    return wide.select("order_department", "normal_mult", "exotic_mult",
                       (F.col("exotic_mult") / F.col("normal_mult")).alias("exotic_premium"),
                       "log_premium", "exotic_orders",
                       L(s).cast("double").alias("delta_marg"),
                       F.exp(L(s).cast("double")).alias("exp_delta_marg"))


def exotic_mix(f: AovFit) -> DataFrame:
    """Exotic share of orders; share of 2+ order customers with both kinds."""
    ex = F.col("order_is_exotic").cast("int")
    per = f.cells.groupBy("customer_id").agg(
        F.sum("n_orders").alias("n_c"),
        F.sum(F.col("n_orders") * ex).alias("ex"),
        F.sum(F.col("n_orders") * (1 - ex)).alias("nex"))
    multi = F.col("n_c") >= 2
    both = (F.col("ex") > 0) & (F.col("nex") > 0)
    return per.agg(
        (F.sum("ex") / F.sum("n_c")).alias("share_exotic"),
        F.avg(F.when(multi, both.cast("double"))).alias("mix_rate"),
        F.count(F.when(multi, 1)).alias("customers_multi"))


#: the name of the exotic column among the regressors; the others are the departments
EXOTIC = "exotic"


def normal_equations(f: AovFit) -> DataFrame:
    """X'WX and X'Wy of the customer-demeaned regression of cell mean log value on exotic and department, as rows.

    A cell is a few (column, value) pairs: one for its department, one for
    exotic if it is, and ``y``.  With the customer's means subtracted, the sum
    of n (a - mean a)(b - mean b) over cells is the sum of n a b minus N mean a
    mean b over customers, so only columns that meet in a customer make a
    product, and the width of the matrix is rows, never columns.  Returns
    ``row_name`` <= ``col_name`` and ``total``; pairs that never meet are left
    out (zero).
    """
    one = lambda name: F.struct(name.alias("name"), L(1.0).alias("value"))
    pairs = F.concat(F.array(one(F.concat(L("dept:"), F.col("order_department"))), F.struct(L("y").alias("name"), F.col("cell_mean_log").alias("value"))),
                     F.when(F.col("order_is_exotic"), F.array(one(L(EXOTIC)))).otherwise(F.array().cast("array<struct<name:string,value:double>>")))
    cells = f.cells.select("customer_id", F.col("n_orders").cast("double").alias("w"), pairs.alias("pairs"))

    def products(df, weight):
        """Sum of weight * a * b by pair of names in a row's ``pairs``, each unordered pair once."""
        left = df.select("pairs", F.explode("pairs").alias("a"), weight.alias("w"))
        both = left.select("a", "w", F.explode("pairs").alias("b")).where(F.col("a.name") <= F.col("b.name"))
        return both.groupBy(F.col("a.name").alias("row_name"), F.col("b.name").alias("col_name")).agg(F.sum(F.col("w") * F.col("a.value") * F.col("b.value")).alias("s"))

    # per customer the weighted sum of each column it has: no more columns than it has departments, and two
    sums = (cells.select("customer_id", "w", F.explode("pairs").alias("p")).groupBy("customer_id", F.col("p.name").alias("name"))
            .agg(F.sum(F.col("w") * F.col("p.value")).alias("value")))
    weight = cells.groupBy("customer_id").agg(F.sum("w").alias("n"))
    per = sums.groupBy("customer_id").agg(F.collect_list(F.struct("name", "value")).alias("pairs")).join(weight, "customer_id")
    inner, outer = products(cells, F.col("w")), products(per, -1.0 / F.col("n"))
    return inner.unionByName(outer).groupBy("row_name", "col_name").agg(F.sum("s").alias("total"))


def exotic_within_effect(f: AovFit) -> DataFrame:
    """The within-customer exotic effect from ``normal_equations``; the small system (departments + 1)
    is solved with a least-norm pseudo-inverse on the driver."""
    import numpy as np

    rows = {(r["row_name"], r["col_name"]): r["total"] for r in normal_equations(f).collect()}       # departments squared at most
    names = sorted({n for pair in rows for n in pair if n != "y"} | {EXOTIC})
    at = lambda a, b: rows.get((min(a, b), max(a, b)), 0.0)
    xtx = np.array([[at(a, b) for b in names] for a in names])
    xty = np.array([at(a, "y") for a in names])
    coef = np.linalg.pinv(xtx, rcond=1e-10, hermitian=True) @ xty
    d = float(coef[names.index(EXOTIC)])
    within = F.try_divide(L(float(at(EXOTIC, EXOTIC))), F.sum("n_orders"))
    return f.cells.agg(F.count(F.lit(1)).alias("cells"), within.alias("within_var")).select(
        "cells", L(d).alias("delta_within"), F.exp(L(d)).alias("exp_delta_within"), "within_var",
        (F.col("within_var") < 1e-8).alias("exotic_is_type"))


def sigma_resid(f: AovFit) -> DataFrame:
    """A10: pooled within-cell sigma, and sigma with exotic folded into the residual."""
    coll = f.cells.groupBy("customer_id", "order_department").agg(
        F.sum("n_orders").alias("n"), F.sum("sum_log_value").alias("s1"),
        F.sum("sum_log_value_sq").alias("s2"))
    multi = F.col("n") >= 2
    ss = F.col("s2") - F.col("s1") * F.col("s1") / F.col("n")
    out = coll.agg((F.sum(F.when(multi, ss)) / F.sum(F.when(multi, F.col("n") - 1))).alias("sigma2_without"))
    sw = F.sqrt("sigma2_without")
    return out.select(
        L(f.sigma2).alias("sigma2"), L(f.sigma).alias("sigma"), sw.alias("sigma_without"),
        ((sw / L(f.sigma) - 1) * 100).alias("sigma_inflation_pct"),
        ((F.col("sigma2_without") / L(f.sigma2) - 1) * 100).alias("k_inflation_pct"))


def theta_raw(f: AovFit) -> DataFrame:
    return f.customers.select("customer_id", "n_c", "cust_mean_log",
                              (F.col("mix_gamma_num") / F.col("n_c")).alias("mix_gamma"), "theta_raw")


def fit_prior(f: AovFit) -> DataFrame:
    """One row with sigma^2, tau^2, mu, K and credibility weights."""
    return f.customers.agg(F.count(F.lit(1)).alias("customers")).select(
        "customers", L(f.sigma2).alias("sigma2"), L(f.tau2).alias("tau2"), L(f.mu).alias("mu"),
        L(f.k if f.tau2 > 0 else None).cast("double").alias("k"),
        L(f.weight(2)).alias("w2"), L(f.weight(5)).alias("w5"), L(f.weight(10)).alias("w10"))


def shrink_theta(f: AovFit) -> DataFrame:
    return f.customers.select("customer_id", "n_c", "theta_raw", "w", "prior_mean", "theta_hat")


def smearing(f: AovFit) -> DataFrame:
    """Retransformation factors and the population-average cell multiplier."""
    return f.premiums.agg(
        (F.sum(F.col("n_orders") * F.col("a_cell")) / F.sum("n_orders")).alias("abar_pop"),
        F.count(F.lit(1)).alias("cells")).select(
        L(f.smear).alias("smear"), L(f.parametric).alias("parametric"), L(f.rt).alias("rt"),
        "abar_pop", "cells")


def value_ladder(f: AovFit) -> DataFrame:
    """Typical dollars per order in each observed cell, and its order share."""
    mt = f.customers.agg(F.avg("theta_hat").alias("m")).first()["m"]
    tot = f.premiums.agg(F.sum("n_orders").alias("n")).first()["n"]
    return f.premiums.select("order_department", "order_is_exotic",
                             (F.exp(L(mt)) * F.col("a_cell")).alias("usd"),
                             (F.col("n_orders") / L(tot)).alias("order_share"))


def expected_aov(f: AovFit) -> DataFrame:
    return f.customers.select("customer_id", "n_c", "theta_raw", "w", "theta_hat", "obs_sum",
                              "expected_aov")


def fit_checks(f: AovFit) -> DataFrame:
    """The fit's pass/fail checks as one row."""
    w5 = f.weight(5)
    return f.customers.agg(
        (F.min("expected_aov") > 0).alias("expected_aov_all_positive"),
        F.count(F.lit(1)).alias("customers")).select(
        L(f.tau2 > 0).alias("tau2_positive"), "expected_aov_all_positive",
        L(w5).alias("w5"), L(w5 > 0.4).alias("w5_above_0_4"), "customers")


# Order-count tiers (right-closed edges, labels) of the shrinkage report.
N_TIERS = ([0, 1, 4, 10, 10**9], ["1", "2-4", "5-10", "11+"])


def shrinkage_tiers(f: AovFit) -> DataFrame:
    """Customers, share, median weight and median expected AOV by order tier."""
    total = f.customers.count()
    t = f.customers.withColumn("n_tier", right_closed_bucket("n_c", *N_TIERS))
    agg = t.groupBy("n_tier").agg(
        F.count(F.lit(1)).alias("customers"),
        (F.count(F.lit(1)) * 100.0 / L(total)).alias("pct_of_base"))
    return attach_quantiles(agg, t, {"w": F.col("w"), "aov": F.col("expected_aov")},
                            [("median_w", "w", 0.5), ("median_expected_aov", "aov", 0.5)], ["n_tier"])


def aov_decomposition(f: AovFit) -> DataFrame:
    """Expected AOV rebuilt cell by cell (plus the population pseudo-cell),
    against the closed form, for every customer."""
    M = float(f.p.mix_shrink_m)
    cust = f.customers.select("customer_id", "n_c", "theta_hat", "expected_aov")
    j = f.cells.select("customer_id", "n_orders", "gamma_cell").join(cust, "customer_id")
    contrib = (F.col("n_orders") / (F.col("n_c") + L(M))) * F.exp(F.col("theta_hat") + F.col("gamma_cell")) * L(f.rt)
    g = j.groupBy("customer_id", "n_c", "theta_hat", "expected_aov").agg(
        F.count(F.lit(1)).alias("n_cells"), F.sum(contrib).alias("own_part"))
    pop = (L(M) / (F.col("n_c") + L(M))) * L(f.abar_pop) * F.exp("theta_hat")
    long_form = F.col("own_part") + pop
    return g.select("customer_id", "n_c", "n_cells",
                    (L(M) / (F.col("n_c") + L(M))).alias("pop_weight"),
                    long_form.alias("long_form"), F.col("expected_aov").alias("closed_form"),
                    (F.abs(long_form - F.col("expected_aov")) <= 1e-9 * F.col("expected_aov")).alias("matches"))


def aov_decomposition_cells(f: AovFit) -> DataFrame:
    """The parts of each customer's expected AOV -- own cells and the population row: weight, value, contribution."""
    M = float(f.p.mix_shrink_m)
    cust = f.customers.select("customer_id", "n_c", "theta_hat")
    whole = F.col("n_c") + L(M)
    own = f.cells.select("customer_id", "order_department", "order_is_exotic", "n_orders", "gamma_cell").join(cust, "customer_id").select(
        "customer_id", F.col("order_department").alias("part"), "order_is_exotic", (F.col("n_orders") / whole).alias("weight"),
        (F.exp(F.col("theta_hat") + F.col("gamma_cell")) * L(f.rt)).alias("value"))
    population = cust.select("customer_id", L("(population)").alias("part"), L(None).cast("boolean").alias("order_is_exotic"),
                             (L(M) / whole).alias("weight"), (F.exp("theta_hat") * L(f.abar_pop)).alias("value"))
    return own.unionByName(population).withColumn("contribution", F.col("weight") * F.col("value"))


def expected_vs_actual(f: AovFit) -> DataFrame:
    """In-sample expected AOV vs the raw arithmetic mean, 1-5 order customers."""
    c = (f.customers.where(F.col("n_c").between(1, 5))
         .withColumn("actual_mean", F.col("sum_value") / F.col("n_c"))
         .withColumn("ratio", F.col("expected_aov") / F.col("actual_mean")))
    agg = c.groupBy("n_c").agg(
        F.count(F.lit(1)).alias("customers"), F.avg("actual_mean").alias("mean_actual"),
        F.avg("expected_aov").alias("mean_expected"), F.avg("ratio").alias("mean_ratio"))
    return attach_quantiles(agg, c, {"r": F.col("ratio")}, [("median_ratio", "r", 0.5)], ["n_c"])


def _normal_density(distance, sd):
    """Density of a normal at a distance from its mean; NULL without spread."""
    return safe_div(F.exp(-0.5 * safe_div(distance, sd) ** 2), sd * F.sqrt(L(2 * 3.141592653589793)))


def population_baseline(f: AovFit, points: int = 80) -> DataFrame:
    """The featureless prior in dollars and its density on mu +/- 3 tau (NULL where tau is 0: a point mass)."""
    tau = f.tau2 ** 0.5
    base = f.customers.agg(F.var_pop("prior_mean").alias("var_prior"),
                           F.avg("prior_mean").alias("mu_log"))
    i = F.col("i")
    x = F.col("mu_log") - 3 * L(tau) + i * (6 * L(tau) / (points - 1))
    dens = _normal_density(x - F.col("mu_log"), L(tau))
    return (base.select("*", F.explode(F.sequence(L(0), L(points - 1))).alias("i"))
            .select("i", "mu_log", L(tau).alias("tau"),
                    (F.exp("mu_log") * L(f.rt)).alias("base_usd"), "var_prior",
                    (F.exp(x) * L(f.rt)).alias("usd"), dens.alias("density")))


def _within(f: AovFit) -> DataFrame:
    c = f.customers.where(F.col("n_c") >= 2)
    var = (F.col("sum_log_sq") - F.col("sum_log") * F.col("sum_log") / F.col("n_c")) / (F.col("n_c") - 1)
    return c.select("customer_id", "n_c", "sum_log", (F.col("sum_log") / F.col("n_c")).alias("mean_log"),
                    F.greatest(var, L(0.0)).alias("within_var"))


def within_customer_variance(f: AovFit) -> DataFrame:
    """Within-customer log variance for n >= 2: mean and percentiles."""
    w = _within(f)
    agg = w.agg(F.count(F.lit(1)).alias("customers"), F.avg("within_var").alias("avg_within_var")).select(
        "customers", "avg_within_var", F.sqrt("avg_within_var").alias("avg_within_sd"),
        L(f.sigma2).alias("sigma2_cell"))
    qs = [("p10", 0.1), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p90", 0.9)]
    return attach_quantiles(agg, w, {"v": F.col("within_var")}, [(n, "v", q) for n, q in qs])


def within_variance_histogram(f: AovFit, bins: int = 30) -> DataFrame:
    """30-bin histogram of within-customer variance capped at its p98."""
    w = _within(f)
    lo = w.agg(F.min("within_var").alias("lo")).first()["lo"]
    cap = scalar_quantiles(w, F.col("within_var"), [0.98])[0]
    hi = max(cap, lo)
    capped = F.least(F.col("within_var"), L(cap))
    counts = w.select(fixed_bin(capped, L(lo), L(hi), bins).alias("bin")).groupBy("bin").count()
    spine = w.agg(F.count(F.lit(1)).alias("n")).select(F.explode(F.sequence(L(0), L(bins - 1))).alias("bin"))
    step = (hi - lo) / bins
    return (join_small(spine, counts, "bin", "left", known_rows=bins)
            .select("bin", (L(lo) + F.col("bin") * L(step)).alias("edge_lo"),
                    (L(lo) + (F.col("bin") + 1) * L(step)).alias("edge_hi"),
                    F.coalesce("count", L(0)).cast("bigint").alias("customers")))


def variance_example(f: AovFit) -> DataFrame:
    """The 3-8 order customer whose variance is nearest the mean, with cells."""
    w = _within(f)
    avg = w.agg(F.avg("within_var").alias("a")).first()["a"]
    cand = w.where(F.col("n_c").between(3, 8))
    pick = cand.agg(F.min_by(F.struct("customer_id", "n_c", "within_var", "mean_log"),
                             F.struct(F.abs(F.col("within_var") - L(avg)), F.col("customer_id"))).alias("s")
                    ).select("s.*").where(F.col("customer_id").isNotNull())
    return join_small(f.cells.select("customer_id", "order_department", "order_is_exotic", "n_orders", "sum_value"),
                      pick, "customer_id", "inner", known_rows=1).select(
        "customer_id", "n_c", "within_var", F.exp("mean_log").alias("geomean_usd"),
        "order_department", "order_is_exotic", "n_orders",
        (F.col("sum_value") / F.col("n_orders")).alias("cell_mean_usd"))


def spend_type_ratio(f: AovFit) -> DataFrame:
    """Exotic buyers' figures over the other customers'."""
    t = spend_by_type(f).groupBy().pivot("buys_exotic", [True, False]).agg(
        *[F.max(c).alias(c) for c in ("raw_avg_order_value", "model_expected_aov", "pooled_order_value")])
    return t.select(*[safe_div(F.col(f"true_{c}"), F.col(f"false_{c}")).alias(f"{c}_ratio")
                      for c in ("raw_avg_order_value", "model_expected_aov", "pooled_order_value")])


def spend_by_type(f: AovFit) -> DataFrame:
    """Exotic vs other buyers: raw and model order value."""
    c = f.customers.withColumn("raw_aov", F.col("sum_value") / F.col("n_c"))
    return c.groupBy("buys_exotic").agg(
        F.count(F.lit(1)).alias("customers"), F.avg("n_c").alias("avg_orders"),
        F.avg("raw_aov").alias("raw_avg_order_value"), F.avg("expected_aov").alias("model_expected_aov"),
        (F.sum("sum_value") / F.sum("n_c")).alias("pooled_order_value"))


# --- temporal holdout (fit on TRAIN cells, score TEST actuals) ---------------

# Train order-count tiers of the holdout error report.
HOLDOUT_TIERS = ([0, 1, 2, 3, 5, 10, 10**9], ["1", "2", "3", "4-5", "6-10", "11+"])


def scorable(f: AovFit) -> DataFrame:
    """Customers with at least one TEST order, with actual AOV and baselines."""
    tot = f.cells.agg(F.sum("sum_value").alias("sv"), F.sum("n_orders").alias("n")).first()
    pop_mean = tot["sv"] / tot["n"]
    return (f.customers.where(F.col("test_n_orders") > 0)
            .withColumn("actual_aov", F.col("test_sum_value") / F.col("test_n_orders"))
            .withColumn("raw_train_mean", F.col("sum_value") / F.col("n_c"))
            .withColumn("pop_mean", L(pop_mean))
            .withColumn("n_tier", right_closed_bucket("n_c", *HOLDOUT_TIERS)))


def holdout_error_by_tier(f: AovFit) -> DataFrame:
    """Median abs % error of model vs population mean vs raw train mean."""
    v = scorable(f)
    a = F.col("actual_aov")
    g = v.groupBy("n_tier").agg(F.count(F.lit(1)).alias("customers"))
    g = attach_quantiles(g, v, {"pop": _ape(F.col("pop_mean"), a), "raw": _ape(F.col("raw_train_mean"), a),
                                "model": _ape(F.col("expected_aov"), a)},
                         [("m_pop", "pop", 0.5), ("m_raw", "raw", 0.5), ("m_model", "model", 0.5)], ["n_tier"])
    g = g.select("n_tier", "customers", (F.col("m_pop") * 100).alias("err_pop"),
                 (F.col("m_raw") * 100).alias("err_raw"), (F.col("m_model") * 100).alias("err_model"))
    e1, e2, e3 = F.col("err_pop"), F.col("err_raw"), F.col("err_model")
    winner = (F.when((e1 <= e2) & (e1 <= e3), "pop-mean").when(e2 <= e3, "raw-mean").otherwise("MODEL"))
    return g.withColumn("winner", winner)


def holdout_calibration(f: AovFit) -> DataFrame:
    """Calibration in the large and the train vs test level of scorable customers."""
    v = scorable(f)
    fit_n = f.customers.count()
    ape = _ape(F.col("expected_aov"), F.col("actual_aov"))
    agg = v.agg(
        F.count(F.lit(1)).alias("scorable"),
        F.avg("actual_aov").alias("mean_actual"), F.avg("expected_aov").alias("mean_pred"),
        (F.avg("expected_aov") / F.avg("actual_aov")).alias("ratio"),
        (F.avg(ape) * 100).alias("mean_ape"),
        (F.sum("sum_value") / F.sum("n_c")).alias("train_level"),
        (F.sum("test_sum_value") / F.sum("test_n_orders")).alias("test_level"),
    ).select("*", L(fit_n).alias("fit_customers"),
             (F.col("test_level") / F.col("train_level")).alias("level_ratio"))
    out = attach_quantiles(agg, v, {"ape": ape, "t": F.col("test_n_orders")}, [("m_ape", "ape", 0.5), ("median_test_orders", "t", 0.5)])
    return out.select("scorable", "median_test_orders", "mean_actual", "mean_pred", "ratio", (F.col("m_ape") * 100).alias("median_ape"),
                      "mean_ape", "train_level", "test_level", "fit_customers", "level_ratio")


def holdout_binned_calibration(f: AovFit, parts: int = 5) -> DataFrame:
    """Quantile bins of the prediction: mean predicted vs realised.

    Bins are right-closed on the prediction's quantile edges; equal edges
    merge bins instead of failing.
    """
    v = scorable(f)
    qs = [i / parts for i in range(1, parts)]
    edges = scalar_quantiles(v, F.col("expected_aov"), qs)
    b = F.lit(1)
    for e in edges:
        b = b + (F.col("expected_aov") > L(e)).cast("int")
    return v.withColumn("bin", F.concat(L("Q"), b.cast("string"))).groupBy("bin").agg(
        F.avg("expected_aov").alias("predicted"), F.avg("actual_aov").alias("realized"),
        F.count(F.lit(1)).alias("customers"))


def holdout_signal(f: AovFit, ks=(1, 2, 3, 5), min_rows: int = 30) -> DataFrame:
    """Predictable ceiling, and error / correlation as TEST evidence grows."""
    v = scorable(f)
    pred = v.agg(F.avg(L(f.tau2) / (L(f.tau2) + L(f.sigma2) / F.col("test_n_orders"))).alias("p")).first()["p"]
    ex = v.select("*", F.explode(F.array(*[L(k) for k in ks])).alias("k")).where(
        F.col("test_n_orders") >= F.col("k"))
    g = ex.groupBy("k").agg(F.count(F.lit(1)).alias("customers"),
                            F.corr("expected_aov", "actual_aov").alias("corr"))
    g = attach_quantiles(g, ex, {"ape": _ape(F.col("expected_aov"), F.col("actual_aov"))},
                         [("m_ape", "ape", 0.5)], ["k"])
    return g.where(F.col("customers") >= min_rows).select(
        "k", "customers", (F.col("m_ape") * 100).alias("median_ape"), "corr", L(pred).alias("predictable"))


def mix_shrink_sweep(f: AovFit) -> DataFrame:
    """Holdout error by tier for several M (no refit) plus the population row."""
    v = scorable(f)
    ms = [float(m) for m in f.p.sweep_m]
    ex = v.select("*", F.explode(F.array(*[L(m) for m in ms] + [L(None).cast("double")])).alias("m"))
    pred = F.when(F.col("m").isNull(), F.col("pop_mean")).otherwise(
        F.exp("theta_hat") * (F.col("obs_sum") + F.col("m") * L(f.abar_pop)) / (F.col("n_c") + F.col("m")))
    ex = ex.withColumn("pred", pred).withColumn("m_key", F.coalesce(F.col("m").cast("string"), L("pop")))
    calib = ex.groupBy("m_key").agg(
        F.when(F.first("m", ignorenulls=True).isNull(), L(None))
         .otherwise(F.avg("pred") / F.avg("actual_aov")).alias("calib"))
    err = ex.groupBy("m_key", "n_tier").agg(F.first("m", ignorenulls=True).alias("m"),
                                            F.count(F.lit(1)).alias("customers"))
    err = attach_quantiles(err, ex, {"ape": _ape(F.col("pred"), F.col("actual_aov"))},
                           [("m_ape", "ape", 0.5)], ["m_key", "n_tier"])
    return err.join(calib, "m_key").select("m", "n_tier", "customers", (F.col("m_ape") * 100).alias("err"), "calib")


def variance_example_curve(f: AovFit, points: int = 80) -> DataFrame:
    """Model-implied lognormal order distribution of the example customer."""
    w = _within(f)
    avg = w.agg(F.avg("within_var").alias("a")).first()["a"]
    pick = w.where(F.col("n_c").between(3, 8)).agg(
        F.min_by(F.struct("customer_id", "within_var", "mean_log"),
                 F.struct(F.abs(F.col("within_var") - L(avg)), F.col("customer_id"))).alias("s")).select("s.*")
    sd = F.sqrt("within_var")
    x = F.col("mean_log") - 3.2 * sd + F.col("i") * (6.4 * sd / (points - 1))
    dens = _normal_density(x - F.col("mean_log"), sd)
    return (pick.where(F.col("customer_id").isNotNull())
            .select("*", F.explode(F.sequence(L(0), L(points - 1))).alias("i"))
            .select("customer_id", "i", F.exp(x).alias("usd"), dens.alias("density")))
