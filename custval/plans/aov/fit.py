"""Empirical-Bayes fit of log order value.

Model: log(value) = theta_c + gamma_cell + eps, eps ~ N(0, sigma^2),
theta_c ~ N(mu, tau^2).  All population quantities are aggregates over the
cell table; only one-row results and the per-order-count likelihood table
(one row per distinct order count) ever reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custval.operators.joins import join_small
from custval.operators.persist import materialize
from custval.params import Params

CELL_KEYS = ["order_department", "order_is_exotic"]


@dataclass
class AovFit:
    cells: DataFrame       # cells + cell_mean_log, cell_ss, gamma_cell, a_cell
    premiums: DataFrame    # one row per (department, exotic) cell
    customers: DataFrame   # one row per customer, with expected_aov
    grand_mean: float
    sigma2: float
    smear: float
    parametric: float
    rt: float
    abar_pop: float
    theta_center: float
    mu: float
    tau2: float
    k: float
    p: Params

    @property
    def sigma(self) -> float:
        return math.sqrt(self.sigma2)

    def weight(self, n: float) -> float:
        return 0.0 if self.tau2 <= 0 else n / (n + self.k)


def cell_moments(cells: DataFrame) -> DataFrame:
    """A3: cell mean log and within-cell sum of squares."""
    mean = F.col("sum_log_value") / F.col("n_orders")
    return (cells.withColumn("cell_mean_log", mean)
                 .withColumn("cell_ss", F.col("sum_log_value_sq") - F.col("n_orders") * mean * mean))


def premiums_table(cm: DataFrame, grand_mean: float, rt: float) -> DataFrame:
    """Saturated cell effect gamma = order-weighted cell mean log - grand mean."""
    g = cm.groupBy(*CELL_KEYS).agg(F.sum("sum_log_value").alias("sum_log"),
                                   F.sum("n_orders").alias("n_orders"))
    gamma = F.col("sum_log") / F.col("n_orders") - F.lit(grand_mean)
    return (g.withColumn("cell_logmean", F.col("sum_log") / F.col("n_orders"))
             .withColumn("gamma_cell", gamma)
             .withColumn("premium", F.exp(gamma))
             .withColumn("a_cell", F.exp(gamma) * F.lit(rt)))


def customer_table(cells: DataFrame) -> DataFrame:
    """A10b inputs: per customer totals over their cells (cells carry gamma, a_cell)."""
    extra = [F.max(c).alias(c) for c in ("test_n_orders", "test_sum_value") if c in cells.columns]
    t = cells.groupBy("customer_id").agg(
        F.sum("n_orders").alias("n_c"),
        F.sum("sum_log_value").alias("sum_log"),
        F.sum("sum_log_value_sq").alias("sum_log_sq"),
        F.sum(F.col("n_orders") * F.col("gamma_cell")).alias("mix_gamma_num"),
        F.sum(F.col("n_orders") * F.col("a_cell")).alias("obs_sum"),
        F.sum("sum_value").alias("sum_value"),
        F.count(F.lit(1)).alias("n_cells"),
        F.max("buys_exotic").alias("buys_exotic"),
        *extra)
    return (t.withColumn("cust_mean_log", F.col("sum_log") / F.col("n_c"))
             .withColumn("theta_raw", F.col("cust_mean_log") - F.col("mix_gamma_num") / F.col("n_c")))


# --- tau^2: profile likelihood on the per-order-count table ------------------

def _profile_nll(t: np.ndarray, n, cnt, s1, s2, sigma2: float):
    """Negative log-likelihood of theta_raw ~ N(mu, t + sigma2/n), mu profiled out.

    ``t`` is a vector of candidates; rows of (n, cnt, s1, s2) are the
    per-order-count sums of (theta_raw - centre) and its square.
    """
    v = np.maximum(t[:, None] + sigma2 / n[None, :], 1e-12)
    mu = (s1 / v).sum(axis=1) / (cnt / v).sum(axis=1)
    nll = 0.5 * (cnt * np.log(v) + (s2 - 2 * mu[:, None] * s1 + (mu * mu)[:, None] * cnt) / v).sum(axis=1)
    return nll, mu


def fit_tau2(table, sigma2: float) -> tuple[float, float]:
    """Two-stage grid: step 1e-3 on [0, 5], then step 1e-6 around the best point.

    Returns (tau2, mu offset from the centre).  Ties go to the smaller tau2.
    """
    n = np.array([r[0] for r in table], float)
    cnt = np.array([r[1] for r in table], float)
    s1 = np.array([r[2] for r in table], float)
    s2 = np.array([r[3] for r in table], float)
    coarse = np.arange(0, 5001)
    nll, _ = _profile_nll(coarse / 1000.0, n, cnt, s1, s2, sigma2)
    best = int(coarse[int(np.argmin(nll))])
    fine = np.arange(best * 1000 - 1000, best * 1000 + 1001)
    fine = fine[(fine >= 0) & (fine <= 5_000_000)]
    nll, mu = _profile_nll(fine / 1e6, n, cnt, s1, s2, sigma2)
    i = int(np.argmin(nll))
    return float(fine[i] / 1e6), float(mu[i])


def fit(cells: DataFrame, p: Params, persist: bool = True) -> AovFit:
    cells = materialize(cells) if persist else cells
    cm = cell_moments(cells)
    multi = F.col("n_orders") >= 2
    r = cm.agg(
        F.sum("sum_log_value").alias("sl"), F.sum("n_orders").alias("n"),
        F.sum(F.when(multi, F.col("cell_ss"))).alias("ss"),
        F.sum(F.when(multi, F.col("n_orders") - 1)).alias("dof"),
        F.sum(F.when(multi, F.col("sum_value") / F.exp("cell_mean_log"))).alias("smear_num"),
        F.sum(F.when(multi, F.col("n_orders"))).alias("smear_den"),
    ).first()
    if not r["n"]:
        raise ValueError("no order-value cells to fit")
    grand = r["sl"] / r["n"]
    # without a cell of two orders there is no residual variance: no noise, and no smearing
    sigma2 = r["ss"] / r["dof"] if r["dof"] else 0.0
    smear = r["smear_num"] / r["smear_den"] if r["smear_den"] else 1.0
    rt = smear if p.predictor == "mean" else 1.0
    prem = premiums_table(cm, grand, rt)
    # one small job: the population multiplier and the premium table's size,
    # which decides the broadcast of the (department, exotic) lookup below
    pr = prem.agg((F.sum(F.col("n_orders") * F.col("a_cell")) / F.sum("n_orders")).alias("abar"),
                  F.count(F.lit(1)).alias("cells")).first()
    abar = pr["abar"]

    cells_g = join_small(cm, prem.select(*CELL_KEYS, "gamma_cell", "a_cell"), CELL_KEYS, "left",
                         known_rows=pr["cells"])
    # one row per customer, written once: every report and score reads it
    cust = customer_table(cells_g)
    cust = materialize(cust) if persist else cust
    center = cust.agg(F.avg("theta_raw").alias("c")).first()["c"]
    dev = F.col("theta_raw") - F.lit(center)
    table = (cust.groupBy("n_c").agg(F.count(F.lit(1)).alias("cnt"), F.sum(dev).alias("s1"),
                                     F.sum(dev * dev).alias("s2"))
                 .orderBy("n_c").collect())
    tau2, mu_off = fit_tau2([(t["n_c"], t["cnt"], t["s1"], t["s2"]) for t in table], sigma2)
    mu = center + mu_off
    k = sigma2 / tau2 if tau2 > 0 else math.inf
    w = (F.col("n_c") / (F.col("n_c") + F.lit(k))) if tau2 > 0 else F.lit(0.0)
    M = float(p.mix_shrink_m)
    cust = (cust.withColumn("w", w)
                .withColumn("prior_mean", F.lit(mu))
                .withColumn("theta_hat", F.col("w") * F.col("theta_raw") + (1 - F.col("w")) * F.lit(mu))
                .withColumn("expected_aov", F.exp("theta_hat") * (F.col("obs_sum") + F.lit(M * abar))
                            / (F.col("n_c") + F.lit(M))))
    return AovFit(cells_g, prem, cust, grand, sigma2, smear, math.exp(sigma2 / 2), rt, abar,
                  center, mu, tau2, k, p)


def expected_aov_sink(f: AovFit) -> DataFrame:
    """The per-customer expected order value handed to the score build."""
    return f.customers.select("customer_id", "expected_aov")
