"""Registered order-value queries (A-keys)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from custval.operators.persist import materialize
from custval.oracle import aov as osql
from custval.params import DEFAULT as P
from custval.plans.aov import cells as C
from custval.registry import app_key, register, rounded
from custval.sources.testdata import order_lines

MONEY4 = {"sum_value": 5, "test_sum_value": 5, "order_value": 5}


@register("aov_cells", osql.sql_aov_cells)
def aov_cells(spark, sf_dir):
    return rounded(C.aov_cells(order_lines(spark, sf_dir), P), MONEY4)


@register("order_primary", osql.sql_order_primary)
def order_primary(spark, sf_dir):
    return rounded(C.aov_orders(order_lines(spark, sf_dir), P), MONEY4)


@register("customer_totals", osql.sql_customer_totals)
def customer_totals(spark, sf_dir):
    return C.customer_totals(C.all_orders(order_lines(spark, sf_dir), P), P, P.join_ceiling)


@register("acquisition_cohort", osql.sql_acquisition_cohort)
def acquisition_cohort(spark, sf_dir):
    return C.acquisition_cohort(order_lines(spark, sf_dir), P, P.join_ceiling)


@register("aov_holdout_cells", osql.sql_holdout_cells)
def aov_holdout_cells(spark, sf_dir):
    return rounded(C.holdout_cells(order_lines(spark, sf_dir), P), MONEY4)


@register("holdout_actuals", osql.sql_holdout_actuals)
def holdout_actuals(spark, sf_dir):
    return rounded(C.holdout_actuals(C.all_orders(order_lines(spark, sf_dir), P), P), MONEY4)


# --- fitted model and reports -------------------------------------------------

from custval.oracle import aov_fit as ofit  # noqa: E402
from custval.plans.aov import fit as FIT  # noqa: E402
from custval.plans.aov import reports as REP  # noqa: E402

_FITS: dict = {}
_ORDERS: dict = {}


def write_orders(spark, sf_dir) -> None:
    """Roll the orders up and write them, for queries that need more than one fit."""
    key = (app_key(spark), sf_dir)
    if key not in _ORDERS:
        _ORDERS[key] = materialize(C.all_orders(order_lines(spark, sf_dir), P, last_date=True))


def orders_of(spark, sf_dir, p=P):
    """All in-scope orders as of ``p``: out of the written ones if there are any and none of them has lines on both sides of the day."""
    written = _ORDERS.get((app_key(spark), sf_dir))
    if written is None or p.as_of > P.as_of or replace(p, as_of=P.as_of) != P:
        return C.all_orders(order_lines(spark, sf_dir), p)
    day = F.lit(p.as_of)
    if p.as_of < P.as_of and not written.where((F.col("order_date") <= day) & (F.col("last_date") > day)).isEmpty():
        return C.all_orders(order_lines(spark, sf_dir), p)
    return written.where(F.col("order_date") <= day).drop("last_date")


def production_fit(spark, sf_dir, p=P) -> FIT.AovFit:
    """The production fit, once per application, input folder and parameters."""
    key = (app_key(spark), sf_dir, "prod", p)
    if key not in _FITS:
        _FITS[key] = FIT.fit(C.cell_table(orders_of(spark, sf_dir, p), p, p.join_ceiling), p)
    return _FITS[key]


def holdout_fit(spark, sf_dir) -> FIT.AovFit:
    key = (app_key(spark), sf_dir, "holdout")
    if key not in _FITS:
        _FITS[key] = FIT.fit(C.cell_table(orders_of(spark, sf_dir), P, P.train_cutoff, holdout=True), P)
    return _FITS[key]


def _report(key, fn, sql, digits=None, holdout=False):
    def build(spark, sf_dir):
        f = holdout_fit(spark, sf_dir) if holdout else production_fit(spark, sf_dir)
        return rounded(fn(f), digits or {})
    build.__name__ = key
    register(key, sql)(build)


D4 = 4
_report("cell_moments", REP.cell_moments_report, ofit.cell_moments)
_report("cell_premiums", REP.cell_premiums, ofit.cell_premiums)
_report("exotic_premium_by_dept", REP.exotic_premium_by_dept, ofit.exotic_premium_by_dept)
_report("exotic_normal_equations", lambda f: REP.normal_equations(f).where("abs(total) > 1e-6"), ofit.exotic_normal_equations)
_report("exotic_within_effect", REP.exotic_within_effect, None)
_report("exotic_mix", REP.exotic_mix, ofit.exotic_mix)
_report("sigma_resid", REP.sigma_resid, ofit.sigma_resid)
_report("theta_raw", REP.theta_raw, ofit.theta_raw)
_report("fit_prior", REP.fit_prior, ofit.fit_prior)
_report("shrink_theta", REP.shrink_theta, ofit.shrink_theta)
_report("smearing", REP.smearing, ofit.smearing)
_report("value_ladder", REP.value_ladder, ofit.value_ladder, {"usd": D4})
_report("expected_aov", REP.expected_aov, ofit.expected_aov, {"expected_aov": D4})
_report("fit_checks", REP.fit_checks, ofit.fit_checks)
_report("shrinkage_tiers", REP.shrinkage_tiers, ofit.shrinkage_tiers, {"median_expected_aov": D4})
_report("aov_decomposition", REP.aov_decomposition, ofit.aov_decomposition,
        {"long_form": D4, "closed_form": D4})
_report("aov_decomposition_cells", REP.aov_decomposition_cells, ofit.aov_decomposition_cells, {"value": D4, "contribution": D4})
_report("expected_vs_actual", REP.expected_vs_actual, ofit.expected_vs_actual,
        {"mean_actual": D4, "mean_expected": D4})
_report("population_baseline", REP.population_baseline, ofit.population_baseline,
        {"base_usd": D4, "usd": D4})
_report("within_customer_variance", REP.within_customer_variance, ofit.within_customer_variance)
_report("within_variance_histogram", REP.within_variance_histogram, ofit.within_variance_histogram)
_report("variance_example", REP.variance_example, ofit.variance_example,
        {"geomean_usd": D4, "cell_mean_usd": D4})
_report("variance_example_curve", REP.variance_example_curve, ofit.variance_example_curve, {"usd": D4})
_report("spend_by_type", REP.spend_by_type, ofit.spend_by_type,
        {"raw_avg_order_value": D4, "model_expected_aov": D4, "pooled_order_value": D4})
_report("spend_type_ratio", REP.spend_type_ratio, ofit.spend_type_ratio)
_report("holdout_error_by_tier", REP.holdout_error_by_tier, ofit.holdout_error_by_tier, holdout=True)
_report("holdout_calibration", REP.holdout_calibration, ofit.holdout_calibration,
        {"mean_actual": D4, "mean_pred": D4, "train_level": D4, "test_level": D4}, holdout=True)
_report("holdout_binned_calibration", REP.holdout_binned_calibration, ofit.holdout_binned_calibration,
        {"predicted": D4, "realized": D4}, holdout=True)
_report("holdout_decile_calibration", lambda f: REP.holdout_binned_calibration(f, 10),
        lambda: ofit.holdout_binned_calibration(10), {"predicted": D4, "realized": D4}, holdout=True)
_report("holdout_signal", REP.holdout_signal, ofit.holdout_signal, holdout=True)
_report("mix_shrink_sweep", REP.mix_shrink_sweep, ofit.mix_shrink_sweep, holdout=True)
