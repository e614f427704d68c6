"""Registered validation-protocol queries."""

from __future__ import annotations

from dataclasses import replace

from custval.oracle import validate as ov
from custval.params import DEFAULT as P
from custval.plans.pltv import validate as V
from custval.plans.hazard import curve as CV
from custval.queries.aov_q import holdout_fit, production_fit, write_orders
from custval.queries.pltv_q import curve_and_multipliers, scores_table as value_scores, written_latest, written_matured
from custval.operators.persist import materialize
from custval.registry import app_key, register, rounded
from custval.sources.testdata import load_inputs

PC = V.cutoff_params(P)
BEFORE = replace(P, as_of=P.as_of.fromordinal(P.as_of.toordinal() - 30))
D4 = 4


_FRAMES: dict = {}


def frame(spark, sf_dir):
    """The holdout validation frame, written once per application and input."""
    key = (app_key(spark), sf_dir)
    if key not in _FRAMES:
        i = load_inputs(spark, sf_dir)
        r, m = curve_and_multipliers(spark, sf_dir, PC)
        n = V.orders_in_window(written_matured(spark, sf_dir, PC), P)
        _FRAMES[key] = materialize(
            V.holdout_frame(i.lines, written_latest(spark, sf_dir, PC), P, holdout_fit(spark, sf_dir), r, m, n))
    return _FRAMES[key]


def _reg(key, fn, sql, digits=None):
    def build(spark, sf_dir):
        return rounded(fn(spark, sf_dir), digits or {})
    build.__name__ = key
    register(key, sql)(build)


_reg("val_frequency_aov_interaction", lambda s, d: V.frequency_aov_interaction(frame(s, d)),
     ov.frequency_aov_interaction, {"mean_predicted_aov": D4, "mean_realized_aov": D4})
_reg("val_orders_per_purchase_day", lambda s, d: V.orders_per_purchase_day(frame(s, d)), ov.orders_per_purchase_day)
_reg("val_decile_dollars", lambda s, d: V.decile_dollars(frame(s, d)), ov.decile_dollars,
     {"mean_predicted": D4, "mean_realized": D4})
_reg("val_aggregate_bias", lambda s, d: V.aggregate_bias(frame(s, d)), ov.aggregate_bias,
     {"predicted_total": 2, "realized_total": 2})
_reg("val_rank_quality", lambda s, d: V.rank_quality(frame(s, d)), ov.rank_quality)
_reg("val_gains", lambda s, d: V.gains(frame(s, d)), ov.gains)
_reg("val_segment_calibration", lambda s, d: V.segment_calibration(frame(s, d)), ov.segment_calibration,
     {"predicted_total": 2, "realized_total": 2})
_reg("val_horizon_sensitivity",
     lambda s, d: V.horizon_sensitivity(frame(s, d), curve_and_multipliers(s, d, PC)[0], PC),
     ov.horizon_sensitivity, {"predicted_total": 2})
_reg("val_fallback_share", lambda s, d: V.fallback_share(value_scores(s, d)), ov.fallback_share)
_reg("val_extremes", lambda s, d: V.extremes(value_scores(s, d)), ov.extremes,
     {"max_remaining": D4, "max_total": D4})
_reg("val_top_customers", lambda s, d: V.top_customers(value_scores(s, d)), ov.top_customers,
     {"realized_value": D4, "expected_aov": D4, "remaining_pltv": D4, "total_pltv": D4})


def score_stability(spark, sf_dir):
    write_orders(spark, sf_dir)
    return V.score_stability(value_scores(spark, sf_dir), value_scores(spark, sf_dir, BEFORE))


def pass_criteria(spark, sf_dir):
    """V11, from one panel and one rollup of the orders for its three dates."""
    write_orders(spark, sf_dir)
    scored = CV.with_scores(written_matured(spark, sf_dir), P)
    return V.pass_criteria(production_fit(spark, sf_dir), holdout_fit(spark, sf_dir), frame(spark, sf_dir), value_scores(spark, sf_dir),
                           value_scores(spark, sf_dir, BEFORE), scored, curve_and_multipliers(spark, sf_dir, PC)[0], P)


_reg("val_score_stability", score_stability, ov.score_stability, {"mean_delta": D4, "p10_delta": D4, "p50_delta": D4, "p90_delta": D4})
_reg("val_pass_criteria", pass_criteria, ov.pass_criteria)
