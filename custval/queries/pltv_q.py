"""Registered curve, projection, metric and value-score queries."""

from __future__ import annotations

from dataclasses import replace

from custval.oracle import curve as oc
from custval.oracle import pltv as op
from custval.params import DEFAULT as P
from custval.plans.hazard import curve as CV
from custval.plans.hazard import model as MD
from custval.plans.hazard import panel as PN
from custval.plans.pltv import scores as SC
from custval.queries.aov_q import production_fit
from custval.queries.hazard_q import matured_panel, panel_all, scoring_extract
from custval.operators.persist import materialize
from custval.registry import app_key, register, rounded

D4 = 4
_CURVES: dict = {}


def scored_panel(spark, sf_dir, p=P):
    return CV.with_scores(matured_panel(spark, sf_dir, p), p)


_PANELS: dict = {}
#: what scores, curve, projections and the validation frame read of the panel
SCORE_COLUMNS = ["customer_id", "split_rand", "order_date", "order_seq", "next_order_date", "days_to_next_order", "churned_400d", "days_since_prev_order",
                 "cum_net_spend", "acq_channel", "entry_department", "customer_state"]


def written_panel(spark, sf_dir, p=P):
    """The panel's score columns, written once, so the lines are read once for curve and scored rows; one as of an earlier day is a view of it."""
    key = (app_key(spark), sf_dir, p)
    if p.as_of < P.as_of and replace(p, as_of=P.as_of) == P:
        return PN.as_of_view(written_panel(spark, sf_dir), p)
    if key not in _PANELS:
        _PANELS[key] = materialize(panel_all(spark, sf_dir, p).select(*SCORE_COLUMNS))
    return _PANELS[key]


def written_matured(spark, sf_dir, p=P):
    return PN.matured_rows(written_panel(spark, sf_dir, p), p)


def written_latest(spark, sf_dir, p=P):
    return PN.latest_of(written_panel(spark, sf_dir, p)).drop(*PN.LABEL_COLUMNS)


def curve_and_multipliers(spark, sf_dir, p=P):
    """The repeat curve values and multipliers (8 + 16 numbers), once per input."""
    key = (app_key(spark), sf_dir, p)
    if key not in _CURVES:
        r = CV.curve_values(CV.hazard_curve(CV.with_scores(written_matured(spark, sf_dir, p), p), p))
        _CURVES[key] = (r, CV.multipliers(r, p.horizon))
    return _CURVES[key]


def projections(spark, sf_dir):
    r, _ = curve_and_multipliers(spark, sf_dir)
    return CV.chained_projection(CV.with_scores(written_matured(spark, sf_dir), P), r, P)


def value_scores(spark, sf_dir, p=P):
    _, m = curve_and_multipliers(spark, sf_dir, p)
    aov = production_fit(spark, sf_dir, p).customers
    return SC.pltv_scores(written_latest(spark, sf_dir, p), m, aov, p)


_SCORES: dict = {}


def scores_table(spark, sf_dir, p=P):
    """The score table written once (the reference's scores file) and read back by
    every report, so report actions do not rerun the scoring lineage."""
    key = (app_key(spark), sf_dir, p)
    if key not in _SCORES:
        _SCORES[key] = materialize(value_scores(spark, sf_dir, p))
    return _SCORES[key]


def _reg(key, fn, sql, digits=None):
    def build(spark, sf_dir):
        return rounded(fn(spark, sf_dir), digits or {})
    build.__name__ = key
    register(key, sql)(build)


_reg("grouped_split", lambda s, d: CV.grouped_split(matured_panel(s, d), P), oc.grouped_split)
_reg("split_check", lambda s, d: CV.split_check(matured_panel(s, d), P), oc.split_check)
_reg("churn_overview", lambda s, d: CV.churn_overview(matured_panel(s, d)), oc.churn_overview)
_reg("churn_by_order_seq", lambda s, d: CV.churn_by_order_seq(matured_panel(s, d)), oc.churn_by_order_seq)
_reg("model_frame", lambda s, d: MD.model_frame(matured_panel(s, d)), oc.model_frame,
     {"cum_net_spend": 4, "cum_items": 0, "this_order_spend": 4, "this_order_items": 0,
      "this_order_discount_amount": 4, "cum_return_qty_prior": 0, "cum_exchange_qty_prior": 0})
_reg("category_vocab", lambda s, d: MD.category_vocab(MD.model_frame(matured_panel(s, d))), oc.category_vocab)
_reg("calibration_by_stage", lambda s, d: CV.calibration_by_stage(scored_panel(s, d)), oc.calibration_by_stage)
_reg("hazard_curve", lambda s, d: CV.hazard_curve(scored_panel(s, d), P), oc.hazard_curve)
_reg("forward_multiplier", lambda s, d: CV.forward_multiplier(CV.hazard_curve(scored_panel(s, d), P), P),
     oc.forward_multiplier)
_reg("chained_projection", projections, oc.chained_projection, {"proj_additional_value": D4})
_reg("projection_readout", lambda s, d: CV.projection_readout(projections(s, d)), oc.projection_readout,
     {"mean_additional_value": D4})
_reg("projection_summary", lambda s, d: CV.projection_summary(projections(s, d)), oc.projection_summary,
     {"median_additional_value": D4, "mean_additional_value": D4})
_reg("auc_by_stage", lambda s, d: CV.auc_by_stage(scored_panel(s, d)), oc.auc_by_stage)
_reg("auc_summary", lambda s, d: CV.auc_summary(scored_panel(s, d)), oc.auc_summary)
_reg("ranking_metrics", lambda s, d: CV.ranking_metrics(scored_panel(s, d)), oc.ranking_metrics)
_reg("roc_points", lambda s, d: CV.roc_points(scored_panel(s, d)), oc.roc_points)
_reg("score_histogram", lambda s, d: CV.score_histogram(scored_panel(s, d)), oc.score_histogram)
_reg("projection_histogram", lambda s, d: CV.projection_histogram(projections(s, d)), oc.projection_histogram)
_reg("projection_backtest",
     lambda s, d: CV.projection_backtest(CV.with_scores(written_matured(s, d), P), curve_and_multipliers(s, d)[1], P),
     oc.projection_backtest)
_reg("cadence_vs_churn", lambda s, d: CV.cadence_vs_churn(matured_panel(s, d)), oc.cadence_vs_churn)
_reg("cadence_by_stage", lambda s, d: CV.cadence_by_stage(matured_panel(s, d)), oc.cadence_by_stage)
_reg("sample_ltv", lambda s, d: CV.sample_ltv(projections(s, d), P), oc.sample_ltv,
     {"pred_remaining_value": D4, "pred_total_ltv": D4})
_reg("sample_ltv_medians", lambda s, d: CV.sample_ltv_medians(CV.sample_ltv(projections(s, d), P)), oc.sample_ltv_medians,
     {"median_pred_remaining_value": D4, "median_pred_total_ltv": D4})
_reg("live_scores", lambda s, d: CV.live_scores(scoring_extract(s, d), P), oc.live_scores)

MONEY = {"realized_value": D4, "expected_aov": D4, "remaining_pltv": D4, "total_pltv": D4}
_reg("pltv_scores", lambda s, d: SC.ranked(value_scores(s, d)), op.pltv_scores, MONEY)
_reg("pltv_scores_fallback", lambda s, d: SC.with_fallback(scores_table(s, d), P.flat_aov), op.pltv_scores_fallback, MONEY)
_reg("pltv_describe", lambda s, d: SC.describe(scores_table(s, d)), op.pltv_describe,
     {k: D4 for k in ("mean", "std", "min", "p10", "p25", "p50", "p75", "p90", "max")})
_reg("pltv_null_report", lambda s, d: SC.null_report(scores_table(s, d)), op.pltv_null_report)
_reg("pltv_by_stage", lambda s, d: SC.by_stage(scores_table(s, d)), op.pltv_by_stage, {"mean_remaining": D4})
_reg("pltv_quality_checks", lambda s, d: SC.quality_checks(scores_table(s, d), P), op.pltv_quality_checks,
     {**{f"d{i}0": D4 for i in range(1, 10)}, "top_10pct_sum": D4, "bottom_10pct_sum": D4})
_reg("pltv_decile_concentration", lambda s, d: SC.decile_concentration(scores_table(s, d)),
     op.pltv_decile_concentration, {"remaining": D4})
_reg("pltv_trend", lambda s, d: SC.trend_and_tiers(scores_table(s, d)), op.pltv_trend, {"intercept": D4})
_reg("pltv_by_tier", lambda s, d: SC.by_tier(scores_table(s, d)), op.pltv_by_tier, {"mean_remaining": D4})
_reg("pltv_histogram", lambda s, d: SC.histogram(SC.reportable(scores_table(s, d)), 50), op.pltv_histogram,
     {"edge_lo": D4, "edge_hi": D4})
_reg("pltv_scorecard", lambda s, d: SC.scorecard(scores_table(s, d), P), op.pltv_scorecard, {"value": D4})
