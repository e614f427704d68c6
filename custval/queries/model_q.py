"""Registered trained-model queries (C6, C13b): rows-only checks, no SQL oracle."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from custval.params import DEFAULT as P
from custval.operators.persist import materialize, settle, shuffles_removed
from custval.oracle import model as om
from custval.plans.hazard import categories as CT
from custval.plans.hazard import curve as CV
from custval.plans.hazard import model as MD
from custval.plans.hazard import panel as PN
from custval.plans.pltv import validate as V
from custval.queries.aov_q import holdout_fit
from custval.queries.hazard_q import matured_panel
from custval.registry import app_key, register, rounded
from custval.sources.testdata import load_inputs

PC = V.cutoff_params(P)
_MODELS: dict = {}
_PANELS: dict = {}


def written_panel(spark, sf_dir):
    """The matured panel, written once per application and input: training and TEST rows are cuts of it."""
    key = (app_key(spark), sf_dir)
    if key not in _PANELS:
        _PANELS[key] = settle(matured_panel(spark, sf_dir))
    return _PANELS[key]


def trained(spark, sf_dir):
    key = (app_key(spark), sf_dir)
    if key not in _MODELS:
        _MODELS[key] = MD.fit_hazard_model(written_panel(spark, sf_dir), P, written=True)
    return _MODELS[key]


def _fit_rows(spark, sf_dir):
    """FIT rows of the panel's model frame, pruned to the categories and the label; the categories; the overall rate."""
    panel = matured_panel(spark, sf_dir)
    rows = MD.training_rows(panel.select(*MD.ROW_KEYS, "split_rand", MD.LABEL, *MD.CAT_COLS), P).where(F.col("split") == "fit")
    rows = materialize(rows)
    return rows, CT.prior_of(rows, MD.LABEL)


@register("ordered_category_means", om.sql_ordered_means)
def ordered_category_means(spark, sf_dir):
    """Per FIT row and categorical feature the smoothed mean over the rows before it in the hashed order."""
    rows, prior = _fit_rows(spark, sf_dir)
    return rounded(CT.ordered_means(rows, MD.CAT_COLS, MD.LABEL, MD.ROW_KEYS, prior), {"mean": 8})


@register("category_means", om.sql_category_means)
def category_means(spark, sf_dir):
    """Per categorical feature and value the smoothed mean over all FIT rows."""
    rows, prior = _fit_rows(spark, sf_dir)
    return rounded(CT.category_means(rows, MD.CAT_COLS, MD.LABEL, prior), {"mean": 8})


_TEST_ROWS: dict = {}


def model_scored(spark, sf_dir):
    """The TEST rows with the trained model's score, written once per application and input."""
    key = (app_key(spark), sf_dir)
    if key not in _TEST_ROWS:
        model, feats = trained(spark, sf_dir)
        frame = MD.model_frame(written_panel(spark, sf_dir), keep=("customer_id", "order_date", "split_rand"))
        test = frame.where(CV.split_of(F.col("split_rand"), P) == "test")
        _TEST_ROWS[key] = settle(MD.predict(model, test, feats).select("customer_id", "order_date", "order_seq", "churned_400d", "churn_prob"))
    return _TEST_ROWS[key]


@register("churn_model_scores")
def churn_model_scores(spark, sf_dir):
    return rounded(model_scored(spark, sf_dir))


@register("churn_model_metrics")
def churn_model_metrics(spark, sf_dir):
    """C11, C12 on the trained model, from one running pass: per stage, with the overall figures beside."""
    summary = CV.ranking_summary(CV.ranked_scores(model_test_rows(spark, sf_dir)))
    overall = F.struct("auc", "average_precision")
    whole = F.max(F.when(F.col("scope") == 0, overall)).over(Window.partitionBy(F.lit(1)))          # nine rows
    return rounded(summary.withColumn("whole", whole).where("scope > 0").select(
        F.col("scope").alias("seq_bucket"), "n", (F.col("positives") / F.col("n")).alias("churn_rate"), "auc",
        F.col("whole.auc").alias("overall_auc"), F.col("whole.average_precision").alias("average_precision")))


@register("feature_importance")
def feature_importance(spark, sf_dir):
    model, feats = trained(spark, sf_dir)
    top = MD.feature_importance(model, feats, 25)
    return rounded(spark.createDataFrame(top, "feature string, importance double"))


def model_test_rows(spark, sf_dir):
    """The TEST rows with the trained model's score, shaped like the curve's input."""
    return model_scored(spark, sf_dir).withColumn("p_repeat", 1 - F.col("churn_prob")).withColumn(
        "split", F.lit("test")).withColumn("seq_bucket", F.least(F.col("order_seq").cast("int"), F.lit(P.max_bucket)))


@register("model_hazard_curve")
def model_hazard_curve(spark, sf_dir):
    """C8 on the trained model."""
    return rounded(CV.hazard_curve(model_test_rows(spark, sf_dir), P))


@register("model_calibration_by_stage")
def model_calibration_by_stage(spark, sf_dir):
    """C7 on the trained model."""
    return rounded(CV.calibration_by_stage(model_test_rows(spark, sf_dir)))


def model_value_scores(spark, sf_dir):
    """F1 on the production path: the trained classifier scores the TEST rows
    (for the repeat curve) and each customer's latest row (for the score)."""
    from custval.plans.pltv import scores as SC
    from custval.queries.aov_q import production_fit
    from custval.queries.hazard_q import scoring_extract
    model, feats = trained(spark, sf_dir)
    r = CV.curve_values(CV.hazard_curve(model_test_rows(spark, sf_dir), P))
    m = CV.multipliers(r, P.horizon)
    latest = scoring_extract(spark, sf_dir)
    frame = MD.model_frame(latest, keep=("customer_id",))
    pred = MD.predict(model, frame, feats).select("customer_id", "churn_prob")
    rows = latest.join(pred, "customer_id")
    return SC.pltv_scores(rows, m, production_fit(spark, sf_dir).customers, P, score=F.col("churn_prob"))


@register("pltv_scores_model")
def pltv_scores_model(spark, sf_dir):
    return rounded(model_value_scores(spark, sf_dir), {"realized_value": 4, "expected_aov": 4,
                                                       "remaining_pltv": 4, "total_pltv": 4})


# --- the validation protocol on the trained model (V1-V11, C14) ------------------------------------

_HOLDOUT: dict = {}


def model_holdout(spark, sf_dir):
    """(validation frame, repeat curve as of the cutoff) of a model trained on what was known at the train cutoff.

    Panel, split, training, curve and scored rows are those of a run at the
    cutoff; what customers did behind it is only compared.  Written once per
    application and input; the panel goes when the frame is there.
    """
    key = (app_key(spark), sf_dir)
    if key not in _HOLDOUT:
        i = load_inputs(spark, sf_dir)
        panel_all = settle(PN.cohort_panel(i.lines, i.products, i.customers, PC, parts=i.parts))
        panel, latest = PN.matured_rows(panel_all, PC), PN.latest_rows(panel_all)
        model, feats = MD.fit_hazard_model(panel, PC, written=True)
        test = MD.model_frame(panel, keep=("customer_id", "order_date", "split_rand")).where(CV.split_of(F.col("split_rand"), PC) == "test")
        scored = (MD.predict(model, test, feats).withColumn("p_repeat", 1 - F.col("churn_prob")).withColumn("split", F.lit("test"))
                  .withColumn("seq_bucket", F.least(F.col("order_seq").cast("int"), F.lit(PC.max_bucket))))
        r = CV.curve_values(CV.hazard_curve(scored, PC))
        rows = latest.join(MD.predict(model, MD.model_frame(latest, keep=("customer_id",)), feats).select("customer_id", "churn_prob"), "customer_id")
        with shuffles_removed(spark):
            fit = holdout_fit(spark, sf_dir)
        frame = V.holdout_frame(i.lines, rows, P, fit, r, CV.multipliers(r, PC.horizon), V.orders_in_window(panel, P),
                                score=F.col("churn_prob"))
        _HOLDOUT[key] = settle(frame, panel_all), r
    return _HOLDOUT[key]


def _protocol(key, fn, digits=None):
    def build(spark, sf_dir):
        return rounded(fn(*model_holdout(spark, sf_dir)), digits or {})
    build.__name__ = key
    register(key)(build)


_protocol("model_val_frequency_aov_interaction", lambda f, r: V.frequency_aov_interaction(f), {"mean_predicted_aov": 4, "mean_realized_aov": 4})
_protocol("model_val_decile_dollars", lambda f, r: V.decile_dollars(f), {"mean_predicted": 4, "mean_realized": 4})
_protocol("model_val_aggregate_bias", lambda f, r: V.aggregate_bias(f), {"predicted_total": 2, "realized_total": 2})
_protocol("model_val_rank_quality", lambda f, r: V.rank_quality(f))
_protocol("model_val_gains", lambda f, r: V.gains(f))
_protocol("model_val_segment_calibration", lambda f, r: V.segment_calibration(f), {"predicted_total": 2, "realized_total": 2})
_protocol("model_val_horizon_sensitivity", lambda f, r: V.horizon_sensitivity(f, r, PC), {"predicted_total": 2})


@register("model_projection_backtest")
def model_projection_backtest(spark, sf_dir):
    """C14 on the trained model: expected and actual later orders of the TEST rows."""
    rows = model_test_rows(spark, sf_dir)
    r = CV.curve_values(CV.hazard_curve(rows, P))
    return rounded(CV.projection_backtest(rows, CV.multipliers(r, P.horizon), P))
