"""Registered sketches (G8, G10): estimates with their measured errors, and the exact part that SQL can check."""

from __future__ import annotations

from pyspark.sql import functions as F

from custval.operators import sketches as SK
from custval.oracle import sketches as osk
from custval.params import DEFAULT as P
from custval.queries.pltv_q import scores_table
from custval.registry import register, rounded
from custval.sources.testdata import order_lines

QS = (0.1, 0.25, 0.5, 0.75, 0.9)
COUNTED = ["customer_id", "style", "store_name"]


def _quantiles(spark, sf_dir):
    rows = scores_table(spark, sf_dir).select(F.least(F.col("order_seq"), F.lit(P.max_bucket)).cast("bigint").alias("stage"), "risk_tier", "remaining_pltv", "total_pltv")
    return SK.quantile_report(rows, ["stage", "risk_tier"], {c: F.col(c) for c in ("remaining_pltv", "total_pltv")}, QS, groups_max=3 * P.max_bucket)


@register("sketched_quantiles")
def sketched_quantiles(spark, sf_dir):
    """KLL estimates of remaining and total value per stage and tier, the exact quantiles, and the rank errors."""
    return rounded(_quantiles(spark, sf_dir), {"estimate": 2, "exact": 2})


@register("sketched_quantiles_check", osk.quantiles)
def sketched_quantiles_check(spark, sf_dir):
    """The same without the estimates, which are random: exact values, and that every estimate lies within the bound."""
    return rounded(_quantiles(spark, sf_dir).select("stage", "risk_tier", "metric", "q", "n", "exact", "within_bound"), {"exact": 2})


def _distinct(spark, sf_dir):
    lines = order_lines(spark, sf_dir).where(F.col("order_date") <= F.lit(P.as_of)).select("order_date", *COUNTED)
    return SK.distinct_report(lines, "order_date", F.trunc("order_date", "quarter"), COUNTED)


@register("sketched_distinct")
def sketched_distinct(spark, sf_dir):
    """Distinct customers, styles and stores per quarter, rolled up from daily sketches, beside the exact counts."""
    return rounded(_distinct(spark, sf_dir))


@register("sketched_distinct_check", osk.distinct)
def sketched_distinct_check(spark, sf_dir):
    """The same without the estimates."""
    return rounded(_distinct(spark, sf_dir).select("period", "counted", "exact", "within_bound"))
