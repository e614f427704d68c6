"""Registered hazard-panel queries (C1, C1a-C1g, C3)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from custval.operators.persist import remove_folder, settings, write_rows
from custval.oracle import hazard as oh
from custval.params import DEFAULT as P
from custval.plans.hazard import panel as PN
from custval.plans.hazard import state as ST
from custval.registry import app_key, register, rounded
from custval.session import ensure_checkpoint_dir
from custval.sources.layout import read_lines, write_lines
from custval.sources.testdata import load_inputs

DIG = oh.PANEL_DIGITS




def panel_all(spark, sf_dir, p=P):
    """The cohort panel (the feature extract that training, curve, scoring and
    reports all cut).  Kept lazy: each query's plan prunes it to the columns
    that query needs, which beats materialising every feature once."""
    i = load_inputs(spark, sf_dir)
    return PN.cohort_panel(i.lines, i.products, i.customers, p, parts=i.parts)


def matured_panel(spark, sf_dir, p=P):
    return PN.matured_rows(panel_all(spark, sf_dir, p), p)


def scoring_extract(spark, sf_dir, p=P):
    return PN.latest_rows(panel_all(spark, sf_dir, p))


@register("churn_panel", oh.sql_panel)
def churn_panel(spark, sf_dir):
    return rounded(matured_panel(spark, sf_dir), DIG)


_LAYOUTS: dict = {}
#: of the registered query: the least number of buckets (one task reads a bucket, so they grow in line with the lines), and the period
LAYOUT_BUCKETS, LAYOUT_GRAIN = 8, "year"
#: of written lines that a task reads where they are many: about half a million, so that it can sort them in memory
SCAN_BYTES = "16m"


def laid_out_lines(spark, sf_dir, p=P):
    """The lines as of the run date from the partitioned, bucketed table, which is written once per application and input."""
    key = (app_key(spark), sf_dir)
    if key not in _LAYOUTS:
        name = f"custval_lines_{uuid.uuid4().hex}"
        i = load_inputs(spark, sf_dir)
        write_lines(i.lines, name, f"{ensure_checkpoint_dir(spark)}/{name}", max(LAYOUT_BUCKETS, i.parts), LAYOUT_GRAIN)
        _LAYOUTS[key] = name
    return read_lines(spark, _LAYOUTS[key], p.as_of, grain=LAYOUT_GRAIN)


@register("churn_panel_partitioned", oh.sql_panel)
def churn_panel_partitioned(spark, sf_dir):
    """C1 from lines partitioned by order period and bucketed by customer."""
    i = load_inputs(spark, sf_dir)
    return rounded(PN.matured_rows(PN.cohort_panel(laid_out_lines(spark, sf_dir), i.products, i.customers, P, bucketed=True), P), DIG)


@register("purchase_day", oh.sql_purchase_day)
def purchase_day(spark, sf_dir):
    i = load_inputs(spark, sf_dir)
    return rounded(PN.purchase_days(i.lines, i.products, P), {"day_items": 0, "day_return_qty": 0,
                                                              "day_exchange_qty": 0})


SUBSETS = {
    "churn_label": ["customer_id", "order_date", "next_order_date", "days_to_next_order", "churned_400d"],
    "cadence_features": ["customer_id", "order_date", "order_seq", "days_since_first_order",
                         "days_since_prev_order", "avg_gap_so_far", "gap_vs_cadence"],
    "monetary_features": ["customer_id", "order_date", "cum_net_spend", "cum_avg_order_value", "spend_velocity",
                          "cum_items", "this_order_spend", "this_order_items", "this_order_discount_amount",
                          "this_order_discount_rate", "paid_full_price"],
    "breadth_features": ["customer_id", "order_date", "cum_distinct_depts", "cum_bought_cross_gender",
                         "cum_footwear_plus_nonfootwear", "cum_distinct_physical_stores", "cum_ever_ecomm",
                         "cum_ever_retail", "cum_both_channels"],
    "prior_returns": ["customer_id", "order_date", "cum_return_qty_prior", "cum_exchange_qty_prior"],
    "entry_attributes": ["customer_id", "order_date", "entry_department", "first_product_style", "acq_channel",
                         "acq_store", "customer_state", "state_missing"],
}


def _subset(key, cols):
    def build(spark, sf_dir):
        return rounded(matured_panel(spark, sf_dir).select(*cols), DIG)
    build.__name__ = key
    register(key, lambda: oh.sql_subset(cols))(build)


for _k, _c in SUBSETS.items():
    _subset(_k, _c)


@register("latest_order_features", oh.sql_latest)
def latest_order_features(spark, sf_dir):
    return rounded(scoring_extract(spark, sf_dir), DIG)


@register("latest_order_features_incremental", oh.sql_latest)
def latest_order_features_incremental(spark, sf_dir, days=30, steps=3):
    """C3 by increments: the state of ``days`` before the run date, then the lines since, in ``steps`` updates.

    One order in 97 arrives an update late, so customers with late lines are
    part of every run.  The lines are joined once; those that can count are
    written by the update in which they arrive.  Each state is written before
    the next update, and deleted after it.
    """
    i = load_inputs(spark, sf_dir)
    width = days // steps
    cuts = [P.as_of - dt.timedelta(days=days - width * k) for k in range(steps)] + [P.as_of]
    # the update in which a line arrives
    step = F.lit(steps + 1)
    for k in range(steps, -1, -1):
        step = F.when(F.col("order_date") <= F.lit(cuts[k]), k).otherwise(step)
    arrival = F.least(step + (F.col("order_id") % 97 == 0).cast("int"), F.lit(steps))
    own = i.lines.withColumn("_step", F.when(step > steps, step).otherwise(arrival)).where(F.col("_step") <= steps)
    lines, path = write_rows(PN.panel_lines(own, P).select(*PN.LINE_COLUMNS, "_step"), "_step")
    with settings(spark, {"spark.sql.files.maxPartitionBytes": SCAN_BYTES} if i.parts > 1 else {}):
        state, written = write_rows(ST.state_of(PN.purchase_days(lines.where("_step = 0").drop("_step"), i.products, P)))
        for k in range(1, steps + 1):
            new, history = (lines.where(c).drop("_step") for c in (f"_step = {k}", f"_step < {k}"))
            before = written
            state, written = write_rows(ST.update(state, new, history, i.products, P))
            remove_folder(spark, before)
    remove_folder(spark, path)
    return rounded(ST.latest_features(state, i.customers, P), DIG)
