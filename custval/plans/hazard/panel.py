"""Purchase-day feature panel (C1, C1a-C1g, C3).

Lines are first rolled up to (customer, purchase-day) by a partial+final hash
aggregate, so the windows that follow run on a grain whose size per customer
is bounded by the number of calendar days in the history -- a customer with a
huge share of all lines still yields at most one row per day.  All running
windows share one specification (one Exchange + one Sort); the first-seen
store flag adds only a Sort on (customer, store).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custval.functions.exprs import (
    clean_state, dept_slot, hash_unit, safe_div, store_label,
)
from custval.operators.joins import join_small, spread
from custval.params import Params

SLOTS = ["mens_fw", "womens_fw", "kids_fw", "acc", "mens_ap", "womens_ap"]
INACTIVE_STATUS = ("Discontinued", "Never Launched")

PANEL_COLUMNS = [
    "customer_id", "split_rand", "order_date", "order_seq", "next_order_date", "days_to_next_order",
    "churned_400d", "days_since_first_order", "days_since_prev_order", "avg_gap_so_far", "gap_vs_cadence",
    "cum_net_spend", "cum_avg_order_value", "spend_velocity", "cum_items", "this_order_spend",
    "this_order_items", "this_order_discount_amount", "this_order_discount_rate", "paid_full_price",
    "cum_distinct_depts", "cum_bought_cross_gender", "cum_footwear_plus_nonfootwear",
    "cum_distinct_physical_stores", "cum_ever_ecomm", "cum_ever_retail", "cum_both_channels",
    "cum_return_qty_prior", "cum_exchange_qty_prior", "this_order_department", "this_order_style",
    "this_order_channel", "this_order_store", "order_month", "entry_department", "first_product_style",
    "acq_channel", "acq_store", "customer_state", "state_missing",
]
#: what the panel reads of a line
LINE_COLUMNS = ["customer_id", "order_id", "line_no", "part_key", "supp_key", "order_date", "channel_type", "store_name", "department", "style",
                "quantity", "return_quantity", "exchanged_quantity", "gross_sales", "discounts", "net_sales"]
LABEL_COLUMNS = ["next_order_date", "days_to_next_order", "churned_400d"]


def style_validity(products: DataFrame) -> DataFrame:
    """Products collapsed to one row per style (guards the join against fan-out)."""
    st = F.col("item_status")
    return products.groupBy("product_style").agg(
        F.bool_or(st.isNotNull() & ~st.isin(*INACTIVE_STATUS)).alias("valid_style"))


def panel_lines(lines: DataFrame, p: Params) -> DataFrame:
    """The lines that the panel counts: registered customers, channels in scope (a NULL channel is dropped), up to ``as_of``."""
    return lines.where((F.col("customer_id") > 0) & ~F.col("channel_type").isin(*p.hazard_excluded)
                       & (F.col("order_date") <= F.lit(p.as_of)))


def tagged_lines(lines: DataFrame, products: DataFrame, p: Params) -> DataFrame:
    j = join_small(panel_lines(lines, p), style_validity(products).withColumnRenamed("product_style", "style"), "style", "left")
    return (j.withColumn("valid_style", F.coalesce("valid_style", F.lit(False)))
             .withColumn("dept_slot", dept_slot("department")))


def purchase_days(lines: DataFrame, products: DataFrame, p: Params) -> DataFrame:
    """One row per (customer, purchase-day) with totals, flags and the
    attributes of the day's first line (by order, line, part, supplier)."""
    t = tagged_lines(lines, products, p)
    first = F.struct("order_id", "line_no", "part_key", "supp_key")
    valid = F.col("valid_style")
    when_valid = lambda c: F.when(valid & F.col(c).isNotNull(), first)
    slot_flags = [F.bool_or(valid & (F.col("dept_slot") == s)).alias(f"day_{s}") for s in SLOTS]
    return t.groupBy("customer_id", "order_date").agg(
        F.sum("net_sales").alias("day_net"),
        F.sum("quantity").alias("day_items"),
        F.sum("gross_sales").alias("day_gross"),
        F.abs(F.sum("discounts")).alias("day_discount"),
        F.sum("return_quantity").alias("day_return_qty"),
        F.sum("exchanged_quantity").alias("day_exchange_qty"),
        *slot_flags,
        F.bool_or(F.col("channel_type") == "eComm").alias("day_ecomm"),
        F.bool_or(F.col("channel_type") == "Retail").alias("day_retail"),
        F.min_by("department", when_valid("department")).alias("day_department"),
        F.min_by("style", when_valid("style")).alias("day_style"),
        F.min_by("channel_type", first).alias("day_channel"),
        F.min_by("store_name", first).alias("day_store"),
    )


def _days(a: str, b: str) -> Column:
    return F.datediff(F.col(a), F.col(b)).cast("bigint")


def _churned(p: Params) -> Column:
    """The label: no next order within the window."""
    after = F.col("next_order_date")
    return (~(after.isNotNull() & (after <= F.date_add("order_date", p.window_days)))).cast("bigint")


def cumulative_state(days: DataFrame, bucketed: bool = False, parts: int = 1) -> DataFrame:
    """Running features as of each purchase-day (windows on the day grain)."""
    # one exchange on the customer serves every window below; lines bucketed by customer have it already
    days = days if bucketed else spread(days, parts, "customer_id") if parts > 1 else days.repartition("customer_id")
    physical = F.col("day_store").isNotNull() & (F.col("day_store") != "000 - Website")
    first_seen = F.row_number().over(Window.partitionBy("customer_id", "day_store").orderBy("order_date")) == 1
    d = days.withColumn("new_physical_store", physical & first_seen)

    w = Window.partitionBy("customer_id").orderBy("order_date")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prior = w.rowsBetween(Window.unboundedPreceding, -1)
    return d.select(
        "*",
        F.row_number().over(w).cast("bigint").alias("order_seq"),
        F.lag("order_date").over(w).alias("prev_order_date"),
        F.lead("order_date").over(w).alias("next_order_date"),
        F.min("order_date").over(run).alias("first_order_date"),
        F.sum("day_net").over(run).alias("cum_net_spend"),
        F.sum("day_items").over(run).alias("cum_items"),
        F.sum("day_return_qty").over(prior).alias("cum_return_prior"),
        F.sum("day_exchange_qty").over(prior).alias("cum_exchange_prior"),
        F.sum(F.col("new_physical_store").cast("int")).over(run).cast("bigint").alias("cum_distinct_physical_stores"),
        *[F.max(F.col(f"day_{s}").cast("int")).over(run).alias(f"cum_{s}") for s in SLOTS],
        F.max(F.col("day_ecomm").cast("int")).over(run).alias("cum_ecomm"),
        F.max(F.col("day_retail").cast("int")).over(run).alias("cum_retail"),
        F.first("day_department", ignorenulls=True).over(run).alias("entry_department"),
        F.first("day_style", ignorenulls=True).over(run).alias("first_product_style"),
        F.first("day_channel").over(run).alias("acq_channel"),
        F.first("day_store").over(run).alias("acq_store_raw"),
    )


def state_codes(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", clean_state("customer_state").alias("state_code"))


def cohort_panel(lines: DataFrame, products: DataFrame, customers: DataFrame, p: Params, bucketed: bool = False, parts: int = 1) -> DataFrame:
    """Every purchase-day (up to ``as_of``) of customers acquired on/after the floor,
    with features and label columns.  The training panel and the scoring rows
    are both cuts of this one table, so their features cannot drift apart.
    ``bucketed``: the lines come from a table bucketed by customer
    (``sources.layout``), so neither the rollup nor the windows exchange them.
    ``parts``: tasks of the windows (``joins.parts_for``; 1: Spark's own number)."""
    return panel_features(cumulative_state(purchase_days(lines, products, p), bucketed, parts), customers, p)


def panel_features(state: DataFrame, customers: DataFrame, p: Params) -> DataFrame:
    """Features and labels of purchase-days with their running state (``cumulative_state``), cohort customers only."""
    s = state.join(state_codes(customers), "customer_id", "left")
    since_first, since_prev = _days("order_date", "first_order_date"), _days("order_date", "prev_order_date")
    avg_gap = safe_div(since_first, F.nullif(F.col("order_seq") - 1, F.lit(0)))
    rate = safe_div("day_discount", "day_gross")
    cum = {x: F.col(f"cum_{x}") for x in SLOTS}
    ecomm, retail = F.col("cum_ecomm") == 1, F.col("cum_retail") == 1
    out = s.select(
        "customer_id",
        hash_unit("customer_id", p.split_seed).alias("split_rand"),
        "order_date", "order_seq", "next_order_date",
        _days("next_order_date", "order_date").alias("days_to_next_order"),
        _churned(p).alias("churned_400d"),
        since_first.alias("days_since_first_order"),
        since_prev.alias("days_since_prev_order"),
        avg_gap.alias("avg_gap_so_far"),
        safe_div(since_prev, avg_gap).alias("gap_vs_cadence"),
        "cum_net_spend",
        safe_div("cum_net_spend", "order_seq").alias("cum_avg_order_value"),
        safe_div("cum_net_spend", since_first).alias("spend_velocity"),
        "cum_items",
        F.col("day_net").alias("this_order_spend"),
        F.col("day_items").alias("this_order_items"),
        F.col("day_discount").alias("this_order_discount_amount"),
        rate.alias("this_order_discount_rate"),
        (rate < 0.01).alias("paid_full_price"),
        (cum["mens_fw"] + cum["womens_fw"] + cum["kids_fw"] + cum["acc"] + cum["mens_ap"] + cum["womens_ap"]
         ).cast("bigint").alias("cum_distinct_depts"),
        (((cum["mens_fw"] == 1) | (cum["mens_ap"] == 1)) &
         ((cum["womens_fw"] == 1) | (cum["womens_ap"] == 1))).alias("cum_bought_cross_gender"),
        (((cum["mens_fw"] + cum["womens_fw"] + cum["kids_fw"]) > 0) &
         ((cum["acc"] + cum["mens_ap"] + cum["womens_ap"]) > 0)).alias("cum_footwear_plus_nonfootwear"),
        "cum_distinct_physical_stores",
        ecomm.alias("cum_ever_ecomm"), retail.alias("cum_ever_retail"), (ecomm & retail).alias("cum_both_channels"),
        F.coalesce("cum_return_prior", F.lit(0)).alias("cum_return_qty_prior"),
        F.coalesce("cum_exchange_prior", F.lit(0)).alias("cum_exchange_qty_prior"),
        F.col("day_department").alias("this_order_department"),
        F.col("day_style").alias("this_order_style"),
        F.col("day_channel").alias("this_order_channel"),
        store_label("day_store").alias("this_order_store"),
        F.month("order_date").cast("bigint").alias("order_month"),
        "entry_department", "first_product_style", "acq_channel",
        store_label("acq_store_raw").alias("acq_store"),
        F.coalesce("state_code", F.lit("Unknown")).alias("customer_state"),
        F.col("state_code").isNull().alias("state_missing"),
        "first_order_date",
    )
    return out.where(F.col("first_order_date") >= F.lit(p.order_floor)).select(*PANEL_COLUMNS)


def as_of_view(panel_all: DataFrame, p: Params) -> DataFrame:
    """The panel as of an earlier day, out of one whose ``as_of`` is later (other parameters equal).

    A row's features look back only, so it is a row of both; the next order is known if it is not behind ``p.as_of``.
    """
    after = F.col("next_order_date")
    known = F.when(after <= F.lit(p.as_of), after)
    return (panel_all.where(F.col("order_date") <= F.lit(p.as_of)).withColumn("next_order_date", known)
            .withColumn("days_to_next_order", _days("next_order_date", "order_date"))
            .withColumn("churned_400d", _churned(p)))


def matured_rows(panel_all: DataFrame, p: Params) -> DataFrame:
    """Rows whose label window is fully observed (filter above the windows)."""
    return panel_all.where(F.col("order_date") <= F.lit(p.maturity_cutoff))


def latest_rows(panel_all: DataFrame) -> DataFrame:
    """Each customer's latest purchase-day, without label columns.

    Rank-1 filtering on the panel's own customer partitioning needs no new
    Exchange (Spark plans it as a WindowGroupLimit).
    """
    return latest_of(panel_all).select(*[c for c in PANEL_COLUMNS if c not in LABEL_COLUMNS])


def latest_of(panel_all: DataFrame) -> DataFrame:
    """Each customer's last row of a panel, whichever columns it has."""
    w = Window.partitionBy("customer_id").orderBy(F.col("order_seq").desc())
    return panel_all.withColumn("_rk", F.row_number().over(w)).where("_rk = 1").drop("_rk")


def build_panel(lines: DataFrame, products: DataFrame, customers: DataFrame, p: Params,
                matured: bool = True) -> DataFrame:
    """C1 (``matured=True``): emitted rows have a fully observed label window.
    ``matured=False``: all cohort rows without label columns."""
    allp = cohort_panel(lines, products, customers, p)
    if matured:
        return matured_rows(allp, p)
    return allp.select(*[c for c in PANEL_COLUMNS if c not in LABEL_COLUMNS])


def latest_order_features(lines: DataFrame, products: DataFrame, customers: DataFrame,
                          p: Params) -> DataFrame:
    """The scoring extract -- each customer's latest purchase-day as of ``as_of``."""
    return latest_rows(cohort_panel(lines, products, customers, p))
