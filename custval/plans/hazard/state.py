"""Per-customer state that a day's lines update, so that a dated rerun does not replay the history.

A customer's state is an aggregate over their purchase-days: counts, sums,
flags, the stores seen, the first and last day's attributes.  States of
consecutive stretches merge, so the lines of a new stretch become a state of
their own and are added to the stored one.  Lines that arrive late (dated on or
before the customer's last stored day) would change days inside; customers
that have any are rebuilt from their own lines, all others are not read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custval.operators.joins import join_measured
from custval.operators.persist import settle
from custval.params import Params
from custval.plans.hazard import panel as PN

SUMS = ["cum_net_spend", "cum_items", "return_total", "exchange_total"]
FLAGS = [*[f"cum_{s}" for s in PN.SLOTS], "cum_ecomm", "cum_retail"]
#: the first of their kind, and those of the first day
FIRSTS, ACQUIRED = ["entry_department", "first_product_style"], ["acq_channel", "acq_store_raw"]
#: of the last day
LAST = ["day_net", "day_items", "day_gross", "day_discount", "day_return_qty", "day_exchange_qty", "day_department", "day_style", "day_channel", "day_store"]
STATE = ["customer_id", "order_seq", "first_order_date", "order_date", "prev_order_date", *SUMS, *FLAGS, "stores", *FIRSTS, *ACQUIRED, *LAST]


def state_of(days: DataFrame) -> DataFrame:
    """The state after the purchase-days ``days`` (``panel.purchase_days``), one row per customer."""
    date = F.col("order_date")
    physical = F.col("day_store").isNotNull() & (F.col("day_store") != "000 - Website")
    known = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), date))
    return days.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_seq"), F.min(date).alias("first_order_date"),
        # the last two days
        F.slice(F.sort_array(F.collect_list(date), asc=False), 1, 2).alias("_two"),
        F.sum("day_net").alias("cum_net_spend"), F.sum("day_items").alias("cum_items"),
        F.sum("day_return_qty").alias("return_total"), F.sum("day_exchange_qty").alias("exchange_total"),
        *[F.max(F.col(f"day_{s}").cast("int")).alias(f"cum_{s}") for s in [*PN.SLOTS, "ecomm", "retail"]],
        F.sort_array(F.collect_set(F.when(physical, F.col("day_store")))).alias("stores"),
        known("day_department").alias("entry_department"), known("day_style").alias("first_product_style"),
        F.min_by("day_channel", date).alias("acq_channel"), F.min_by("day_store", date).alias("acq_store_raw"),
        F.max_by(F.struct(*LAST), date).alias("_last"),
    ).select("*", F.get("_two", F.lit(0)).alias("order_date"), F.get("_two", F.lit(1)).alias("prev_order_date"), "_last.*").select(*STATE)


def _merged(name: str) -> Column:
    """A column of the state after a stored state ``s`` and the state ``n`` of later days."""
    s, n = F.col(f"s.{name}"), F.col(f"n.{name}")
    if name in SUMS or name == "order_seq":
        return s + n
    if name in FLAGS:
        return F.greatest(s, n)                       # a null flag gives way
    if name == "stores":
        return F.sort_array(F.array_union(s, n))
    if name == "prev_order_date":
        return F.coalesce(n, F.col("s.order_date"))
    if name in FIRSTS:
        return F.coalesce(s, n)
    if name in ACQUIRED or name == "first_order_date":
        return s
    return n


def merge(stored: DataFrame, later: DataFrame) -> DataFrame:
    """The state after both; every day of ``later`` must lie behind its customer's stored ones."""
    both = stored.alias("s").join(later.alias("n"), F.col("s.customer_id") == F.col("n.customer_id"), "full")
    old, new = F.col("s.customer_id").isNotNull(), F.col("n.customer_id").isNotNull()
    return both.select(F.coalesce("s.customer_id", "n.customer_id").alias("customer_id"),
                       *[F.when(old & new, _merged(c)).when(old, F.col(f"s.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in STATE[1:]])


def update(stored: DataFrame, new_lines: DataFrame, history: DataFrame, products: DataFrame, p: Params) -> DataFrame:
    """The state after ``new_lines``, equal to ``state_of`` everything.

    ``history`` are the lines behind ``stored``; of them only those of
    customers with late lines are read by the rebuild.  Lines behind
    ``p.as_of`` are not taken.  No new lines leave the state as it is.  The new
    days and the customers with late ones are written, since several joins read
    them; so many as can be broadcast are, so that the history is not exchanged.
    """
    days = settle(PN.purchase_days(new_lines, products, p))
    last = stored.select("customer_id", F.col("order_date").alias("_last_day"))
    late = settle(days.join(last, "customer_id").where("order_date <= _last_day").select("customer_id").distinct())
    found = late.count()
    on_time = state_of(join_measured(days, late, "customer_id", "left_anti", found))
    again = join_measured(history.unionByName(new_lines), late, "customer_id", "left_semi", found)
    kept = join_measured(stored, late, "customer_id", "left_anti", found)
    return merge(kept, on_time).unionByName(state_of(PN.purchase_days(again, products, p)))


def latest_features(state: DataFrame, customers: DataFrame, p: Params) -> DataFrame:
    """C3 from the state: each customer's latest purchase-day with its features."""
    rows = (state.withColumn("next_order_date", F.lit(None).cast("date"))
            .withColumn("cum_return_prior", F.when(F.col("order_seq") > 1, F.col("return_total") - F.col("day_return_qty")))
            .withColumn("cum_exchange_prior", F.when(F.col("order_seq") > 1, F.col("exchange_total") - F.col("day_exchange_qty")))
            .withColumn("cum_distinct_physical_stores", F.size("stores").cast("bigint")))
    return PN.panel_features(rows, customers, p).select(*[c for c in PN.PANEL_COLUMNS if c not in PN.LABEL_COLUMNS])
