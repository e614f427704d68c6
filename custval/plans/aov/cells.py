"""Order-value cells.

Grain chain: consumer lines -> (customer, order, department) -> order with one
primary department -> (customer, department, exotic) cell with log-scale
sufficient statistics.  Every step is a partial+final hash aggregate, so a
customer with a huge history never lands whole in one task; the only window
runs on the cell grain, which is bounded per customer by the number of
(department, exotic) combinations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custval.operators.joins import join_hot
from custval.operators.persist import materialize
from custval.params import Params

ORDER_COLS = ["customer_id", "order_id", "order_date", "order_department", "order_is_exotic", "order_value"]


def consumer_lines(lines: DataFrame, excluded) -> DataFrame:
    """Registered customers, consumer channels (a NULL channel is dropped)."""
    return lines.where((F.col("customer_id") > 0) & ~F.col("channel_type").isin(*excluded))


def all_orders(lines: DataFrame, p: Params, last_date: bool = False) -> DataFrame:
    """Every in-scope order up to ``as_of`` with its primary department and value
    (before the positivity filter).  One scan of the lines: (customer, order, department)
    -> order, both partial+final aggregates.

    Primary department = most lines, then most revenue, then name ascending.
    ``last_date`` adds the order's last line date.
    """
    base = consumer_lines(lines, p.aov_excluded).where(F.col("order_date") <= F.lit(p.as_of)).select(
        "customer_id", "order_id", "order_date",
        F.coalesce("department", F.lit("Unassigned")).alias("dept"),
        F.coalesce("is_exotic", F.lit(False)).alias("is_exotic"),
        "order_value")
    per_dept = base.groupBy("customer_id", "order_id", "dept").agg(
        F.min("order_date").alias("order_date"),
        F.count(F.lit(1)).alias("dept_lines"),
        F.sum("order_value").alias("dept_rev"),
        F.bool_or("is_exotic").alias("dept_exotic"),
        *([F.max("order_date").alias("last_date")] if last_date else []))
    rank_key = F.struct(-F.col("dept_lines"), -F.col("dept_rev"), F.col("dept"))
    return per_dept.groupBy("customer_id", "order_id").agg(
        F.min("order_date").alias("order_date"),
        F.min_by("dept", rank_key).alias("order_department"),
        F.bool_or("dept_exotic").alias("order_is_exotic"),
        F.sum("dept_rev").alias("order_value"),
        *([F.max("last_date").alias("last_date")] if last_date else []))


def cohort_of(orders: DataFrame, p: Params, ceiling) -> DataFrame:
    """A4: first order date over all in-scope orders (= lines), kept if in [floor, ceiling]."""
    first = orders.groupBy("customer_id").agg(F.min("order_date").alias("first_order_date"))
    return first.where(F.col("first_order_date").between(F.lit(p.order_floor), F.lit(ceiling)))


def acquisition_cohort(lines: DataFrame, p: Params, ceiling) -> DataFrame:
    return cohort_of(all_orders(lines, p), p, ceiling)


def positive(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_value") > 0)


def primary_orders(orders: DataFrame, cohort: DataFrame) -> DataFrame:
    """Positive ones of ``orders`` whose customer is in the cohort; a customer with very many orders is dealt over several tasks."""
    return join_hot(positive(orders), cohort.select("customer_id"), ["customer_id"], "left_semi", salt_by=["order_id"])


def order_primary(lines: DataFrame, cohort: DataFrame, p: Params) -> DataFrame:
    """Positive orders of cohort customers (order grain, semi join on customer); the orders are rolled up and written once."""
    return primary_orders(materialize(all_orders(lines, p)), cohort)


def _cohort_orders(lines: DataFrame, p: Params, ceiling) -> DataFrame:
    """A1a with the cohort taken from the same rollup."""
    orders = materialize(all_orders(lines, p))
    return primary_orders(orders, cohort_of(orders, p, ceiling))


def _in_cohort(first_any, p: Params, ceiling):
    """A4 on a customer's first in-scope order date."""
    return first_any.between(F.lit(p.order_floor), F.lit(ceiling))


def customer_totals(orders: DataFrame, p: Params, ceiling) -> DataFrame:
    """Per cohort customer positive orders, first positive order date, ever-exotic -- one pass over all in-scope orders."""
    pos = F.col("order_value") > 0
    t = orders.groupBy("customer_id").agg(
        F.min("order_date").alias("first_any"),
        F.count_if(pos).alias("cust_total_orders"),
        F.min(F.when(pos, F.col("order_date"))).alias("first_order_date"),
        F.bool_or(F.when(pos, F.col("order_is_exotic"))).alias("buys_exotic"))
    return t.where(_in_cohort(F.col("first_any"), p, ceiling) & (F.col("cust_total_orders") > 0)).drop("first_any")


def aov_orders(lines: DataFrame, p: Params) -> DataFrame:
    return _cohort_orders(lines, p, p.join_ceiling)


def cell_table(orders: DataFrame, p: Params, ceiling, holdout: bool = False) -> DataFrame:
    """Cells of cohort customers from ALL in-scope orders, in one aggregate.

    Conditional aggregates keep the positive (and, for the holdout, TRAIN)
    order statistics per cell together with the earliest date of any order;
    a window on the cell grain (bounded per customer) then applies the cohort
    bounds and adds customer totals.  The lines are read once -- no semi join
    back to the order or line grain.
    """
    val, date = F.col("order_value"), F.col("order_date")
    keep = val > 0
    if holdout:
        test = keep & (date > F.lit(p.train_cutoff)) & (date <= F.lit(p.test_end))
        keep = keep & (date <= F.lit(p.train_cutoff))
    lv = F.ln(val.cast("double"))
    aggs = [
        F.count_if(keep).alias("n_orders"),
        F.sum(F.when(keep, lv)).alias("sum_log_value"),
        F.sum(F.when(keep, lv * lv)).alias("sum_log_value_sq"),
        F.sum(F.when(keep, val)).alias("sum_value_dec"),
        F.min(F.when(keep, date)).alias("cell_first_date"),
        F.min(date).alias("any_first_date"),
    ]
    if holdout:
        aggs += [F.count_if(test).alias("cell_test_n"), F.sum(F.when(test, val)).alias("cell_test_sum"),
                 F.sum(F.when(test, lv)).alias("cell_test_log")]
    cells = orders.groupBy("customer_id", "order_department", "order_is_exotic").agg(*aggs)
    w = Window.partitionBy("customer_id")
    cols = [
        "customer_id", "order_department", "order_is_exotic", "n_orders",
        "sum_log_value", "sum_log_value_sq",
        F.col("sum_value_dec").cast("double").alias("sum_value"),
        F.sum("n_orders").over(w).alias("cust_total_orders"),
        F.max(F.when(F.col("n_orders") > 0, F.col("order_is_exotic"))).over(w).alias("buys_exotic"),
        F.min("cell_first_date").over(w).alias("first_order_date"),
        F.min("any_first_date").over(w).alias("cohort_first_date"),
    ]
    if holdout:
        cols += [F.sum("cell_test_n").over(w).cast("bigint").alias("test_n_orders"),
                 F.coalesce(F.sum("cell_test_sum").over(w).cast("double"), F.lit(0.0)).alias("test_sum_value"),
                 F.sum("cell_test_log").over(w).alias("test_sum_log_value")]
    t = cells.select(*cols)
    t = t.where(F.col("cohort_first_date").between(F.lit(p.order_floor), F.lit(ceiling))
                & (F.col("n_orders") > 0))
    return t.drop("cohort_first_date")


def aov_cells(lines: DataFrame, p: Params) -> DataFrame:
    """A1: production cells for customers acquired in [floor, join ceiling]."""
    return cell_table(all_orders(lines, p), p, p.join_ceiling)


def holdout_orders(lines: DataFrame, p: Params) -> DataFrame:
    """Positive orders of customers acquired by the train cutoff (holdout cohort)."""
    return _cohort_orders(lines, p, p.train_cutoff)


def holdout_actuals(orders: DataFrame, p: Params) -> DataFrame:
    """A5: per cohort customer TEST-window actuals (cutoff, end] -- one pass over all in-scope orders."""
    test = ((F.col("order_value") > 0) & (F.col("order_date") > F.lit(p.train_cutoff)) & (F.col("order_date") <= F.lit(p.test_end)))
    value = F.when(test, F.col("order_value"))
    t = orders.groupBy("customer_id").agg(
        F.min("order_date").alias("first_any"),
        F.count_if(test).alias("test_n_orders"),
        F.sum(value).cast("double").alias("test_sum_value"),
        F.sum(F.ln(value.cast("double"))).alias("test_sum_log_value"))
    return t.where(_in_cohort(F.col("first_any"), p, p.train_cutoff) & (F.col("test_n_orders") > 0)).drop("first_any")


def holdout_cells(lines: DataFrame, p: Params) -> DataFrame:
    """A2: cells on TRAIN orders plus each customer's TEST actuals.

    Non-returners keep test_n_orders 0, test_sum_value 0.0, test_sum_log_value NULL.
    """
    return cell_table(all_orders(lines, p), p, p.train_cutoff, holdout=True)
