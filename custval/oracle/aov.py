"""Oracle CTEs and statements for the order-value jobs (A-keys)."""

from __future__ import annotations

from custval.oracle.fixtures import ORDER_LINES, params_fmt, with_ctes
from custval.params import DEFAULT, Params


def R(expr: str, n: int = 6) -> str:
    """Rounded double; '+ 0.0' folds a negative zero into +0.0."""
    return f"(ROUND(CAST({expr} AS DOUBLE) * 1e{n}) / 1e{n} + 0.0)"


def orders_ctes(ceiling_key: str = "ceiling", p: Params = DEFAULT) -> list[str]:
    """order_lines -> cohort -> primary-department positive orders (``aov_orders``)."""
    f = params_fmt(p)
    ceiling = f[ceiling_key]
    return [ORDER_LINES, f"""
aov_lines AS (
  SELECT customer_id, order_id, order_date, COALESCE(department, 'Unassigned') AS dept,
         COALESCE(is_exotic, FALSE) AS is_exotic, order_value
  FROM order_lines WHERE customer_id > 0 AND channel_type NOT IN ({f['aov_excl']}) AND order_date <= {f['as_of']})""", f"""
aov_first AS (SELECT customer_id, MIN(order_date) AS first_order_date FROM aov_lines GROUP BY customer_id)""", f"""
aov_cohort AS (SELECT customer_id, first_order_date FROM aov_first
               WHERE first_order_date >= {f['floor']} AND first_order_date <= {ceiling})""", """
aov_dept AS (
  SELECT customer_id, order_id, dept, MIN(order_date) AS order_date, COUNT(*) AS dept_lines,
         SUM(order_value) AS dept_rev, BOOL_OR(is_exotic) AS dept_exotic
  FROM aov_lines WHERE customer_id IN (SELECT customer_id FROM aov_cohort)
  GROUP BY customer_id, order_id, dept)""", """
aov_dept_ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id, order_id
                               ORDER BY dept_lines DESC, dept_rev DESC, dept) AS rk
  FROM aov_dept)""", """
aov_orders AS (
  SELECT customer_id, order_id, MIN(order_date) AS order_date,
         MAX(CASE WHEN rk = 1 THEN dept END) AS order_department,
         BOOL_OR(dept_exotic) AS order_is_exotic, SUM(dept_rev) AS order_value
  FROM aov_dept_ranked GROUP BY customer_id, order_id HAVING SUM(dept_rev) > 0)"""]


def cells_cte(src: str = "aov_orders", name: str = "cells") -> str:
    return f"""
{name}_raw AS (
  SELECT customer_id, order_department, order_is_exotic, COUNT(*) AS n_orders,
         SUM(LN(order_value)) AS sum_log_value, SUM(LN(order_value) * LN(order_value)) AS sum_log_value_sq,
         CAST(SUM(order_value) AS DOUBLE) AS sum_value, MIN(order_date) AS cell_first
  FROM {src} GROUP BY customer_id, order_department, order_is_exotic),
{name} AS (
  SELECT customer_id, order_department, order_is_exotic, n_orders, sum_log_value, sum_log_value_sq, sum_value,
         CAST(SUM(n_orders) OVER (PARTITION BY customer_id) AS BIGINT) AS cust_total_orders,
         BOOL_OR(order_is_exotic) OVER (PARTITION BY customer_id) AS buys_exotic,
         MIN(cell_first) OVER (PARTITION BY customer_id) AS first_order_date
  FROM {name}_raw)"""


def production_cells(p: Params = DEFAULT) -> list[str]:
    return orders_ctes("ceiling", p) + [cells_cte()]


def holdout_cells_ctes(p: Params = DEFAULT) -> list[str]:
    f = params_fmt(p)
    return orders_ctes("train_cutoff", p) + [f"""
train_orders AS (SELECT * FROM aov_orders WHERE order_date <= {f['train_cutoff']})""", f"""
test_actuals AS (
  SELECT customer_id, COUNT(*) AS test_n_orders, CAST(SUM(order_value) AS DOUBLE) AS test_sum_value,
         SUM(LN(order_value)) AS test_sum_log_value
  FROM aov_orders WHERE order_date > {f['train_cutoff']} AND order_date <= {f['test_end']}
  GROUP BY customer_id)""", cells_cte("train_orders", "train_cells"), """
cells AS (
  SELECT t.*, COALESCE(a.test_n_orders, 0) AS test_n_orders, COALESCE(a.test_sum_value, 0.0) AS test_sum_value,
         a.test_sum_log_value
  FROM train_cells t LEFT JOIN test_actuals a USING (customer_id))"""]


CELL_SELECT = f"""
SELECT customer_id, order_department, order_is_exotic, n_orders,
       {R('sum_log_value')} AS sum_log_value, {R('sum_log_value_sq')} AS sum_log_value_sq,
       {R('sum_value', 5)} AS sum_value, cust_total_orders, buys_exotic, first_order_date"""


def sql_aov_cells() -> str:
    return with_ctes(*production_cells()) + CELL_SELECT + " FROM cells"


def sql_holdout_cells() -> str:
    return (with_ctes(*holdout_cells_ctes()) + CELL_SELECT +
            f", test_n_orders, {R('test_sum_value', 5)} AS test_sum_value,"
            f" {R('test_sum_log_value')} AS test_sum_log_value FROM cells")


def sql_order_primary() -> str:
    return with_ctes(*orders_ctes("ceiling")) + f"""
SELECT customer_id, order_id, order_date, order_department, order_is_exotic,
       {R('order_value', 5)} AS order_value FROM aov_orders"""


def sql_customer_totals() -> str:
    return with_ctes(*orders_ctes("ceiling")) + """
SELECT customer_id, COUNT(*) AS cust_total_orders, MIN(order_date) AS first_order_date,
       BOOL_OR(order_is_exotic) AS buys_exotic
FROM aov_orders GROUP BY customer_id"""


def sql_acquisition_cohort() -> str:
    return with_ctes(*orders_ctes("ceiling")) + " SELECT customer_id, first_order_date FROM aov_cohort"


def sql_holdout_actuals() -> str:
    return with_ctes(*holdout_cells_ctes()) + f"""
SELECT customer_id, test_n_orders, {R('test_sum_value', 5)} AS test_sum_value,
       {R('test_sum_log_value')} AS test_sum_log_value FROM test_actuals"""
