"""DuckDB statements for the category statistics of the hazard model."""

from __future__ import annotations

from custval.oracle.curve import split_case
from custval.oracle.aov import R
from custval.oracle.fixtures import with_ctes
from custval.oracle.hazard import panel_ctes

FEATURES = ["this_order_department", "this_order_style", "this_order_channel", "this_order_store", "order_month", "entry_department",
            "first_product_style", "acq_channel", "acq_store", "customer_state"]


def _fit_ctes() -> list[str]:
    melted = "\n  UNION ALL ".join(
        f"SELECT customer_id, order_date, churned_400d AS y, '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), 'missing') AS value FROM fit_rows"
        for c in FEATURES)
    return [*panel_ctes(True),
            f"fit_rows AS (SELECT * FROM (SELECT *, {split_case()} AS split FROM panel) WHERE split = 'fit' AND churned_400d IS NOT NULL)",
            "overall AS (SELECT avg(churned_400d) AS prior FROM fit_rows)",
            f"melted AS ({melted})"]


def sql_ordered_means() -> str:
    return with_ctes(*_fit_ctes()) + f"""
SELECT customer_id, order_date, feature, value, n_before, positives_before,
  {R('(positives_before + 20.0 * prior) / (n_before + 20.0)', 8)} AS mean
FROM (SELECT customer_id, order_date, feature, value, CAST(count(y) OVER earlier AS BIGINT) AS n_before,
        CAST(coalesce(sum(y) OVER earlier, 0) AS BIGINT) AS positives_before
      FROM melted
      WINDOW earlier AS (PARTITION BY feature, value ORDER BY md5(customer_id || '|' || order_date || '|ordered_1')
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), overall"""


def sql_category_means() -> str:
    return with_ctes(*_fit_ctes()) + f"""
SELECT feature, value, n, positives, {R('(positives + 20.0 * prior) / (n + 20.0)', 8)} AS mean
FROM (SELECT feature, value, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives FROM melted GROUP BY feature, value), overall"""
