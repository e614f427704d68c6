"""DuckDB statements for the exact part of the sketch reports."""

from __future__ import annotations

from custval.oracle import pltv as op
from custval.oracle.aov import R
from custval.oracle.fixtures import params_fmt, with_ctes

QS = (0.1, 0.25, 0.5, 0.75, 0.9)


def quantiles() -> str:
    B = params_fmt()["max_bucket"]
    asked = "\n  UNION ALL ".join(
        f"SELECT LEAST(order_seq, {B}) AS stage, risk_tier, '{m}' AS metric, CAST({q} AS DOUBLE) AS q, COUNT({m}) AS n, QUANTILE_CONT({m}, {q}) AS v "
        f"FROM scores GROUP BY ALL HAVING COUNT({m}) > 0" for m in ("remaining_pltv", "total_pltv") for q in QS)
    return op._q(f"""SELECT CAST(stage AS BIGINT) AS stage, risk_tier, metric, q, n, {R('v', 2)} AS exact, TRUE AS within_bound
FROM ({asked})""")


def distinct() -> str:
    from custval.oracle.hazard import panel_ctes
    f = params_fmt()
    lines = next(c for c in panel_ctes(True) if c.strip().startswith("order_lines"))
    counts = "\n  UNION ALL ".join(
        f"SELECT CAST(date_trunc('quarter', order_date) AS DATE) AS period, '{c}' AS counted, COUNT(DISTINCT {c}) AS exact "
        f"FROM order_lines WHERE order_date <= {f['as_of']} GROUP BY ALL" for c in ("customer_id", "style", "store_name"))
    return with_ctes(lines) + f"\nSELECT period, counted, exact, TRUE AS within_bound FROM ({counts})"
