"""Extract round trip (S4, P4): cells written as a CSV extract and read back."""

from __future__ import annotations

import uuid

from custval.oracle import aov as osql
from custval.oracle.fixtures import with_ctes
from custval.params import DEFAULT as P
from custval.plans.aov import cells as C
from custval.registry import register, rounded
from custval.session import ensure_checkpoint_dir
from custval.sources.extracts import load_aov_cells
from custval.sources.sinks import write_table
from custval.sources.testdata import order_lines


def _sql() -> str:
    return with_ctes(*osql.production_cells()) + f"""
SELECT customer_id, order_department, CAST(order_is_exotic AS BIGINT) AS order_is_exotic, n_orders,
       {osql.R('sum_log_value')} AS sum_log_value, {osql.R('sum_log_value_sq')} AS sum_log_value_sq,
       {osql.R('sum_value', 5)} AS sum_value, cust_total_orders, CAST(buys_exotic AS BIGINT) AS buys_exotic,
       first_order_date FROM cells"""


@register("aov_cells_from_extract", _sql)
def aov_cells_from_extract(spark, sf_dir):
    """Cells exported as a header CSV to the shared checkpoint folder, then loaded
    through the extract reader (empty rows/columns dropped, flags to 0/1)."""
    path = f"{ensure_checkpoint_dir(spark)}/extract-aov-cells-{uuid.uuid4().hex}"
    write_table(C.aov_cells(order_lines(spark, sf_dir), P), path, "csv")
    return rounded(load_aov_cells(spark, path), {"sum_value": 5})
