"""Sources and sinks: canonical tables, extract readers, score writers."""

from custval.sources.tables import (
    ORDER_LINE_SCHEMA, PRODUCT_SCHEMA, CUSTOMER_SCHEMA, require_columns, read_table,
)
from custval.sources.testdata import order_lines, products, customers, Inputs, load_inputs

__all__ = [
    "ORDER_LINE_SCHEMA", "PRODUCT_SCHEMA", "CUSTOMER_SCHEMA", "require_columns", "read_table",
    "order_lines", "products", "customers", "Inputs", "load_inputs",
]
