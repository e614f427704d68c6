"""CSV extract readers.

Columns are found by the header, not by place; a file whose header differs from
the others', a missing required column, a row of the wrong length or a value of
the wrong type is an error.  All-null rows are dropped, and columns that are
NULL everywhere are removed after one aggregate pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custval.functions.exprs import truthy_flag
from custval.plans.hazard.panel import LABEL_COLUMNS, PANEL_COLUMNS
from custval.sources.tables import require_columns

AOV_CELL_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("order_department", T.StringType()),
    T.StructField("order_is_exotic", T.StringType()),     # text flags arrive as "True"/"true"/1/"t"
    T.StructField("n_orders", T.LongType()),
    T.StructField("sum_log_value", T.DoubleType()),
    T.StructField("sum_log_value_sq", T.DoubleType()),
    T.StructField("sum_value", T.DoubleType()),
    T.StructField("cust_total_orders", T.LongType()),
    T.StructField("buys_exotic", T.StringType()),
    T.StructField("first_order_date", T.DateType()),
])
HOLDOUT_CELL_SCHEMA = T.StructType([*AOV_CELL_SCHEMA.fields,
                                    T.StructField("test_n_orders", T.LongType()),
                                    T.StructField("test_sum_value", T.DoubleType()),
                                    T.StructField("test_sum_log_value", T.DoubleType())])
EXPECTED_AOV_SCHEMA = T.StructType([T.StructField("customer_id", T.LongType()), T.StructField("expected_aov", T.DoubleType())])
SCORE_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()), T.StructField("order_seq", T.LongType()),
    *[T.StructField(c, T.DoubleType()) for c in ("churn_prob", "p_repeat")], T.StructField("risk_tier", T.StringType()),
    *[T.StructField(c, T.DoubleType()) for c in ("expected_future_orders", "realized_value", "expected_aov", "remaining_pltv", "total_pltv")]])

_PANEL_DATES = {"order_date", "next_order_date"}
_PANEL_LONGS = {"customer_id", "order_seq", "days_to_next_order", "churned_400d", "days_since_first_order", "days_since_prev_order",
                "cum_distinct_depts", "cum_distinct_physical_stores", "order_month"}
_PANEL_TEXT = {"this_order_department", "this_order_style", "this_order_channel", "this_order_store", "entry_department",
               "first_product_style", "acq_channel", "acq_store", "customer_state"}
PANEL_FLAGS = ("paid_full_price", "cum_bought_cross_gender", "cum_footwear_plus_nonfootwear", "cum_ever_ecomm", "cum_ever_retail",
               "cum_both_channels", "state_missing")


def _panel_type(c: str) -> T.DataType:
    if c in _PANEL_DATES:
        return T.DateType()
    if c in _PANEL_LONGS:
        return T.LongType()
    return T.StringType() if c in _PANEL_TEXT or c in PANEL_FLAGS else T.DoubleType()


PANEL_SCHEMA = T.StructType([T.StructField(c, _panel_type(c)) for c in PANEL_COLUMNS])
SCORING_SCHEMA = T.StructType([f for f in PANEL_SCHEMA.fields if f.name not in LABEL_COLUMNS])


@dataclass(frozen=True)
class Extract:
    schema: T.StructType
    required: tuple = ()
    flags: tuple = ()
    fill: dict = field(default_factory=dict)


_CELL_KEYS = ("customer_id", "order_department", "order_is_exotic", "n_orders", "sum_log_value", "sum_log_value_sq")
#: the extracts that a build reads and the tables that it writes, by name
EXTRACTS = {
    "aov_cells": Extract(AOV_CELL_SCHEMA, _CELL_KEYS, ("order_is_exotic", "buys_exotic"), {"order_department": "Unassigned"}),
    "holdout_cells": Extract(HOLDOUT_CELL_SCHEMA, (*_CELL_KEYS, "test_n_orders", "test_sum_value"), ("order_is_exotic", "buys_exotic"),
                             {"order_department": "Unassigned", "test_n_orders": 0, "test_sum_value": 0.0}),
    "expected_aov": Extract(EXPECTED_AOV_SCHEMA, ("customer_id", "expected_aov")),
    "scores": Extract(SCORE_SCHEMA, ("customer_id", "order_seq", "churn_prob", "remaining_pltv", "total_pltv")),
    "churn_panel": Extract(PANEL_SCHEMA, ("customer_id", "order_date", "order_seq", "churned_400d"), PANEL_FLAGS),
    "scoring": Extract(SCORING_SCHEMA, ("customer_id", "order_seq", "cum_net_spend"), PANEL_FLAGS),
}


def drop_empty(df: DataFrame) -> DataFrame:
    """Drop rows that are entirely NULL, then columns that are entirely NULL."""
    rows = df.dropna(how="all")
    counts = rows.agg(*[F.count(F.col(c)).alias(c) for c in rows.columns]).first().asDict()
    return rows.select(*[c for c in rows.columns if counts[c] > 0])


def _typed(name: str, kind: T.DataType) -> Column:
    """A text column as ``kind``; text that is not one fails the read."""
    text = F.trim(F.col(name))
    value = F.nullif(text, F.lit("")).try_cast(kind)
    bad = F.raise_error(F.concat(F.lit(f"not a {kind.simpleString()} in column {name}: "), text)).cast(kind)
    return F.when(text.isNull() | (text == "") | value.isNotNull(), value).otherwise(bad).alias(name)


def load_extract(spark: SparkSession, path: str, schema: T.StructType, required=(),
                 flags=(), fill: dict | None = None) -> DataFrame:
    """Read a header CSV extract by its column names; check ``required`` ones;
    normalise ``flags`` to 0/1 integers; fill NULLs per ``fill``."""
    raw = spark.read.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    require_columns(raw, required, path)
    df = drop_empty(raw.select(*[_typed(f.name, f.dataType) for f in schema.fields if f.name in raw.columns]))
    require_columns(df, required, f"{path} (a required column is empty)")
    for c in flags:
        if c in df.columns:
            df = df.withColumn(c, truthy_flag(c))
    if fill:
        df = df.fillna({k: v for k, v in fill.items() if k in df.columns})
    return df


def read_extract(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One of ``EXTRACTS`` from CSV."""
    e = EXTRACTS[name]
    return load_extract(spark, path, e.schema, e.required, e.flags, e.fill)


def load_aov_cells(spark: SparkSession, path: str) -> DataFrame:
    """The order-value cell extract, flags as 0/1 and a missing department 'Unassigned'."""
    return read_extract(spark, path, "aov_cells")
