"""Canonical schemas of the three inputs and a column-checked reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER_LINE_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("line_no", T.IntegerType()),
    T.StructField("part_key", T.LongType()),
    T.StructField("supp_key", T.LongType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("channel_type", T.StringType()),
    T.StructField("store_name", T.StringType()),
    T.StructField("department", T.StringType()),
    T.StructField("style", T.StringType()),
    T.StructField("is_exotic", T.BooleanType()),
    T.StructField("quantity", T.DecimalType(10, 0)),
    T.StructField("return_quantity", T.DecimalType(10, 0)),
    T.StructField("exchanged_quantity", T.DecimalType(10, 0)),
    T.StructField("gross_sales", T.DecimalType(12, 2)),
    T.StructField("discounts", T.DecimalType(18, 4)),
    T.StructField("net_sales", T.DecimalType(18, 4)),
    T.StructField("order_value", T.DecimalType(24, 5)),
])

PRODUCT_SCHEMA = T.StructType([
    T.StructField("product_style", T.StringType()),
    T.StructField("item_status", T.StringType()),
])

CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("customer_state", T.StringType()),
])


class MissingColumns(ValueError):
    pass


def require_columns(df: DataFrame, columns, what: str = "input") -> DataFrame:
    """Fail before any action if ``df`` lacks a required column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"{what} is missing columns {missing}; has {df.columns}")
    return df


def read_table(spark: SparkSession, path: str, schema: T.StructType,
               fmt: str = "parquet") -> DataFrame:
    """Read a canonical table and project it to ``schema`` (pruned, typed).

    Only the schema's columns reach the scan, so Parquet reads just those.
    """
    df = spark.read.format(fmt).load(path)
    require_columns(df, schema.fieldNames(), path)
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
