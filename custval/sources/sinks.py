"""Sinks (S6-S10): score tables, expected AOV, live scores and JSON payloads.

All writers go through the DataFrame writer (partitioned files, written by the
executors); nothing is collected to the driver first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=()) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_expected_aov(customers: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One row per customer: customer_id, expected_aov."""
    write_table(customers.select("customer_id", "expected_aov"), path, fmt)


def write_live_scores(live: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Latest-order churn scores with tiers."""
    write_table(live, path, fmt, partition_by=("risk_tier",))


def json_payload(df: DataFrame, name: str) -> DataFrame:
    """A small report as one JSON document (array of row objects).

    Only for report-sized tables (bins, tiers, stages): the rows are gathered
    into one value by a single aggregate, ordered by their columns from the left.
    """
    return df.agg(F.to_json(F.sort_array(F.collect_list(F.struct(*df.columns)))).alias("json")).select(
        F.lit(name).alias("payload"), "json")
