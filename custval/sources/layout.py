"""Order lines laid out for dated reruns: partitioned by order period, bucketed by customer.

A run as of a date reads only the periods it needs (the condition on the
period is on the partition column, so whole folders are left out), and jobs
that group or rank by customer need no exchange, because each bucket already
holds all of its customers' lines of a period and buckets of the same number
are read together.  A customer's lines meet in one task this way; where one
customer has a large part of all lines, the flat layout spreads them better.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PERIOD = "order_period"
GRAINS = ("year", "quarter", "month", "week")


def write_lines(lines: DataFrame, table: str, path: str, buckets: int = 256, grain: str = "month") -> None:
    """Write ``lines`` as the table ``table`` under the shared folder ``path``, one file per period and bucket.

    Lines without a date lie in a partition of their own and are in no run.
    Files hold a customer's lines together, in order.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain {grain}: one of {GRAINS}")
    (lines.withColumn(PERIOD, F.trunc("order_date", grain)).repartition(buckets, "customer_id")
     .write.mode("overwrite").format("parquet").option("path", path)
     .partitionBy(PERIOD).bucketBy(buckets, "customer_id").sortBy("customer_id", "order_date").saveAsTable(table))


def read_lines(spark: SparkSession, table: str, until: dt.date, since: dt.date | None = None, grain: str = "month") -> DataFrame:
    """The lines of ``since`` (or the beginning) up to ``until``, both included; only their periods are read."""
    if grain not in GRAINS:
        raise ValueError(f"grain {grain}: one of {GRAINS}")
    lines = spark.table(table).where((F.col(PERIOD) <= F.trunc(F.lit(until), grain)) & (F.col("order_date") <= F.lit(until)))
    if since is not None:
        lines = lines.where((F.col(PERIOD) >= F.trunc(F.lit(since), grain)) & (F.col("order_date") >= F.lit(since)))
    return lines.drop(PERIOD)
