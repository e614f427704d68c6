"""The three canonical inputs, derived from the TPC-H-style test tables.

The mapping (channel, store, department, style, exotic flag, money columns)
is the fixture of FIXTURES.md section 5, written with DataFrame functions.
Only the columns each view needs are read, so the Parquet scans are pruned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custval.operators.joins import parts_for, spread


def _read(spark: SparkSession, sf_dir: str, name: str, cols) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def _dec(c: Column, p: int, s: int) -> Column:
    return c.cast(f"decimal({p},{s})")


def lines_parts(spark: SparkSession, sf_dir: str) -> int:
    """Partitions that the lines are dealt into (their number is in the files' footers)."""
    return parts_for(spark.read.parquet(f"{sf_dir}/lineitem.parquet").count())


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus"])
    od = _read(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
    pt = _read(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_type", "p_size"])
    # a task joins and rolls up so many lines at most, whatever their number
    n = lines_parts(spark, sf_dir)
    on_order, on_part = F.col("l_orderkey") == F.col("o_orderkey"), F.col("l_partkey") == F.col("p_partkey")
    if parts_for(pt.count()) > 1:
        # parts that may not be broadcast go first: the rollups by order need no exchange behind the join with the orders
        li = spread(li, n, "l_partkey").join(spread(pt, n, "p_partkey"), on_part)
        j = spread(li, n, "l_orderkey").join(spread(od, n, "o_orderkey"), on_order)
    else:
        j = spread(li, n, "l_orderkey").join(spread(od, n, "o_orderkey"), on_order).join(pt, on_part)

    okey, prio, ptype, psize = F.col("o_orderkey"), F.col("o_orderpriority"), F.col("p_type"), F.col("p_size")
    web = prio.isin("1-URGENT", "2-HIGH")
    channel = (F.when(okey % 97 == 0, F.lit(None).cast("string"))
                .when(web, "eComm").when(prio == "3-MEDIUM", "Retail")
                .when(prio == "4-NOT SPECIFIED", "Wholesale").otherwise("Event"))
    store = (F.when(web, "000 - Website").when(okey % 20 == 0, F.lit(None).cast("string"))
              .otherwise(F.concat(F.lpad((1 + okey % 25).cast("string"), 3, "0"), F.lit(" - Store"))))
    department = (F.when(psize == 50, F.lit(None).cast("string"))
                   .when(psize == 49, "(Not Provided)")
                   .when(ptype == "PROMO", "Men's Footwear")
                   .when(ptype == "ECONOMY", "Women's Footwear")
                   .when(ptype == "SMALL", "Kids' Footwear")
                   .when(ptype == "MEDIUM", "Accessories")
                   .when(ptype == "LARGE", "Men's Apparel")
                   .otherwise("Women's Apparel"))
    exotic = F.when(ptype.isin("PROMO", "ECONOMY", "MEDIUM"), F.col("p_partkey") % 8 == 0)
    qty = F.col("l_quantity")
    gross = _dec(F.col("l_extendedprice"), 12, 2)
    net = gross * _dec(1 - F.col("l_discount"), 4, 2)
    mult = _dec(F.when(F.col("o_custkey") % 5 == 0, F.lit(0.6)).when(F.col("o_custkey") % 5 == 1, F.lit(0.8))
                 .when(F.col("o_custkey") % 5 == 2, F.lit(1.0)).when(F.col("o_custkey") % 5 == 3, F.lit(1.3))
                 .otherwise(F.lit(1.7)), 2, 1)
    sign = F.when(okey % 50 == 0, F.lit(-1)).otherwise(F.lit(1))
    return j.select(
        F.col("o_custkey").alias("customer_id"),
        okey.alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supp_key"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        channel.alias("channel_type"),
        store.alias("store_name"),
        department.alias("department"),
        F.concat(F.col("p_brand"), F.lit("/"), psize.cast("string")).alias("style"),
        exotic.alias("is_exotic"),
        _dec(qty, 10, 0).alias("quantity"),
        _dec(F.when(F.col("l_returnflag") == "R", qty).otherwise(0), 10, 0).alias("return_quantity"),
        _dec(F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), qty).otherwise(0),
             10, 0).alias("exchanged_quantity"),
        gross.alias("gross_sales"),
        (-gross * _dec(F.col("l_discount"), 4, 2)).alias("discounts"),
        net.alias("net_sales"),
        (net * mult * sign).alias("order_value"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    pt = _read(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_size"])
    m = F.col("p_partkey") % 10
    status = (F.when(m == 0, "Discontinued").when(m == 1, "Never Launched")
               .when(m == 2, F.lit(None).cast("string")).otherwise("Active"))
    return pt.select(
        F.concat(F.col("p_brand"), F.lit("/"), F.col("p_size").cast("string")).alias("product_style"),
        status.alias("item_status"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    n = _read(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    k = F.col("c_nationkey")
    state = (F.when(k == 0, F.lit(None).cast("string")).when(k == 1, " n/a ")
              .when(k == 2, "Unknown").otherwise(F.concat(F.lit(" "), F.lower("n_name"))))
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .select(F.col("c_custkey").alias("customer_id"), state.alias("customer_state")))


@dataclass
class Inputs:
    lines: DataFrame
    products: DataFrame
    customers: DataFrame
    parts: int = 1         # that the lines, and what is rolled up from them by customer, are dealt into


def load_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(order_lines(spark, sf_dir), products(spark, sf_dir), customers(spark, sf_dir), lines_parts(spark, sf_dir))
