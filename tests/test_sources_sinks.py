"""Extract reader, required-column check and sinks."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from custval.sources.extracts import EXTRACTS, drop_empty, load_aov_cells, read_extract
from custval.sources.sinks import json_payload, write_expected_aov, write_table
from custval.sources.tables import MissingColumns, ORDER_LINE_SCHEMA, read_table, require_columns


def test_truthy_flags_and_empty_rows_and_columns(spark):
    d = tempfile.mkdtemp(prefix="custval-test-")
    path = os.path.join(d, "cells.csv")
    with open(path, "w") as fh:
        fh.write("customer_id,order_department,order_is_exotic,n_orders,sum_log_value,sum_log_value_sq,"
                 "sum_value,cust_total_orders,buys_exotic,first_order_date\n")
        fh.write("1,,True,2,10.0,50.0,300.0,2,t,1999-01-01\n")
        fh.write("2,Kids,0,1,5.0,25.0,150.0,1,yes,\n")
        fh.write(",,,,,,,,,\n")
    df = load_aov_cells(spark, path).orderBy("customer_id").toPandas()
    assert len(df) == 2
    assert list(df.order_is_exotic) == [1, 0] and list(df.buys_exotic) == [1, 1]
    assert df.order_department.iloc[0] == "Unassigned"


def test_drop_empty_removes_all_null_columns(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b string")
    assert drop_empty(df).columns == ["a"]


def test_required_columns_fail_before_any_action(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(MissingColumns):
        require_columns(df, ["a", "b"])


def test_read_table_projects_to_schema(spark):
    d = tempfile.mkdtemp(prefix="custval-test-")
    rows = [(1, 2, 1, 3, 4, None, "eComm", None, None, "S/1", None, None, None, None, None, None, None, None)]
    spark.createDataFrame(rows, ORDER_LINE_SCHEMA).withColumn("extra", F.lit(1)).write.parquet(d + "/t")
    back = read_table(spark, d + "/t", ORDER_LINE_SCHEMA)
    assert back.columns == ORDER_LINE_SCHEMA.fieldNames()


def test_sinks_write_and_json_payload(spark):
    d = tempfile.mkdtemp(prefix="custval-test-")
    df = spark.createDataFrame([(1, 10.0), (2, 20.0)], "customer_id long, expected_aov double")
    write_expected_aov(df, d + "/aov")
    assert spark.read.parquet(d + "/aov").count() == 2
    write_table(df, d + "/csv", "csv")
    assert spark.read.option("header", True).csv(d + "/csv").count() == 2
    payload = json_payload(df, "aov").first()
    assert payload.payload == "aov" and len(json.loads(payload.json)) == 2


HEADER = "sum_log_value_sq,sum_log_value,customer_id,order_department,order_is_exotic,n_orders"


def _csv(*lines):
    path = os.path.join(tempfile.mkdtemp(prefix="custval-test-"), "cells.csv")
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_columns_are_read_by_name(spark):
    row = load_aov_cells(spark, _csv(HEADER, "50.0,10.0,1,Kids,t,2")).first()
    assert (row.sum_log_value, row.sum_log_value_sq, row.customer_id, row.n_orders) == (10.0, 50.0, 1, 2)


def test_a_missing_column_and_a_bad_value_fail(spark):
    with pytest.raises(MissingColumns):
        load_aov_cells(spark, _csv(HEADER.replace("n_orders", "orders"), "50.0,10.0,1,Kids,t,2"))
    with pytest.raises(Exception, match="not a bigint in column n_orders: x2"):
        load_aov_cells(spark, _csv(HEADER, "50.0,10.0,1,Kids,t,x2")).collect()
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        load_aov_cells(spark, _csv(HEADER, "50.0,10.0,1,Kids,t,2,9,9")).collect()


def test_every_extract_reads_what_it_names(spark):
    for name, e in EXTRACTS.items():
        values = {"date": "2001-01-02", "string": "true", "bigint": "7", "double": "1.5"}
        path = _csv(",".join(e.schema.fieldNames()), ",".join(values[f.dataType.simpleString()] for f in e.schema.fields))
        df = read_extract(spark, path, name)
        assert df.columns == e.schema.fieldNames() and df.count() == 1, name


def test_partitioned_lines_prune_and_spare_exchanges(spark):
    """Periods behind the run date are not read, the panel needs fewer exchanges, and equals that of the flat lines."""
    import re
    from dataclasses import replace

    from custval.params import DEFAULT
    from custval.plans.hazard import panel as PN
    from custval.queries import hazard_q as H
    from custval.sources.layout import read_lines
    from tests.tables import SF_SMALL

    p = replace(DEFAULT, as_of=DEFAULT.as_of.replace(year=DEFAULT.as_of.year - 2))
    i = H.load_inputs(spark, SF_SMALL)
    laid = H.laid_out_lines(spark, SF_SMALL, p)
    assert laid.columns == i.lines.columns
    flat = PN.cohort_panel(i.lines, i.products, i.customers, p)
    dealt = PN.cohort_panel(laid, i.products, i.customers, p, bucketed=True)
    assert flat.exceptAll(dealt).isEmpty() and dealt.exceptAll(flat).isEmpty() and flat.count() > 0

    def plan(df):
        return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    tree = lambda df: len(re.findall(r"[-+:] Exchange", plan(df).split("\n\n")[0]))
    assert "PartitionFilters: [isnotnull(order_period" in plan(laid)
    lines_only = lambda f, b: PN.cumulative_state(PN.purchase_days(f, i.products, p), b)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        exchanges = [tree(lines_only(f, b)) for f, b in ((laid.cache().unpersist(), False), (laid, True))]
        assert exchanges[1] < exchanges[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    files = {r[0] for r in laid.select(F.input_file_name()).distinct().collect()}
    years = {int(re.search(r"order_period=(\d{4})", f).group(1)) for f in files}
    assert years and max(years) <= p.as_of.year
    table = next(v for k, v in H._LAYOUTS.items() if k[1] == SF_SMALL)
    some = read_lines(spark, table, p.as_of, p.as_of.replace(day=1), H.LAYOUT_GRAIN)
    want = i.lines.where((F.col("order_date") <= F.lit(p.as_of)) & (F.col("order_date") >= F.lit(p.as_of.replace(day=1))))
    assert some.exceptAll(want).isEmpty() and some.count() == want.count()
    with pytest.raises(ValueError, match="grain"):
        read_lines(spark, table, p.as_of, grain="hour")
