"""Tasks of bounded size, one panel and one rollup for several dates: the same rows as before, from less work."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest

from custval.operators import joins
from custval.params import DEFAULT as P
from custval.plans.aov import cells as C
from custval.plans.hazard import panel as PN
from custval.plans.hazard import state as ST
from custval.plans.pltv.validate import cutoff_params
from custval.queries import aov_q, hazard_q
from custval.sources import tables as T
from custval.sources import testdata as TD


@pytest.fixture(scope="module")
def inputs(spark):
    """Lines of 30 customers before, around and behind the cutoff; an order with lines on both sides of it; a late one."""
    def line(c, o, n, day, dept="Accessories"):
        v = Decimal(10 + (c * 7 + o + n) % 23)
        return (c, o, n, 1, 1, day, "Retail" if c % 2 else "eComm", f"{c % 4:03d} - Store", dept, "A/1" if c % 3 else "B/2", n == 1, Decimal(1), Decimal(0), Decimal(0), v, Decimal(0), v, v)
    rows = [line(c, 100 * c + k, n, dt.date(1996, 1, 1) + dt.timedelta(days=(c * 37 + k * 211) % 2030), "Men's Footwear" if n else None)
            for c in range(1, 31) for k in range(7) for n in (1, 2)]
    rows += [line(1, 9_000, 1, P.train_cutoff), line(1, 9_000, 2, P.train_cutoff + dt.timedelta(days=20))]
    products = spark.createDataFrame([("A/1", "Active"), ("B/2", "Discontinued")], T.PRODUCT_SCHEMA)
    customers = spark.createDataFrame([(c, "ohio" if c % 2 else None) for c in range(1, 31)], T.CUSTOMER_SCHEMA)
    return spark.createDataFrame(rows, T.ORDER_LINE_SCHEMA), products, customers


def same(a, b):
    return a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_partitions_grow_with_the_rows(spark):
    few = joins.TASK_ROWS * joins.OWN_PARTS
    assert joins.parts_for(0) == joins.parts_for(few) == 1 and joins.parts_for(10 * few) == 10 * joins.OWN_PARTS
    df = spark.range(1000)
    assert joins.spread(df, 1, "id") is df
    assert joins.spread(df, 37, "id").rdd.getNumPartitions() == 37              # the adaptive rules leave it


@pytest.mark.parametrize("many_parts", [False, True])
def test_lines_dealt_into_tasks_are_the_same_lines(spark, tmp_path, monkeypatch, many_parts):
    """Null and repeated keys as before, with parts that may be broadcast and with many."""
    k = lambda i, m: None if i % 19 == 0 else i % m
    t = dt.datetime(1996, 5, 1)
    data = {"lineitem": ([(k(i, 60), i % 4, k(i, 25), 1, 2.0, 10.0 + i, 0.1, "R", "F") for i in range(300)],
                         "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string"),
            "orders": ([(k(i, 60), i % 9, t, "3-MEDIUM") for i in range(80)], "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string"),
            "part": ([(k(i, 25), "B", "PROMO", i % 50) for i in range(30)], "p_partkey long, p_brand string, p_type string, p_size int"),
            }
    for name, (rows, schema) in data.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    before = TD.order_lines(spark, str(tmp_path))
    assert TD.lines_parts(spark, str(tmp_path)) == 1 and before.count() > 300
    monkeypatch.setattr(joins, "TASK_ROWS", 10)
    monkeypatch.setattr(joins, "OWN_PARTS", 2 if many_parts else 3)
    assert TD.lines_parts(spark, str(tmp_path)) == 30
    assert same(before, TD.order_lines(spark, str(tmp_path)))


def test_panel_as_of_an_earlier_day_is_a_view(inputs):
    whole = PN.cohort_panel(*inputs, P, parts=5)
    for p in (cutoff_params(P), replace(P, as_of=P.as_of - dt.timedelta(days=30))):
        assert same(PN.as_of_view(whole, p), PN.cohort_panel(*inputs, p))


def test_written_orders_serve_earlier_days_unless_an_order_lies_on_both_sides(spark, inputs, monkeypatch):
    lines = inputs[0]
    seen = []
    monkeypatch.setattr(aov_q, "order_lines", lambda s, d: (seen.append(d), lines)[1])
    aov_q.write_orders(spark, "own")
    aov_q.write_orders(spark, "own")
    assert seen == ["own"]
    before = replace(P, as_of=P.as_of - dt.timedelta(days=30))
    assert same(aov_q.orders_of(spark, "own"), C.all_orders(lines, P)) and same(aov_q.orders_of(spark, "own", before), C.all_orders(lines, before))
    assert seen == ["own"]
    cut = cutoff_params(P)                                              # order 9000 has lines on both sides
    assert same(aov_q.orders_of(spark, "own", cut), C.all_orders(lines, cut)) and seen == ["own"] * 2


def test_buckets_of_the_layout_grow_with_the_lines(spark, inputs, monkeypatch):
    made = []
    monkeypatch.setattr(hazard_q, "load_inputs", lambda s, d: TD.Inputs(*inputs, parts=40))
    monkeypatch.setattr(hazard_q, "write_lines", lambda lines, name, path, buckets, grain: made.append(buckets))
    monkeypatch.setattr(hazard_q, "read_lines", lambda *a, **k: inputs[0])
    monkeypatch.setattr(hazard_q, "_LAYOUTS", {})
    hazard_q.laid_out_lines(spark, "own")
    assert made == [40]


def test_increments_join_the_lines_once(spark, inputs, monkeypatch):
    """The lines are read for the arrivals only: every update reads what was written."""
    from pyspark.sql import functions as F
    lines, products, customers = inputs
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        reads.add(1)
        yield from batches
    counting = lines.coalesce(1).mapInArrow(counted, lines.schema)
    monkeypatch.setattr(hazard_q, "load_inputs", lambda s, d: TD.Inputs(counting, products, customers))
    got = hazard_q.latest_order_features_incremental(spark, "own")
    want = hazard_q.rounded(ST.latest_features(ST.state_of(PN.purchase_days(lines, products, P)), customers, P), hazard_q.DIG)
    assert same(got, want) and reads.value == 1 and want.where(F.col("order_seq") > 3).count() > 0
