"""What a job leaves on disk while it runs: no shuffle files behind a written frame, nothing that is not read again."""

import datetime as dt
import glob
import time
from decimal import Decimal

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from custval.operators import joins
from custval.operators import persist
from custval.params import DEFAULT as P
from custval.plans.hazard import boosting
from custval.plans.hazard import model as MD
from custval.plans.hazard import panel as PN
from custval.plans.hazard import state as ST
from custval.queries import aov_q, hazard_q, model_q
from custval.session import ensure_checkpoint_dir
from custval.sources import tables as T
from custval.sources import testdata as TD

from tests.tables import SF_SMALL


def shuffle_files(spark) -> int:
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum(x.startswith("shuffle_") for x in disk.getAllFiles().mkString("|").replace("/", "|").split("|"))


def no_more_shuffle_files(spark, than: int) -> bool:
    """Spark removes the files in the background."""
    for _ in range(100):
        if shuffle_files(spark) <= than:
            return True
        time.sleep(0.1)
    return False


def folders(spark, name: str) -> set[str]:
    return set(glob.glob(f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/{name}"))


@pytest.fixture(scope="module")
def inputs(spark):
    """Lines of 40 customers, before and within the last month; orders 97 and 9700 arrive late; event lines, a null channel, customer 0, a line behind the run date."""
    def line(c, o, n, day, channel="Retail"):
        v = Decimal(10 + (c * 7 + o + n) % 23)
        return (c, o, n, 1, 1, day, channel, f"{c % 4:03d} - Store", "Accessories" if n else None, "A/1" if c % 3 else "B/2", n == 1, Decimal(1), Decimal(0), Decimal(0), v, Decimal(0), v, v)
    rows = [line(c, 1000 * c + k, n, P.as_of - dt.timedelta(days=(c * 37 + k * 211) % 1500), ("Retail", "eComm", "Event", None)[(c + k) % 4])
            for c in range(0, 41) for k in range(8) for n in (0, 1)]
    rows += [line(5, 97, 1, P.as_of - dt.timedelta(days=700)), line(6, 9700, 1, P.as_of - dt.timedelta(days=15)), line(6, 9701, 1, P.as_of - dt.timedelta(days=12)),
             line(7, 9702, 1, P.as_of + dt.timedelta(days=1))]
    products = spark.createDataFrame([("A/1", "Active"), ("B/2", "Discontinued")], T.PRODUCT_SCHEMA)
    customers = spark.createDataFrame([(c, "ohio" if c % 2 else None) for c in range(1, 41)], T.CUSTOMER_SCHEMA)
    return spark.createDataFrame(rows, T.ORDER_LINE_SCHEMA), products, customers


def same(a, b):
    return a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_a_settled_frame_leaves_its_rows_only(spark):
    """No shuffle files stay, the spent checkpoint goes, the session's setting is as it was."""
    def rolled():
        return spark.range(2000).withColumn("k", F.col("id") % 50).groupBy("k").agg(F.sum("id").alias("s"))
    first = persist.materialize(rolled())
    was, setting = shuffle_files(spark), spark.conf.get(persist.SHUFFLE_CLEANUP, None)
    there = folders(spark, "rdd-*")
    second = persist.settle(rolled().join(first, "k"), first)
    assert no_more_shuffle_files(spark, was) and spark.conf.get(persist.SHUFFLE_CLEANUP, None) == setting
    gone, new = there - folders(spark, "rdd-*"), folders(spark, "rdd-*") - there
    assert len(gone) == len(new) == 1 and second.count() == 50
    was = shuffle_files(spark)
    rows, path = persist.write_rows(rolled().withColumn("part", F.col("k") % 2), "part")
    assert no_more_shuffle_files(spark, was) and rows.where("part = 1").count() == 25 and len(folders(spark, path.rsplit("/", 1)[1])) == 1
    persist.remove_folder(spark, path)
    assert not folders(spark, path.rsplit("/", 1)[1])


@pytest.mark.parametrize(("most", "parts"), [(joins.KEYS_MAX, 1), (0, 5)])
def test_increments_keep_one_state_and_no_arrivals(spark, inputs, monkeypatch, most, parts):
    """Late customers sent to the lines or met in a shuffle: the same rows; of all that was written the last state is left."""
    lines, products, customers = inputs
    monkeypatch.setattr(joins, "KEYS_MAX", most)
    monkeypatch.setattr(hazard_q, "load_inputs", lambda s, d: TD.Inputs(lines, products, customers, parts))
    split = spark.conf.get("spark.sql.files.maxPartitionBytes", None)
    late, join = [], ST.join_measured
    monkeypatch.setattr(ST, "join_measured", lambda big, keys, on, how, rows: (late.append(rows), join(big, keys, on, how, rows))[1])
    there, was = folders(spark, "custval_*"), shuffle_files(spark)
    got = hazard_q.latest_order_features_incremental(spark, "own")
    left = folders(spark, "custval_*") - there
    assert len(left) == 1 and no_more_shuffle_files(spark, was)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes", None) == split
    assert max(late) > 0 and glob.glob(f"{left.pop()}/*.parquet")
    want = hazard_q.rounded(ST.latest_features(ST.state_of(PN.purchase_days(lines, products, P)), customers, P), hazard_q.DIG)
    assert same(got, want) and want.count() > 30


def test_the_history_is_not_exchanged_for_a_few_late_customers(spark):
    """A written table has no measured size before a plan is made; its counted rows decide."""
    lines = spark.range(1000).withColumn("customer_id", F.col("id") % 100).select("customer_id", "id")
    late = persist.settle(spark.range(10).select(F.col("id").alias("customer_id")).distinct())
    plan = joins.join_measured(lines, late, "customer_id", "left_semi", late.count())._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = joins.join_measured(lines, late, "customer_id", "left_semi", 10)
        many = joins.join_measured(lines, late, "customer_id", "left_semi", joins.KEYS_MAX + 1)
        assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in many._jdf.queryExecution().executedPlan().toString() and same(few, many)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def points(spark):
    rows = [(i, (i * 37 % 101) / 101, (i * 53 % 89) / 89, float((i * 37 % 101) * (i * 53 % 89) % 7 > 3)) for i in range(600)]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(rows, "id long, a double, b double, y double"))
    df = persist.materialize(df)
    return df.where("id % 4 > 0"), df.where("id % 4 = 0")


def test_rounds_write_no_rows(spark, points, monkeypatch):
    """However often margins are held and renewed: the same losses to the last bit, nothing written, nothing held at the end."""
    held = lambda: set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    there, before = folders(spark, "rdd-*"), held()
    kinds = {"max_rounds": 10, "patience": 20, "depth": 3, "step": 0.3, "bins": 32}
    plain = boosting.boost(*points, "y", **kinds, cut_every=100)
    cut = boosting.boost(*points, "y", **kinds, cut_every=2)
    monkeypatch.setattr(boosting, "BASE_ROUNDS", 4)
    renewed = boosting.boost(*points, "y", **kinds, cut_every=2)
    assert plain.losses == cut.losses == renewed.losses and len(plain.losses) == 10
    assert folders(spark, "rdd-*") <= there and held() <= before


def test_added_trees_are_the_running_sum(points):
    """The leaves that an ensemble names, looked up and added, against each tree's own prediction."""
    made = boosting.boost(*points, "y", max_rounds=5, depth=4, step=0.3)
    trees, weights = made.trees[:3] or made.trees, made.weights[:3] or made.weights
    rows = points[1].withColumn("margin", F.col("a") / 3)
    want = rows
    for k, (tree, weight) in enumerate(zip(trees, weights)):
        want = tree.copy({tree.predictionCol: f"t{k}"}).transform(want).withColumn("margin", F.col("margin") + F.lit(weight) * F.col(f"t{k}"))
    assert same(boosting.add_trees(rows, trees, weights).select("id", "margin"), want.select("id", "margin"))
    assert [len(boosting.leaf_values(t)) for t in trees] == [(t.numNodes + 1) // 2 for t in trees]


def few_rounds(monkeypatch):
    boost = MD.boost
    monkeypatch.setattr(MD, "boost", lambda train, val, label, rounds, *rest: boost(train, val, label, 2, *rest))


def test_training_and_test_rows_are_cuts_of_one_panel(spark, monkeypatch):
    """The panel is made once; of the written rows that training reads none is left but the panel, the category means and the scores."""
    few_rounds(monkeypatch)
    for memo in ("_MODELS", "_PANELS", "_TEST_ROWS"):
        monkeypatch.setattr(model_q, memo, {})
    made, panel = [], model_q.matured_panel
    monkeypatch.setattr(model_q, "matured_panel", lambda *a: (made.append(a), panel(*a))[1])
    there = folders(spark, "rdd-*")
    assert model_q.model_calibration_by_stage(spark, SF_SMALL).count() > 0
    assert len(made) == 1 and len(folders(spark, "rdd-*") - there) <= 3


def test_the_holdout_leaves_its_frame_and_fits(spark, monkeypatch):
    """Panel and training rows are gone when the frame is there."""
    few_rounds(monkeypatch)
    monkeypatch.setattr(model_q, "_HOLDOUT", {})
    monkeypatch.setattr(aov_q, "_FITS", {})
    there = folders(spark, "rdd-*")
    frame, r = model_q.model_holdout(spark, SF_SMALL)
    left = folders(spark, "rdd-*") - there
    assert frame.count() > 0 and len(r) == P.max_bucket
    assert len(left) <= 4                              # the frame, the category means, the fit's cells and customers
