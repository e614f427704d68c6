"""Trained hazard classifier: fit on FIT rows, score TEST rows, artifact round trip."""

import hashlib
import json
import tempfile

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from custval.params import DEFAULT as P
from custval.plans.hazard import boosting
from custval.plans.hazard import categories as CT
from custval.plans.hazard import curve as CV
from custval.plans.hazard import model as MD
from custval.plans.pltv.validate import cutoff_params
from custval.queries.hazard_q import matured_panel, scoring_extract

from tests.tables import SF_SMALL

CP = cutoff_params(P)


def test_fit_predict_and_artifact(spark):
    panel = matured_panel(spark, SF_SMALL)
    model, feats = MD.fit_hazard_model(panel, P, max_iter=5)
    frame = MD.model_frame(panel, keep=("customer_id", "order_date", "split_rand"))
    test = frame.where(CV.split_of(F.col("split_rand"), P) == "test")
    scored = MD.predict(model, test, feats)
    probs = scored.agg(F.min("churn_prob"), F.max("churn_prob"), F.count(F.lit(1))).first()
    assert 0.0 <= probs[0] <= probs[1] <= 1.0 and probs[2] == test.count()
    # absent feature columns become NULL and still score
    partial = MD.predict(model, test.drop("customer_state"), feats)
    assert partial.count() == test.count()
    imp = MD.feature_importance(model, feats, 5)
    assert len(imp) == 5 and all(v >= 0 for _, v in imp)

    curve = CV.hazard_curve(CV.with_scores(panel, P), P)
    r = CV.curve_values(curve)
    d = tempfile.mkdtemp(prefix="custval-art-")
    MD.save_artifact(model, feats, r, CV.multipliers(r, P.horizon), d, P, MD.category_vocab(MD.model_frame(panel)))
    back = MD.load_artifact(spark, d)
    assert back.features == feats and back.meta["r_k"] == r and back.multipliers == CV.multipliers(r, P.horizon)
    latest = scoring_extract(spark, SF_SMALL)
    direct = MD.predict(model, MD.model_frame(latest, keep=("customer_id",)), feats)
    saved = MD.score_from_artifact(back, latest)
    assert (sorted((x.customer_id, x.churn_prob) for x in direct.select("customer_id", "churn_prob").collect())
            == sorted((x.customer_id, x.model_prob) for x in saved.select("customer_id", "model_prob").collect()))
    odd = latest.withColumn("customer_state", F.lit("NOWHERE"))
    assert [(x.feature, x.value) for x in MD.unseen_categories(back, odd).where("value = 'NOWHERE'").collect()] == [("customer_state", "NOWHERE")]


def test_artifact_without_a_key_or_of_another_version_is_refused(spark):
    d = tempfile.mkdtemp(prefix="custval-art-")
    meta = {k: 0 for k in MD.ARTIFACT_KEYS} | {"version": 99}
    for bad, message in (({"version": 1}, "lacks"), (meta, "version 99")):
        spark.createDataFrame([(json.dumps(bad),)], "value string").write.mode("overwrite").text(f"{d}/meta")
        with pytest.raises(ValueError, match=message):
            MD.load_artifact(spark, d)


def test_more_categories_than_the_default_bins(spark):
    panel = matured_panel(spark, SF_SMALL).withColumn("customer_state", F.concat(F.lit("S"), F.pmod(F.hash("customer_id", "order_seq"), F.lit(130)).cast("string")))
    model, feats = MD.fit_hazard_model(panel, P, max_iter=1)
    assert len(model.trees) == 1 and model.categories.where("feature = 'customer_state'").count() > MD.MAX_BINS
    assert not [s for s in model.stages if hasattr(s, "labels") or hasattr(s, "labelsArray")]        # no vocabulary in the pipeline


@pytest.fixture(scope="module")
def points(spark):
    """A learnable label on two features: (training, validation) frames."""
    rows = spark.range(4000).select(
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000.0).alias("a"), (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000)) / 1000.0).alias("b"),
        (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1000)) / 1000.0).alias("noise"), "id")
    rows = rows.withColumn("y", (F.col("a") * F.col("b") + 0.4 * F.col("noise") > 0.45).cast("double"))
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows).select("features", "y", "id").cache()
    return rows.where("id % 4 > 0"), rows.where("id % 4 = 0")


def test_every_round_is_trained_once_and_equals_a_direct_fit(points, monkeypatch):
    """The kept trees are those of a plain fit of the best round; the best round has the least validation loss."""
    fits = []
    fit = boosting.DecisionTreeRegressor.fit
    monkeypatch.setattr(boosting.DecisionTreeRegressor, "fit", lambda self, df, *a: (fits.append(self.getSeed()), fit(self, df, *a))[1])
    got = boosting.boost(*points, "y", max_rounds=40, patience=6, depth=3, step=0.3, bins=32, cut_every=4)
    monkeypatch.undo()
    assert len(fits) == len(set(fits)) == len(got.losses) and len(got.trees) == got.losses.index(min(got.losses)) + 1
    assert 2 < len(got.trees) <= 40 and (len(got.losses) == 40 or len(got.losses) == len(got.trees) + 6)
    direct = GBTClassifier(labelCol="y", maxIter=len(got.trees), maxDepth=3, stepSize=0.3, maxBins=32, seed=42).fit(points[0])
    scored = PipelineModel(stages=got.stages()).transform(direct.transform(points[1]).withColumnRenamed("prediction", "p"))
    worst = scored.agg(F.max(F.abs(vector_to_array("probability")[1] - F.col("churn_prob")))).first()[0]
    assert worst < 1e-9
    assert direct.evaluateEachIteration(points[1])[-1] == pytest.approx(min(got.losses))


def test_boosting_without_validation_rows_keeps_all_rounds(points):
    assert len(boosting.boost(points[0], points[1].where("false"), "y", max_rounds=3, depth=2).trees) == 3


def test_boosting_holds_its_rows_and_frees_them(spark, points, monkeypatch):
    """Every round reads rows that are held; none are held afterwards; where the margin is written does not matter."""
    held = lambda: set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    before, rounds = held(), []
    fit = boosting.DecisionTreeRegressor.fit
    monkeypatch.setattr(boosting.DecisionTreeRegressor, "fit", lambda self, df, *a: (fit(self, df, *a), rounds.append("InMemoryTableScan" in df._jdf.queryExecution().executedPlan().toString()))[0])
    few, many = (boosting.boost(*points, "y", max_rounds=6, depth=3, step=0.3, cut_every=k) for k in (2, 100))
    assert rounds == [True] * 12 and held() <= before
    assert few.losses == pytest.approx(many.losses, abs=1e-12) and len(few.losses) == 6


def test_a_thousand_trees_score_in_one_expression(points):
    """As many trees as the rounds allow, on every row, against their sum."""
    tree = boosting.boost(*points, "y", max_rounds=1, depth=2).trees[0]
    many = boosting.Boosted([tree.copy({tree.predictionCol: f"__t{k}"}) for k in range(1000)], [1.0] + [0.05] * 999, [])
    scored = PipelineModel(stages=many.stages()).transform(tree.transform(points[1]).withColumnRenamed(tree.getPredictionCol(), "one"))
    want = 1 / (1 + F.exp(-2 * (1 + 0.05 * 999) * F.col("one")))
    assert scored.agg(F.max(F.abs(want - F.col("churn_prob")))).first()[0] < 1e-9


def test_missing_indicators_without_a_missing_value_are_left_out(spark):
    """Two numbers, one with nulls: its indicator is a feature, the other's is not, and is still listed with importance 0."""
    rows = [(k, None if k % 3 == 0 else float(k % 7), float(k % 5), float(k % 3 == 0)) for k in range(90)]
    df = MD._prepare(spark.createDataFrame(rows, "k long, a double, b double, y double"), ["a", "b"])
    assembly = MD._assembly(["a", "b"], df).fit(df)
    assert assembly.stages[-1].getInputCols() == ["a__im", "b__im", "a__na"]
    frame = assembly.transform(df).select("features", "y")
    got = boosting.boost(frame, frame, "y", max_rounds=2, depth=2)
    model = MD.HazardModel(PipelineModel(stages=[*assembly.stages, *got.stages()]), None, 0.5)
    assert len(model.trees) == 2 and MD.feature_importance(model, ["a", "b"]) == [("a(missing)", 1.0), ("a", 0.0), ("b", 0.0), ("b(missing)", 0.0)]


def test_ordered_means_leave_out_the_row_and_spread_a_hot_category(spark):
    """Against a plain loop; a category with most rows spans the partitions; nulls are a category; an empty table gives none."""
    rows = [(k, f"d{k}", None if k % 11 == 0 else "hot" if k % 3 else f"c{k % 40}", k % 5, int(k * 7919 % 10 < 4)) for k in range(1200)]
    df = spark.createDataFrame(rows, "k long, d string, cat string, num int, y int").repartition(5)
    out = CT.ordered_means(df, ["cat", "num"], "y", ["k", "d"], 0.3).collect()
    assert len(out) == 2400
    seen, got = {}, {(r.k, r.feature): (r.value, r.n_before, r.positives_before, r.mean) for r in out}
    key = lambda r: hashlib.md5(f"{r[0]}|{r[1]}|{CT.ORDER_SEED}".encode()).hexdigest()
    for k, _, cat, num, y in sorted(rows, key=key):
        for name, value in (("cat", "missing" if cat is None else cat), ("num", str(num))):
            n, pos = seen.get((name, value), (0, 0))
            assert got[k, name][:3] == (value, n, pos) and got[k, name][3] == pytest.approx((pos + 20 * 0.3) / (n + 20))
            seen[name, value] = n + 1, pos + y
    table = {(r.feature, r.value): (r.n, r.positives) for r in CT.category_means(df, ["cat", "num"], "y", 0.3).collect()}
    assert table == seen
    new = spark.createDataFrame([(1, "hot", None), (2, "never", 3), (3, None, 4)], "k long, cat string, num int")
    back = {r.k: (r.cat__mean, r.num__mean) for r in CT.with_category_means(new, CT.category_means(df, ["cat", "num"], "y", 0.3), ["cat", "num"], 0.3).collect()}
    assert back[2][0] == 0.3 and back[1][1] == 0.3 and back[3][0] == pytest.approx((table["cat", "missing"][1] + 6) / (table["cat", "missing"][0] + 20))
    wide = CT.with_ordered_means(df, ["cat", "num"], "y", ["k", "d"], 0.3)
    assert wide.count() == 1200 and wide.where("cat__mean is null or num__mean is null").count() == 0
    assert CT.ordered_means(df.where("false"), ["cat"], "y", ["k", "d"], 0.5).collect() == [] and CT.prior_of(df.where("false"), "y") == 0.5


def test_protocol_on_the_trained_model(spark):
    """V1-V7 and C14 run on the model's scores: one row per customer scored at the cutoff, TEST rows only behind the curve."""
    from custval import registry
    q = registry.queries()
    from custval.queries.model_q import model_holdout, model_scored
    frame, r = model_holdout(spark, SF_SMALL)
    assert len(r) == P.max_bucket and all(0 <= x <= 1 for x in r)
    assert frame.count() == frame.select("customer_id").distinct().count() == scoring_extract(spark, SF_SMALL, CP).count()
    assert frame.where("churn_prob < 0 or churn_prob > 1 or remaining_pltv < 0 or window_pltv > remaining_pltv + 1e-6").count() == 0
    scored = frame.where("expected_aov is not null").count()
    deciles = q["model_val_decile_dollars"](spark, SF_SMALL).collect()
    assert len(deciles) == 10 and sum(x.customers for x in deciles) == scored
    base = [x for x in q["model_val_horizon_sensitivity"](spark, SF_SMALL).collect() if x.horizon == P.horizon]
    assert base[0].spearman_vs_base == 1.0
    for key in ("model_val_frequency_aov_interaction", "model_val_aggregate_bias", "model_val_rank_quality", "model_val_gains",
                "model_val_segment_calibration", "model_projection_backtest"):
        assert q[key](spark, SF_SMALL).count() > 0, key
    panel = matured_panel(spark, SF_SMALL)
    assert model_scored(spark, SF_SMALL).count() == CV.test_rows(CV.with_scores(panel, P)).count()
    metrics = q["churn_model_metrics"](spark, SF_SMALL).collect()
    assert sum(x.n for x in metrics) == model_scored(spark, SF_SMALL).count() and len({x.overall_auc for x in metrics}) == 1


def test_one_pass_ranking_against_pairs(spark):
    """AUC by pairs, average precision by thresholds and the ROC points, with ties, a stage of one class, and no rows at all."""
    rows = [(k, "test" if k % 10 else "fit", k % 4 + 1, (k * 37 % 23) / 23.0, int(k % 4 and k * 31 % 7 < 3)) for k in range(400)]
    df = spark.createDataFrame(rows, "customer_id long, split string, seq_bucket int, churn_prob double, churned_400d int")
    test = [r for r in rows if r[1] == "test"]

    def auc(some):
        pos, neg = [r[3] for r in some if r[4]], [r[3] for r in some if not r[4]]
        return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg)) if pos and neg else None
    by = {r.seq_bucket: r for r in CV.auc_by_stage(df).collect()}
    assert set(by) == {1, 2, 3, 4} and by[1].auc is None and by[1].churn_rate == 0
    for s in (2, 3, 4):
        own = [r for r in test if r[2] == s]
        assert by[s].auc == pytest.approx(auc(own)) and by[s].n == len(own) and by[s].churn_rate == pytest.approx(sum(r[4] for r in own) / len(own))
    s = CV.auc_summary(df).first()
    weighted = sum(by[k].auc * by[k].n for k in (2, 3, 4)) / sum(by[k].n for k in (2, 3, 4))
    assert (s.overall_auc, s.weighted_auc, s.gap, s.stages) == pytest.approx((auc(test), weighted, auc(test) - weighted, 3))
    cuts = sorted({r[3] for r in test}, reverse=True)
    total, points, ap, last = sum(r[4] for r in test), [], 0.0, 0
    for c in cuts:
        above = [r for r in test if r[3] >= c]
        hit = sum(r[4] for r in above)
        ap, last = ap + (hit - last) / total * hit / len(above), hit
        points.append((c, (len(above) - hit) / (len(test) - total), hit / total))
    m = CV.ranking_metrics(df).first()
    assert (m.auc, m.average_precision, m.thresholds) == pytest.approx((auc(test), ap, len(cuts)))
    got = sorted((tuple(r) for r in CV.roc_points(df).collect()), reverse=True)
    assert [x for g in got for x in g] == pytest.approx([x for p in points for x in p])
    none = df.where("split = 'none'")
    assert CV.auc_by_stage(none).collect() == [] and CV.auc_summary(none).first().stages == 0 and CV.ranking_metrics(none).collect() == []


def test_normal_equations_against_demeaned_columns(spark):
    """X'WX and X'Wy as rows equal those of explicit, demeaned columns; the effect equals weighted least squares."""
    import numpy as np
    from types import SimpleNamespace

    from custval.plans.aov import reports as REP
    rng = np.random.default_rng(4)
    rows = [(int(c), d, bool(e), int(rng.integers(1, 5)), float(rng.normal(4, 1) + 0.3 * e + len(d) / 10)) for c in range(60)
            for d in ("A", "Bb", "Ccc") for e in (0, 1) if rng.random() < 0.5]
    f = SimpleNamespace(cells=spark.createDataFrame(rows, "customer_id long, order_department string, order_is_exotic boolean, n_orders long, cell_mean_log double"))
    got = {(r.row_name, r.col_name): r.total for r in REP.normal_equations(f).collect()}
    names = ["dept:A", "dept:Bb", "dept:Ccc", "exotic", "y"]
    x = np.array([[float(d == n[5:]) for n in names[:3]] + [float(e), y] for _, d, e, _, y in rows])
    w, c = np.array([r[3] for r in rows], float), np.array([r[0] for r in rows])
    for k in set(c):
        own = c == k
        x[own] -= (w[own, None] * x[own]).sum(0) / w[own].sum()
    gram = (w[:, None] * x).T @ x
    for i, a in enumerate(names):
        for j in range(i, 5):
            assert got.get((a, names[j]), 0.0) == pytest.approx(gram[i, j], abs=1e-9)
    want = np.linalg.lstsq(np.sqrt(w)[:, None] * x[:, :4], np.sqrt(w) * x[:, 4], rcond=1e-10)[0][3]
    out = REP.exotic_within_effect(f).first()
    assert out.delta_within == pytest.approx(want) and out.within_var == pytest.approx(gram[3, 3] / w.sum()) and not out.exotic_is_type
    alike = SimpleNamespace(cells=f.cells.where("order_is_exotic"))
    assert REP.exotic_within_effect(alike).first().exotic_is_type
