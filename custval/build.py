"""End-to-end build: inputs -> both phases -> written score tables.

    spark-submit -m custval.build --lines L --products P --customers C --as-of 2001-08-01 --out /shared/run1 [--fallback-aov 310.23]
    spark-submit -m custval.build --lines L --products P --customers C --as-of 2001-09-01 --out /shared/run2 --artifact /shared/run1/artifact

Inputs are Parquet tables with the canonical columns (``sources.tables``); the
session, its master and ``spark.checkpoint.dir`` are the launcher's.  Writes
(each a table under ``--out``): expected_aov (S7), panel (O1, the matured rows
by customer and order), curve and multipliers, artifact (S9, when trained),
scores (S6, in descending value), live_scores (S8), and the score reports as
JSON payloads (S10).  Without ``--artifact`` the classifier is trained; with it
the saved model, curve and multipliers score and nothing is fitted but the
order values.
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from custval.operators.persist import materialize
from custval.params import DEFAULT, Params
from custval.plans.aov import cells as C
from custval.plans.aov import fit as FIT
from custval.plans.hazard import curve as CV
from custval.plans.hazard import model as MD
from custval.plans.hazard import panel as PN
from custval.plans.pltv import scores as SC
from custval.sources import sinks
from custval.sources.tables import CUSTOMER_SCHEMA, ORDER_LINE_SCHEMA, PRODUCT_SCHEMA, read_table
from custval.sources.testdata import Inputs, load_inputs


def load_canonical(spark: SparkSession, lines: str, products: str, customers: str) -> Inputs:
    return Inputs(read_table(spark, lines, ORDER_LINE_SCHEMA), read_table(spark, products, PRODUCT_SCHEMA),
                  read_table(spark, customers, CUSTOMER_SCHEMA))


def build(spark: SparkSession, inputs: Inputs | str, out: str, p: Params = DEFAULT, fallback_aov: float | None = None,
          train_model: bool = False, artifact: str | None = None, max_iter: int = 1000) -> dict:
    """Run both phases and write every table; ``inputs`` may name a folder of the test tables.

    The score is the saved model's (``artifact``), a newly trained one's
    (``train_model``), or the closed-form fixture's.
    """
    i = load_inputs(spark, inputs) if isinstance(inputs, str) else inputs
    saved = MD.load_artifact(spark, artifact) if artifact else None
    aov = FIT.fit(C.aov_cells(i.lines, p), p)
    sinks.write_expected_aov(aov.customers, f"{out}/expected_aov")

    # the lines are read once more, for the panel; training, curve and latest rows all cut this table
    panel_all = materialize(PN.cohort_panel(i.lines, i.products, i.customers, p))
    panel = PN.matured_rows(panel_all, p)
    sinks.write_table(panel.orderBy("customer_id", "order_seq"), f"{out}/panel")
    latest = PN.latest_rows(panel_all)
    score, unseen = None, 0
    if saved:
        latest = materialize(MD.score_from_artifact(saved, latest))
        score, r, m = F.col("model_prob"), saved.meta["r_k"], saved.multipliers
        unseen = MD.unseen_categories(saved, latest.drop("model_prob")).count()
        curve = mult = None
    else:
        if train_model:
            model, feats = MD.fit_hazard_model(panel, p, max_iter)
            frame = MD.model_frame(panel, keep=("customer_id", "order_date", "split_rand"))
            test = MD.predict(model, frame.where(CV.split_of(F.col("split_rand"), p) == "test"), feats)
            scored = (test.withColumn("p_repeat", 1 - F.col("churn_prob")).withColumn("split", F.lit("test"))
                          .withColumn("seq_bucket", F.least(F.col("order_seq").cast("int"), F.lit(p.max_bucket))))
        else:
            scored = CV.with_scores(panel, p)
        curve = materialize(CV.hazard_curve(scored, p))
        mult = CV.forward_multiplier(curve, p)
        r = CV.curve_values(curve)
        m = CV.multipliers(r, p.horizon)
        sinks.write_table(curve, f"{out}/curve")
        sinks.write_table(mult, f"{out}/multipliers")
        if train_model:
            MD.save_artifact(model, feats, r, m, f"{out}/artifact", p, MD.category_vocab(MD.model_frame(panel)))
            # score with what was saved, so that a later run with the artifact gives the same
            latest = materialize(MD.score_from_artifact(MD.load_artifact(spark, f"{out}/artifact"), latest))
            score = F.col("model_prob")

    scores = SC.pltv_scores(latest, m, aov.customers, p, fallback_aov=fallback_aov, score=score)
    SC.write_scores(scores, f"{out}/scores")
    written = spark.read.parquet(f"{out}/scores")
    sinks.write_live_scores(CV.live_scores(latest, p, score), f"{out}/live_scores")
    payloads = (sinks.json_payload(SC.describe(written), "describe")
                .unionByName(sinks.json_payload(SC.null_report(written), "null_report"))
                .unionByName(sinks.json_payload(SC.by_stage(written), "by_stage"))
                .unionByName(SC.scorecard_json(SC.scorecard(written, p)).select(F.lit("scorecard").alias("payload"), "json")))
    sinks.write_table(payloads, f"{out}/reports")
    return {"customers": written.count(), "curve": r, "tau2": aov.tau2, "sigma2": aov.sigma2, "unseen_categories": unseen}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Build per-customer value scores.")
    for name in ("lines", "products", "customers"):
        ap.add_argument(f"--{name}", required=True, help=f"Parquet table of {name} with the canonical columns")
    ap.add_argument("--out", required=True, help="shared output folder")
    ap.add_argument("--as-of", type=dt.date.fromisoformat, required=True, help="run date; later lines are not read")
    ap.add_argument("--order-floor", type=dt.date.fromisoformat, default=DEFAULT.order_floor, help="earliest first order kept")
    ap.add_argument("--fallback-aov", type=float, default=None, help="order value for customers without their own estimate")
    ap.add_argument("--artifact", default=None, help="score with this saved artifact instead of training")
    a = ap.parse_args(argv)
    from custval.session import current_session
    spark = current_session()
    p = replace(DEFAULT, as_of=a.as_of, order_floor=a.order_floor)
    print(build(spark, load_canonical(spark, a.lines, a.products, a.customers), a.out, p, a.fallback_aov,
                train_model=a.artifact is None, artifact=a.artifact))


if __name__ == "__main__":
    main()
