"""Report payloads as JSON documents (rows-only: JSON number formatting
differs between engines, so no value-hash oracle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from custval.params import DEFAULT as P
from custval.plans.aov import reports as REP
from custval.plans.pltv import scores as SC
from custval.queries.aov_q import production_fit
from custval.queries.pltv_q import scores_table
from custval.registry import register
from custval.sources.sinks import json_payload


@register("report_payloads")
def report_payloads(spark, sf_dir):
    f = production_fit(spark, sf_dir)
    parts = [
        json_payload(REP.value_ladder(f), "value_ladder"),
        json_payload(REP.population_baseline(f), "population_baseline"),
        json_payload(REP.within_customer_variance(f), "within_variance"),
        json_payload(REP.within_variance_histogram(f), "within_variance_histogram"),
        json_payload(REP.spend_by_type(f), "spend_by_type"),
        SC.scorecard_json(SC.scorecard(scores_table(spark, sf_dir), P)).select(F.lit("scorecard").alias("payload"), "json"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
