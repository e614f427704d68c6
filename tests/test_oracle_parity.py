"""Every registered query equals its DuckDB oracle on the smallest test tables."""

import pytest

from custval import registry
from scripts.oracle_check import _hash, _norm

from tests.tables import SF_SMALL

QUERIES, SQL = registry.queries(), registry.oracle_sql()
KEYS = sorted(SQL)


def test_every_query_has_an_oracle_or_is_listed_rows_only():
    rows_only = set(QUERIES) - set(SQL)
    assert rows_only <= {"exotic_within_effect", "churn_model_scores", "feature_importance",
                         "churn_model_metrics", "model_hazard_curve", "model_calibration_by_stage",
                         "pltv_scores_model", "report_payloads", "model_val_frequency_aov_interaction", "model_val_decile_dollars",
                         "model_val_aggregate_bias", "model_val_rank_quality", "model_val_gains", "model_val_segment_calibration",
                         "model_val_horizon_sensitivity", "model_projection_backtest", "sketched_quantiles", "sketched_distinct"}, rows_only


TYPE_NAMES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    rel = duck.sql(SQL[key])
    duck_types = dict(zip(rel.columns, (str(t) for t in rel.types)))
    for f in sdf.schema.fields:
        assert TYPE_NAMES.get(f.dataType.simpleString()) == duck_types.get(f.name), (f.name, f.dataType)
    s = _norm(sdf.toPandas())
    o = _norm(duck.execute(SQL[key]).df())
    assert list(s.columns) == list(o.columns)
    assert len(s) == len(o)
    assert _hash(s) == _hash(o)
