"""Query registry: key -> (Spark builder, oracle SQL).

Every builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input tables.  Output columns are aliased and doubles rounded identically on
both sides, so the DuckDB oracle can be compared by value hash.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custval.functions.exprs import rnd
from custval.params import DEFAULT
from custval.sources.testdata import order_lines


@dataclass
class Query:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: Callable[[], str] | None = None


REGISTRY: dict[str, Query] = {}


def register(key: str, sql: Callable[[], str] | None = None):
    def deco(fn):
        REGISTRY[key] = Query(key, fn, sql)
        return fn
    return deco


def rounded(df: DataFrame, digits: dict | None = None, default: int = 6) -> DataFrame:
    """Round every double column (``digits`` overrides per column)."""
    digits = digits or {}
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            cols.append(rnd(f.name, digits.get(f.name, default)).alias(f.name))
        elif f.dataType.typeName() == "decimal":
            # exact decimals become doubles at their own scale
            cols.append(rnd(f.name, digits.get(f.name, min(f.dataType.scale, 6))).alias(f.name))
        elif f.dataType.typeName() in ("integer", "short", "byte"):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(cols)


def app_key(spark: SparkSession):
    """Identity of the running application, for memoising fitted tables."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 -- sessions without a local context
        return id(spark)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {k: q.build for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: q.sql() for k, q in REGISTRY.items() if q.sql is not None}


def _load() -> None:
    # importing the query modules fills REGISTRY
    import custval.queries  # noqa: F401


__all__ = ["register", "rounded", "queries", "oracle_sql", "REGISTRY", "DEFAULT", "order_lines"]


def reset_caches() -> None:
    """Forget memoised fits / curves (used by the benchmark between queries)."""
    from custval.queries import aov_q, hazard_q, model_q, pltv_q, validate_q
    pltv_q._SCORES.clear()
    validate_q._FRAMES.clear()
    aov_q._FITS.clear()
    aov_q._ORDERS.clear()
    hazard_q._LAYOUTS.clear()
    for memo in (model_q._MODELS, model_q._PANELS, model_q._TEST_ROWS, model_q._HOLDOUT):
        memo.clear()
    pltv_q._CURVES.clear()
    pltv_q._PANELS.clear()
