"""Mergeable sketches beside the exact operators: quantiles (KLL) and distinct counts (HyperLogLog).

A sketch of fixed size per group is built in each task and merged, so no value
is sorted or exchanged; sketches that were written once answer for any union
of their groups (days to months, stages to the whole) without the rows.  The
reports of this module set each estimate against the exact value and state
its measured error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custval.operators.joins import join_small
from custval.operators.ranking import exact_quantiles

#: of quantile sketches; ranks err by at most RANK_ERROR of the rows with a chance of 99 %
KLL_K, RANK_ERROR = 200, 0.0165
#: of distinct sketches: four standard errors of 1.04 / sqrt(2 ** 12)
HLL_LG_K, COUNT_ERROR = 12, 4 * 1.04 / 64


def quantile_sketches(df: DataFrame, group: Sequence[str], metrics: dict[str, Column]) -> DataFrame:
    """Per group one KLL sketch (binary) per metric; null values are not counted, a group of nulls has a null sketch."""
    return df.groupBy(*group).agg(*[F.when(F.count(c) > 0, F.kll_sketch_agg_double(c.cast("double"), F.lit(KLL_K))).alias(m) for m, c in metrics.items()])


def merged_quantiles(sketches: DataFrame, group: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """``quantile_sketches`` of the unions: the same metrics by fewer group columns."""
    return sketches.groupBy(*group).agg(*[F.kll_merge_agg_double(m).alias(m) for m in metrics])


def estimates(sketches: DataFrame, group: Sequence[str], metrics: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """(group, metric, q, estimate) of every sketch."""
    wanted = [F.struct(F.lit(m).alias("metric"), F.lit(float(q)).alias("q"), F.kll_sketch_get_quantile_double(m, F.lit(float(q))).alias("estimate"))
              for m in metrics for q in qs]
    return sketches.select(*group, F.explode(F.array(*wanted)).alias("x")).select(*group, "x.*")


def quantile_report(df: DataFrame, group: Sequence[str], metrics: dict[str, Column], qs: Sequence[float], groups_max: int) -> DataFrame:
    """Per group, metric and q: rows ``n``, ``estimate``, the ``exact`` linear quantile, and by how much of the rows the
    estimate's rank misses q (``rank_error``; ties span an interval of ranks).

    ``groups_max`` bounds the groups by construction: the estimates, that
    many times metrics and quantiles, meet the rows in a broadcast.  A group whose
    values are all null has no rows.
    """
    names = list(metrics)
    est = estimates(quantile_sketches(df, group, metrics), group, names, qs).where(F.col("estimate").isNotNull())
    long = df.select(*group, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), c.cast("double").alias("v")) for m, c in metrics.items()])).alias("x")).select(
        *group, "x.*").where("v is not null")
    at = est.groupBy(*group, "metric").agg(F.collect_list(F.struct("q", "estimate")).alias("at"))
    placed = (join_small(long, at, [*group, "metric"], "inner", known_rows=groups_max * len(names))
              .select(*group, "metric", "v", F.explode("at").alias("e")).groupBy(*group, "metric", F.col("e.q").alias("q"), F.col("e.estimate").alias("estimate"))
              .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") < F.col("e.estimate")).alias("below"), F.count_if(F.col("v") <= F.col("e.estimate")).alias("upto")))
    error = F.greatest(F.col("below") / F.col("n") - F.col("q"), F.col("q") - F.col("upto") / F.col("n"), F.lit(0.0))
    exact = exact_quantiles(df, metrics, [(f"{m}__{i}", m, q) for m in names for i, q in enumerate(qs)], group)
    values = [F.struct(F.lit(m).alias("metric"), F.lit(float(q)).alias("q"), F.col(f"{m}__{i}").alias("exact")) for m in names for i, q in enumerate(qs)]
    exact = exact.select(*group, F.explode(F.array(*values)).alias("x")).select(*group, "x.*")
    return (placed.join(exact, [*group, "metric", "q"])
            .select(*group, "metric", "q", "n", "estimate", "exact", error.alias("rank_error"), (error <= RANK_ERROR + 1 / F.col("n")).alias("within_bound")))


def distinct_sketches(df: DataFrame, group: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per group one HyperLogLog sketch (binary) per column; null values are not counted."""
    return df.groupBy(*group).agg(*[F.hll_sketch_agg(c, HLL_LG_K).alias(c) for c in columns])


def merged_distinct(sketches: DataFrame, group: Sequence[str | Column], columns: Sequence[str]) -> DataFrame:
    """Distinct counts (long) of unions of ``distinct_sketches``."""
    return sketches.groupBy(*group).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).cast("bigint").alias(c) for c in columns])


def distinct_report(df: DataFrame, fine: str, coarse: Column, columns: Sequence[str]) -> DataFrame:
    """Per ``period`` (``coarse`` of the column ``fine``) and column: the estimate rolled up from sketches per ``fine``, the
    exact count, and the relative error."""
    sketches = distinct_sketches(df, [fine], columns)
    est = merged_distinct(sketches, [coarse.alias("period")], columns)
    exact = df.groupBy(coarse.alias("period")).agg(*[F.count_distinct(c).alias(c) for c in columns])

    def melted(t, name):
        return t.select("period", F.explode(F.array(*[F.struct(F.lit(c).alias("counted"), F.col(c).alias(name)) for c in columns])).alias("x")).select("period", "x.*")
    error = F.abs(F.col("estimate") - F.col("exact")) / F.greatest(F.col("exact"), F.lit(1))
    return (melted(est, "estimate").join(melted(exact, "exact"), ["period", "counted"])
            .select("period", "counted", "estimate", "exact", error.alias("relative_error"), (error <= COUNT_ERROR).alias("within_bound")))
