"""Category statistics of the hazard model: smoothed target means, in a table instead of a vocabulary on the driver.

A training row must not see its own label, so it gets the mean over the rows
before it in a hashed order (``ordered_means``); rows that are scored get the
mean over all training rows (``category_means``, ``with_category_means``).
Both are smoothed towards the overall rate, which also stands for a category
that training never saw.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custval.operators.ranking import running_before

#: the overall rate counts as so many rows
WEIGHT = 20.0
#: seed of the row order
ORDER_SEED = "ordered_1"


def as_category(column: str) -> Column:
    """A categorical value as text; NULL is a category."""
    return F.coalesce(F.col(column).cast("string"), F.lit("missing"))


def row_order(keys: Sequence[str]) -> Column:
    """The hashed order of rows: the same on every run, and unrelated to time."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(ORDER_SEED)))


def _melted(rows: DataFrame, features: Sequence[str], keep: Sequence[Column]) -> DataFrame:
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), as_category(c).alias("value")) for c in features]))
    return rows.select(*keep, pairs.alias("pair")).select("*", "pair.feature", "pair.value").drop("pair")


def smoothed(positives: Column, n: Column, prior: float) -> Column:
    return (positives + F.lit(WEIGHT * prior)) / (n + F.lit(WEIGHT))


def prior_of(rows: DataFrame, label: str) -> float:
    """The overall rate; one half without a row."""
    rate = rows.agg(F.avg(label)).first()[0]
    return 0.5 if rate is None else float(rate)


def ordered_means(rows: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], prior: float, spent: list[DataFrame] | None = None) -> DataFrame:
    """Per row (named by ``keys``, which must be unique) and feature: ``value``, rows and positives before it in the category, and their mean.

    The running sums go over ranges of (category, order): a category that a
    third of the rows have is no task of its own.  ``spent``: see ``running_before``.
    """
    long = _melted(rows, features, [*keys, row_order(keys).alias("_order"), F.col(label).cast("bigint").alias("positives"), F.lit(1).cast("bigint").alias("n")])
    run = running_before(long, [F.col("_order"), *[F.col(k) for k in keys]], ["positives", "n"], ["feature", "value"], spent)
    return run.select(*keys, "feature", "value", F.col("before_n").alias("n_before"), F.col("before_positives").alias("positives_before"),
                      smoothed(F.col("before_positives"), F.col("before_n"), prior).alias("mean"))


def category_means(rows: DataFrame, features: Sequence[str], label: str, prior: float) -> DataFrame:
    """Per feature and category over all rows: rows, positives and their mean."""
    long = _melted(rows, features, [F.col(label).cast("bigint").alias("y")])
    return (long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positives"))
            .withColumn("mean", smoothed(F.col("positives"), F.col("n"), prior)))


def with_ordered_means(rows: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], prior: float, spent: list[DataFrame] | None = None) -> DataFrame:
    """``rows`` with a column ``<feature>__mean`` per feature, over the rows before each."""
    wide = ordered_means(rows, features, label, keys, prior, spent).groupBy(*keys).pivot("feature", list(features)).agg(F.first("mean"))
    return rows.join(wide.select(*keys, *[F.col(c).alias(f"{c}__mean") for c in features]), list(keys))


def with_category_means(rows: DataFrame, table: DataFrame, features: Sequence[str], prior: float) -> DataFrame:
    """``rows`` with ``<feature>__mean`` per feature from ``category_means``; an unknown category has the prior.

    One join per feature with that feature's part of the table; Spark
    broadcasts it by its measured size or shuffles both (plain inputs, which
    its skew rule can split).
    """
    for c in features:
        own = table.where(F.col("feature") == c).select(F.col("value").alias("_value"), F.col("mean").alias("_mean"))
        rows = (rows.join(own, as_category(c) == F.col("_value"), "left")
                .withColumn(f"{c}__mean", F.coalesce("_mean", F.lit(prior))).drop("_value", "_mean"))
    return rows
