"""Joins against summary tables, and joins whose heavy keys are spread.

A plain shuffled join sends all rows of a key to one task.  The adaptive skew
rule splits such a partition only where both inputs are plain exchanges; above
an aggregate on the same keys it does not apply.  ``join_hot`` looks for heavy
keys first, in one sketch that merges without a shuffle, deals only their rows
over several tasks, and copies the other side's rows of these keys to each.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: rows of a side whose size is fixed by construction that may be broadcast without a look at its bytes
FIXED_ROWS_MAX = 10_000
#: keys of a measured table that may be broadcast (about 20 MB)
KEYS_MAX = 1_000_000
#: keys a sketch of heavy keys reports and counters it keeps: its counts err by at most 3.5 / HOT_TRACKED of the rows
HOT_KEYS, HOT_TRACKED = 1_000, 16_384
#: rows of a key below which dealing it out cannot pay
HOT_ROWS = 1_000

#: rows that one task joins, sorts or rolls up, and partitions up to which Spark's own number does
TASK_ROWS, OWN_PARTS = 250_000, 16


def parts_for(rows: int) -> int:
    """Partitions for so many rows, in line with their number; 1: few enough for whichever number Spark takes."""
    parts = math.ceil(rows / TASK_ROWS)
    return parts if parts > OWN_PARTS else 1


def spread(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` into ``parts`` tasks; as it is for one part.

    A shuffle's own number of partitions is fixed, and the adaptive rules join
    them up to a number of compressed bytes; either way a task's sorts and hash
    maps grow with the input until they spill.  The number given here stays.
    """
    return df.repartition(parts, *keys) if parts > 1 else df


def _pieces(counts: dict[int, int], total: int, parts: int, share: float | None, weight: int, least_share: float) -> dict[int, int]:
    least = max(HOT_ROWS, total * (share if share is not None else max(1 / (4 * parts), least_share)))
    return {h: min(4 * parts, max(2, math.ceil(n / (weight * least)))) for h, n in counts.items() if n > least}


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left", known_rows: int | None = None) -> DataFrame:
    """Join ``big`` to a summary table.

    Whether the summary is broadcast is left to Spark, which knows its bytes
    from the shuffle (``spark.sql.autoBroadcastJoinThreshold``) and splits
    skewed partitions otherwise.  Only a side of ``known_rows`` fixed by
    construction (a spine of N bins) is hinted.
    """
    fixed = known_rows is not None and known_rows <= FIXED_ROWS_MAX
    return big.join(F.broadcast(small) if fixed else small, on, how)


def join_measured(big: DataFrame, keys: DataFrame, on: str, how: str, rows: int) -> DataFrame:
    """Join ``big`` to a written table of ``rows`` integer keys (one column): broadcast by that number, else left to Spark.

    Spark only has an estimate of a written table, from the plan that made it,
    and when it has measured the bytes ``big`` is exchanged already.
    """
    return big.join(F.broadcast(keys) if rows <= KEYS_MAX else keys, on, how)


def pieces_of_hot_keys(df: DataFrame, keys: Sequence[str], weight: int = 1, share: float | None = None) -> dict[int, int]:
    """Hash of each heavy key of ``df`` -> pieces its rows should be dealt into.

    A key is heavy if it has over ``HOT_ROWS`` rows and over ``share`` of all
    (default: a quarter of what a shuffle partition has on average); its pieces
    hold about that many rows each, times ``weight``.  Null keys count as a key.  One aggregate of
    fixed size: a sketch of frequent hashes per task, merged; keys whose hashes
    meet are dealt together, which costs nothing but their copies.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = df.select(F.xxhash64(*keys).alias("h")).agg(
        F.expr(f"approx_top_k(h, {HOT_KEYS}, {HOT_TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return _pieces({x["item"]: x["count"] for x in row["top"] or []}, row["n"], parts, share, weight, 8 / HOT_TRACKED)


def hot_from_counts(counts: DataFrame, keys: Sequence[str], count_col: str, total: int, weight: int = 1, always_null: bool = False) -> dict[int, int]:
    """``pieces_of_hot_keys`` where an aggregate already has the rows of each key; null keys if ``always_null``.

    At most four keys per shuffle partition can be that heavy.
    """
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = counts.where(F.col(count_col) > max(HOT_ROWS, total * max(1 / (4 * parts), 1 / HOT_KEYS))).select(F.xxhash64(*keys).alias("h"), F.col(count_col).alias("n"))
    hot = _pieces({r["h"]: r["n"] for r in rows.collect()}, total, parts, None, weight, 1 / HOT_KEYS)
    if always_null:
        null = counts.sparkSession.range(1).select(F.xxhash64(*[F.lit(None).cast(counts.schema[k].dataType) for k in keys])).first()[0]
        hot[null] = 4 * parts
    return hot


def join_hot(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner", hot: dict[int, int] | None = None,
             salt_by: Sequence[str] | None = None) -> DataFrame:
    """``big`` join ``small`` on the columns ``keys`` that both have, heavy keys of ``big`` dealt over several tasks.

    ``how`` is inner, left, left_semi or left_anti.  ``hot`` (by default
    ``pieces_of_hot_keys(big)``) names the heavy keys, at most ``HOT_KEYS`` of
    them.  A heavy row's piece is a hash of ``salt_by`` (default: all columns
    but maps) and of the map task that has it, so equal rows are dealt out too and a
    task that runs again repeats it.  ``small`` should be bounded per
    key: its rows of a heavy key are copied to each piece.  Without a heavy key
    it is a plain join.  Null keys join nothing, as in any equi-join, but are
    dealt like others; the result has
    the columns of ``big.join(small, keys, how)``, in its order.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type {how} would repeat the copied rows")
    hot = pieces_of_hot_keys(big, keys) if hot is None else hot
    if not hot:
        return big.join(small, list(keys), how)
    if len(hot) > HOT_KEYS + 1:
        raise ValueError(f"{len(hot)} heavy keys; at most {HOT_KEYS} are dealt out")
    heavy = F.broadcast(big.sparkSession.createDataFrame(list(hot.items()), "__h long, __n int"))      # HOT_KEYS rows at most

    def weighed(df: DataFrame) -> DataFrame:
        return df.withColumn("__h", F.xxhash64(*keys)).join(heavy, "__h", "left").withColumn("__n", F.coalesce("__n", F.lit(1))).drop("__h")

    by = [f.name for f in big.schema.fields if "map" not in f.dataType.simpleString()] if salt_by is None else list(salt_by)
    piece = F.when(F.col("__n") > 1, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in by], F.spark_partition_id()), F.col("__n"))).otherwise(0)
    dealt = weighed(big).withColumn("__piece", piece.cast("int")).drop("__n")
    copied = weighed(small).withColumn("__piece", F.explode(F.sequence(F.lit(0), F.col("__n") - 1))).drop("__n")
    return dealt.join(copied, [*keys, "__piece"], how).drop("__piece")
