"""Global order statistics without a single-partition window.

``running_totals`` gives every row its 1-based position and inclusive running
sums in a total order (optionally per small group such as an order stage):

1. range-partition and sort by (group, order) -- balanced by sampling;
2. cut lineage (checkpoint) so the partition a row sits in is fixed;
3. per (partition, group) totals -- one row per partition and group;
4. exclusive prefix over partitions on that small table -> offsets;
5. positions and running sums inside each partition, in its read order
   (one vectorised pass, no further shuffle), plus the offset.

No step moves a whole group into one task, so a stage holding a third of
all rows is still spread over many partitions.  Callers whose order has ties
first count equal values, so a value that a third of the rows share is one row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custval.operators.persist import materialize, settle


def _local_totals(ranged: DataFrame, group: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``ranged`` with running sums ``_l_<value>`` (bigint) within each partition and group, in read order."""
    def heads_of(batch) -> np.ndarray:
        """Rows at which a group begins."""
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for g in group:
            code = pc.fill_null(batch.column(g).dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
            new[1:] |= code[1:] != code[:-1]
        return np.flatnonzero(new)

    def run(batches):
        last, carry = None, [0] * len(values)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if [batch.column(g)[0].as_py() for g in group] != last:
                carry = [0] * len(values)
            heads = heads_of(batch)
            size = np.diff(np.append(heads, batch.num_rows))
            out = []
            for k, v in enumerate(values):
                total = np.cumsum(batch.column(v).to_numpy(zero_copy_only=False).astype(np.int64))
                before = np.concatenate([[0], total])[heads]
                before[0] -= carry[k]
                total = total - np.repeat(before, size)
                carry[k] = int(total[-1])
                out.append(pa.array(total, pa.int64()))
            last = [batch.column(g)[-1].as_py() for g in group]
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=[*batch.schema.names, *[f"_l_{v}" for v in values]])

    schema = T.StructType([*ranged.schema.fields, *[T.StructField(f"_l_{v}", T.LongType()) for v in values]])
    return ranged.mapInArrow(run, schema)


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which null group keys meet."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(right, on)


def running_totals(df: DataFrame, order: Sequence[Column], values: Sequence[str] = (),
                   group: Sequence[str] = (), row_col: str = "row_pos",
                   total_col: str | None = None) -> DataFrame:
    """``df`` with positions and running sums of the integer columns ``values`` (nulls must be absent)."""
    keys = [F.col(g) for g in group] + list(order)
    ranged = (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                .withColumn("_pid", F.spark_partition_id()))
    ranged = materialize(ranged)
    # Reading the checkpoint returns each partition in its sorted order, and
    # monotonically_increasing_id numbers a partition's rows consecutively, so
    # a row's place inside its (partition, group) needs no further shuffle.
    ranged = ranged.withColumn("_mid", F.monotonically_increasing_id())
    part_keys = ["_pid", *group]
    tot = ranged.groupBy(*part_keys).agg(F.count(F.lit(1)).alias("_t_n"), F.min("_mid").alias("_first"),
                                         *[F.sum(v).alias(f"_t_{v}") for v in values])
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    off = tot.select(*part_keys, "_first", F.coalesce(F.sum("_t_n").over(before), F.lit(0)).alias("_o_n"),
                     F.sum("_t_n").over(whole).alias("_all_n"),
                     *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_o_{v}") for v in values],
                     *[F.sum(f"_t_{v}").over(whole).alias(f"_a_{v}") for v in values])
    local = _local_totals(ranged, group, values) if values else ranged
    # one row per partition and group in it: partitions plus groups at most, whatever the rows
    out = local.join(F.broadcast(off), part_keys) if not group else _null_safe(local, F.broadcast(off), part_keys)
    return out.select(
        *[c for c in df.columns],
        (F.col("_o_n") + (F.col("_mid") - F.col("_first")) + 1).alias(row_col),
        *([F.col("_all_n").alias(total_col)] if total_col else []),
        *[(F.col(f"_o_{v}") + F.col(f"_l_{v}")).alias(f"cum_{v}") for v in values],
        *[F.col(f"_a_{v}").alias(f"all_{v}") for v in values])


def running_before(df: DataFrame, order: Sequence[Column], values: Sequence[str], group: Sequence[str], spent: list[DataFrame] | None = None) -> DataFrame:
    """``df`` with ``before_<value>``: the sum of each integer column over the earlier rows of the row's group.

    For any number of groups of any size: rows are dealt by ranges of (group,
    order), so a group with a third of all rows spans many partitions and a
    small one shares its partition.  Only a partition's first group can have
    begun before it; what it brings along is one row per partition at most.
    ``order`` must be total within a group.  ``spent`` gets the written frame that the result reads, for ``persist.discard``.
    """
    keys = [*[F.col(g) for g in group], *order]
    ranged = settle(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_pid", F.spark_partition_id()))
    if spent is not None:
        spent.append(ranged)
    totals = ranged.groupBy("_pid", *group).agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    earlier = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    brought = (totals.select("_pid", *[F.col(g).alias(f"_g_{g}") for g in group], F.count(F.lit(1)).over(earlier).alias("_parts"),
                             *[F.sum(f"_t_{v}").over(earlier).alias(f"_o_{v}") for v in values])
               .where("_parts > 0").drop("_parts"))
    own = F.lit(True)
    for g in group:
        own = own & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    out = _local_totals(ranged, group, values).join(F.broadcast(brought), "_pid", "left")
    return out.select(*df.columns, *[(F.col(f"_l_{v}") - F.col(v) + F.coalesce(F.when(own, F.col(f"_o_{v}")), F.lit(0))).alias(f"before_{v}") for v in values])


def exact_auc(scored: DataFrame, score: str, label: str, group: Sequence[str] = ()) -> DataFrame:
    """Exact ROC AUC (ties count one half) per group, label 1 = positive.

    Scores are first reduced to (group, score) -> (pos, neg) counts; the
    running negative count below each score comes from ``running_totals``.
    """
    counts = scored.groupBy(*group, score).agg(
        F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).alias("pos"),
        F.coalesce(F.sum((1 - F.col(label)).cast("long")), F.lit(0)).alias("neg"))
    return auc_of_counts(counts, score, group)


def auc_of_counts(counts: DataFrame, score: str, group: Sequence[str] = ()) -> DataFrame:
    """``exact_auc`` of rows that are already counted: (group, score, pos, neg), one per score."""
    run = running_totals(counts, [F.col(score).asc()], ["neg"], group)
    below = F.col("cum_neg") - F.col("neg")
    # products of counts pass 2**63 at about 3e9 of each label: doubles
    agg = run.groupBy(*group).agg(
        F.sum(F.col("pos").cast("double") * (below + F.col("neg") / 2.0)).alias("_num"),
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return agg.select(*group, "pos", "neg",
                      F.when((F.col("pos") > 0) & (F.col("neg") > 0),
                             F.col("_num") / (F.col("pos").cast("double") * F.col("neg"))).alias("auc"))


def exact_quantiles(df: DataFrame, metrics: dict[str, Column], requests: Sequence[tuple[str, str, float]],
                    group: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolation quantiles (same definition as ``percentile``
    / SQL ``quantile_cont``) per group, without gathering a group's values in
    one buffer.

    ``metrics`` maps a name to a value column; ``requests`` lists
    (output column, metric name, q).  Values are melted to (group, metric,
    value) and equal ones counted, so ties are one row and no tie-breaker is
    needed; the counts' running totals place each value, and only the values
    at floor/ceil of (n - 1) * q survive to the final, tiny aggregate.
    """
    melted = df.select(*group, F.explode(F.array(*[
        F.struct(F.lit(k).alias("_m"), e.cast("double").alias("_v")) for k, e in metrics.items()])).alias("_x")
    ).select(*group, "_x._m", "_x._v").where(F.col("_v").isNotNull())
    counted = melted.groupBy(*group, "_m", "_v").agg(F.count(F.lit(1)).alias("c"))
    r = running_totals(counted, [F.col("_v").asc()], ["c"], [*group, "_m"])
    first, last = F.col("cum_c") - F.col("c"), F.col("cum_c") - 1
    parts, keep = [], F.lit(False)
    for out, metric, q in requests:
        h = (F.col("all_c") - 1) * F.lit(float(q))
        lo, hi = F.floor(h), F.ceil(h)
        frac = h - lo
        mine = F.col("_m") == metric
        has_lo, has_hi = lo.between(first, last), hi.between(first, last)
        w = F.when(mine & has_lo & has_hi, F.lit(1.0)).when(mine & has_lo, 1 - frac).when(mine & has_hi, frac)
        keep = keep | (mine & (has_lo | has_hi))
        parts.append(F.struct(F.lit(out).alias("o"), w.alias("w")))
    picked = r.where(keep).select(*group, "_v", F.explode(F.array(*parts)).alias("p")).where(F.col("p.w").isNotNull())
    outs = [o for o, _, _ in requests]
    return (picked.groupBy(*group).pivot("p.o", outs).agg(F.sum(F.col("_v") * F.col("p.w")))
                  .select(*group, *[F.col(o).cast("double").alias(o) for o in outs]))


def at_quantile(pos: Column, n: Column, value: Column, q: float) -> Column:
    """Aggregate: the linear quantile of a column whose 1-based rank is ``pos`` of ``n``."""
    h = (n - 1) * F.lit(float(q))
    lo, hi = F.floor(h), F.ceil(h)
    return F.sum(F.when((pos - 1 == lo) & (lo == hi), value).when(pos - 1 == lo, value * (1 - (h - lo)))
                 .when(pos - 1 == hi, value * (h - lo)))


def scalar_quantiles(df: DataFrame, column: Column, qs: Sequence[float]) -> list[float | None]:
    """A few exact quantiles of one column, as driver values (one small row)."""
    res = exact_quantiles(df, {"v": column}, [(f"q{i}", "v", q) for i, q in enumerate(qs)]).collect()
    if not res:
        return [None] * len(qs)
    return [res[0][f"q{i}"] for i in range(len(qs))]


def attach_quantiles(agg: DataFrame, df: DataFrame, metrics: dict[str, Column],
                     requests: Sequence[tuple[str, str, float]], group: Sequence[str] = ()) -> DataFrame:
    """Add exact quantile columns to a per-group aggregate ``agg`` (one row per group)."""
    q = exact_quantiles(df, metrics, requests, group)
    if group:
        return agg.join(q, list(group), "left")
    # ungrouped: the result is one small row -- attach its values as literals
    row = q.first()
    return agg.select("*", *[F.lit(row[o] if row is not None else None).cast("double").alias(o)
                             for o, _, _ in requests])
