"""Per-customer value scores (F1) and score-table reports.

scores = latest-order features -> churn score -> p_repeat x M_min(k, H)
         -> zeroed at high churn -> LEFT JOIN expected AOV -> remaining, total.
The expected-AOV table is keyed by customer like the scoring rows, so the
join is a co-partitioned shuffle join; AQE broadcasts it only when runtime
size statistics say it is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custval.functions.exprs import decile_from_rank, fixed_bin, risk_tier
from custval.operators.joins import join_small
from custval.operators.ranking import at_quantile, attach_quantiles, running_totals
from custval.params import Params
from custval.plans.hazard.curve import demo_score, m_of

L = F.lit


def score_orders(latest: DataFrame, m: dict[int, float], p: Params, score: Column | None = None) -> DataFrame:
    s = demo_score() if score is None else score
    t = latest.withColumn("churn_prob", s).withColumn("p_repeat", 1 - F.col("churn_prob"))
    return t.select(
        "customer_id", "order_seq", "churn_prob", "p_repeat",
        risk_tier("churn_prob", p.tier_high, p.tier_medium).alias("risk_tier"),
        (F.col("p_repeat") * m_of(F.col("order_seq"), m, p.horizon)).alias("expected_future_orders"),
        F.col("cum_net_spend").cast("double").alias("realized_value"))


def zero_high_churn(scored: DataFrame, cutoff: float) -> DataFrame:
    """churn_prob >= cutoff -> no expected future orders."""
    return scored.withColumn("expected_future_orders",
                             F.when(F.col("churn_prob") >= cutoff, L(0.0)).otherwise(F.col("expected_future_orders")))


def combine(scored: DataFrame, aov: DataFrame, fallback_aov: float | None = None) -> DataFrame:
    return with_fallback(scored.join(aov.select("customer_id", "expected_aov"), "customer_id", "left"), fallback_aov)


def with_fallback(out: DataFrame, fallback_aov: float | None) -> DataFrame:
    """Customers without an order value of their own get the fallback, if one is given; then remaining and total value."""
    if fallback_aov is not None:
        out = out.withColumn("expected_aov", F.coalesce("expected_aov", L(float(fallback_aov))))
    remaining = F.col("expected_future_orders") * F.col("expected_aov")
    return (out.withColumn("remaining_pltv", remaining)
               .withColumn("total_pltv", F.coalesce("realized_value", L(0.0)) + F.col("remaining_pltv")))


def pltv_scores(latest: DataFrame, m: dict[int, float], aov: DataFrame, p: Params,
                fallback_aov: float | None = None, score: Column | None = None) -> DataFrame:
    s = zero_high_churn(score_orders(latest, m, p, score), p.high_churn_cutoff)
    return combine(s, aov, fallback_aov).select(
        "customer_id", "order_seq", "churn_prob", "p_repeat", "risk_tier", "expected_future_orders",
        "realized_value", "expected_aov", "remaining_pltv", "total_pltv")


def ranked(scores: DataFrame) -> DataFrame:
    """O2: scores in descending total value (range-partitioned global sort)."""
    return scores.orderBy(F.col("total_pltv").desc_nulls_last(), F.col("customer_id"))


def write_scores(scores: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write the score table in descending value order."""
    from custval.sources.sinks import write_table
    write_table(ranked(scores), path, fmt)


# --- reports -----------------------------------------------------------------

QS = [0.1, 0.25, 0.5, 0.75, 0.9]


def describe(scores: DataFrame, col: str = "remaining_pltv") -> DataFrame:
    """count, mean, std, min, p10-p90, max (NULLs skipped)."""
    agg = scores.agg(F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
                     F.min(col).alias("min"), F.max(col).alias("max"))
    names = [f"p{int(x * 100)}" for x in QS]
    out = attach_quantiles(agg, scores, {"v": F.col(col)}, [(n, "v", q) for n, q in zip(names, QS)])
    return out.select("count", "mean", "std", "min", *names, "max")


def null_report(scores: DataFrame) -> DataFrame:
    """customers with and without a remaining value / an expected AOV."""
    return scores.agg(
        F.count("remaining_pltv").alias("non_null_remaining"),
        F.count_if(F.col("remaining_pltv").isNull()).alias("null_remaining"),
        F.count("expected_aov").alias("customers_with_aov"),
        F.count(F.lit(1)).alias("customers_scored"))


def by_stage(scores: DataFrame) -> DataFrame:
    """mean remaining value by order_seq."""
    return scores.groupBy("order_seq").agg(F.avg("remaining_pltv").alias("mean_remaining"),
                                           F.count(F.lit(1)).alias("customers"))


def quality_checks(scores: DataFrame, p: Params) -> DataFrame:
    """deciles, top vs bottom 10% sums, high-churn share and their orders."""
    k = int(0.1 * scores.count())
    vals = scores.where(F.col("remaining_pltv").isNotNull()).select("customer_id", "remaining_pltv")
    # one ascending ranking: bottom k = first k positions, top k = last k, deciles by place
    run = running_totals(vals, [F.col("remaining_pltv").asc(), F.col("customer_id")], [], row_col="pos",
                         total_col="m")
    pos, m, v = F.col("pos"), F.col("m"), F.col("remaining_pltv")
    deciles = {f"d{i}0": i / 10 for i in range(1, 10)}
    ranked_row = run.agg(F.sum(F.when(pos > m - k, v)).alias("top_10pct_sum"), F.sum(F.when(pos <= k, v)).alias("bottom_10pct_sum"),
                         *[at_quantile(pos, m, v, q).alias(d) for d, q in deciles.items()]).first()
    hi = F.col("churn_prob") >= p.high_churn_cutoff
    agg = scores.agg(
        (F.count_if(hi) * 100.0 / F.count(F.lit(1))).alias("high_churn_pct"),
        F.count_if(hi).alias("high_churn_customers"),
        F.count_distinct(F.when(hi, F.col("expected_future_orders"))).alias("high_churn_distinct_orders"),
        F.max(F.when(hi, F.col("expected_future_orders"))).alias("high_churn_max_orders"),
    )
    return agg.select(*[L(ranked_row[d]).cast("double").alias(d) for d in deciles], L(k).cast("bigint").alias("k"),
                      *[L(ranked_row[c]).cast("double").alias(c) for c in ("top_10pct_sum", "bottom_10pct_sum")],
                      "high_churn_pct", "high_churn_customers", "high_churn_distinct_orders", "high_churn_max_orders")


def reportable(scores: DataFrame, loyal: int = 20) -> DataFrame:
    """Reporting slice -- order_seq <= 20 and positive remaining value."""
    return scores.where((F.col("order_seq") <= loyal) & (F.col("remaining_pltv") > 0))


def with_deciles(scores: DataFrame, col: str = "remaining_pltv") -> DataFrame:
    """Decile of the 1-based value rank (ties by total desc, then id)."""
    r = running_totals(scores, [F.col(col).asc(), F.col("total_pltv").desc(), F.col("customer_id")], [],
                       row_col="value_rank", total_col="_n")
    return r.withColumn("decile", decile_from_rank(F.col("value_rank"), F.col("_n")))


def decile_concentration(scores: DataFrame) -> DataFrame:
    """remaining value and its share of the total by decile (reporting slice)."""
    d = with_deciles(reportable(scores))
    total = d.agg(F.sum("remaining_pltv")).first()[0]
    return d.groupBy("decile").agg(F.count(F.lit(1)).alias("customers"),
                                   F.sum("remaining_pltv").alias("remaining"),
                                   (F.sum("remaining_pltv") * 100.0 / L(total)).alias("pct_of_total"))


def trend_and_tiers(scores: DataFrame) -> DataFrame:
    """least-squares line of remaining on expected orders (both > 0)."""
    s = reportable(scores).where(F.col("expected_future_orders") > 0)
    return s.agg(F.regr_slope("remaining_pltv", "expected_future_orders").alias("slope"),
                 F.regr_intercept("remaining_pltv", "expected_future_orders").alias("intercept"),
                 F.count(F.lit(1)).alias("customers"))


def by_tier(scores: DataFrame) -> DataFrame:
    """mean remaining value by risk tier (reporting slice)."""
    return reportable(scores).groupBy("risk_tier").agg(F.avg("remaining_pltv").alias("mean_remaining"),
                                                       F.count(F.lit(1)).alias("customers"))


def histogram(scores: DataFrame, bins: int = 50, cap: float | None = None) -> DataFrame:
    """Equal-width bins of the remaining value of every row that has one; with ``cap``, larger values fall in the last bin.

    F7b passes the reporting slice (``reportable``); F8 the scored customers.
    """
    v = scores.where(F.col("remaining_pltv").isNotNull())
    r = v.agg(F.min("remaining_pltv").alias("lo"), F.max("remaining_pltv").alias("hi")).first()
    lo, hi = r["lo"], r["hi"] if cap is None else cap
    if lo is None:
        return v.select(L(0).alias("bin"), L(0.0).alias("edge_lo"), L(0.0).alias("edge_hi"), L(0).cast("bigint").alias("customers")).where("false")
    x = F.col("remaining_pltv") if cap is None else F.least(F.col("remaining_pltv"), L(hi))
    c = v.select(fixed_bin(x, L(lo), L(hi), bins).alias("bin")).groupBy("bin").count()
    spine = v.agg(F.count(F.lit(1)).alias("_c")).select(F.explode(F.sequence(L(0), L(bins - 1))).alias("bin"))
    step = (hi - lo) / bins
    return join_small(spine, c, "bin", "left", known_rows=bins).select(
        "bin", (L(lo) + F.col("bin") * L(step)).alias("edge_lo"), (L(lo) + (F.col("bin") + 1) * L(step)).alias("edge_hi"),
        F.coalesce("count", L(0)).cast("bigint").alias("customers"))


def scorecard(scores: DataFrame, p: Params) -> DataFrame:
    """F8: the published aggregate file's shape, as long-form rows.

    sections: seq (stage 1..8+ customers and mean), risk (customers and total),
    dec_pct (share by decile), hist (30 bins, top capped at p99), totals.  The
    first four each count every scored customer once.
    """
    scored = scores.where(F.col("remaining_pltv").isNotNull())
    seq = (scored.withColumn("b", F.least(F.col("order_seq"), L(p.max_bucket)).cast("string"))
           .groupBy("b").agg(F.count(F.lit(1)).alias("customers"), F.avg("remaining_pltv").alias("value"))
           .select(L("seq").alias("section"), F.col("b").alias("bucket"), "customers", "value"))
    risk = (scored.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("customers"), F.sum("remaining_pltv").alias("value"))
            .select(L("risk").alias("section"), F.col("risk_tier").alias("bucket"), "customers", "value"))
    d = with_deciles(scored)
    total = scored.agg(F.sum("remaining_pltv")).first()[0]
    dec = (d.groupBy("decile").agg(F.count(F.lit(1)).alias("customers"),
                                   (F.sum("remaining_pltv") * 100.0 / L(total)).alias("value"))
           .select(L("dec_pct").alias("section"), F.col("decile").cast("string").alias("bucket"), "customers", "value"))
    # the deciles' ranking also places the totals' median and p99, which caps the histogram
    rank, n, rem = F.col("value_rank"), F.col("_n"), F.col("remaining_pltv")
    qv = d.agg(at_quantile(rank, n, rem, 0.5).alias("median"), at_quantile(rank, n, rem, 0.99).alias("p99")).first()
    h = histogram(scored, 30, cap=qv["p99"]).select(
        L("hist").alias("section"), F.col("bin").cast("string").alias("bucket"), "customers",
        F.col("edge_lo").alias("value"))
    tot = scores.agg(F.count(F.lit(1)).alias("n"), F.count("remaining_pltv").alias("scored"),
                     F.sum("remaining_pltv").alias("remaining"))
    tot = tot.select("*", L(qv["median"]).cast("double").alias("median"), L(qv["p99"]).cast("double").alias("p99"))
    def row(bucket, customers, value):
        return F.struct(L(bucket).alias("bucket"), customers.cast("bigint").alias("customers"),
                        value.cast("double").alias("value"))
    none = L(None)
    totals = tot.select(F.explode(F.array(
        row("n", F.col("n"), none), row("scored", F.col("scored"), none),
        row("na", F.col("n") - F.col("scored"), none), row("remaining", none, F.col("remaining")),
        row("median_remaining", none, F.col("median")), row("p99", none, F.col("p99")))).alias("t")).select(
        L("totals").alias("section"), "t.bucket", "t.customers", "t.value")
    return seq.unionByName(risk).unionByName(dec).unionByName(h).unionByName(totals)


def scorecard_json(card: DataFrame) -> DataFrame:
    """The scorecard as the published nested document, one row (buckets in order)."""
    def part(section, *cols):
        row = F.struct(F.try_to_number(F.col("bucket"), L("99")).alias("o"), F.col("bucket"), *cols)
        return F.sort_array(F.collect_list(F.when(F.col("section") == section, row)))

    def total(bucket, col):
        return F.max(F.when((F.col("section") == "totals") & (F.col("bucket") == bucket), F.col(col))).alias(bucket)

    row = card.agg(part("seq", "customers", "value").alias("seq"), part("risk", "customers", "value").alias("risk"),
                   part("dec_pct", "value").alias("dec"), part("hist", "customers", "value").alias("hist"),
                   F.struct(total("n", "customers"), total("scored", "customers"), total("na", "customers"), total("remaining", "value"),
                            total("median_remaining", "value"), total("p99", "value")).alias("totals"))
    return row.select(F.to_json(F.struct(
        F.transform("seq", lambda x: F.struct(x.bucket.cast("int").alias("seq_b"), x.customers.alias("customers"), x.value.alias("mean_remaining"))).alias("seq"),
        F.transform("risk", lambda x: F.struct(x.bucket.alias("tier"), x.customers.alias("customers"), x.value.alias("total"))).alias("risk"),
        F.transform("dec", lambda x: x.value).alias("dec_pct"),
        F.struct(F.transform("hist", lambda x: x.customers).alias("counts"), F.transform("hist", lambda x: x.value).alias("edges")).alias("hist"),
        "totals")).alias("json"))
