"""Oracle statements for the validation protocol (V-keys)."""

from __future__ import annotations

from dataclasses import replace

from custval.oracle.aov import R
from custval.oracle.fixtures import params_fmt, prefixed, with_ctes
from custval.oracle.pltv import score_ctes
from custval.params import DEFAULT

PC = replace(DEFAULT, as_of=DEFAULT.train_cutoff)
BEFORE = replace(DEFAULT, as_of=DEFAULT.as_of.fromordinal(DEFAULT.as_of.toordinal() - 30))


def vf_ctes() -> list[str]:
    f = params_fmt(DEFAULT)
    return score_ctes(PC, holdout_aov=True, aov_p=DEFAULT) + [f"""
room AS (SELECT COALESCE(GREATEST(1, CAST(ROUND_EVEN({DEFAULT.holdout_days} / AVG(days_to_next_order), 0) AS BIGINT)), 1) AS n
         FROM panel WHERE churned_400d = 0)""", f"""
paths(k, done, chance) AS (
  SELECT k, CAST(1 AS BIGINT), CAST(1.0 AS DOUBLE) FROM curve
  UNION ALL
  SELECT p.k, p.done + 1, p.chance * c.r FROM paths p JOIN curve c ON c.k = LEAST(p.k + p.done, {f['max_bucket']})
  WHERE p.done < (SELECT n FROM room))""", """
within AS (SELECT k, SUM(chance) AS orders FROM paths GROUP BY k)""", f"""
realized AS (
  SELECT customer_id, CAST(SUM(net_sales) AS DOUBLE) AS realized_spend, COUNT(DISTINCT order_date) AS realized_days,
         COUNT(DISTINCT order_id) AS realized_orders
  FROM order_lines WHERE customer_id > 0 AND channel_type NOT IN ({f['haz_excl']})
    AND order_date > {f['train_cutoff']} AND order_date <= {f['as_of']}
  GROUP BY customer_id)""", f"""
vf AS (
  SELECT s.*, CASE WHEN s.churn_prob >= {f['cutoff']} THEN 0.0 ELSE s.p_repeat * w.orders END * s.expected_aov AS window_pltv,
         l.acq_channel, l.entry_department, l.customer_state,
         COALESCE(r.realized_spend, 0.0) AS realized_spend, COALESCE(r.realized_days, 0) AS realized_days,
         COALESCE(r.realized_orders, 0) AS realized_orders, a.test_n_orders, a.test_sum_value
  FROM scores s JOIN within w ON w.k = LEAST(s.order_seq, {f['max_bucket']}) LEFT JOIN latest l USING (customer_id)
       LEFT JOIN realized r USING (customer_id) LEFT JOIN custfit a USING (customer_id))""", """
vs AS (SELECT * FROM vf WHERE remaining_pltv IS NOT NULL)""", """
vs_dec AS (SELECT *, CASE WHEN n <= 1 THEN 1 ELSE GREATEST(1, CAST(CEIL((r - 1) * 10 / (n - 1)) AS INTEGER)) END AS bucket
           FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY remaining_pltv, customer_id) AS r, COUNT(*) OVER () AS n FROM vs))""",
        """
gains AS (SELECT bucket, COUNT(*) AS customers, SUM(realized_spend) / (SELECT SUM(realized_spend) FROM vs) AS realized_share,
                 (SUM(realized_spend) / (SELECT SUM(realized_spend) FROM vs)) / (COUNT(*) / (SELECT COUNT(*) FROM vs)) AS lift
          FROM vs_dec GROUP BY bucket)""", """
dollars AS (SELECT bucket, COUNT(*) AS customers, AVG(window_pltv) AS mean_predicted, AVG(realized_spend) AS mean_realized,
                   SUM(realized_spend) / NULLIF(SUM(window_pltv), 0) AS ratio FROM vs_dec GROUP BY bucket)""", """
states AS (SELECT customer_state, AVG(expected_aov) AS state_aov FROM vs GROUP BY customer_state)""", """
segments AS (
  SELECT segment, value, COUNT(*) AS customers, SUM(window_pltv) AS predicted_total, SUM(realized_spend) AS realized_total
  FROM (SELECT window_pltv, realized_spend, UNNEST([
          {'segment': 'stage', 'value': CASE WHEN order_seq = 1 THEN 'first' ELSE 'repeat' END},
          {'segment': 'acq_channel', 'value': COALESCE(acq_channel, 'missing')},
          {'segment': 'entry', 'value': CASE WHEN entry_department LIKE '%Footwear' THEN 'footwear' ELSE 'other' END},
          {'segment': 'state_aov', 'value': CASE WHEN state_aov >= (SELECT AVG(expected_aov) FROM vs) THEN 'high' ELSE 'low' END}],
          recursive := true)
        FROM vs LEFT JOIN states USING (customer_state)) x
  GROUP BY segment, value)""", """
by_frequency AS (
  SELECT bucket, COUNT(*) AS customers, AVG(expected_future_orders) AS mean_orders, AVG(expected_aov) AS promised,
         AVG(realized_aov) AS paid
  FROM (SELECT *, CASE WHEN n <= 1 THEN 1 ELSE GREATEST(1, CAST(CEIL((r - 1) * 5 / (n - 1)) AS INTEGER)) END AS bucket
        FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY expected_future_orders, customer_id) AS r, COUNT(*) OVER () AS n
              FROM (SELECT *, test_sum_value / test_n_orders AS realized_aov FROM vf
                    WHERE expected_aov IS NOT NULL AND test_n_orders > 0))) b
  GROUP BY bucket)"""]


def _q(body: str, extra=()) -> str:
    return with_ctes(*(vf_ctes() + list(extra)), recursive=True) + "\n" + body


def frequency_aov_interaction() -> str:
    return _q(f"""SELECT CAST(bucket AS BIGINT) AS bucket, customers, {R('mean_orders')} AS mean_expected_orders,
  {R('promised', 4)} AS mean_predicted_aov, {R('paid', 4)} AS mean_realized_aov,
  {R('paid / promised')} AS realized_over_predicted FROM by_frequency""")


def orders_per_purchase_day() -> str:
    return _q(f"""SELECT COUNT(*) AS customers, {R('AVG(ratio)')} AS mean_ratio, {R('MEDIAN(ratio)')} AS median_ratio,
  {R('QUANTILE_CONT(ratio, 0.9)')} AS p90_ratio, {R('MAX(ratio)')} AS max_ratio,
  {R('AVG(CAST(ratio = 1 AS DOUBLE))')} AS share_one, {R('SUM(realized_orders) / SUM(realized_days)')} AS correction
FROM (SELECT *, realized_orders / realized_days AS ratio FROM vf WHERE realized_days > 0)""")


def decile_dollars() -> str:
    return _q(f"""SELECT CAST(bucket AS BIGINT) AS bucket, customers, {R('mean_predicted', 4)} AS mean_predicted,
  {R('mean_realized', 4)} AS mean_realized, {R('ratio')} AS realized_over_predicted FROM dollars""")


BIAS = "SUM(realized_spend) / NULLIF(SUM(window_pltv), 0)"


def aggregate_bias() -> str:
    return _q(f"""SELECT COUNT(*) AS customers, {R('SUM(window_pltv)', 2)} AS predicted_total,
  {R('SUM(realized_spend)', 2)} AS realized_total, {R(BIAS)} AS ratio, ABS({BIAS} - 1) <= 0.1 AS within_tolerance FROM vs""")


AVG_RANK = "(RANK() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0)"


def rank_quality() -> str:
    return _q(f"""SELECT {R('(SELECT CORR(ra, rb) FROM rk)')} AS spearman, {R('lift')} AS top_decile_lift,
  {R('realized_share')} AS top_decile_share FROM gains WHERE bucket = 10""", [f"""
rk AS (SELECT {AVG_RANK.format(c='remaining_pltv')} AS ra, {AVG_RANK.format(c='realized_spend')} AS rb FROM vs)"""])


def gains() -> str:
    return _q(f"""SELECT CAST(a.bucket AS BIGINT) AS bucket, a.customers, {R('a.realized_share')} AS realized_share, {R('a.lift')} AS lift,
  {R('SUM(b.realized_share)')} AS cumulative_share,
  {R('SUM(b.realized_share) / (SUM(b.customers) / (SELECT COUNT(*) FROM vs))')} AS cumulative_lift
FROM gains a JOIN gains b ON b.bucket >= a.bucket GROUP BY ALL""")


def segment_calibration() -> str:
    return _q(f"""SELECT segment, value, customers, {R('predicted_total', 2)} AS predicted_total,
  {R('realized_total', 2)} AS realized_total, {R('realized_total / NULLIF(predicted_total, 0)')} AS ratio FROM segments""")


def horizon_ctes() -> list[str]:
    f = params_fmt(PC)
    B, cut = f["max_bucket"], f["cutoff"]
    recs, vals = [], []
    for h in (10, 15, 20):
        recs.append(f"""
mh{h}(k, m) AS (SELECT {h + 1}, CAST(1.0 AS DOUBLE) UNION ALL
               SELECT mh{h}.k - 1, 1 + c.r * mh{h}.m FROM mh{h} JOIN curve c ON c.k = LEAST(mh{h}.k, {B})
               WHERE mh{h}.k > 1)""")
        vals.append(f"(CASE WHEN churn_prob >= {cut} THEN 0.0 ELSE p_repeat * (SELECT m FROM mh{h} WHERE k = LEAST(vs.order_seq, {h})) END)"
                    f" * expected_aov AS v{h}")
    hv = "hv AS (SELECT customer_id, " + ", ".join(vals) + " FROM vs)"
    ranks = "hr AS (SELECT " + ", ".join(AVG_RANK.format(c=f"v{h}") + f" AS r{h}" for h in (10, 15, 20)) + " FROM hv)"
    return recs + [hv, ranks]


def horizon_sensitivity() -> str:
    body = " UNION ALL ".join(
        f"SELECT CAST({h} AS BIGINT) AS horizon, {R(f'(SELECT SUM(v{h}) FROM hv)', 2)} AS predicted_total, "
        f"{R(f'(SELECT CORR(r{h}, r15) FROM hr)')} AS spearman_vs_base" for h in (10, 15, 20))
    return _q(body, horizon_ctes())


def _prod(body: str, extra=()) -> str:
    return with_ctes(*(score_ctes() + list(extra)), recursive=True) + "\n" + body


def fallback_share() -> str:
    return _prod(f"""SELECT COUNT(*) AS customers, COUNT(*) - COUNT(expected_aov) AS on_fallback,
  {R('(COUNT(*) - COUNT(expected_aov)) / COUNT(*)')} AS share FROM scores""")


def extremes() -> str:
    return _prod(f"""SELECT COUNT(CASE WHEN p_repeat >= 0.95 THEN 1 END) AS p_repeat_ge_095,
  COUNT(CASE WHEN remaining_pltv < 0 THEN 1 END) AS negative_remaining, COUNT(CASE WHEN total_pltv < 0 THEN 1 END) AS negative_total,
  {R('MAX(remaining_pltv)', 4)} AS max_remaining, {R('MAX(total_pltv)', 4)} AS max_total FROM scores""")


def top_customers() -> str:
    return _prod(f"""SELECT customer_id, order_seq, {R('churn_prob')} AS churn_prob, {R('p_repeat')} AS p_repeat, risk_tier,
  {R('expected_future_orders')} AS expected_future_orders, {R('realized_value', 4)} AS realized_value,
  {R('expected_aov', 4)} AS expected_aov, {R('remaining_pltv', 4)} AS remaining_pltv, {R('total_pltv', 4)} AS total_pltv
FROM scores WHERE total_pltv IS NOT NULL ORDER BY total_pltv DESC, customer_id LIMIT 100""")


def score_stability() -> str:
    before = prefixed(score_ctes(BEFORE), "b_")
    return _prod(f"""SELECT COUNT(*) AS customers, {R('AVG(d)', 4)} AS mean_delta,
  {R('QUANTILE_CONT(d, 0.1)', 4)} AS p10_delta, {R('QUANTILE_CONT(d, 0.5)', 4)} AS p50_delta,
  {R('QUANTILE_CONT(d, 0.9)', 4)} AS p90_delta, {R('AVG(CAST(ABS(d) <= 0.1 * ABS(bef) AS DOUBLE))')} AS share_within_10pct,
  {R('CORR(nw, bef)')} AS corr
FROM (SELECT a.remaining_pltv AS nw, b.remaining_pltv AS bef, a.remaining_pltv - b.remaining_pltv AS d
      FROM scores a JOIN b_scores b USING (customer_id)
      WHERE a.remaining_pltv IS NOT NULL AND b.remaining_pltv IS NOT NULL) x""", before)


def pass_criteria() -> str:
    f = params_fmt(DEFAULT)
    v = prefixed(vf_ctes() + horizon_ctes(), "v_")
    before = prefixed(score_ctes(BEFORE), "b_")
    w5 = "CASE WHEN tau2 > 0 THEN 5 / (5 + k) ELSE 0 END"
    # criterion, threshold, verdict on x, one-row query of x
    rules = [
        ("tau2_positive", 0.0, "x > 0", "SELECT tau2 AS x FROM fitp"),
        ("w5_above_0_4", 0.4, "x > 0.4", f"SELECT {w5} AS x FROM fitp"),
        ("aov_holdout_calibration", 1.0, "ABS(x - 1) <= 0.1",
         "SELECT AVG(expected_aov) / AVG(test_sum_value / test_n_orders) AS x FROM v_custfit WHERE test_n_orders > 0"),
        ("curve_calibration_max_gap", 0.03, "x <= 0.03",
         "SELECT MAX(ABS(pr - ac)) AS x FROM (SELECT AVG(p_repeat) AS pr, 1 - AVG(churned_400d) AS ac FROM test_rows GROUP BY seq_bucket)"),
        ("interaction_max_drift", 0.1, "x <= 0.1",
         "SELECT MAX(ABS(paid / promised / (SELECT SUM(paid / promised * customers) / SUM(customers) FROM v_by_frequency) - 1)) AS x"
         " FROM v_by_frequency"),
        ("grain_correction", 0.05, "x <= 0.05",
         "SELECT ABS(SUM(realized_orders) / SUM(realized_days) - 1) AS x FROM v_vf WHERE realized_days > 0"),
        ("decile_drops", 0.0, "x = 0",
         "SELECT COUNT(*) AS x FROM v_dollars a JOIN v_dollars b ON b.bucket = a.bucket + 1 AND b.mean_realized < a.mean_realized"),
        ("decile_mean_gap", 0.1, "x <= 0.1",
         "SELECT SUM(customers * ABS(mean_realized - mean_predicted)) / SUM(customers * mean_realized) AS x FROM v_dollars"),
        ("aggregate_dollar_bias", 1.0, "ABS(x - 1) <= 0.1", f"SELECT {BIAS} AS x FROM v_vs"),
        ("top_decile_lift", 1.0, "x > 1", "SELECT lift AS x FROM v_gains WHERE bucket = 10"),
        ("segment_max_drift", 0.25, "x <= 0.25",
         f"SELECT MAX(ABS(realized_total / NULLIF(predicted_total, 0) / (SELECT {BIAS} FROM v_vs) - 1)) AS x FROM v_segments WHERE customers >= 30"),
        ("horizon_min_spearman", 0.95, "x >= 0.95", "SELECT LEAST(CORR(r10, r15), CORR(r20, r15), 1.0) AS x FROM v_hr"),
        ("month_apart_correlation", 0.9, "x >= 0.9",
         "SELECT CORR(a.remaining_pltv, b.remaining_pltv) AS x FROM scores a JOIN b_scores b USING (customer_id)"),
        ("null_aov_share", 0.005, "x < 0.005", "SELECT (COUNT(*) - COUNT(expected_aov)) / COUNT(*) AS x FROM scores"),
        ("null_remaining_share", 0.005, "x < 0.005", "SELECT (COUNT(*) - COUNT(remaining_pltv)) / COUNT(*) AS x FROM scores"),
        ("high_churn_orders_zero", 0.0, "x = 0",
         f"SELECT COALESCE(MAX(CASE WHEN churn_prob >= {f['cutoff']} THEN expected_future_orders END), 0.0) AS x FROM scores"),
    ]
    return _prod(" UNION ALL ".join(
        f"SELECT '{name}' AS criterion, {R('x')} AS value, CAST({limit} AS DOUBLE) AS threshold, {ok} AS passed FROM ({q})"
        for name, limit, ok, q in rules), v + before)
