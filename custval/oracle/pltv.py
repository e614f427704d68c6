"""Oracle statements for the value scores and their reports (F-keys)."""

from __future__ import annotations

from custval.oracle.aov import R
from custval.oracle.aov_fit import fit_ctes
from custval.oracle.curve import curve_ctes, demo
from custval.oracle.fixtures import params_fmt, with_ctes
from custval.params import DEFAULT, Params


def score_ctes(p: Params = DEFAULT, holdout_aov: bool = False, aov_p: Params | None = None) -> list[str]:
    f = params_fmt(p)
    return curve_ctes(p) + fit_ctes(holdout_aov, aov_p or p) + [f"""
sc0 AS (SELECT customer_id, order_seq, cum_net_spend, {demo()} AS churn_prob FROM latest)""", f"""
sc1 AS (SELECT *, 1 - churn_prob AS p_repeat,
               CASE WHEN churn_prob >= {f['tier_high']} THEN 'High' WHEN churn_prob >= {f['tier_medium']} THEN 'Medium'
                    ELSE 'Low' END AS risk_tier FROM sc0)""", f"""
sc2 AS (SELECT s.*, CASE WHEN churn_prob >= {f['cutoff']} THEN 0.0 ELSE s.p_repeat * m.m END AS expected_future_orders,
               CAST(cum_net_spend AS DOUBLE) AS realized_value
        FROM sc1 s JOIN mrec m ON m.k = LEAST(s.order_seq, {f['horizon']}))""", """
scores AS (SELECT s.customer_id, s.order_seq, s.churn_prob, s.p_repeat, s.risk_tier, s.expected_future_orders,
                  s.realized_value, a.expected_aov, s.expected_future_orders * a.expected_aov AS remaining_pltv,
                  COALESCE(s.realized_value, 0) + s.expected_future_orders * a.expected_aov AS total_pltv
           FROM sc2 s LEFT JOIN custfit a USING (customer_id))""", """
rep AS (SELECT * FROM scores WHERE order_seq <= 20 AND remaining_pltv > 0)"""]


def _q(body: str, extra=()) -> str:
    return with_ctes(*(score_ctes() + list(extra)), recursive=True) + "\n" + body


def pltv_scores() -> str:
    return _q(f"""SELECT customer_id, order_seq, {R('churn_prob')} AS churn_prob, {R('p_repeat')} AS p_repeat, risk_tier,
  {R('expected_future_orders')} AS expected_future_orders, {R('realized_value', 4)} AS realized_value,
  {R('expected_aov', 4)} AS expected_aov, {R('remaining_pltv', 4)} AS remaining_pltv,
  {R('total_pltv', 4)} AS total_pltv FROM scores""")


def pltv_scores_fallback() -> str:
    aov = f"COALESCE(a.expected_aov, {DEFAULT.flat_aov})"
    value = f"s.expected_future_orders * {aov}"
    return _q(f"""SELECT customer_id, order_seq, {R('churn_prob')} AS churn_prob, {R('p_repeat')} AS p_repeat, risk_tier,
  {R('expected_future_orders')} AS expected_future_orders, {R('realized_value', 4)} AS realized_value,
  {R(aov, 4)} AS expected_aov, {R(value, 4)} AS remaining_pltv,
  {R(f'COALESCE(realized_value, 0) + {value}', 4)} AS total_pltv
FROM sc2 s LEFT JOIN custfit a USING (customer_id)""")


def pltv_describe() -> str:
    q = {10: 0.1, 25: 0.25, 50: 0.5, 75: 0.75, 90: 0.9}
    qs = ", ".join(f"{R(f'QUANTILE_CONT(remaining_pltv, {v})', 4)} AS p{k}" for k, v in q.items())
    return _q(f"""SELECT COUNT(remaining_pltv) AS count, {R('AVG(remaining_pltv)', 4)} AS mean,
  {R('STDDEV_SAMP(remaining_pltv)', 4)} AS std, {R('MIN(remaining_pltv)', 4)} AS min, {qs},
  {R('MAX(remaining_pltv)', 4)} AS max FROM scores""")


def pltv_null_report() -> str:
    return _q("""SELECT COUNT(remaining_pltv) AS non_null_remaining,
  COUNT(*) - COUNT(remaining_pltv) AS null_remaining, COUNT(expected_aov) AS customers_with_aov,
  COUNT(*) AS customers_scored FROM scores""")


def pltv_by_stage() -> str:
    return _q(f"""SELECT order_seq, {R('AVG(remaining_pltv)', 4)} AS mean_remaining, COUNT(*) AS customers
FROM scores GROUP BY order_seq""")


def pltv_quality_checks() -> str:
    f = params_fmt()
    ds = ", ".join(f"{R(f'QUANTILE_CONT(remaining_pltv, {i / 10})', 4)} AS d{i}0" for i in range(1, 10))
    return _q(f"""SELECT {ds}, k.k,
  {R('(SELECT SUM(remaining_pltv) FROM top_r WHERE pos <= k.k)', 4)} AS top_10pct_sum,
  {R('(SELECT SUM(remaining_pltv) FROM bot_r WHERE pos <= k.k)', 4)} AS bottom_10pct_sum,
  {R(f'COUNT(CASE WHEN churn_prob >= {f["cutoff"]} THEN 1 END) * 100.0 / COUNT(*)')} AS high_churn_pct,
  COUNT(CASE WHEN churn_prob >= {f['cutoff']} THEN 1 END) AS high_churn_customers,
  COUNT(DISTINCT CASE WHEN churn_prob >= {f['cutoff']} THEN expected_future_orders END) AS high_churn_distinct_orders,
  {R(f'MAX(CASE WHEN churn_prob >= {f["cutoff"]} THEN expected_future_orders END)')} AS high_churn_max_orders
FROM scores, k GROUP BY k.k""", ["""
k AS (SELECT CAST(FLOOR(0.1 * COUNT(*)) AS BIGINT) AS k FROM scores)""", """
top_r AS (SELECT remaining_pltv, ROW_NUMBER() OVER (ORDER BY remaining_pltv DESC, customer_id) AS pos
          FROM scores WHERE remaining_pltv IS NOT NULL)""", """
bot_r AS (SELECT remaining_pltv, ROW_NUMBER() OVER (ORDER BY remaining_pltv ASC, customer_id) AS pos
          FROM scores WHERE remaining_pltv IS NOT NULL)"""])


DECILES = """
dec AS (SELECT *, CASE WHEN n <= 1 THEN 1 ELSE GREATEST(1, CAST(CEIL((r - 1) * 10 / (n - 1)) AS INTEGER)) END AS decile
        FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY remaining_pltv ASC, total_pltv DESC, customer_id) AS r,
                     COUNT(*) OVER () AS n FROM {src}))"""


def pltv_decile_concentration() -> str:
    return _q(f"""SELECT CAST(decile AS BIGINT) AS decile, COUNT(*) AS customers, {R('SUM(remaining_pltv)', 4)} AS remaining,
  {R('SUM(remaining_pltv) * 100.0 / (SELECT SUM(remaining_pltv) FROM rep)')} AS pct_of_total
FROM dec GROUP BY decile""", [DECILES.format(src="rep")])


def pltv_trend() -> str:
    return _q(f"""SELECT {R('REGR_SLOPE(remaining_pltv, expected_future_orders)')} AS slope,
  {R('REGR_INTERCEPT(remaining_pltv, expected_future_orders)', 4)} AS intercept, COUNT(*) AS customers
FROM rep WHERE expected_future_orders > 0""")


def pltv_by_tier() -> str:
    return _q(f"""SELECT risk_tier, {R('AVG(remaining_pltv)', 4)} AS mean_remaining, COUNT(*) AS customers
FROM rep GROUP BY risk_tier""")


def _hist(src: str, bins: int, cap_q: float | None) -> list[str]:
    hi = f"QUANTILE_CONT(remaining_pltv, {cap_q})" if cap_q else "MAX(remaining_pltv)"
    return [f"""
hv AS (SELECT * FROM {src} WHERE remaining_pltv IS NOT NULL)""", f"""
hlim AS (SELECT MIN(remaining_pltv) AS lo, {hi} AS hi FROM hv)""", f"""
hb AS (SELECT CASE WHEN hi = lo THEN 0 ELSE LEAST(CAST(FLOOR((LEAST(remaining_pltv, hi) - lo) * {bins} / (hi - lo)) AS BIGINT), {bins - 1}) END AS bin
       FROM hv, hlim)""", f"""
hist AS (SELECT CAST(s.i AS BIGINT) AS bin, lo + s.i * ((hi - lo) / {bins}) AS edge_lo,
                lo + (s.i + 1) * ((hi - lo) / {bins}) AS edge_hi, CAST(COUNT(hb.bin) AS BIGINT) AS customers
         FROM range(0, {bins}) s(i) CROSS JOIN hlim LEFT JOIN hb ON hb.bin = s.i GROUP BY s.i, lo, hi)"""]


def pltv_histogram() -> str:
    return _q(f"SELECT bin, {R('edge_lo', 4)} AS edge_lo, {R('edge_hi', 4)} AS edge_hi, customers FROM hist",
              _hist("rep", 50, None))


def pltv_scorecard() -> str:
    f = params_fmt()
    return _q(f"""
SELECT 'seq' AS section, CAST(LEAST(order_seq, {f['max_bucket']}) AS VARCHAR) AS bucket, COUNT(*) AS customers,
       {R('AVG(remaining_pltv)', 4)} AS value FROM scored_only GROUP BY 2
UNION ALL
SELECT 'risk', risk_tier, COUNT(*), {R('SUM(remaining_pltv)', 4)} FROM scored_only GROUP BY risk_tier
UNION ALL
SELECT 'dec_pct', CAST(decile AS VARCHAR), COUNT(*),
       {R('SUM(remaining_pltv) * 100.0 / (SELECT SUM(remaining_pltv) FROM scored_only)', 4)} FROM dec GROUP BY decile
UNION ALL
SELECT 'hist', CAST(bin AS VARCHAR), customers, {R('edge_lo', 4)} FROM hist
UNION ALL
SELECT 'totals', 'n', COUNT(*), NULL FROM scores
UNION ALL
SELECT 'totals', 'scored', COUNT(remaining_pltv), NULL FROM scores
UNION ALL
SELECT 'totals', 'na', COUNT(*) - COUNT(remaining_pltv), NULL FROM scores
UNION ALL
SELECT 'totals', 'remaining', NULL, {R('SUM(remaining_pltv)', 4)} FROM scores
UNION ALL
SELECT 'totals', 'median_remaining', NULL, {R('MEDIAN(remaining_pltv)', 4)} FROM scores
UNION ALL
SELECT 'totals', 'p99', NULL, {R('QUANTILE_CONT(remaining_pltv, 0.99)', 4)} FROM scores""",
              ["scored_only AS (SELECT * FROM scores WHERE remaining_pltv IS NOT NULL)",
               DECILES.format(src="scored_only")] + _hist("scored_only", 30, 0.99))
