"""Oracle statements for scores, the repeat curve, projections and metrics."""

from __future__ import annotations

from custval.oracle.aov import R
from custval.oracle.fixtures import params_fmt, with_ctes
from custval.oracle.hazard import PANEL_DIGITS, panel_ctes
from custval.params import DEFAULT, Params

CAT_COLS = ["this_order_department", "this_order_style", "this_order_channel", "this_order_store",
            "order_month", "entry_department", "first_product_style", "acq_channel", "acq_store",
            "customer_state"]
BOOL_COLS = ["paid_full_price", "cum_bought_cross_gender", "cum_footwear_plus_nonfootwear",
             "cum_ever_ecomm", "cum_ever_retail", "cum_both_channels", "state_missing"]
NON_FEATURES = {"customer_id", "split_rand", "order_date", "next_order_date", "days_to_next_order", "churned_400d"}


def demo(src: str = "") -> str:
    pre = f"{src}." if src else ""
    z = (f"(CAST(1.2 AS DOUBLE) - CAST(0.25 AS DOUBLE) * {pre}order_seq"
         f" + CAST(0.001 AS DOUBLE) * COALESCE({pre}days_since_prev_order, 200))")
    return R(f"1 / (1 + EXP(-{z}))")


def split_case(col: str = "split_rand", p: Params = DEFAULT) -> str:
    test_cut = p.test_share
    val_cut = p.test_share + (1 - p.test_share) * p.val_share
    return f"CASE WHEN {col} < {test_cut!r} THEN 'test' WHEN {col} < {val_cut!r} THEN 'val' ELSE 'fit' END"


def curve_ctes(p: Params = DEFAULT) -> list[str]:
    f = params_fmt(p)
    B, H = f["max_bucket"], f["horizon"]
    return panel_ctes(True, p) + [f"""
scored0 AS (SELECT *, {demo()} AS churn_prob FROM panel)""", f"""
scored AS (SELECT *, 1 - churn_prob AS p_repeat, {split_case(p=p)} AS split,
                  LEAST(order_seq, {B}) AS seq_bucket FROM scored0)""", """
test_rows AS (SELECT * FROM scored WHERE split = 'test')""", """
curve_obs AS (SELECT seq_bucket AS k, COUNT(*) AS n, AVG(p_repeat) AS r_obs FROM test_rows GROUP BY seq_bucket)""", f"""
curve AS (
  SELECT s.k, CAST(COALESCE(c.n, 0) AS BIGINT) AS n, c.r_obs,
    COALESCE(LAST_VALUE(c.r_obs IGNORE NULLS) OVER (ORDER BY s.k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             FIRST_VALUE(c.r_obs IGNORE NULLS) OVER (ORDER BY s.k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS r
  FROM range(1, {B + 1}) s(k) LEFT JOIN curve_obs c ON c.k = s.k)""", f"""
mrec(k, m) AS (
  SELECT {H + 1}, CAST(1.0 AS DOUBLE)
  UNION ALL
  SELECT mrec.k - 1, 1 + c.r * mrec.m FROM mrec JOIN curve c ON c.k = LEAST(mrec.k, {B}) WHERE mrec.k > 1)""", f"""
trec(k, j, s, acc) AS (
  SELECT k, 0, CAST(1.0 AS DOUBLE), CAST(1.0 AS DOUBLE) FROM curve
  UNION ALL
  SELECT t.k, t.j + 1, t.s * c.r, t.acc + t.s * c.r FROM trec t JOIN curve c ON c.k = LEAST(t.k + t.j + 1, {B})
  WHERE t.j < {H - 1})""", f"""
tails AS (SELECT k, acc AS tail FROM trec WHERE j = {H - 1})""", """
latest_test AS (SELECT * FROM test_rows QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_seq DESC) = 1)""", f"""
proj AS (
  SELECT l.customer_id, l.order_seq, l.churn_prob, l.p_repeat, l.p_repeat * t.tail AS proj_additional_orders,
         l.order_seq + l.p_repeat * t.tail AS proj_total_orders,
         l.p_repeat * t.tail * {f['flat_aov']} AS proj_additional_value
  FROM latest_test l JOIN tails t ON t.k = LEAST(l.order_seq, {B}))"""]


def _q(body: str, extra=()) -> str:
    return with_ctes(*(curve_ctes() + list(extra)), recursive=True) + "\n" + body


def grouped_split() -> str:
    return _q(f"SELECT DISTINCT customer_id, {R('split_rand')} AS split_rand, split FROM scored")


def split_check() -> str:
    return _q("""SELECT split, COUNT(*) AS rows, COUNT(DISTINCT customer_id) AS customers,
  (SELECT COUNT(*) FROM (SELECT customer_id FROM scored GROUP BY customer_id HAVING COUNT(DISTINCT split) > 1))
    AS customers_in_two_splits
FROM scored GROUP BY split""")


def churn_overview() -> str:
    return _q(f"""SELECT COUNT(*) AS rows, COUNT(DISTINCT customer_id) AS customers,
  {R('COUNT(*) / COUNT(DISTINCT customer_id)')} AS rows_per_customer, CAST(SUM(churned_400d) AS BIGINT) AS churned,
  CAST(SUM(1 - churned_400d) AS BIGINT) AS reordered, {R('AVG(churned_400d)')} AS base_rate FROM panel""")


def churn_by_order_seq() -> str:
    return _q(f"""SELECT order_seq, COUNT(*) AS rows, {R('AVG(churned_400d)')} AS churn_rate
FROM panel WHERE order_seq <= 10 GROUP BY order_seq""")


def model_frame() -> str:
    from custval.oracle.hazard import PANEL_COLUMNS
    cols = []
    for c in PANEL_COLUMNS:
        if c in NON_FEATURES:
            continue
        if c in CAT_COLS:
            cols.append(f"COALESCE(CAST({c} AS VARCHAR), 'missing') AS {c}")
        elif c in BOOL_COLS:
            cols.append(f"CAST({c} AS BIGINT) AS {c}")
        else:
            cols.append(f"{R(c, PANEL_DIGITS.get(c, 6))} AS {c}")
    return _q("SELECT customer_id, order_date, churned_400d, " + ", ".join(cols)
              + " FROM panel WHERE churned_400d IS NOT NULL")


def category_vocab() -> str:
    arms = " UNION ".join(f"SELECT '{c}' AS feature, COALESCE(CAST({c} AS VARCHAR), 'missing') AS value FROM panel"
                          for c in CAT_COLS)
    return _q(f"SELECT DISTINCT feature, value FROM ({arms})")


def calibration_by_stage() -> str:
    return _q(f"""SELECT CAST(seq_bucket AS BIGINT) AS seq_bucket, COUNT(*) AS n, {R('AVG(p_repeat)')} AS pred_repeat,
  {R('1 - AVG(churned_400d)')} AS actual_repeat FROM test_rows GROUP BY seq_bucket""")


def hazard_curve() -> str:
    return _q(f"SELECT CAST(k AS BIGINT) AS k, n, {R('r_obs')} AS r_obs, {R('r')} AS r FROM curve")


def forward_multiplier() -> str:
    B = params_fmt()["max_bucket"]
    return _q(f"""SELECT CAST(m.k AS BIGINT) AS k, {R('c.r')} AS r, {R('m.m')} AS m
FROM mrec m JOIN curve c ON c.k = LEAST(m.k, {B})""")


def chained_projection() -> str:
    return _q(f"""SELECT customer_id, order_seq, {R('churn_prob')} AS churn_prob, {R('p_repeat')} AS p_repeat,
  {R('proj_additional_orders')} AS proj_additional_orders, {R('proj_total_orders')} AS proj_total_orders,
  {R('proj_additional_value', 4)} AS proj_additional_value FROM proj""")


def projection_readout() -> str:
    return _q(f"""SELECT order_seq, COUNT(*) AS customers, {R('AVG(proj_additional_orders)')} AS mean_additional_orders,
  {R('AVG(proj_additional_value)', 4)} AS mean_additional_value FROM proj GROUP BY order_seq""")


def projection_summary() -> str:
    return _q(f"""SELECT COUNT(*) AS customers, {R('MEDIAN(proj_additional_orders)')} AS median_additional_orders,
  {R('MEDIAN(proj_additional_value)', 4)} AS median_additional_value,
  {R('AVG(proj_additional_value)', 4)} AS mean_additional_value FROM proj""")


AUC_CTES = ["""
auc_counts AS (SELECT seq_bucket, churn_prob, SUM(churned_400d) AS pos, SUM(1 - churned_400d) AS neg
               FROM test_rows GROUP BY seq_bucket, churn_prob)""", """
auc_run AS (SELECT *, SUM(neg) OVER (PARTITION BY seq_bucket ORDER BY churn_prob
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM auc_counts)""", """
auc_stage AS (SELECT seq_bucket, SUM(pos) AS pos, SUM(neg) AS neg,
                     CASE WHEN SUM(pos) > 0 AND SUM(neg) > 0 THEN
                       SUM(pos * ((cum_neg - neg) + neg / 2.0)) / (SUM(pos) * SUM(neg)) END AS auc
              FROM auc_run GROUP BY seq_bucket)""", """
all_counts AS (SELECT churn_prob, SUM(churned_400d) AS pos, SUM(1 - churned_400d) AS neg, COUNT(*) AS cnt
               FROM test_rows GROUP BY churn_prob)""", """
all_run AS (SELECT *, SUM(neg) OVER (ORDER BY churn_prob ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
                   SUM(pos) OVER (ORDER BY churn_prob DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos_d,
                   SUM(cnt) OVER (ORDER BY churn_prob DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_cnt_d
            FROM all_counts)""", """
overall AS (SELECT SUM(pos * ((cum_neg - neg) + neg / 2.0)) / (SUM(pos) * SUM(neg)) AS auc,
                   SUM(pos) AS P, SUM(neg) AS N FROM all_run)""", """
stage_n AS (SELECT seq_bucket, COUNT(*) AS n, AVG(churned_400d) AS churn_rate FROM test_rows GROUP BY seq_bucket)"""]


def auc_by_stage() -> str:
    return _q(f"""SELECT CAST(n.seq_bucket AS BIGINT) AS seq_bucket, n.n, {R('n.churn_rate')} AS churn_rate, {R('a.auc')} AS auc
FROM stage_n n LEFT JOIN auc_stage a USING (seq_bucket)""", AUC_CTES)


def auc_summary() -> str:
    return _q(f"""SELECT {R('o.auc')} AS overall_auc, {R('w.wauc')} AS weighted_auc, {R('o.auc - w.wauc')} AS gap, w.stages
FROM overall o, (SELECT SUM(a.auc * n.n) / SUM(n.n) AS wauc, COUNT(*) AS stages
                 FROM auc_stage a JOIN stage_n n USING (seq_bucket) WHERE a.auc IS NOT NULL) w""", AUC_CTES)


def ranking_metrics() -> str:
    return _q(f"""SELECT {R('(SELECT auc FROM overall)')} AS auc,
  {R('SUM((pos / (SELECT P FROM overall)) * (cum_pos_d / cum_cnt_d))')} AS average_precision,
  COUNT(*) AS thresholds FROM all_run""", AUC_CTES)


def roc_points() -> str:
    return _q(f"""SELECT {R('churn_prob')} AS threshold, {R('(cum_cnt_d - cum_pos_d) / (SELECT N FROM overall)')} AS fpr,
  {R('cum_pos_d / (SELECT P FROM overall)')} AS tpr FROM all_run""", AUC_CTES)


def score_histogram() -> str:
    return _q(f"""SELECT CAST(s.i AS BIGINT) AS bin, {R('s.i / 30.0')} AS edge_lo, {R('(s.i + 1) / 30.0')} AS edge_hi,
  CAST(COUNT(CASE WHEN t.churned_400d = 0 THEN 1 END) AS BIGINT) AS reordered,
  CAST(COUNT(CASE WHEN t.churned_400d = 1 THEN 1 END) AS BIGINT) AS churned
FROM range(0, 30) s(i) LEFT JOIN test_rows t
  ON LEAST(CAST(FLOOR((t.churn_prob - 0.0) * 30 / (1.0 - 0.0)) AS BIGINT), 29) = s.i
GROUP BY s.i""")


def projection_histogram() -> str:
    return _q(f"""SELECT CAST(s.i AS BIGINT) AS bin, {R('lo + s.i * ((hi - lo) / 30)')} AS edge_lo,
  {R('lo + (s.i + 1) * ((hi - lo) / 30)')} AS edge_hi, CAST(COUNT(b.x) AS BIGINT) AS customers
FROM range(0, 30) s(i) CROSS JOIN lim
LEFT JOIN (SELECT CASE WHEN hi = lo THEN 0 ELSE LEAST(CAST(FLOOR((x - lo) * 30 / (hi - lo)) AS BIGINT), 29) END AS bin, x
           FROM (SELECT LEAST(proj_additional_orders, 10.0) AS x FROM proj), lim) b ON b.bin = s.i
GROUP BY s.i, lo, hi""", ["""
lim AS (SELECT MIN(LEAST(proj_additional_orders, 10.0)) AS lo, MAX(LEAST(proj_additional_orders, 10.0)) AS hi FROM proj)"""])


def projection_backtest() -> str:
    f = params_fmt()
    years = ", ".join(str(y) for y in (1998, 1999))
    return _q(f"""SELECT order_seq, COUNT(*) AS customers, {R('AVG(expected_future_orders)')} AS expected,
  {R('AVG(actual_future_orders)')} AS actual
FROM (SELECT t.*, MAX(order_seq) OVER (PARTITION BY customer_id) - order_seq AS actual_future_orders,
             t.p_repeat * m.m AS expected_future_orders
      FROM test_rows t JOIN mrec m ON m.k = LEAST(t.order_seq, {f['horizon']})) x
WHERE YEAR(order_date) IN ({years}) AND order_seq IN (1, 2, 3, 4, 5)
GROUP BY order_seq""")


GAPS = """CASE WHEN avg_gap_so_far > 0 AND avg_gap_so_far <= 30 THEN '0–30'
     WHEN avg_gap_so_far > 30 AND avg_gap_so_far <= 60 THEN '31–60'
     WHEN avg_gap_so_far > 60 AND avg_gap_so_far <= 120 THEN '61–120'
     WHEN avg_gap_so_far > 120 AND avg_gap_so_far <= 240 THEN '121–240'
     WHEN avg_gap_so_far > 240 AND avg_gap_so_far <= 400 THEN '241–400'
     WHEN avg_gap_so_far > 400 AND avg_gap_so_far <= 1e9 THEN '400+' END"""


def cadence_vs_churn() -> str:
    return _q(f"""SELECT gap_bucket, {R('AVG(churned_400d)')} AS churn_rate, COUNT(*) AS n
FROM (SELECT *, {GAPS} AS gap_bucket FROM panel WHERE order_seq >= 2) g
WHERE gap_bucket IS NOT NULL GROUP BY gap_bucket""")


def cadence_by_stage() -> str:
    return _q(f"""SELECT gap_bucket,
  {R('AVG(CASE WHEN seq_grp = 2 THEN churned_400d END)')} AS stage_2,
  {R('AVG(CASE WHEN seq_grp = 3 THEN churned_400d END)')} AS stage_3,
  {R('AVG(CASE WHEN seq_grp = 4 THEN churned_400d END)')} AS stage_4,
  {R('AVG(CASE WHEN seq_grp = 5 THEN churned_400d END)')} AS stage_5plus
FROM (SELECT *, {GAPS} AS gap_bucket, LEAST(order_seq, 5) AS seq_grp FROM panel WHERE order_seq >= 2) g
WHERE gap_bucket IS NOT NULL GROUP BY gap_bucket""")


def sample_ltv() -> str:
    f = params_fmt()
    h = "CAST(('0x' || SUBSTR(MD5(CAST(customer_id AS VARCHAR) || 'sample_42'), 1, 8)) AS BIGINT) % 100000 / 100000.0"
    return _q(f"""SELECT customer_id, order_seq AS orders_so_far, {R('churn_prob')} AS last_order_churn_score,
  {R('proj_additional_orders')} AS proj_future_orders,
  {R(f'proj_additional_orders * {f["flat_aov"]}', 4)} AS pred_remaining_value,
  {R(f'(order_seq + proj_additional_orders) * {f["flat_aov"]}', 4)} AS pred_total_ltv
FROM proj ORDER BY {h}, customer_id LIMIT 100""")


def sample_ltv_medians() -> str:
    flat = params_fmt()["flat_aov"]
    h = "CAST(('0x' || SUBSTR(MD5(CAST(customer_id AS VARCHAR) || 'sample_42'), 1, 8)) AS BIGINT) % 100000 / 100000.0"
    return _q(f"""SELECT COUNT(*) AS customers, {R('MEDIAN(order_seq)')} AS median_orders_so_far,
  {R('MEDIAN(proj_additional_orders)')} AS median_proj_future_orders,
  {R(f'MEDIAN(proj_additional_orders * {flat})', 4)} AS median_pred_remaining_value,
  {R(f'MEDIAN((order_seq + proj_additional_orders) * {flat})', 4)} AS median_pred_total_ltv
FROM (SELECT * FROM proj ORDER BY {h}, customer_id LIMIT 100)""")


def live_scores() -> str:
    f = params_fmt()
    return _q(f"""SELECT customer_id, order_seq, {R('churn_prob')} AS churn_prob, {R('1 - churn_prob')} AS p_repeat,
  CASE WHEN churn_prob >= {f['tier_high']} THEN 'High' WHEN churn_prob >= {f['tier_medium']} THEN 'Medium' ELSE 'Low' END AS risk_tier,
  {R('LEAST(1 - churn_prob, 0.95) / (1 - LEAST(1 - churn_prob, 0.95))')} AS proj_additional_orders
FROM (SELECT *, {demo()} AS churn_prob FROM latest) l""")
