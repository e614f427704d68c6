"""Oracle statements for the order-value fit and its reports."""

from __future__ import annotations

from custval.oracle.aov import R, holdout_cells_ctes, production_cells
from custval.oracle.fixtures import params_fmt, with_ctes
from custval.params import DEFAULT, Params

DBL = "CAST({} AS DOUBLE)"


def fit_ctes(holdout: bool = False, p: Params = DEFAULT) -> list[str]:
    """cells -> moments, scalars, premiums, customers, tau^2 grid, fitted customers."""
    f = params_fmt(p)
    M = f["M"]
    base = holdout_cells_ctes(p) if holdout else production_cells(p)
    test_cols = (", MAX(test_n_orders) AS test_n_orders, MAX(test_sum_value) AS test_sum_value"
                 if holdout else "")
    return base + ["""
cm0 AS (SELECT *, sum_log_value / n_orders AS cell_mean_log FROM cells)""", """
cm AS (SELECT *, sum_log_value_sq - n_orders * cell_mean_log * cell_mean_log AS cell_ss FROM cm0)""", """
scal AS (
  SELECT SUM(sum_log_value) / SUM(n_orders) AS grand,
         SUM(CASE WHEN n_orders >= 2 THEN cell_ss END) / SUM(CASE WHEN n_orders >= 2 THEN n_orders - 1 END) AS sigma2,
         SUM(CASE WHEN n_orders >= 2 THEN sum_value / EXP(cell_mean_log) END)
           / SUM(CASE WHEN n_orders >= 2 THEN n_orders END) AS smear
  FROM cm)""", """
prem0 AS (SELECT order_department, order_is_exotic, SUM(sum_log_value) AS sum_log,
                 CAST(SUM(n_orders) AS BIGINT) AS n_orders
          FROM cm GROUP BY order_department, order_is_exotic)""", """
prem AS (
  SELECT p.*, sum_log / n_orders AS cell_logmean, sum_log / n_orders - s.grand AS gamma_cell,
         EXP(sum_log / n_orders - s.grand) AS premium, EXP(sum_log / n_orders - s.grand) * s.smear AS a_cell
  FROM prem0 p, scal s)""", """
abar AS (SELECT SUM(n_orders * a_cell) / SUM(n_orders) AS abar_pop FROM prem)""", """
cg AS (SELECT cm.*, prem.gamma_cell, prem.a_cell FROM cm JOIN prem USING (order_department, order_is_exotic))""", f"""
cust0 AS (
  SELECT customer_id, CAST(SUM(n_orders) AS BIGINT) AS n_c, SUM(sum_log_value) AS sum_log,
         SUM(sum_log_value_sq) AS sum_log_sq, SUM(n_orders * gamma_cell) AS mix_gamma_num,
         SUM(n_orders * a_cell) AS obs_sum, SUM(sum_value) AS sum_value, COUNT(*) AS n_cells,
         COUNT(DISTINCT order_department) AS n_dept, BOOL_OR(buys_exotic) AS buys_exotic{test_cols}
  FROM cg GROUP BY customer_id)""", """
cust AS (SELECT *, sum_log / n_c AS cust_mean_log, sum_log / n_c - mix_gamma_num / n_c AS theta_raw FROM cust0)""", """
centre AS (SELECT AVG(theta_raw) AS c FROM cust)""", """
coll AS (SELECT n_c, COUNT(*) AS cnt, SUM(theta_raw - c) AS s1, SUM((theta_raw - c) * (theta_raw - c)) AS s2
         FROM cust, centre GROUP BY n_c)""", """
g1 AS (SELECT i AS tm, CAST(i AS DOUBLE) / 1000.0 AS t FROM range(0, 5001) r(i))""", """
g1v AS (SELECT g1.tm, g1.t, coll.*, g1.t + s.sigma2 / coll.n_c AS v FROM g1, coll, scal s)""", """
g1m AS (SELECT tm, SUM(s1 / v) / SUM(cnt / v) AS mu FROM g1v GROUP BY tm)""", """
g1n AS (SELECT v.tm, 0.5 * SUM(cnt * LN(v) + (s2 - 2 * m.mu * s1 + m.mu * m.mu * cnt) / v) AS nll
        FROM g1v v JOIN g1m m USING (tm) GROUP BY v.tm)""", """
best1 AS (SELECT tm FROM g1n ORDER BY nll, tm LIMIT 1)""", """
g2 AS (SELECT b.tm * 1000 + j - 1000 AS tm, CAST(b.tm * 1000 + j - 1000 AS DOUBLE) / 1000000.0 AS t
       FROM best1 b, range(0, 2001) r(j) WHERE b.tm * 1000 + j - 1000 BETWEEN 0 AND 5000000)""", """
g2v AS (SELECT g2.tm, g2.t, coll.*, g2.t + s.sigma2 / coll.n_c AS v FROM g2, coll, scal s)""", """
g2m AS (SELECT tm, SUM(s1 / v) / SUM(cnt / v) AS mu FROM g2v GROUP BY tm)""", """
g2n AS (SELECT v.tm, MAX(m.mu) AS mu, 0.5 * SUM(cnt * LN(v) + (s2 - 2 * m.mu * s1 + m.mu * m.mu * cnt) / v) AS nll
        FROM g2v v JOIN g2m m USING (tm) GROUP BY v.tm)""", """
fitp AS (
  SELECT CAST(b.tm AS DOUBLE) / 1000000.0 AS tau2, c.c + b.mu AS mu, s.sigma2,
         s.sigma2 / (CAST(b.tm AS DOUBLE) / 1000000.0) AS k, s.smear, a.abar_pop, s.grand
  FROM (SELECT * FROM g2n ORDER BY nll, tm LIMIT 1) b, centre c, scal s, abar a)""", f"""
custw AS (
  SELECT cust.*, CASE WHEN f.tau2 > 0 THEN n_c / (n_c + f.k) ELSE 0.0 END AS w, f.mu AS prior_mean
  FROM cust, fitp f)""", f"""
custfit AS (
  SELECT c.*, w * theta_raw + (1 - w) * prior_mean AS theta_hat,
         EXP(w * theta_raw + (1 - w) * prior_mean) * (obs_sum + {M} * f.abar_pop) / (n_c + {M}) AS expected_aov
  FROM custw c, fitp f)"""]


def _q(body: str, holdout: bool = False) -> str:
    return with_ctes(*fit_ctes(holdout)) + "\n" + body


def cell_moments() -> str:
    return _q(f"""SELECT customer_id, order_department, order_is_exotic, n_orders,
  {R('cell_mean_log')} AS cell_mean_log, {R('cell_ss')} AS cell_ss FROM cm""")


def cell_premiums() -> str:
    return _q(f"""SELECT order_department, order_is_exotic, n_orders, {R('cell_logmean')} AS cell_logmean,
  {R('gamma_cell')} AS gamma_cell, {R('premium')} AS premium FROM prem""")


def exotic_normal_equations() -> str:
    return _with_extra(
        """names AS (SELECT DISTINCT 'dept:' || order_department AS name FROM cm UNION SELECT 'exotic' UNION SELECT 'y')""",
        """vals AS (
  SELECT customer_id, order_department, order_is_exotic, CAST(n_orders AS DOUBLE) AS w, name,
         CASE WHEN name = 'y' THEN cell_mean_log WHEN name = 'exotic' THEN CAST(order_is_exotic AS INT)
              ELSE CAST(name = 'dept:' || order_department AS INT) END AS x FROM cm, names)""",
        """demeaned AS (
  SELECT *, x - SUM(w * x) OVER (PARTITION BY customer_id, name) / SUM(w) OVER (PARTITION BY customer_id, name) AS d FROM vals)""",
        body=f"""SELECT a.name AS row_name, b.name AS col_name, {R('SUM(a.w * a.d * b.d)')} AS total
FROM demeaned a JOIN demeaned b USING (customer_id, order_department, order_is_exotic) WHERE a.name <= b.name
GROUP BY a.name, b.name HAVING abs(SUM(a.w * a.d * b.d)) > 1e-6""")


def exotic_premium_by_dept() -> str:
    return _with_extra(
        """wide AS (
  SELECT order_department,
    MAX(CASE WHEN NOT order_is_exotic THEN premium END) AS normal_mult,
    MAX(CASE WHEN order_is_exotic THEN premium END) AS exotic_mult,
    MAX(CASE WHEN NOT order_is_exotic THEN gamma_cell END) AS g0,
    MAX(CASE WHEN order_is_exotic THEN gamma_cell END) AS g1,
    CAST(SUM(CASE WHEN order_is_exotic THEN n_orders ELSE 0 END) AS BIGINT) AS exotic_orders
  FROM prem GROUP BY order_department)""",
        "w2 AS (SELECT *, g1 - g0 AS log_premium FROM wide WHERE g0 IS NOT NULL AND g1 IS NOT NULL)",
        "dm AS (SELECT SUM(log_premium * exotic_orders) / SUM(exotic_orders) AS d FROM w2)",
        body=f"""SELECT order_department, {R('normal_mult')} AS normal_mult, {R('exotic_mult')} AS exotic_mult,
  {R('exotic_mult / normal_mult')} AS exotic_premium, {R('log_premium')} AS log_premium, exotic_orders,
  {R('d')} AS delta_marg, {R('EXP(d)')} AS exp_delta_marg FROM w2, dm""")


def _with_extra(*ctes: str, body: str, holdout: bool = False) -> str:
    return with_ctes(*(fit_ctes(holdout) + list(ctes))) + "\n" + body


def exotic_mix() -> str:
    return _with_extra(
        """per AS (SELECT customer_id, SUM(n_orders) AS n_c,
                   SUM(n_orders * CAST(order_is_exotic AS INTEGER)) AS ex,
                   SUM(n_orders * (1 - CAST(order_is_exotic AS INTEGER))) AS nex
            FROM cells GROUP BY customer_id)""",
        body=f"""SELECT {R('SUM(ex) / SUM(n_c)')} AS share_exotic,
  {R('AVG(CASE WHEN n_c >= 2 THEN CAST(ex > 0 AND nex > 0 AS DOUBLE) END)')} AS mix_rate,
  COUNT(CASE WHEN n_c >= 2 THEN 1 END) AS customers_multi FROM per""")


def sigma_resid() -> str:
    return _with_extra(
        """coll2 AS (SELECT customer_id, order_department, SUM(n_orders) AS n, SUM(sum_log_value) AS s1,
                    SUM(sum_log_value_sq) AS s2 FROM cells GROUP BY customer_id, order_department)""",
        """sw AS (SELECT SUM(CASE WHEN n >= 2 THEN s2 - s1 * s1 / n END) / SUM(CASE WHEN n >= 2 THEN n - 1 END)
                  AS sigma2_without FROM coll2)""",
        body=f"""SELECT {R('s.sigma2')} AS sigma2, {R('SQRT(s.sigma2)')} AS sigma,
  {R('SQRT(sigma2_without)')} AS sigma_without,
  {R('(SQRT(sigma2_without) / SQRT(s.sigma2) - 1) * 100')} AS sigma_inflation_pct,
  {R('(sigma2_without / s.sigma2 - 1) * 100')} AS k_inflation_pct FROM sw, scal s""")


def theta_raw() -> str:
    return _q(f"""SELECT customer_id, n_c, {R('cust_mean_log')} AS cust_mean_log,
  {R('mix_gamma_num / n_c')} AS mix_gamma, {R('theta_raw')} AS theta_raw FROM cust""")


def fit_prior() -> str:
    return _q(f"""SELECT (SELECT COUNT(*) FROM cust) AS customers, {R('sigma2')} AS sigma2, {R('tau2')} AS tau2,
  {R('mu')} AS mu, {R('CASE WHEN tau2 > 0 THEN k END')} AS k,
  {R('CASE WHEN tau2 > 0 THEN 2 / (2 + k) ELSE 0 END')} AS w2,
  {R('CASE WHEN tau2 > 0 THEN 5 / (5 + k) ELSE 0 END')} AS w5,
  {R('CASE WHEN tau2 > 0 THEN 10 / (10 + k) ELSE 0 END')} AS w10 FROM fitp""")


def shrink_theta() -> str:
    return _q(f"""SELECT customer_id, n_c, {R('theta_raw')} AS theta_raw, {R('w')} AS w,
  {R('prior_mean')} AS prior_mean, {R('theta_hat')} AS theta_hat FROM custfit""")


def smearing() -> str:
    return _q(f"""SELECT {R('smear')} AS smear, {R('EXP(sigma2 / 2)')} AS parametric, {R('smear')} AS rt,
  {R('abar_pop')} AS abar_pop, (SELECT COUNT(*) FROM prem) AS cells FROM fitp""")


def value_ladder() -> str:
    return _q(f"""SELECT order_department, order_is_exotic,
  {R('EXP((SELECT AVG(theta_hat) FROM custfit)) * a_cell', 4)} AS usd,
  {R('n_orders / (SELECT SUM(n_orders) FROM prem)')} AS order_share FROM prem""")


def expected_aov() -> str:
    return _q(f"""SELECT customer_id, n_c, {R('theta_raw')} AS theta_raw, {R('w')} AS w,
  {R('theta_hat')} AS theta_hat, {R('obs_sum')} AS obs_sum, {R('expected_aov', 4)} AS expected_aov FROM custfit""")


def fit_checks() -> str:
    return _q(f"""SELECT (SELECT tau2 > 0 FROM fitp) AS tau2_positive, MIN(expected_aov) > 0 AS expected_aov_all_positive,
  {R('(SELECT CASE WHEN tau2 > 0 THEN 5 / (5 + k) ELSE 0 END FROM fitp)')} AS w5,
  (SELECT CASE WHEN tau2 > 0 THEN 5 / (5 + k) ELSE 0 END > 0.4 FROM fitp) AS w5_above_0_4,
  COUNT(*) AS customers FROM custfit""")


def _tier_case(col: str, edges, labels) -> str:
    arms = " ".join(f"WHEN {col} > {edges[i]} AND {col} <= {edges[i + 1]} THEN '{lab}'"
                    for i, lab in enumerate(labels))
    return f"CASE {arms} END"


N_TIERS = ([0, 1, 4, 10, 10**9], ["1", "2-4", "5-10", "11+"])
HOLDOUT_TIERS = ([0, 1, 2, 3, 5, 10, 10**9], ["1", "2", "3", "4-5", "6-10", "11+"])


def shrinkage_tiers() -> str:
    return _q(f"""SELECT {_tier_case('n_c', *N_TIERS)} AS n_tier, COUNT(*) AS customers,
  {R('COUNT(*) * 100.0 / (SELECT COUNT(*) FROM custfit)')} AS pct_of_base,
  {R('MEDIAN(w)')} AS median_w, {R('MEDIAN(expected_aov)', 4)} AS median_expected_aov
FROM custfit GROUP BY 1""")


def aov_decomposition() -> str:
    f = params_fmt()
    M = f["M"]
    return _with_extra(
        f"""dec AS (SELECT c.customer_id, c.n_c, c.theta_hat, c.expected_aov, COUNT(*) AS n_cells,
                   SUM((g.n_orders / (c.n_c + {M})) * EXP(c.theta_hat + g.gamma_cell) * fp.smear) AS own_part
            FROM cg g JOIN custfit c USING (customer_id), fitp fp
            GROUP BY c.customer_id, c.n_c, c.theta_hat, c.expected_aov)""",
        body=f"""SELECT customer_id, n_c, n_cells, {R(f'{M} / (n_c + {M})')} AS pop_weight,
  {R(f'own_part + ({M} / (n_c + {M})) * fp.abar_pop * EXP(theta_hat)', 4)} AS long_form,
  {R('expected_aov', 4)} AS closed_form,
  ABS(own_part + ({M} / (n_c + {M})) * fp.abar_pop * EXP(theta_hat) - expected_aov) <= 1e-9 * expected_aov AS matches
FROM dec, fitp fp""")


def aov_decomposition_cells() -> str:
    M = params_fmt()["M"]
    return _with_extra(
        f"""parts AS (
          SELECT customer_id, g.order_department AS part, g.order_is_exotic, g.n_orders / (c.n_c + {M}) AS weight,
                 fp.smear * EXP(c.theta_hat + g.gamma_cell) AS value FROM custfit c JOIN cg g USING (customer_id), fitp fp
          UNION ALL
          SELECT customer_id, '(population)', NULL, {M} / (n_c + {M}), fp.abar_pop * EXP(theta_hat) FROM custfit, fitp fp)""",
        body=f"""SELECT customer_id, part, order_is_exotic, {R('weight')} AS weight, {R('value', 4)} AS value,
  {R('weight * value', 4)} AS contribution FROM parts""")


def spend_type_ratio() -> str:
    pairs = {"raw_avg_order_value": "AVG(sum_value / n_c)", "model_expected_aov": "AVG(expected_aov)",
             "pooled_order_value": "SUM(sum_value) / SUM(n_c)"}
    return _q("SELECT " + ", ".join(
        f"{R(f'(SELECT {e} FROM custfit WHERE buys_exotic) / (SELECT {e} FROM custfit WHERE NOT buys_exotic)')} AS {k}_ratio"
        for k, e in pairs.items()))


def expected_vs_actual() -> str:
    return _with_extra(
        """ea AS (SELECT *, sum_value / n_c AS actual_mean, expected_aov / (sum_value / n_c) AS ratio
                  FROM custfit WHERE n_c BETWEEN 1 AND 5)""",
        body=f"""SELECT n_c, COUNT(*) AS customers, {R('AVG(actual_mean)', 4)} AS mean_actual,
  {R('AVG(expected_aov)', 4)} AS mean_expected, {R('AVG(ratio)')} AS mean_ratio, {R('MEDIAN(ratio)')} AS median_ratio
FROM ea GROUP BY n_c""")


def population_baseline() -> str:
    return _with_extra(
        "base AS (SELECT VAR_POP(prior_mean) AS var_prior, AVG(prior_mean) AS mu_log FROM custfit)",
        "grid AS (SELECT i, mu_log - 3 * SQRT(f.tau2) + i * (6 * SQRT(f.tau2) / 79) AS x, SQRT(f.tau2) AS tau, "
        "f.smear AS rt, mu_log, var_prior FROM base, fitp f, range(0, 80) r(i))",
        body=f"""SELECT i, {R('mu_log')} AS mu_log, {R('tau')} AS tau, {R('EXP(mu_log) * rt', 4)} AS base_usd,
  {R('var_prior')} AS var_prior, {R('EXP(x) * rt', 4)} AS usd,
  {R('EXP(-0.5 * POW((x - mu_log) / tau, 2)) / (tau * SQRT(2 * 3.141592653589793))')} AS density FROM grid""")


WITHIN = """wv AS (SELECT customer_id, n_c, sum_log, sum_log / n_c AS mean_log,
               GREATEST((sum_log_sq - sum_log * sum_log / n_c) / (n_c - 1), 0.0) AS within_var
        FROM custfit WHERE n_c >= 2)"""


def within_customer_variance() -> str:
    return _with_extra(WITHIN, body=f"""SELECT COUNT(*) AS customers, {R('AVG(within_var)')} AS avg_within_var,
  {R('SQRT(AVG(within_var))')} AS avg_within_sd, {R('(SELECT sigma2 FROM fitp)')} AS sigma2_cell,
  {R('QUANTILE_CONT(within_var, 0.1)')} AS p10, {R('QUANTILE_CONT(within_var, 0.25)')} AS p25,
  {R('QUANTILE_CONT(within_var, 0.5)')} AS p50, {R('QUANTILE_CONT(within_var, 0.75)')} AS p75,
  {R('QUANTILE_CONT(within_var, 0.9)')} AS p90 FROM wv""")


def within_variance_histogram() -> str:
    return _with_extra(
        WITHIN,
        "lim AS (SELECT QUANTILE_CONT(within_var, 0.98) AS cap, MIN(within_var) AS lo FROM wv)",
        "lim2 AS (SELECT cap, lo, GREATEST(cap, lo) AS hi FROM lim)",
        """bins AS (SELECT CASE WHEN hi = lo THEN 0 ELSE LEAST(CAST(FLOOR((LEAST(within_var, cap) - lo) * 30 / (hi - lo)) AS INTEGER), 29) END AS bin
                 FROM wv, lim2)""",
        "cnt AS (SELECT bin, COUNT(*) AS n FROM bins GROUP BY bin)",
        body=f"""SELECT CAST(s.i AS BIGINT) AS bin, {R('lo + s.i * ((hi - lo) / 30)')} AS edge_lo,
  {R('lo + (s.i + 1) * ((hi - lo) / 30)')} AS edge_hi, CAST(COALESCE(n, 0) AS BIGINT) AS customers
FROM range(0, 30) s(i) CROSS JOIN lim2 LEFT JOIN cnt ON cnt.bin = s.i""")


def variance_example() -> str:
    return _with_extra(
        WITHIN,
        """pick AS (SELECT customer_id, n_c, within_var, mean_log FROM wv WHERE n_c BETWEEN 3 AND 8
                 ORDER BY ABS(within_var - (SELECT AVG(within_var) FROM wv)), customer_id LIMIT 1)""",
        body=f"""SELECT p.customer_id, p.n_c, {R('p.within_var')} AS within_var, {R('EXP(p.mean_log)', 4)} AS geomean_usd,
  c.order_department, c.order_is_exotic, c.n_orders, {R('c.sum_value / c.n_orders', 4)} AS cell_mean_usd
FROM pick p JOIN cells c USING (customer_id)""")


def spend_by_type() -> str:
    return _q(f"""SELECT buys_exotic, COUNT(*) AS customers, {R('AVG(n_c)')} AS avg_orders,
  {R('AVG(sum_value / n_c)', 4)} AS raw_avg_order_value, {R('AVG(expected_aov)', 4)} AS model_expected_aov,
  {R('SUM(sum_value) / SUM(n_c)', 4)} AS pooled_order_value FROM custfit GROUP BY buys_exotic""")


# --- holdout ------------------------------------------------------------------

SCORABLE = f"""val AS (
  SELECT *, test_sum_value / test_n_orders AS actual_aov, sum_value / n_c AS raw_train_mean,
         (SELECT SUM(sum_value) / SUM(n_orders) FROM cells) AS pop_mean,
         {_tier_case('n_c', *HOLDOUT_TIERS)} AS n_tier
  FROM custfit WHERE test_n_orders > 0)"""


def holdout_error_by_tier() -> str:
    return _with_extra(
        SCORABLE,
        """t AS (SELECT n_tier, COUNT(*) AS customers,
                 MEDIAN(ABS(pop_mean / actual_aov - 1)) * 100 AS err_pop,
                 MEDIAN(ABS(raw_train_mean / actual_aov - 1)) * 100 AS err_raw,
                 MEDIAN(ABS(expected_aov / actual_aov - 1)) * 100 AS err_model FROM val GROUP BY n_tier)""",
        body=f"""SELECT n_tier, customers, {R('err_pop')} AS err_pop, {R('err_raw')} AS err_raw,
  {R('err_model')} AS err_model,
  CASE WHEN err_pop <= err_raw AND err_pop <= err_model THEN 'pop-mean'
       WHEN err_raw <= err_model THEN 'raw-mean' ELSE 'MODEL' END AS winner FROM t""", holdout=True)


def holdout_calibration() -> str:
    return _with_extra(
        SCORABLE,
        """a AS (SELECT COUNT(*) AS scorable, AVG(actual_aov) AS mean_actual, AVG(expected_aov) AS mean_pred,
                 MEDIAN(ABS(expected_aov / actual_aov - 1)) * 100 AS median_ape,
                 AVG(ABS(expected_aov / actual_aov - 1)) * 100 AS mean_ape,
                 SUM(sum_value) / SUM(n_c) AS train_level, SUM(test_sum_value) / SUM(test_n_orders) AS test_level,
                 MEDIAN(test_n_orders) AS median_test_orders
          FROM val)""",
        body=f"""SELECT scorable, {R('median_test_orders')} AS median_test_orders, {R('mean_actual', 4)} AS mean_actual, {R('mean_pred', 4)} AS mean_pred,
  {R('mean_pred / mean_actual')} AS ratio, {R('median_ape')} AS median_ape, {R('mean_ape')} AS mean_ape,
  {R('train_level', 4)} AS train_level, {R('test_level', 4)} AS test_level,
  (SELECT COUNT(*) FROM custfit) AS fit_customers, {R('test_level / train_level')} AS level_ratio FROM a""",
        holdout=True)


def holdout_binned_calibration(parts: int = 5) -> str:
    above = " + ".join(f"CAST(expected_aov > q[{i}] AS INTEGER)" for i in range(1, parts))
    return _with_extra(
        SCORABLE,
        f"e AS (SELECT QUANTILE_CONT(expected_aov, {[i / parts for i in range(1, parts)]}) AS q FROM val)",
        f"b AS (SELECT val.*, 'Q' || CAST(1 + {above} AS VARCHAR) AS bin FROM val, e)",
        body=f"""SELECT bin, {R('AVG(expected_aov)', 4)} AS predicted, {R('AVG(actual_aov)', 4)} AS realized,
  COUNT(*) AS customers FROM b GROUP BY bin""", holdout=True)


def holdout_signal() -> str:
    return _with_extra(
        SCORABLE,
        "ks AS (SELECT UNNEST([1, 2, 3, 5]) AS k)",
        """g AS (SELECT k, COUNT(*) AS customers, MEDIAN(ABS(expected_aov / actual_aov - 1)) * 100 AS median_ape,
                 CORR(expected_aov, actual_aov) AS corr FROM val JOIN ks ON test_n_orders >= k GROUP BY k)""",
        body=f"""SELECT CAST(k AS BIGINT) AS k, customers, {R('median_ape')} AS median_ape, {R('corr')} AS corr,
  {R('(SELECT AVG(f.tau2 / (f.tau2 + f.sigma2 / test_n_orders)) FROM val, fitp f)')} AS predictable
FROM g WHERE customers >= 30""", holdout=True)


def mix_shrink_sweep() -> str:
    return _with_extra(
        SCORABLE,
        "ms AS (SELECT UNNEST([1.0, 2.0, 3.0, 5.0, 10.0, NULL]) AS m)",
        """p AS (SELECT val.*, ms.m, CASE WHEN ms.m IS NULL THEN pop_mean
                   ELSE EXP(theta_hat) * (obs_sum + ms.m * f.abar_pop) / (n_c + ms.m) END AS pred
                FROM val, ms, fitp f)""",
        """cal AS (SELECT m, CASE WHEN m IS NULL THEN NULL ELSE AVG(pred) / AVG(actual_aov) END AS calib FROM p GROUP BY m)""",
        """err AS (SELECT m, n_tier, COUNT(*) AS customers, MEDIAN(ABS(pred / actual_aov - 1)) * 100 AS err
                  FROM p GROUP BY m, n_tier)""",
        body=f"""SELECT CAST(err.m AS DOUBLE) AS m, n_tier, customers, {R('err')} AS err, {R('calib')} AS calib
FROM err JOIN cal ON err.m IS NOT DISTINCT FROM cal.m""", holdout=True)


def variance_example_curve() -> str:
    return _with_extra(
        WITHIN,
        """pick AS (SELECT customer_id, within_var, mean_log, SQRT(within_var) AS sd FROM wv WHERE n_c BETWEEN 3 AND 8
                 ORDER BY ABS(within_var - (SELECT AVG(within_var) FROM wv)), customer_id LIMIT 1)""",
        """grid AS (SELECT customer_id, i, mean_log - 3.2 * sd + i * (6.4 * sd / 79) AS x, mean_log, sd
                 FROM pick, range(0, 80) r(i))""",
        body=f"""SELECT customer_id, i, {R('EXP(x)', 4)} AS usd,
  {R('EXP(-0.5 * POW((x - mean_log) / sd, 2)) / (sd * SQRT(2 * 3.141592653589793))')} AS density FROM grid""")
