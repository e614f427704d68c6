"""Fixture CTEs (FIXTURES.md section 5) and helpers to compose oracle statements."""

from __future__ import annotations

from custval.params import DEFAULT, Params

ORDER_LINES = """
order_lines AS (
  SELECT o_custkey AS customer_id, o_orderkey AS order_id, l_linenumber AS line_no,
    l_partkey AS part_key, l_suppkey AS supp_key, CAST(o_orderdate AS DATE) AS order_date,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'eComm'
         WHEN o_orderpriority = '3-MEDIUM' THEN 'Retail' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Wholesale'
         ELSE 'Event' END AS channel_type,
    CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN '000 - Website' WHEN o_orderkey % 20 = 0 THEN NULL
         ELSE lpad(CAST(1 + o_orderkey % 25 AS VARCHAR(10)), 3, '0') || ' - Store' END AS store_name,
    CASE WHEN p_size = 50 THEN NULL WHEN p_size = 49 THEN '(Not Provided)' WHEN p_type = 'PROMO' THEN 'Men''s Footwear'
         WHEN p_type = 'ECONOMY' THEN 'Women''s Footwear' WHEN p_type = 'SMALL' THEN 'Kids'' Footwear'
         WHEN p_type = 'MEDIUM' THEN 'Accessories' WHEN p_type = 'LARGE' THEN 'Men''s Apparel'
         ELSE 'Women''s Apparel' END AS department,
    p_brand || '/' || CAST(p_size AS VARCHAR(10)) AS style,
    CASE WHEN p_type IN ('PROMO','ECONOMY','MEDIUM') THEN p_partkey % 8 = 0 END AS is_exotic,
    CAST(l_quantity AS DECIMAL(10,0)) AS quantity,
    CAST(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END AS DECIMAL(10,0)) AS return_quantity,
    CAST(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN l_quantity ELSE 0 END AS DECIMAL(10,0)) AS exchanged_quantity,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS gross_sales,
    -CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS discounts,
    CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(1 - l_discount AS DECIMAL(4,2)) AS net_sales,
    CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(1 - l_discount AS DECIMAL(4,2))
      * CAST(CASE o_custkey % 5 WHEN 0 THEN 0.6 WHEN 1 THEN 0.8 WHEN 2 THEN 1.0 WHEN 3 THEN 1.3 ELSE 1.7 END AS DECIMAL(2,1))
      * CASE WHEN o_orderkey % 50 = 0 THEN -1 ELSE 1 END AS order_value
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
)"""

PRODUCTS = """
products AS (
  SELECT p_brand || '/' || CAST(p_size AS VARCHAR(10)) AS product_style,
    CASE p_partkey % 10 WHEN 0 THEN 'Discontinued' WHEN 1 THEN 'Never Launched' WHEN 2 THEN NULL
         ELSE 'Active' END AS item_status
  FROM part
)"""

CUSTOMERS = """
customers AS (
  SELECT c_custkey AS customer_id,
    CASE WHEN c_nationkey = 0 THEN NULL WHEN c_nationkey = 1 THEN ' n/a ' WHEN c_nationkey = 2 THEN 'Unknown'
         ELSE ' ' || lower(n_name) END AS customer_state
  FROM customer JOIN nation ON n_nationkey = c_nationkey
)"""


def d(x) -> str:
    """A date literal."""
    return f"DATE '{x.isoformat()}'"


def in_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def with_ctes(*ctes: str, recursive: bool = False) -> str:
    """Join CTE bodies ("name AS (...)") into one WITH clause (repeats dropped)."""
    seen, parts = set(), []
    for c in ctes:
        c = c.strip()
        if c not in seen:
            seen.add(c)
            parts.append(c)
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts)


SHARED = ("order_lines", "products", "customers")


def prefixed(ctes: list[str], prefix: str, keep=SHARED) -> list[str]:
    """Rename every CTE defined in ``ctes`` (except ``keep``) to ``prefix + name``,
    so two dated chains can live in one statement."""
    import re
    names = []
    for c in ctes:
        for m in re.finditer(r"^\s*(\w+)\s*(\([^)]*\))?\s+AS\s*\(", c, re.M):
            if m.group(1) not in keep:
                names.append(m.group(1))
    if not names:
        return list(ctes)
    pat = re.compile(r"\b(" + "|".join(sorted(set(names), key=len, reverse=True)) + r")\b(?!\s*\.\s*\w+\s*\()")
    out = []
    for c in ctes:
        out.append(pat.sub(lambda m: prefix + m.group(1), c))
    return out


def params_fmt(p: Params = DEFAULT) -> dict:
    return {
        "as_of": d(p.as_of), "floor": d(p.order_floor), "maturity": d(p.maturity_cutoff),
        "ceiling": d(p.join_ceiling), "train_cutoff": d(p.train_cutoff), "test_end": d(p.test_end),
        "window": p.window_days, "haz_excl": in_list(p.hazard_excluded),
        "aov_excl": in_list(p.aov_excluded), "M": repr(float(p.mix_shrink_m)),
        "max_bucket": p.max_bucket, "horizon": p.horizon, "seed": p.split_seed,
        "tier_high": p.tier_high, "tier_medium": p.tier_medium,
        "cutoff": p.high_churn_cutoff, "flat_aov": p.flat_aov,
    }
