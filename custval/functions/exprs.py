"""Reusable column expressions.

Everything here is a composition of ``pyspark.sql.functions`` built-ins, so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_or", "rnd", "safe_div", "hash_unit", "risk_tier", "right_closed_bucket",
    "decile_from_rank", "fixed_bin", "truthy_flag", "dept_slot", "clean_state",
    "store_label", "stage_bucket", "DEPT_SLOTS", "STATE_JUNK",
]


def col_or(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c, digits: int = 6) -> Column:
    """Round to ``digits`` decimals as a double: round(x * 10^d) / 10^d.

    Scaling first makes exact decimal ties (x / 8, ...) round the same way in
    every engine, so outputs compare equal by value hash.
    """
    scale = float(10 ** digits)
    return F.round(col_or(c).cast("double") * F.lit(scale), 0) / F.lit(scale)


def safe_div(a, b) -> Column:
    """NULL when the divisor is 0 or NULL (ANSI-safe division)."""
    return F.try_divide(col_or(a).cast("double"), col_or(b).cast("double"))


def hash_unit(id_col, seed: str) -> Column:
    """Deterministic pseudo-uniform value in [0, 1) from an id and a seed.

    First 32 bits of md5(id || seed), modulo 100000, scaled to [0, 1).
    """
    h = F.conv(F.substring(F.md5(F.concat(col_or(id_col).cast("string"), F.lit(seed))), 1, 8), 16, 10)
    return (h.cast("bigint") % 100000) / F.lit(100000.0)


def risk_tier(prob, high: float, medium: float) -> Column:
    p = col_or(prob)
    return F.when(p >= high, "High").when(p >= medium, "Medium").otherwise("Low")


def right_closed_bucket(x, edges: Sequence[float], labels: Sequence[str],
                        include_lowest: bool = False) -> Column:
    """Label of the right-closed bin (e_i, e_{i+1}] holding ``x``; NULL outside."""
    x = col_or(x)
    expr = None
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = ((x >= lo) if (include_lowest and i == 0) else (x > lo)) & (x <= hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def decile_from_rank(rank, n, parts: int = 10) -> Column:
    """Equal-count bin of a 1-based rank among ``n`` rows (quantile cut of ranks)."""
    r, n = col_or(rank), col_or(n)
    return F.when(n <= 1, F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.ceil((r - 1) * parts / (n - 1)).cast("int")))


def fixed_bin(x, lo, hi, nbins: int) -> Column:
    """0-based equal-width bin over [lo, hi]; x == hi falls into the last bin."""
    x, lo, hi = col_or(x), col_or(lo), col_or(hi)
    idx = F.floor((x - lo) * nbins / (hi - lo)).cast("int")
    return F.when((x < lo) | (x > hi), F.lit(None)).when(hi == lo, F.lit(0)).otherwise(
        F.least(idx, F.lit(nbins - 1)))


def truthy_flag(c) -> Column:
    """Text / numeric / boolean flag -> 0/1 ("true", "1", "t", "yes" are true)."""
    return F.lower(col_or(c).cast("string")).isin("true", "1", "t", "yes").cast("int")


# Department -> slot names, and the state placeholders treated as missing.
DEPT_SLOTS = {
    "Men's Footwear": "mens_fw",
    "Women's Footwear": "womens_fw",
    "Kids' Footwear": "kids_fw",
    "Accessories": "acc",
    "Men's Apparel": "mens_ap",
    "Women's Apparel": "womens_ap",
    "(Not Provided)": "not_provided",
}
STATE_JUNK = ("", "(NOT PROVIDED)", "UNKNOWN", "N/A", "NA", "NULL", "NONE")


def dept_slot(c) -> Column:
    c = col_or(c)
    expr = None
    for name, slot in DEPT_SLOTS.items():
        expr = F.when(c == name, slot) if expr is None else expr.when(c == name, slot)
    return expr


def clean_state(c) -> Column:
    s = F.upper(F.trim(col_or(c)))
    return F.when(col_or(c).isNull() | s.isin(*STATE_JUNK), F.lit(None).cast("string")).otherwise(s)


def store_label(c) -> Column:
    c = col_or(c)
    return F.when(c.isNull() | (c == "000 - Website"), "Online").otherwise(c)


def stage_bucket(seq, cap: int) -> Column:
    return F.least(col_or(seq), F.lit(cap)).cast("int")
