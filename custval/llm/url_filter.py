"""URL rules matched by hashed host-suffix and path-prefix expressions.

A URL expands into one expression per (host suffix, path prefix); only prefix
lengths that some rule has are made, so a URL has at most its number of labels
times the number of distinct rule lengths.  Distinct expressions meet the rules
in an equi-join on the first bytes of their SHA-256, the full digest confirms,
and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: host up to / ? #, path up to ? #, behind the first ://
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url) -> tuple:
    """(host, A-Z lower-cased; path) of a URL column; both empty for null or without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(text, _URL, 1), UPPER, LOWER), F.regexp_extract(text, _URL, 2)


def _digest(host, path):
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def apply_rules(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                default: str = "allow", prefix_hex: int = 8) -> DataFrame:
    """Judge every row's URL by ``rules`` (host string, path string, action string).

    A rule fits its host and all subdomains if the URL's path starts with the
    rule's; the longest host and path wins, of equally long ones the longer
    host, and of equal rules block before allow.  Returns per input row
    ``page_id``, ``host``, ``path``, ``rule`` (host and path, null if none
    fits) and ``verdict`` (the rule's action, else ``default``).  A null URL or
    one without ``://`` has an empty host and path and no rule; rules with a
    null host, path or action are no rules; repeated rows are judged each;
    other columns are not read.
    """
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    known = rules.select(F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"),
                         F.lower("action").alias("action")).dropna()
    # block sorts behind allow, so max() takes it
    known = (known.groupBy("rule_host", "rule_path").agg(F.max("action").alias("action"))
             .withColumn("rule_sha", _digest(F.col("rule_host"), F.col("rule_path")))
             .withColumn("short", F.substring("rule_sha", 1, prefix_hex)))
    # one number per distinct path length: bounded by the longest rule, not by the input
    lengths = sorted(r[0] for r in known.select(F.length("rule_path")).distinct().collect())
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>"), lambda n: n <= F.length("path"))
    heads = F.transform(fitting, lambda n: F.substring(F.col("path"), F.lit(1), n))
    distinct = urls.where("host <> ''").select("host", "path").distinct()
    expressions = (distinct.select("host", "path", F.explode(suffixes).alias("suffix"))
                   .select("host", "path", "suffix", F.explode(heads).alias("head"))
                   .withColumn("sha", _digest(F.col("suffix"), F.col("head")))
                   .withColumn("short", F.substring("sha", 1, prefix_hex)))
    rank = F.struct((F.length("rule_host") + F.length("rule_path")).alias("n"), F.length("rule_host").alias("h"), "rule_host", "rule_path", "action")
    best = (expressions.join(known, "short").where((F.col("sha") == F.col("rule_sha")) & (F.col("suffix") == F.col("rule_host")) & (F.col("head") == F.col("rule_path")))
            .groupBy("host", "path").agg(F.max(rank).alias("best")))
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.concat("best.rule_host", "best.rule_path").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"))
