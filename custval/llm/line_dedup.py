"""Cross-site boilerplate lines, found by distinct-site spread; DataFrame functions only.

Every line is keyed by a hash of its words.  HyperLogLog sketches of the sites
per key are built before the shuffle and merge by aggregation; where the
estimate lies near the threshold, the distinct sites are counted exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custval.operators.joins import hot_from_counts, join_hot
from custval.operators.persist import materialize

#: sketches of 2**12 registers, and eight of their standard errors (a chance of 1e-15 a line, so none is missed among very many)
LG_K, MARGIN = 12, 0.13
#: white space other than single spaces
_BLANK = r"[ \t\n\x0B\f\r]{2,}|[\t\n\x0B\f\r]"


def lines_of(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """(id, site, line_no, line) of every line that has a word, with 128 bits of key; rows without an id or text have none."""
    lines = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(site_col).cast("string"), F.lit("")).alias("site"),
        F.posexplode(F.split(F.col(text_col).cast("string"), "\n", -1)).alias("line_no", "line"))
    # white space at the ends and runs of it inside do not tell lines apart
    plain = F.trim(F.regexp_replace("line", _BLANK, " "))
    return (lines.select("id", "site", "line_no", plain.alias("line")).where("line <> ''")
            .select("id", "site", "line_no", F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2")))


def candidate_lines(lines: DataFrame, min_sites: int) -> tuple[DataFrame, dict[int, int]]:
    """``lines`` whose key's sketch of sites estimates ``min_sites`` or nearly, with the estimate, written once; and the heavy keys.

    Each task sketches its own lines, so a line that a third of the documents
    have costs one small sketch per task; its rows are dealt over several tasks.
    """
    sketched = materialize(lines.groupBy("k1", "k2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("sites"), F.count(F.lit(1)).alias("n"))
                           .where(F.col("sites") >= min_sites * (1 - MARGIN)))
    hot = hot_from_counts(sketched, ["k1", "k2"], "n", sketched.agg(F.sum("n")).first()[0] or 0)
    return materialize(join_hot(lines, sketched.drop("n"), ["k1", "k2"], hot=hot, salt_by=["id", "line_no"])), hot


def spread_of(candidates: DataFrame, min_sites: int) -> DataFrame:
    """(k1, k2, first_id, first_line, sites) of the lines that ``min_sites`` or more distinct sites have.

    Estimates above the margin are taken, those within it replaced by exact
    counts of distinct sites.
    """
    near = candidates.where(F.col("sites") <= min_sites * (1 + MARGIN))
    exact = near.groupBy("k1", "k2").agg(F.count_distinct("site").alias("exact"))
    keys = candidates.groupBy("k1", "k2").agg(F.min(F.struct("id", "line_no")).alias("first"), F.max("sites").alias("sites"))
    counted = keys.join(exact, ["k1", "k2"], "left").withColumn("sites", F.coalesce("exact", "sites"))
    return counted.where(F.col("sites") >= min_sites).select(
        "k1", "k2", F.col("first.id").alias("first_id"), F.col("first.line_no").alias("first_line"), F.col("sites").cast("long").alias("sites"))


def boilerplate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                      min_sites: int = 5) -> DataFrame:
    """(id, removed): the line numbers to cut from each document that has any."""
    candidates, hot = candidate_lines(lines_of(docs, id_col, text_col, site_col), min_sites)
    spread = spread_of(candidates, min_sites)
    return (join_hot(candidates.select("k1", "k2", "id", "line_no"), spread, ["k1", "k2"], hot=hot, salt_by=["id", "line_no"])
            .where((F.col("id") != F.col("first_id")) | (F.col("line_no") != F.col("first_line")))
            .groupBy("id").agg(F.collect_set("line_no").alias("removed")))


def without_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                        min_sites: int = 5) -> DataFrame:
    """``docs`` with ``text_col`` cut, and a column ``n_removed`` (it replaces one of that name).

    A line that ``min_sites`` or more distinct sites have stays where it is
    first (smallest id, then line number) and is cut everywhere else, repeats in
    the same document included.  Lines without a word are never cut and lines
    are compared with white space trimmed and runs of it as one space.  A null
    site is a site of its own, null texts stay null, rows without an id are
    kept as they are, and of rows that share an id each loses the line numbers
    cut in any of them.
    """
    cut = boilerplate_lines(docs, id_col, text_col, site_col, min_sites)
    # the text travels once, as its lines; a column of the join is read by place inside the lambda
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.split(F.col(text_col).cast("string"), "\n", -1).alias("lines"),
                       F.struct(*[F.col(c) for c in docs.columns if c != text_col]).alias("rest"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("removed"))
    kept = F.when(F.col("removed").isNull(), F.col("lines")).otherwise(F.transform(left, lambda i: F.get("lines", i)))
    out = rows.join(cut, "id", "left").select("rest", F.array_join(kept, "\n").alias("kept"),
                                              F.coalesce(F.array_size("removed"), F.lit(0)).cast("long").alias("n"))
    return out.select(*[F.col("kept").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c) for c in docs.columns if c != "n_removed"],
                      F.col("n").alias("n_removed"))
