"""The ``opN_*`` queries over the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custval.llm.bpe import round_trip
from custval.llm.decontaminate import contaminated
from custval.llm.exact_dedup import exact_groups
from custval.llm.hard_negatives import hard_negatives
from custval.llm.lexical_search import ranked_search
from custval.llm.line_dedup import without_boilerplate
from custval.llm.passage_classifier import quality_scores
from custval.llm.quality_rules import quality_rules
from custval.llm.simhash import near_duplicates
from custval.llm.substring_dedup import remove_repeated_windows
from custval.llm.suffix_dedup import remove_repeated_bytes
from custval.llm.url_filter import apply_rules
from custval.llm.warc import deduplicated_records, read_archives, write_archives
from custval.session import ensure_checkpoint_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, where all executors can read and write."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_windows(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _shared_folder(spark, "warc")
    write_archives(deduplicated_records(_table(spark, sf_dir, "pages")), path)
    read = read_archives(spark, path, payloads=False).where("kind = 'record'")
    return read.select(F.col("record_id").try_cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").try_cast("bigint").alias("refers_to"))


#: fixed values: the rules of the query
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return apply_rules(_table(spark, sf_dir, "pages"), rules)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_bytes(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_passage_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def byte_bpe_path() -> str:
    """The vocabulary file of the byte-level BPE queries."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "documents"), byte_bpe_path())


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_boilerplate(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"), keep="largest")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_substring_dedup,
    op2_simhash_dedup,
    op3_warc,
    op4_url_filter,
    op5_suffix_dedup,
    op6_passage_classifier,
    op7_byte_bpe,
    op8_decontaminate,
    op9_line_dedup,
    op10_quality_rules,
    op11_exact_dedup,
    op12_lexical_search,
    op13_hard_negatives,
)}

ORACLES: dict[str, str] = {
    "op11_exact_dedup": """
        WITH plain AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
               sha256(t) AS text_sha256
        FROM plain WINDOW g AS (PARTITION BY t)""",
    "op9_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS line_no
            FROM documents),
        plain AS (
            SELECT *, trim(regexp_replace(line, '[ \t\n\x0B\f\r]+', ' ', 'g')) AS p FROM lines),
        spread AS (
            SELECT p, min({'d': doc_id, 'n': line_no}) AS first FROM plain WHERE p <> ''
            GROUP BY p HAVING count(DISTINCT site) >= 5),
        judged AS (
            SELECT doc_id, line_no, line, coalesce({'d': doc_id, 'n': line_no} <> first, false) AS gone
            FROM plain LEFT JOIN spread USING (p))
        SELECT doc_id, count(*) FILTER (gone) AS n_removed,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op4_url_filter": f"""
        WITH rules(rule_host, rule_path, action) AS (VALUES {', '.join(str(r) for r in URL_RULES)}),
        parts AS (
            SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
            FROM pages),
        ranked AS (
            SELECT p.*, rule_host || rule_path AS rule, action,
                   row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host) + length(rule_path) DESC NULLS LAST) AS k
            FROM parts p LEFT JOIN rules r
              ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path))
        SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM ranked WHERE k = 1""",
}

#: fixed value: the terms of the search
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')"

ORACLES["op12_lexical_search"] = f"""
        WITH docs AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
        corpus AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_all FROM docs),
        wanted AS (
            SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
        hits AS (
            SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM docs)
            WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
        weights AS (
            SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
            FROM hits, corpus GROUP BY term),
        sizes AS (SELECT doc_id, 100 - 25 + ((25 * len(terms) * n_docs) // n_all) AS m FROM docs, corpus),
        scored AS (
            SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
            FROM wanted JOIN hits USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id) GROUP BY ALL)
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 20"""

ORACLES["op13_hard_negatives"] = """
        WITH rows AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
        scored AS (
            SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
            FROM rows a, rows r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score QUALIFY rank <= 10"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
