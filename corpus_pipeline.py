"""A training corpus from raw documents, stage by stage.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over everything its
predecessor kept; ``run`` writes each result as Parquet to the shared folder
and reads it back for the next one.  All but the last return the columns of
``documents``.

Of every stage: null and empty texts have no words, tables may be empty, and
columns beside those of ``documents`` are kept whatever their names.  Rows that
share a doc_id stay or go together; a row without one is told apart from the
others by its text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custval.llm import bpe, decontaminate, line_dedup, quality_rules, simhash
from custval.llm.chunks import row_key
from custval.llm.queries import byte_bpe_path
from custval.session import configure, ensure_checkpoint_dir


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; rows that share an id stay if one of them is kept.

    Null and empty texts fail the rules and go; without labels only the base
    rules judge; rows without an id and with equal texts are judged alike.
    """
    key = row_key("doc_id", "text")
    judged = quality_rules.quality_rules(docs.select(key.alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = judged.where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, key == kept["__kept"], "left_semi")


def cut_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sites share; n_chars follows the text.

    Every row stays: null texts stay null (n_chars too), rows without an id as
    they are; of tied documents the one of smallest id, then line, keeps a line.
    """
    cut = line_dedup.without_boilerplate(docs)
    return cut.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near-duplicates.

    Texts without a word are copies of each other; rows without an id come
    behind all others, and those of equal text stay or go together.
    """
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; null and empty texts hold none, an empty benchmark removes nothing."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to, one row per row; a null text is empty."""
    return bpe.round_trip(docs, byte_bpe_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_quality),
    ("line_dedup", cut_boilerplate),
    ("simhash_dedup", one_per_group),
    ("decontaminate", drop_contaminated),
    ("byte_bpe", to_tokens),
]

#: hashing, a fitted model and token merges are beyond SQL; tests/llm holds the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result lies in a new folder beside the checkpoints."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
