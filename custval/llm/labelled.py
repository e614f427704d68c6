"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality", usable=None) -> DataFrame:
    """(doc_id, data binary, label int) of at most ``rows`` labelled ids, those of smallest hash; same rows on every run.

    Of rows that share an id the one of smallest text hash counts.  Ids with a null label or id are left out, of several labels the smallest
    counts.  ``usable`` maps the id column to a condition on ids that may be
    learnt from.  The sample's ids (``rows`` at most) are broadcast.
    """
    known = labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    if usable is not None:
        known = known.where(usable(F.col("id")))
    known = (known.groupBy("id").agg(F.min("label").alias("label"))
             .orderBy(F.xxhash64("id"), "id").limit(rows))
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("data"))
    return (texts.join(F.broadcast(known), texts.doc_id == known.id)
            .groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("data").alias("hash"), "data")).alias("text"), F.min("label").alias("label"))
            .select("doc_id", F.col("text.data").alias("data"), "label"))
