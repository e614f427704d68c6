"""Lineage cuts that survive executor loss.

``materialize`` writes a DataFrame to the session's checkpoint folder
(``spark.checkpoint.dir``; reliable storage on a cluster) and returns a frame
that reads it back, so repeated actions over a fitted table do not rescan the
raw inputs and a lost executor does not force a recompute from the source.

Spark keeps the shuffle files that led to a frame, and the frame's checkpoint,
until the driver happens to collect the objects that name them.  ``settle`` and
``discard`` free both as soon as the job knows that nothing reads them again.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from custval.session import ensure_checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: shuffle files go when the execution that made them ends; a read after that would make them again
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """The session's settings ``values`` for queries made and run inside."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shuffles_removed(spark: SparkSession):
    """Queries made and run inside leave no shuffle files behind."""
    return settings(spark, {SHUFFLE_CLEANUP: "true"})


def settle(df: DataFrame, *spent: DataFrame) -> DataFrame:
    """``materialize`` after which the disk holds the rows only: the shuffle files that led to them go, and the checkpoints of ``spent``."""
    with shuffles_removed(df.sparkSession):
        out = materialize(df.select("*"))         # a query takes the setting when it is made
    discard(*spent)
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the checkpoints of frames that ``materialize`` or ``settle`` returned and that nothing reads any more."""
    for df in frames:
        remove_folder(df.sparkSession, df._jdf.queryExecution().logical().rdd().getCheckpointFile().get())


def write_rows(df: DataFrame, *by: str) -> tuple[DataFrame, str]:
    """``df`` written to a folder of its own beside the checkpoints (in folders by the columns ``by``); that folder, for ``remove_folder``.

    Parquet holds a fraction of the bytes of a checkpoint, and a read takes only
    its columns; the order of the rows and their partitions are lost.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/custval_rows_{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the checkpoints' file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
