"""Spark session helpers.

On a cluster the session comes from the launcher; we only fill in settings
that are unset.  The checkpoint folder is read from ``spark.checkpoint.dir``;
a scratch folder is created only for a local master with nothing configured.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "custval") -> SparkSession:
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # drop checkpoint files once the DataFrames that wrote them are gone
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def current_session(app: str = "custval") -> SparkSession:
    """The launcher's session (or a plain new one) with our unset defaults filled in."""
    return configure(SparkSession.builder.appName(app).getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    for key, value in _DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Checkpoint folder: the session's ``spark.checkpoint.dir`` if set."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- remote sessions: the server owns the folder
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="custval-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
