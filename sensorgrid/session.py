"""Spark session helpers.

Library code never creates its own session: every operator receives
DataFrames.  ``get_session`` is for tests, the bench and scripts; on a
cluster the submitting application owns the session and its settings.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of this package relies on.  The time zone matters:
# all stamps are zone-free (TIMESTAMP_NTZ) and the few conversions that go
# through epoch values must not shift them.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sensorgrid") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by the cluster.

    Only a local session that names none gets a scratch folder; on a cluster
    ``spark.checkpoint.dir`` must point at shared storage, and it is an error
    if it is missing.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="sensorgrid-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
