"""Spark session helpers.

Cluster runs bring their own session; the helpers here only fill in settings that
are unset (local tests and the bench), never override a cluster's choices.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # local runs read single small files: smaller splits give the 8 cores work; on a
    # cluster the session's own setting (128 MB default) applies
    "spark.sql.files.maxPartitionBytes": str(8 * 1024 * 1024),
}


def local_session(cpus: int | str = 8, partitions: int | None = None,
                  app: str = "qmeasures", driver_memory: str = "12g") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(partitions or cpus))
               .config("spark.driver.memory", driver_memory))
    for k, v in LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only a session without it (local tests) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="qm-ckpt-", dir=os.environ.get("QM_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return path
