"""Session settings used by the bench, the tests and the query registry."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(app: str, cpus: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A session for one machine. On a cluster the submitted configuration is used instead."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; only a local session may fall back to a new one."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="marquee-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
