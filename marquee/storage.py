"""Results that are read several times, written once to the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local session without that setting gets a new one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


def stored(rows: DataFrame) -> DataFrame:
    """The rows, computed once. Readers survive the loss of any executor; the folder goes when the application ends."""
    spark = rows.sparkSession
    folder = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(rows.schema).parquet(folder)
