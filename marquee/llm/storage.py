"""Where intermediate results go: the shared folder of the cluster, never one machine's own."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only a local session without that setting gets a new one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local["):
        folder = "file://" + tempfile.mkdtemp(prefix="marquee-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder; later readers survive the loss of any executor."""
    return stored_at(rows)[1]


def stored_at(rows: DataFrame) -> tuple[str, DataFrame]:
    """As `stored`, with the folder, from which tasks can read the rows by `each_row`."""
    spark = rows.sparkSession
    folder = new_folder(spark, "stored")
    rows.write.parquet(folder)
    return folder, spark.read.schema(rows.schema).parquet(folder)


def each_row(folder: str) -> Iterator[pa.RecordBatch]:
    """Inside a task: the rows of a stored table, one after the other, in the same order everywhere."""
    system, root = pafs.FileSystem.from_uri(folder)
    files = pads.dataset(root, filesystem=system, format="parquet").files
    for file in sorted(files):
        for batch in pads.dataset(file, filesystem=system, format="parquet").to_batches(batch_size=1, batch_readahead=1):
            yield from (batch.slice(i, 1) for i in range(batch.num_rows))
