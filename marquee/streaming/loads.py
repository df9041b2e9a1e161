"""Incremental loads: pick up files that are not done yet, a few per step, and survive a restart."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.keyed import last_wins
from ..operators.reviews import RAW_REVIEW, clean_reviews, review_part
from ..sources.manifest import Manifests
from ..sources.review_files import CSV_OPTIONS, read_raw_reviews, write_parts
from ..storage import stored

STEPS_PER_SNAPSHOT = 10


def raw_review_stream(spark: SparkSession, path: str, files_per_step: int) -> DataFrame:
    """New review files. Columns go by the header of the files there are: an unnamed row number in front is dropped."""
    columns = spark.read.options(**CSV_OPTIONS).csv(path).columns
    kinds = {f.name: f.dataType for f in RAW_REVIEW.fields}
    schema = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in columns])
    files = spark.readStream.schema(schema).options(**CSV_OPTIONS).option("maxFilesPerTrigger", files_per_step)
    return files.csv(path).select(*[c for c in RAW_REVIEW.fieldNames() if c in columns])


def load_reviews(
    spark: SparkSession, raw_path: str, target: str, progress: str, parts: int, files_per_step: int = 50
) -> StreamingQuery:
    """Clean all new review files and append them under `part=N`.

    Cleaning keeps no state, so no watermark is needed. A file is processed once: the file sink commits each
    step together with the progress, and a second run finds nothing to do.
    """
    cleaned = clean_reviews(raw_review_stream(spark, raw_path, files_per_step))
    return (
        cleaned.withColumn("part", review_part(parts))
        .writeStream.partitionBy("part")
        .format("parquet")
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start(target)
    )


def changed_files(spark: SparkSession, path: str, done: DataFrame | None, pattern: str = "*.{csv,csv.gz}") -> DataFrame:
    """file, length, modified of the files that are new, have grown or were written again since they were noted in `done`."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    # The contents of the files are not read: only these columns are asked for.
    listed = files.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))
    return listed if done is None else listed.join(done, ["file", "length", "modified"], "left_anti")


def refresh_reviews(
    spark: SparkSession, raw_path: str, target: str, parts: int, files_per_step: int = 50, form: str = "parquet", pattern: str = "*.{csv,csv.gz}"
) -> int:
    """Bring the target up to date with the raw review files, some files per step; returns the number of steps.

    What a file gave is replaced by what it gives now: a file that has grown or was written again is read again, rows of a title that come from
    several files are all kept, and a file that is no longer there takes its rows with it. Which files are done is published together with
    their rows, so a run that dies is continued by the next one, and a second run finds nothing to do.
    """
    steps = 0
    while True:
        done = Manifests(spark, target).table("progress")
        listed = stored(changed_files(spark, raw_path, None, pattern))
        todo = listed if done is None else listed.join(done, ["file", "length", "modified"], "left_anti")
        todo = stored(todo.orderBy("file").limit(files_per_step))
        lost = None if done is None else stored(done.join(listed, "file", "left_anti"))
        names = [r["file"] for r in todo.collect()]  # at most files_per_step
        if not names and (lost is None or lost.isEmpty()):
            return steps
        kept = None if done is None else done.join(todo, "file", "left_anti").join(lost, "file", "left_anti")
        progress = todo if kept is None else kept.unionByName(todo)
        # Files without rows are gone as far as the target is concerned.
        rows = clean_reviews(read_raw_reviews(spark, names, with_file=True)) if names else _no_reviews(spark)
        empty = todo.select(F.col("file").alias("unit")).join(rows.select(F.col("file").alias("unit")).distinct(), "unit", "left_anti")
        gone = empty if lost is None else empty.unionByName(lost.select(F.col("file").alias("unit")))
        write_parts(rows, target, parts, form, unit="file", gone=stored(gone), progress=stored(progress))
        steps += 1


def _no_reviews(spark: SparkSession) -> DataFrame:
    raw = spark.createDataFrame([], T.StructType([*RAW_REVIEW.fields, T.StructField("file", T.StringType())]))
    return clean_reviews(raw)


def load_titles(
    spark: SparkSession, path: str, schema: T.StructType, log: str, progress: str, files_per_step: int = 50
) -> StreamingQuery:
    """Append new title records (JSON lines) to a log. A step that is repeated overwrites its own folder.

    After every STEPS_PER_SNAPSHOT steps they are folded into a snapshot, so reading the current titles does not get slower with time.
    """

    def append(batch: DataFrame, number: int) -> None:
        # A step that the snapshot holds already was repeated since its end was not noted; it would be read twice for nothing.
        if number > _snapshot(Manifests(spark, log))[1]:
            batch.write.mode("overwrite").parquet(f"{log}/step={number}")
        if (number + 1) % STEPS_PER_SNAPSHOT == 0:
            compact_titles(spark, log)

    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_step)
        .json(path)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )


def _steps_after(manifests: Manifests, log: str, last: int) -> list[int]:
    found = (name.removeprefix("step=") for name in manifests.names(log) if name.startswith("step="))
    return sorted(int(n) for n in found if n.isdigit() and int(n) > last)


def _snapshot(manifests: Manifests) -> tuple[str | None, int]:
    """The folder of the snapshot and the last step that is in it."""
    found = manifests.table("snapshot")
    row = found.first() if found is not None else None
    return (row["folder"], row["step"]) if row else (None, -1)


def current_titles(spark: SparkSession, log: str, key: str = "id", version: str = "step") -> DataFrame:
    """The latest record of each title in the log: from the last snapshot and the steps after it."""
    manifests = Manifests(spark, log)
    folder, last = _snapshot(manifests)
    steps = _steps_after(manifests, log, last)
    parts = []
    if folder:
        parts.append(spark.read.parquet(f"{log}/{folder}").drop("bucket"))
    if steps:
        parts.append(spark.read.option("basePath", log).parquet(*[f"{log}/step={n}" for n in steps]))
    if not parts:
        return spark.read.parquet(log)
    rows = parts[0].unionByName(parts[1], allowMissingColumns=True) if len(parts) > 1 else parts[0]
    return last_wins(rows, key, [version]).drop(version)


def compact_titles(spark: SparkSession, log: str, key: str = "id", buckets: int = 16) -> bool:
    """Fold the snapshot and all steps after it into a new snapshot in folders by a hash of the id; False if there is nothing to fold.

    The new snapshot counts once the manifest names it. Only then are the steps in it and the old snapshot deleted; a run that dies before
    leaves the log as it was.
    """
    manifests = Manifests(spark, log)
    number = manifests.latest()
    folder, last = _snapshot(manifests)
    steps = _steps_after(manifests, log, last)
    if not steps:
        return False
    rows = spark.read.option("basePath", log).parquet(*[f"{log}/step={n}" for n in steps])
    rows = rows.withColumn("step", F.col("step").cast("bigint"))
    if folder:
        rows = rows.unionByName(spark.read.parquet(f"{log}/{folder}").drop("bucket"), allowMissingColumns=True)
    newest = last_wins(rows, key, ["step"])
    name = f"snapshot-{uuid.uuid4().hex}"
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    newest.withColumn("bucket", bucket).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{log}/{name}")
    manifests.publish({"snapshot": spark.createDataFrame([(name, steps[-1])], "folder string, step bigint")}, number)
    for old in [*(f"step={n}" for n in steps), *([folder] if folder else [])]:
        manifests.delete(f"{log}/{old}")
    manifests.forget()
    return True
