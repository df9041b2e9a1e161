"""Raw reviews as CSV, processed reviews in hash partitions."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.guards import require_columns
from ..operators.reviews import RAW_REVIEW, clean_reviews, review_part, reviews_of_titles
from ..storage import stored
from .manifest import Manifests

CSV_OPTIONS = {"header": True, "multiLine": True, "escape": '"', "quote": '"'}
CSV_WRITING = {
    "header": True,
    "escape": '"',
    "quote": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
FORMATS = ("parquet", "csv")
def read_raw_reviews(spark: SparkSession, path: str | list[str], with_file: bool = False) -> DataFrame:
    """All review files of a folder in one read. Titles without a file simply have no rows.

    All files must have the header of the first one; unless that has an unnamed row number in front, Spark
    checks it. Without an id column, the file name gives the id. `with_file` adds the path of the file as `file`.
    """
    files = spark.read.options(**CSV_OPTIONS)
    columns = files.csv(path).columns
    unnamed = any(c.startswith("_c") for c in columns)
    rows = files.option("enforceSchema", unnamed).csv(path)
    known = [c for c in RAW_REVIEW.fieldNames() if c in columns]
    if with_file:
        rows = rows.withColumn("file", F.col("_metadata.file_path"))
        known.append("file")
    if "id" in columns:
        return rows.select(*known)
    file = F.regexp_extract("_metadata.file_name", r"^(.*?)\.csv", 1)
    return rows.select(F.concat(F.lit("/title/"), file, F.lit("/")).alias("id"), *known)


def write_raw_reviews(reviews: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One folder per title, of gzip files; with line breaks in texts a file is read by one task in any case."""
    require_columns(reviews, "id")
    # 'rebalance' gathers small titles and spreads a title with very many rows over several tasks.
    (
        reviews.withColumn("title_id", F.col("id"))
        .hint("rebalance", "title_id")
        .write.partitionBy("title_id")
        .mode(mode)
        .options(compression="gzip", **CSV_WRITING)
        .csv(path)
    )


def check_format(form: str) -> str:
    if form not in FORMATS:
        raise ValueError(f"reviews are stored as {' or '.join(FORMATS)}, not {form!r}")
    return form


LOG = "unit string, part int, n bigint, sum bigint, mix bigint"


def finished_titles(spark: SparkSession, path: str) -> DataFrame | None:
    """unit (the id of a title), part, and what was last written of it (n, sum, mix); None before the first write."""
    return Manifests(spark, path).table("units")


def _contents(placed: DataFrame, unit: str) -> DataFrame:
    """unit, part, and the number of its rows there with two sums of their hashes, whatever their order."""
    row = F.xxhash64(*placed.columns)
    low = F.sum(row.bitwiseAND(F.lit(0xFFFFFFFF))).alias("sum")
    rows = placed.groupBy(F.col(unit).cast("string").alias("unit"), "part")
    return rows.agg(F.count("*").alias("n"), low, F.bit_xor(row).alias("mix"))


def write_parts(
    reviews: DataFrame,
    path: str,
    parts: int,
    form: str = "parquet",
    unit: str = "id",
    gone: DataFrame | None = None,
    progress: DataFrame | None = None,
) -> None:
    """Bring processed reviews into `parts` partitions, title by title; `read_parts` gives them back.

    A title that is new, or whose rows differ from those last written, is replaced by the given rows; titles in `gone` (column `unit`) are
    removed; all others keep theirs, given or not. `unit` may name another column by which rows are replaced, such as the file they came from. `progress`
    is a table that is published with the rows.

    Partitions with a change are written anew beside the old ones, and become visible together when the manifest that
    names them is published. A run that dies before that has changed nothing. The number of partitions and the format cannot change.
    """
    check_format(form)
    spark = reviews.sparkSession
    manifests = Manifests(spark, path)
    number = manifests.latest()
    settings = manifests.table("settings", number)
    if settings is not None:
        other = settings.first()
        if (other["parts"], other["form"], other["unit"]) != (parts, form, unit):
            raise ValueError(f"{path} holds {other['parts']} partitions of {other['form']} by {other['unit']}, not {parts} of {form} by {unit}")
    placed = reviews if "part" in reviews.columns else reviews.withColumn("part", review_part(parts))
    given = stored(_contents(placed, unit))
    names = ["unit", "part", "n", "sum", "mix"]
    before = manifests.table("units", number) if number else spark.createDataFrame([], LOG)
    # A unit is unchanged if all its entries are as they were. Entries of both sides that stand alone name the others.
    known = before.join(given.select("unit").distinct(), "unit", "left_semi")
    changed = given.join(known, names, "left_anti").select("unit").unionByName(known.join(given, names, "left_anti").select("unit"))
    if gone is not None:
        changed = changed.unionByName(before.join(gone.select(F.col("unit").cast("string")), "unit", "left_semi").select("unit"))
    changed = stored(changed.distinct())
    touched = before.join(changed, "unit", "left_semi").select("part").unionByName(given.join(changed, "unit", "left_semi").select("part"))
    touched = sorted(r["part"] for r in touched.distinct().collect())  # at most `parts` numbers
    if not touched and progress is None:
        return
    run = uuid.uuid4().hex
    old_parts = manifests.table("parts", number) if number else spark.createDataFrame([], "part int, run string")
    replaced = changed if gone is None else changed.unionByName(gone.select(F.col("unit").cast("string"))).distinct()
    rows = placed.join(changed.withColumnRenamed("unit", unit), unit, "left_semi")
    if gone is not None:
        rows = rows.join(gone.select(F.col("unit").alias(unit)).distinct(), unit, "left_anti")
        given = given.join(gone.select(F.col("unit").cast("string")).distinct(), "unit", "left_anti")
    if touched:
        stays = read_parts(spark, path, touched) if number else None
        if stays is not None:
            rows = rows.unionByName(stays.select(rows.columns).join(replaced.withColumnRenamed("unit", unit), unit, "left_anti"))
        _write_rows(rows, f"{path}/run={run}", form)
    units = before.join(replaced, "unit", "left_anti").unionByName(given.join(changed, "unit", "left_semi").select(names))
    units = stored(units)
    new_parts = old_parts.where(~F.col("part").isin(touched)).unionByName(
        units.where(F.col("part").isin(touched)).select("part", F.lit(run).alias("run")).distinct()
    )
    tables = {
        "units": units,
        "parts": new_parts.coalesce(1),
        "settings": spark.createDataFrame([(parts, form, unit, rows.schema.json())], "parts int, form string, unit string, schema string"),
    }
    done = manifests.table("progress", number) if number else None
    if progress is not None or done is not None:
        tables["progress"] = done if progress is None else progress
    manifests.publish(tables, number)


def _write_rows(rows: DataFrame, folder: str, form: str) -> None:
    # 'rebalance' gathers small partitions and spreads one with very many rows over several tasks.
    writer = rows.hint("rebalance", "part").write.partitionBy("part")
    if form == "csv":
        writer = writer.options(compression="gzip", **CSV_WRITING)
    writer.format(form).save(folder)


def read_parts(spark: SparkSession, path: str, some: list[int] | None = None) -> DataFrame | None:
    """The rows that `write_parts` last published, with their partition number, or those of some partitions; None if there are none."""
    manifests = Manifests(spark, path)
    number = manifests.latest()
    if not number:
        return None
    settings = manifests.table("settings", number).first()
    form = settings["form"]
    named = [r for r in manifests.table("parts", number).collect() if some is None or r["part"] in some]  # a row per partition
    runs: dict[str, list[int]] = {}
    for r in named:
        runs.setdefault(r["run"], []).append(r["part"])
    if not runs:
        return None
    columns = [f for f in T.StructType.fromJson(json.loads(settings["schema"])).fields if f.name != "part"]
    schema = T.StructType([*columns, T.StructField("run", T.StringType()), T.StructField("part", T.IntegerType())])
    reader = spark.read.schema(schema).options(**(CSV_OPTIONS if form == "csv" else {})).option("basePath", path)
    rows = reader.format(form).load([f"{path}/run={run}" for run in runs])
    wanted = None
    for run, numbers in runs.items():
        here = (F.col("run") == run) & F.col("part").isin(numbers)
        wanted = here if wanted is None else wanted | here
    return rows.where(wanted).drop("run")


def forget_old_runs(spark: SparkSession, path: str) -> None:
    """Delete what the latest manifest does not name. Not to be called while others write or read older states."""
    manifests = Manifests(spark, path)
    used = {f"run={r['run']}" for r in manifests.table("parts").select("run").distinct().collect()}
    for name in manifests.names(path):
        if name.startswith("run=") and name not in used:
            manifests.delete(f"{path}/{name}")
    manifests.forget()


def read_columns(spark: SparkSession, paths: list[str], columns: list[str], form: str = "parquet") -> DataFrame:
    """Some columns of several folders or files; other columns are never read."""
    reader = spark.read
    if form == "csv":
        reader = reader.options(**CSV_OPTIONS)
    return reader.format(check_format(form)).load(paths).select(*columns)


def run_reviews_job(
    spark: SparkSession, raw_path: str, titles: DataFrame, target: str, parts: int, form: str = "parquet"
) -> None:
    """Raw review files -> cleaned reviews of known titles in hash partitions."""
    cleaned = clean_reviews(read_raw_reviews(spark, raw_path))
    write_parts(reviews_of_titles(cleaned, titles, parts), target, parts, form)


def export_table(rows: DataFrame, path: str, casts: dict[str, str] | None = None) -> None:
    """A table as parquet with some columns cast."""
    casted = rows.withColumns({c: F.col(c).cast(t) for c, t in (casts or {}).items()}) if casts else rows
    casted.write.mode("overwrite").parquet(path)
