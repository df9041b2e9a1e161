"""Records kept as one JSON object per file, keyed by id or by column."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .json_ranges import read_by_column_ranges, read_keyed_ranges
from .locations import Location

HEAD_PIECES = 256  # pieces that end in a brace, from which the form of the files is seen


def parse_keyed(documents: DataFrame, value: Column, schema: T.StructType, key: str = "id") -> DataFrame:
    """`{id: {field: ...}}` texts -> one row per id."""
    mapped = F.from_json(value, T.MapType(T.StringType(), schema))
    return documents.select(F.explode(mapped).alias(key, "record")).select(key, "record.*")


def parse_by_column(documents: DataFrame, value: Column, columns: list[str], key: str = "id") -> DataFrame:
    """`{field: {id: value}}` texts -> one row per id with the given columns, all of them text."""
    mapped = F.from_json(value, "map<string,map<string,string>>")
    cells = (
        documents.select(F.explode(mapped).alias("field", "column"))
        .select("field", F.explode("column").alias(key, "value"))
        .where(F.col("field").isin(columns))
    )
    return cells.groupBy(key).pivot("field", columns).agg(F.first("value"))


def read_keyed(
    spark: SparkSession, path: str, schema: T.StructType, key: str = "id", key_prefix: str | None = None
) -> DataFrame:
    """Files that hold one JSON object `{id: record}` each.

    A large file is read by many tasks. That takes two passes over it; one is enough when all ids begin with the same text, such as
    `/title/`, given as `key_prefix`: that text is where records begin, and Spark splits even a single huge object between records.
    """
    if key_prefix is None:
        return read_keyed_ranges(spark, path, schema, key)
    # How the writer separates records and whether it escapes slashes shows in the first pieces of the files.
    head = "}".join(r["value"] for r in spark.read.option("lineSep", "}").text(path).limit(HEAD_PIECES).collect())
    forms = [key_prefix, key_prefix.replace("/", "\\/")]
    written = next((w for w in reversed(forms) if re.match(r'\s*\{\s*"' + re.escape(w), head)), None)
    found = written and re.search(r'\}(\s*,\s*)"' + re.escape(written), head)
    if not found:  # a single record, or ids that begin otherwise
        return read_keyed(spark, path, schema, key)
    boundary = f'}}{found[1]}"{written}'
    pieces = spark.read.option("lineSep", boundary).text(path)
    # The first piece still has the opening of the object; the others begin inside the id.
    body = F.regexp_replace("value", r'^\s*\{\s*"' + re.escape(written), "")
    ended = F.instr(body, '"')
    identifier = F.concat(F.lit(key_prefix), F.replace(F.substring(body, 1, ended - 1), F.lit("\\/"), F.lit("/")))
    rest = F.regexp_replace(F.substring(body, ended + 1, F.length(body)), r"^\s*:", "")
    # The separator took the closing brace of the record; the last piece has one too many, which the parser ignores.
    record = F.from_json(F.concat(rest, F.lit("}")), schema)
    torn = body.rlike(r'\}\s*,\s*"' + re.escape(written).replace("/", r"\\?/"))
    wrong = F.raise_error(F.concat(F.lit("not one record: "), F.substring("value", 1, 200)))
    record = F.when((ended > 0) & ~torn & record.isNotNull(), record).otherwise(wrong)
    return pieces.where(F.trim("value") != "").select(identifier.alias(key), record.alias("record")).select(key, "record.*")


def read_keyed_at(spark: SparkSession, place: Location, name: str, schema: T.StructType, key: str = "id", **options) -> DataFrame:
    """`read_keyed` of a file or folder in a local folder or an object store."""
    return read_keyed(spark, place.path(name), schema, key, **options)


def read_by_column(spark: SparkSession, path: str, columns: list[str], key: str = "id") -> DataFrame:
    """Files that hold one JSON object `{field: {id: value}}` each; a large file is read by many tasks."""
    return read_by_column_ranges(spark, path, columns, key)


def as_keyed(rows: DataFrame, key: str = "id") -> DataFrame:
    """Rows as texts `{id: record}`, one object per row."""
    fields = [c for c in rows.columns if c != key]
    record = F.create_map(F.col(key).cast("string"), F.struct(*fields))
    return rows.select(F.to_json(record).alias("value"))


def as_by_column(rows: DataFrame, key: str = "id") -> DataFrame:
    """Rows as texts `{field: {id: value}}`, one object per row."""
    fields = [c for c in rows.columns if c != key]
    cells = [F.create_map(F.col(key).cast("string"), F.col(c)).alias(c) for c in fields]
    return rows.select(F.to_json(F.struct(*cells)).alias("value"))


def write_keyed(rows: DataFrame, path: str, key: str = "id", mode: str = "errorifexists") -> None:
    """One line `{id: record}` per row, so that the result can be read in parallel."""
    as_keyed(rows, key).write.mode(mode).text(path)


def read_keyed_lines(spark: SparkSession, path: str, schema: T.StructType, key: str = "id") -> DataFrame:
    return parse_keyed(spark.read.text(path), F.col("value"), schema, key)
