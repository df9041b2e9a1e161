"""Lookups, merges and set operations on keyed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def last_wins(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the one that comes last in `order`.

    `max_by` combines on the map side, so a key with very many versions is no hot spot.
    """
    values = [c for c in rows.columns if c != key]
    newest = F.max_by(F.struct(*values), F.struct(*order)).alias("newest")
    return rows.groupBy(key).agg(newest).select(key, *[F.col(f"newest.{c}").alias(c) for c in values])


def merge_pages(pages: list[DataFrame], key: str) -> DataFrame:
    """Union of keyed tables in which a later table overrides an earlier one."""
    merged = pages[0].withColumn("page_no", F.lit(0))
    for number, page in enumerate(pages[1:], start=1):
        merged = merged.unionByName(page.withColumn("page_no", F.lit(number)))
    return last_wins(merged, key, ["page_no"]).drop("page_no")


def only_in(rows: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is in `ids`. No hint: the adaptive planner broadcasts `ids` when it is small."""
    return rows.join(ids.select(key), key, "left_semi")


def not_in(rows: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    return rows.join(ids.select(key), key, "left_anti")


def unfinished(all_rows: DataFrame, done: DataFrame, batch: int, key: str = "id") -> DataFrame:
    """The next `batch` rows that are not done yet, in key order."""
    return not_in(all_rows, done, key).orderBy(key).limit(batch)


def fetch_in_order(rows: DataFrame, wanted: DataFrame, key: str = "id", position: str = "pos") -> DataFrame:
    """The wanted rows with the position they were asked for; unknown keys give no row."""
    return wanted.join(rows, key).orderBy(position)


def by_title(titles: DataFrame, names: list[str]) -> DataFrame:
    return titles.where(F.col("original_title").isin(names))


def valid_names(requested: DataFrame, valid: DataFrame) -> DataFrame:
    return requested.intersect(valid)


def unknown_names(requested: DataFrame, valid: DataFrame) -> DataFrame:
    return requested.subtract(valid)


def chosen_names(requested: list[str], valid: list[str]) -> list[str]:
    """The requested names that exist, or all of them for 'all'; none at all is an error."""
    if "all" in requested:
        return list(valid)
    chosen = [name for name in valid if name in set(requested)]
    if not chosen:
        raise ValueError(f"none of {requested} is a known name")
    return chosen


def progress(rows: DataFrame, finished: Column) -> DataFrame:
    """How many rows there are and how many of them are finished."""
    return rows.agg(
        F.count("*").alias("total"),
        F.count_if(finished).alias("done"),
        F.count_if(~finished).alias("open"),
    ).withColumn("complete", F.col("total") == F.col("done"))
