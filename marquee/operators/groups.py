"""Aggregates per key. Every one of them combines on the map side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import arrays


def count_by(rows: DataFrame, key: str, counted: str) -> DataFrame:
    """Non-null values of `counted` per key."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(counted).alias("n"))


def means_by(rows: DataFrame, key: str, measured: dict[str, str]) -> DataFrame:
    """Means of several columns per key, named by the keys of `measured`."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.avg(c).alias(name) for name, c in measured.items()])


def genre_combinations(titles: DataFrame, votes_above: float) -> DataFrame:
    """Mean rating, votes and number of titles per combination of genres."""
    combination = arrays.joined_sorted(F.col("genre_1"), F.col("genre_2"), F.col("genre_3"))
    return (
        titles.where(F.col("genre_1").isNotNull())
        .groupBy(combination.alias("genres"))
        .agg(
            F.avg("rating").alias("mean_rating"),
            F.sum("num_votes").alias("total_num_votes"),
            F.count("*").alias("n_titles"),
            F.sum("user_review_num").alias("total_user_review_num"),
        )
        .where(F.col("total_num_votes") > votes_above)
    )


def company_stats(titles: DataFrame, titles_above: int, votes_above: float) -> DataFrame:
    return (
        titles.where(F.col("production_company_1").isNotNull())
        .groupBy("production_company_1")
        .agg(
            F.avg("rating").alias("mean_rating"),
            F.count("original_title").alias("n_titles"),
            F.sum("num_votes").alias("total_num_votes"),
        )
        .where((F.col("n_titles") > titles_above) & (F.col("total_num_votes") > votes_above))
    )


def members(rows: DataFrame, key: str, member: str) -> DataFrame:
    """The set of members of each key, one row per member, so that no set has to fit one row."""
    return rows.select(key, member).where(F.col(member).isNotNull()).distinct()


def distinct_count(rows: DataFrame, column: str) -> DataFrame:
    return rows.agg(F.countDistinct(column).alias("n_distinct"))


def pivot_bounded(rows: DataFrame, key: str, column: str, values: list, measured: str) -> DataFrame:
    """Long to wide over a given list of column values; of repeated entries the largest counts."""
    return rows.groupBy(key).pivot(column, values).agg(F.max(measured))
