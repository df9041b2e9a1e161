"""Cleaning of raw review rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import dates, text
from .guards import require_columns

RAW_REVIEW = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("rating", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("helpfulness", T.StringType()),
    ]
)


def split_helpfulness(raw: DataFrame) -> DataFrame:
    """`171 out of 185 found this helpful` -> upvotes, total_votes; both NULL without numbers."""
    require_columns(raw, "helpfulness")
    votes = text.numbers_in(F.col("helpfulness"))
    return raw.withColumns(
        {"upvotes": F.get(votes, F.lit(0)), "total_votes": F.get(votes, F.lit(1))}
    ).drop("helpfulness")


def clean_author(raw: DataFrame) -> DataFrame:
    require_columns(raw, "author")
    return raw.withColumn("author", text.before(F.col("author"), "?"))


def clean_title(raw: DataFrame) -> DataFrame:
    require_columns(raw, "title")
    return raw.withColumn("title", text.without_trailing_newlines(F.col("title")))


def parse_review_date(raw: DataFrame) -> DataFrame:
    require_columns(raw, "date")
    return raw.withColumn("review_date", dates.review_date(F.col("date"))).drop("date")


def narrow_types(reviews: DataFrame) -> DataFrame:
    require_columns(reviews, "upvotes", "total_votes", "rating")
    return reviews.withColumns(
        {
            "upvotes": F.col("upvotes").try_cast("int"),
            "total_votes": F.col("total_votes").try_cast("int"),
            "rating": F.col("rating").try_cast("double"),
        }
    )


def clean_reviews(raw: DataFrame) -> DataFrame:
    """Raw review rows -> typed rows. One projection over the source, no shuffle."""
    return (
        raw.drop("Unnamed: 0")
        .transform(split_helpfulness)
        .transform(clean_author)
        .transform(clean_title)
        .transform(parse_review_date)
        .transform(narrow_types)
    )


def review_part(parts: int, key: str = "id"):
    """A stable partition number of the title, the same in every run and on every executor."""
    prefix = F.substring(F.md5(F.col(key).cast("string")), 1, 8)
    return F.pmod(F.conv(prefix, 16, 10).cast("bigint"), F.lit(parts)).cast("int")


def reviews_of_titles(reviews: DataFrame, titles: DataFrame, parts: int) -> DataFrame:
    """Reviews whose title is known, with the partition number they are stored under."""
    return reviews.join(titles.select("id"), "id", "left_semi").withColumn("part", review_part(parts))
