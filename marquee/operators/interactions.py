"""The author x title table, kept long: one row per rating."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .ranking import first_share, text_order


def interactions(reviews: DataFrame) -> DataFrame:
    return reviews.select("author", "id", "rating").distinct()


def active_authors(reviews: DataFrame, least: int) -> DataFrame:
    """Reviews by authors with at least `least` reviews.

    Counts are combined before the shuffle; the semi join back is split by the adaptive planner when
    one author has very many rows.
    """
    counts = reviews.groupBy("author").agg(F.count("id").alias("n_reviews"))
    active = counts.where(F.col("n_reviews") >= least).select("author")
    return reviews.join(active, "author", "left_semi")


def likes(reviews: DataFrame, least: float) -> DataFrame:
    """user_id, id and pos of the titles that a user rated `least` or better; `pos` orders them by their last review, then by id."""
    rated = reviews.where(F.col("rating") >= least)
    # One value per (user, title) keeps that order without a sort.
    last = rated.groupBy("user_id", "id").agg(F.max("review_date").alias("last_seen"))
    return last.select("user_id", "id", F.struct("last_seen", "id").alias("pos"))


def sparsity(ratings: DataFrame) -> DataFrame:
    """Percentage of empty cells of the author x title matrix, without building the matrix."""
    cells = ratings.where(F.col("rating").isNotNull()).select("author", "id").distinct()
    return cells.agg(
        F.count("*").alias("cells"),
        F.countDistinct("author").alias("authors"),
        F.countDistinct("id").alias("titles"),
    ).withColumn("sparsity", 100 * (1 - F.col("cells") / (F.col("authors") * F.col("titles"))))


def holdout(ratings: DataFrame, share: float, seed: int = 0, ranges: int | None = None) -> DataFrame:
    """The test rows: floor(share * n) of the n distinct (author, id) cells of each author.

    Drawn without replacement in a hash order, so every run draws the same rows.
    """
    cells = ratings.where(F.col("rating").isNotNull()).select("author", "id").distinct()
    drawn = cells.withColumn("draw", -text_order(F.col("author"), F.col("id"), seed=seed))
    test = first_share(drawn, ["author"], "draw", "id", lambda n: F.floor(F.lit(float(share)) * n), ranges)
    return test.drop("draw")


def split(ratings: DataFrame, share: float, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(train, test): every rating is in exactly one of them."""
    test_cells = holdout(ratings, share, seed)
    train = ratings.join(test_cells, ["author", "id"], "left_anti")
    test = ratings.join(test_cells, ["author", "id"], "left_semi")
    return train, test
