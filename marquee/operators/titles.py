"""Cleaning of the nested title metadata into flat columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import arrays, dates, numbers, text
from .guards import require_columns

_strings = T.ArrayType(T.StringType())
_ranked = T.MapType(T.StringType(), T.StringType())


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Field names of the stored records and of the flat table made from them.
RAW_TITLE = T.StructType(
    [
        T.StructField("main_genre", T.StringType()),
        T.StructField("original_title", T.StringType()),
        T.StructField("genres", _strings),
        T.StructField("poster_url", T.StringType()),
        T.StructField("review_summary", _texts("user_review_num", "critic_review_num", "metascore")),
        T.StructField("agg_rating", _texts("avg_rating", "num_votes")),
        T.StructField("actors", _ranked),
        T.StructField("imdb_recommendations", _ranked),
        T.StructField(
            "details",
            T.StructType(
                [
                    T.StructField("release_date", _strings),
                    T.StructField("countries_of_origin", _strings),
                    T.StructField("language", _strings),
                    T.StructField("also_known_as", _strings),
                    T.StructField("production_companies", _strings),
                    T.StructField("filming_locations", _strings),
                    T.StructField("runtime", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "boxoffice",
            _texts(
                "budget",
                "boxoffice_gross_domestic",
                "boxoffice_gross_opening",
                "boxoffice_gross_worldwide",
            ),
        ),
    ]
)
GENRE_COLUMNS = ["genre_1", "genre_2", "genre_3"]
COUNTRY_COLUMNS = ["country_of_origin_1", "country_of_origin_2", "country_of_origin_3"]
COMPANY_COLUMNS = ["production_company_1", "production_company_2", "production_company_3"]


def split_rating(raw: DataFrame) -> DataFrame:
    """agg_rating -> rating, num_votes. Titles without a rating are left out."""
    require_columns(raw, "agg_rating")
    return (
        raw.where(F.col("agg_rating").isNotNull())
        .withColumns(
            {
                "rating": text.before(F.col("agg_rating.avg_rating"), "/").try_cast("double"),
                "num_votes": numbers.short_form(F.col("agg_rating.num_votes")),
            }
        )
        .drop("agg_rating")
    )


def split_review_summary(raw: DataFrame) -> DataFrame:
    require_columns(raw, "review_summary")
    names = ["user_review_num", "critic_review_num", "metascore"]
    return raw.withColumns(
        {name: numbers.short_form(F.col(f"review_summary.{name}")) for name in names}
    ).drop("review_summary")


def split_genres(raw: DataFrame) -> DataFrame:
    require_columns(raw, "genres")
    return raw.select("*", *arrays.spread(F.col("genres"), GENRE_COLUMNS)).drop("genres")


def parse_release_date(details: DataFrame) -> DataFrame:
    require_columns(details, "release_date")
    first = F.get("release_date", F.lit(0))
    return details.withColumn("release_date", dates.release_date(first))


def first_other_name(details: DataFrame) -> DataFrame:
    require_columns(details, "also_known_as")
    return details.withColumn("also_known_as", F.get("also_known_as", F.lit(0)))


def parse_runtime(details: DataFrame) -> DataFrame:
    require_columns(details, "runtime")
    return details.withColumn("runtime", dates.runtime_minutes(F.col("runtime")))


def split_countries(details: DataFrame) -> DataFrame:
    require_columns(details, "countries_of_origin")
    columns = arrays.spread(F.col("countries_of_origin"), COUNTRY_COLUMNS)
    return details.select("*", *columns).drop("countries_of_origin")


def split_language(details: DataFrame) -> DataFrame:
    require_columns(details, "language")
    spoken = arrays.first_present(F.col("language"))
    return details.withColumn("original_language", spoken).drop("language")


def split_companies(details: DataFrame) -> DataFrame:
    require_columns(details, "production_companies")
    columns = arrays.spread(F.col("production_companies"), COMPANY_COLUMNS)
    return details.select("*", *columns).drop("production_companies")


def split_locations(details: DataFrame) -> DataFrame:
    require_columns(details, "filming_locations")
    place = F.get("filming_locations", F.lit(0))
    return details.withColumns(
        {"filming_location": place, "filming_country": text.last_word(place)}
    ).drop("filming_locations")


def split_details(raw: DataFrame) -> DataFrame:
    require_columns(raw, "details")
    return (
        raw.select("*", "details.*")
        .drop("details")
        .transform(parse_release_date)
        .transform(first_other_name)
        .transform(parse_runtime)
        .transform(split_countries)
        .transform(split_language)
        .transform(split_companies)
        .transform(split_locations)
    )


def split_boxoffice(raw: DataFrame) -> DataFrame:
    require_columns(raw, "boxoffice")
    return raw.select("*", "boxoffice.*").drop("boxoffice")


def clean_titles(raw: DataFrame) -> DataFrame:
    """Nested title records -> flat titles. One filter and projections, no shuffle."""
    return (
        raw.transform(split_rating)
        .transform(split_review_summary)
        .transform(split_genres)
        .transform(split_details)
        .transform(split_boxoffice)
    )


def ranked_entries(titles: DataFrame, column: str, key: str = "id") -> DataFrame:
    """A rank-keyed map as one row per entry, the rank as a number."""
    require_columns(titles, key, column)
    return titles.select(key, F.explode(column).alias("rank_text", "value")).select(
        key, F.col("rank_text").try_cast("int").alias("rank"), "value"
    )


def ranked_columns(titles: DataFrame, column: str, ranks: int, key: str = "id") -> DataFrame:
    """A rank-keyed map as `ranks` columns named 1, 2, 3 ..."""
    require_columns(titles, key, column)
    entry = [F.try_element_at(F.col(column), F.lit(str(r))).alias(str(r)) for r in range(1, ranks + 1)]
    return titles.select(key, *entry)
