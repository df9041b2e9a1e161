"""Cleaning of review rows and nested title records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays, numbers, text
from ..operators import reviews as review_ops, titles as title_ops
from .registry import query
from .views import ITEMS, REVIEWS, items, raw_titles, reviews, with_views


def _as_text(frame, *columns):
    return frame.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns})


@query(
    "helpfulness_split",
    with_views("select order_id, line, id, upvotes, total_votes from reviews", REVIEWS),
)
def helpfulness_split(spark, folder):
    split = review_ops.split_helpfulness(reviews(spark, folder))
    return split.select("order_id", "line", "id", "upvotes", "total_votes")


@query("author_clean", with_views("select order_id, line, id, author_clean as author from reviews", REVIEWS))
def author_clean(spark, folder):
    return review_ops.clean_author(reviews(spark, folder)).select("order_id", "line", "id", "author")


@query("title_rstrip", with_views("select order_id, line, id, title_clean as title from reviews", REVIEWS))
def title_rstrip(spark, folder):
    return review_ops.clean_title(reviews(spark, folder)).select("order_id", "line", "id", "title")


def _raw_reviews(spark, folder):
    """Reviews as they are stored: the date is text with blanks around it."""
    written = F.concat(F.lit("\n    "), F.date_format("review_date", "d MMMM yyyy"), F.lit("\n   "))
    said = F.concat(F.lit("I saw "), "title", F.lit("twice.\n"))
    return reviews(spark, folder).withColumns({"date": written, "text": said}).drop("review_date")


@query(
    "review_date",
    with_views(
        """select order_id, line, id, strftime(review_date, '%Y-%m-%d') as review_date from reviews""",
        REVIEWS,
    ),
)
def review_date(spark, folder):
    parsed = review_ops.parse_review_date(_raw_reviews(spark, folder))
    return _as_text(parsed.select("order_id", "line", "id", "review_date"), "review_date")


@query(
    "reviews_etl",
    with_views(
        """select order_id, line, id, cast(rating as double) as rating, title_clean as title, author_clean as author,
          upvotes, total_votes, strftime(review_date, '%Y-%m-%d') as review_date, 'I saw ' || title || 'twice.' || chr(10) as text from reviews""",
        REVIEWS,
    ),
)
def reviews_etl(spark, folder):
    return _as_text(review_ops.clean_reviews(_raw_reviews(spark, folder)).drop("user_id"), "review_date")


@query(
    "short_form_number",
    with_views(
        """select main_genre, cast(sum(cast(replace(num_votes || '.5K', 'K', 'e+03') as double)) as bigint) as votes,
          cast(sum(cast(replace(user_review_num || '.2M', 'M', 'e+06') as double)) as bigint) as user_reviews
        from items group by main_genre""",
        ITEMS,
    ),
)
def short_form_number(spark, folder):
    texts = items(spark, folder).select(
        "main_genre",
        F.concat(F.col("num_votes").cast("string"), F.lit(".5K")).alias("votes"),
        F.concat(F.col("user_review_num").cast("string"), F.lit(".2M")).alias("user_reviews"),
    )
    return texts.groupBy("main_genre").agg(
        *[F.sum(numbers.short_form(F.col(c))).cast("bigint").alias(c) for c in ("votes", "user_reviews")]
    )


@query(
    "agg_rating_split",
    with_views(
        """select id, cast(cast(runtime as int) % 10 || '.5' as double) as rating, num_votes * 1000 + 500.0::double as num_votes
        from items where id % 13 <> 0 and num_votes is not null""",
        ITEMS,
    ),
)
def agg_rating_split(spark, folder):
    return title_ops.split_rating(raw_titles(spark, folder)).select("id", "rating", "num_votes")


@query(
    "review_summary_split",
    with_views(
        """select id, cast(user_review_num || '.2e+03' as double) as user_review_num,
          cast(critic_review_num as double) as critic_review_num,
          case when id % 3 <> 0 then cast(id % 100 as double) end as metascore from items""",
        ITEMS,
    ),
)
def review_summary_split(spark, folder):
    split = title_ops.split_review_summary(raw_titles(spark, folder))
    return split.select("id", "user_review_num", "critic_review_num", "metascore")


RELEASED = """case id % 3 when 2 then date_trunc('year', release_date) else release_date end"""


@query(
    "release_date_parse",
    with_views(f"select id, strftime({RELEASED}, '%Y-%m-%d') as release_date from items", ITEMS),
)
def release_date_parse(spark, folder):
    raw = raw_titles(spark, folder).select("id", F.col("details.release_date").alias("release_date"))
    return _as_text(title_ops.parse_release_date(raw), "release_date")


MINUTES = "cast((cast(runtime as int) % 3 + 1) * 60 + cast(runtime as int) % 60 as double)"


@query("runtime_minutes", with_views(f"select id, {MINUTES} as runtime from items", ITEMS))
def runtime_minutes(spark, folder):
    raw = raw_titles(spark, folder).select("id", F.col("details.runtime").alias("runtime"))
    return title_ops.parse_runtime(raw)


LISTS = """case when id % 2 = 1 then 'Italy' end as country_of_origin_2, case when id % 2 = 1 then 'Peru' end as country_of_origin_3,
  case when id % 7 <> 0 then production_company_1 end as production_company_1,
  case when id % 7 <> 0 then 'SAFFI' end as production_company_2, cast(null as varchar) as production_company_3,
  'Il ' || original_title as also_known_as, genre_1, genre_2, coalesce(genre_3, main_genre) as genre_3"""


@query("list_spread", with_views(f"select id, country_of_origin_1, {LISTS} from items", ITEMS))
def list_spread(spark, folder):
    raw = raw_titles(spark, folder).transform(title_ops.split_genres).select(
        "id", *title_ops.GENRE_COLUMNS, "details.*"
    )
    flat = (
        raw.transform(title_ops.split_countries)
        .transform(title_ops.split_companies)
        .transform(title_ops.first_other_name)
    )
    return flat.select(
        "id",
        "also_known_as",
        *title_ops.COUNTRY_COLUMNS,
        *title_ops.COMPANY_COLUMNS,
        *title_ops.GENRE_COLUMNS,
    )


@query("first_non_null", with_views("select id, coalesce(original_language, 'it') as original_language from items", ITEMS))
def first_non_null(spark, folder):
    raw = raw_titles(spark, folder).select("id", F.col("details.language").alias("language"))
    return title_ops.split_language(raw)


PLACE = "'Old Mill, ' || original_title || ', ' || country_of_origin_1"


@query(
    "last_token",
    with_views(f"select id, {PLACE} as filming_location, country_of_origin_1 as filming_country from items", ITEMS),
)
def last_token(spark, folder):
    raw = raw_titles(spark, folder).select("id", F.col("details.filming_locations").alias("filming_locations"))
    return title_ops.split_locations(raw)


BOXOFFICE = """'$' || (id * 1000) || ' (estimated)' as budget, cast(null as varchar) as boxoffice_gross_domestic,
  '$' || id as boxoffice_gross_opening, boxoffice_gross_worldwide"""


@query("struct_flatten", with_views(f"select id, {BOXOFFICE} from items", ITEMS))
def struct_flatten(spark, folder):
    return title_ops.split_boxoffice(raw_titles(spark, folder).select("id", "boxoffice"))


@query(
    "metadata_etl",
    with_views(
        f"""select id, main_genre, original_title, poster_url,
          cast(cast(runtime as int) % 10 || '.5' as double) as rating, num_votes * 1000 + 500.0::double as num_votes,
          cast(user_review_num || '.2e+03' as double) as user_review_num, cast(critic_review_num as double) as critic_review_num,
          case when id % 3 <> 0 then cast(id % 100 as double) end as metascore,
          strftime({RELEASED}, '%Y-%m-%d') as release_date, {MINUTES} as runtime, country_of_origin_1, {LISTS},
          coalesce(original_language, 'it') as original_language, {PLACE} as filming_location,
          country_of_origin_1 as filming_country, {BOXOFFICE}
        from items where id % 13 <> 0 and num_votes is not null""",
        ITEMS,
    ),
)
def metadata_etl(spark, folder):
    cleaned = title_ops.clean_titles(raw_titles(spark, folder)).drop("actors", "imdb_recommendations")
    return _as_text(cleaned, "release_date")


@query(
    "map_normalize",
    with_views(
        """select id, r as rank, 'tt' || (id + r * 11) as other, '/title/tt' || (id + 11) || '/' as first_other
        from items, (select cast(unnest([1, 2, 3, 4]) as int) as r)""",
        ITEMS,
    ),
)
def map_normalize(spark, folder):
    raw = raw_titles(spark, folder).select("id", "imdb_recommendations")
    wide = title_ops.ranked_columns(raw, "imdb_recommendations", 1).withColumnRenamed("1", "first_other")
    entries = title_ops.ranked_entries(raw, "imdb_recommendations")
    return entries.join(wide, "id").select("id", "rank", text.bare_id(F.col("value")).alias("other"), "first_other")


@query(
    "bare_id",
    "select p_partkey as id, 'tt' || lpad(cast(p_partkey as varchar), 7, '0') as bare from part",
)
def bare_id(spark, folder):
    part = spark.read.parquet(f"{folder}/part.parquet")
    path = F.concat(F.lit("/title/tt"), F.lpad(F.col("p_partkey").cast("string"), 7, "0"), F.lit("/"))
    return part.select(F.col("p_partkey").alias("id"), text.bare_id(path).alias("bare"))


@query(
    "genre_concat",
    with_views(
        """select id, array_to_string(list_sort(list_filter([genre_1, genre_2, genre_3], lambda x: x is not null)), ', ') as sorted,
          concat_ws(', ', genre_1, genre_2, genre_3) as unsorted from items""",
        ITEMS,
    ),
)
def genre_concat(spark, folder):
    genres = [F.col(c) for c in title_ops.GENRE_COLUMNS]
    return items(spark, folder).select(
        "id", arrays.joined_sorted(*genres).alias("sorted"), arrays.joined(*genres).alias("unsorted")
    )


@query(
    "main_genre",
    """select doc_id, split_part(replace(replace(text, chr(10), ''), ', ', ' '), ' ', 1) as first_word from documents""",
)
def main_genre(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return documents.select("doc_id", text.main_genre(F.col("text")).alias("first_word"))


@query(
    "link_id_rank",
    "select p_partkey as id, '/name/nm' || p_partkey || '/' as link, cast(p_size as varchar) as rank from part",
)
def link_id_rank(spark, folder):
    part = spark.read.parquet(f"{folder}/part.parquet")
    href = F.concat(
        F.lit("/name/nm"), F.col("p_partkey").cast("string"), F.lit("/?ref_=tt_cl_t_"), F.col("p_size").cast("string")
    )
    return part.select(
        F.col("p_partkey").alias("id"), text.link_id(href).alias("link"), text.link_rank(href).alias("rank")
    )


@query(
    "rating_text",
    """select l_orderkey, l_linenumber, l_partkey, case when l_quantity < 100 then cast(l_quantity as int) end as rating
    from lineitem where l_returnflag <> 'N'
    union all
    select l_orderkey, l_linenumber, l_partkey, null from lineitem where l_returnflag = 'N'""",
)
def rating_text(spark, folder):
    lineitem = spark.read.parquet(f"{folder}/lineitem.parquet")
    written = F.when(F.col("l_returnflag") == "N", F.date_format("l_shipdate", "d MMMM yyyy")).otherwise(
        F.col("l_quantity").cast("int").cast("string")
    )
    return lineitem.select("l_orderkey", "l_linenumber", "l_partkey", text.stated_rating(written).alias("rating"))


@query(
    "reviews_num",
    """select o_orderkey, case when o_orderpriority = '5-LOW' then 0 else cast(round(o_totalprice) as int) end as n_reviews from orders""",
)
def reviews_num(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    number = F.format_number(F.round("o_totalprice"), 0)
    header = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("No Reviews yet")).otherwise(
        F.concat(F.lit(" "), number, F.lit(" Reviews "))
    )
    return orders.select("o_orderkey", text.review_total(header).alias("n_reviews"))
