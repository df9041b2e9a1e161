"""Top rows, shares of groups, samples, train and test rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import interactions as inter, ranking
from .registry import query
from .views import ITEMS, REVIEWS, clean_view, items, reviews, with_views


@query(
    "topk",
    with_views(
        """select 'votes' as ranking, id, cast(num_votes as double) as value from (select * from items order by num_votes desc nulls last, id limit 10)
        union all select 'user_reviews', id, cast(user_review_num as double) from (select * from items order by user_review_num desc nulls last, id limit 1000)
        union all select 'rating', id, rating from (select * from items where num_votes > 25 order by rating desc nulls last, id limit 10)
        union all select 'runtime', id, runtime from (select * from items where num_votes > 25 order by runtime desc nulls last, id limit 10)""",
        ITEMS,
    ),
)
def topk(spark, folder):
    titles = items(spark, folder).select("id", "num_votes", "user_review_num", "rating", "runtime")
    voted = F.col("num_votes") > 25
    picks = {
        "votes": ("num_votes", 10),
        "user_reviews": ("user_review_num", 1000),
        "rating": (F.when(voted, F.col("rating")), 10),
        "runtime": (F.when(voted, F.col("runtime")), 10),
    }
    found = ranking.several_tops(titles, picks, among={"rating": voted, "runtime": voted})
    return found.select("ranking", "id", F.col("ranked_by").alias("value"))


@query(
    "topn_per_group",
    with_views(
        """select main_genre, id, rating, cast(rank as int) as rank from (select *, row_number() over (
          partition by main_genre order by rating desc nulls last, id) as rank from items) where rank <= 5""",
        ITEMS,
    ),
)
def topn_per_group(spark, folder):
    order = [F.col("rating").desc_nulls_last(), F.col("id")]
    best = ranking.top_per_group(items(spark, folder), ["main_genre"], 5, order)
    return best.select("main_genre", "id", "rating", "rank")


@query(
    "stratified_topn",
    with_views(
        """select main_genre, id, num_votes from (select *, count(*) over (partition by main_genre) as n, row_number() over (
          partition by main_genre order by num_votes desc, id) as r from items where num_votes is not null)
        where r <= floor(10.0 * n / 100)""",
        ITEMS,
    ),
)
def stratified_topn(spark, folder):
    rated = items(spark, folder).where(F.col("num_votes").isNotNull()).select("main_genre", "id", "num_votes")
    return ranking.first_share(rated, ["main_genre"], "num_votes", "id", ranking.percent_or_count(percent=10))


@query(
    "review_cap",
    with_views(
        """select id, row_key, upvotes from (select *, count(*) over (partition by id) as n, row_number() over (
          partition by id order by upvotes desc, row_key) as r
          from (select id, order_id * 8 + line as row_key, upvotes, review_date from reviews))
        where r <= floor(30.0 * n / 100)""",
        REVIEWS,
    ),
)
def review_cap(spark, folder):
    cleaned = clean_view(reviews(spark, folder))
    keyed = cleaned.select("id", (F.col("order_id") * 8 + F.col("line")).alias("row_key"), "upvotes")
    return ranking.first_share(keyed, ["id"], "upvotes", "row_key", ranking.percent_or_count(percent=30))


@query(
    "holdout_split",
    with_views(
        """, cells as (select distinct author_clean as author, id from reviews where rating is not null)
        select author, id from (select *, count(*) over (partition by author) as n, row_number() over (
          partition by author order by ('0x' || substr(md5(author || '|' || id || '|7'), 1, 15))::bigint, id) as r from cells)
        where r <= floor(0.2::double * n)""",
        REVIEWS,
    ),
)
def holdout_split(spark, folder):
    return inter.holdout(clean_view(reviews(spark, folder)), share=0.2, seed=7)


@query(
    "sample_ids",
    with_views(
        "select id, original_title from items order by ('0x' || substr(md5(id || '|3'), 1, 15))::bigint, id limit 100",
        ITEMS,
    ),
)
def sample_ids(spark, folder):
    return ranking.sample_rows(items(spark, folder), 100, seed=3).select("id", "original_title")
