"""Recommendations and nearest neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as feat, interactions as inter, recommend as rec, similarity as sim
from .features import LABEL_VIEWS, SETTINGS, WEIGHTED, catalogue, rows_sql, title_labels
from .registry import query
from .views import ITEMS, REVIEWS, items, reviews, table, with_maps, with_views

LIKED = [(0, 150), (1, 3), (2, -1), (3, 42), (4, 7)]
LIKED_SQL = "liked as (select * from (values (0, 150), (1, 3), (2, -1), (3, 42), (4, 7)) l(pos, id))"


def _liked(spark):
    """A liked list as a user would send it; one title does not exist."""
    return spark.createDataFrame(LIKED, "pos int, id bigint")


# Views on `features`: the dot product of two titles is the weight of the features they share.
NORMS = "norms as (select id, sum(weight) as w from features group by id)"
LIKED_SIMS = """sims as (select l.pos, l.id as liked_id, c.id, sum(case when b.id is not null then a.weight else 0 end) / sqrt(nl.w * nc.w) as sim
  from liked l join features a on a.id = l.id join norms nl on nl.id = l.id
  cross join (select id from norms where id not in (select id from liked)) c join norms nc on nc.id = c.id
  left join features b on b.id = c.id and b.family = a.family and b.feature = a.feature
  group by l.pos, l.id, c.id, nl.w, nc.w)"""
BEST_SIMS = """best as (select * from (select *, row_number() over (partition by liked_id order by sim desc, id) as r from sims) where r <= 10)"""
KNN = """recs as (select id, arg_max(sim, pos) as relevance from best group by id order by relevance desc, id limit 10)"""
KNN_VIEWS = [*LABEL_VIEWS, rows_sql(SETTINGS), LIKED_SQL, NORMS, LIKED_SIMS, BEST_SIMS, KNN]
WEIGHTED_VIEWS = [*LABEL_VIEWS, rows_sql(WEIGHTED), LIKED_SQL, NORMS, LIKED_SIMS, BEST_SIMS, KNN]


@query(
    "popular_recs",
    with_views(
        "select id, rating as relevance from items where num_votes > 25 and rating is not null order by rating desc, id limit 10",
        ITEMS,
    ),
)
def popular_recs(spark, folder):
    return rec.MostPopular(top_n=10, votes_above=25).recommend(items(spark, folder))


@query(
    "site_recs",
    with_views(
        """select id, rating as relevance from items where id in (select id + k * 11 from liked, (select unnest([1, 2, 3, 4]) as k)
          where id in (select id from items)) and rating is not null order by rating desc, id limit 10""",
        ITEMS,
        LIKED_SQL,
    ),
)
def site_recs(spark, folder):
    return rec.LinkedBySite(top_n=10).recommend(with_maps(items(spark, folder)), _liked(spark))


@query("knn_recs", with_views("select id, round(relevance, 6) as relevance from recs", *KNN_VIEWS))
def knn_recs(spark, folder):
    found = rec.SimilarTitles(top_n=10).recommend(catalogue(spark, folder), _liked(spark))
    return found.withColumn("relevance", F.round("relevance", 6))


@query("knn_weighted", with_views("select id, round(relevance, 6) as relevance from recs", *WEIGHTED_VIEWS))
def knn_weighted(spark, folder):
    model = rec.SimilarTitles(top_n=10, features=feat.CatalogueFeatures(WEIGHTED))
    found = model.recommend(catalogue(spark, folder), _liked(spark))
    return found.withColumn("relevance", F.round("relevance", 6))


@query(
    "format_recs",
    with_views(
        """select i.id, original_title, concat_ws(', ', genre_1, genre_2, genre_3) as genre,
          strftime(release_date, '%B %Y') as release_date, country_of_origin_1, production_company_1,
          round_even(rating, 1) as rating, poster_url, round(relevance, 6) as relevance
        from recs join items i on i.id = recs.id""",
        *KNN_VIEWS,
    ),
)
def format_recs(spark, folder):
    titles = catalogue(spark, folder)
    shown = rec.recommend(rec.SimilarTitles(top_n=10), titles, _liked(spark))
    return shown.withColumn("relevance", F.round("relevance", 6))


@query(
    "similar_to_one",
    with_views(
        """select id, round(sim, 6) as sim, cast(row_number() over (order by sims.sim desc, id) as int) as rank from sims
        qualify rank <= 30""",
        *LABEL_VIEWS,
        rows_sql(SETTINGS),
        "liked as (select 0 as pos, 42 as id)",
        NORMS,
        LIKED_SIMS,
    ),
)
def similar_to_one(spark, folder):
    found = rec.similar_to_one(title_labels(spark, folder), 42, 30, SETTINGS)
    return found.withColumn("sim", F.round("sim", 6))


# All pairs of titles, family by family.
SAME = " + ".join(f"case when a.\"{f}\" = b.\"{f}\" then 1 else 0 end" for f in feat.FAMILIES)
SIZE = " + ".join(f"case when \"{f}\" is not null then 1 else 0 end" for f in feat.FAMILIES)
PAIRS = f"""sized as (select *, {SIZE} as w from labels),
pairs as (select a.id, b.id as other, ({SAME}) / sqrt(a.w * b.w) as sim from sized a join sized b on a.id <> b.id)"""


@query(
    "knn_all_pairs",
    with_views(
        """select id, other, round(sim, 6) as sim, cast(r as int) as rank
        from (select *, row_number() over (partition by id order by sim desc, other) as r from pairs) where r <= 5""",
        *LABEL_VIEWS,
        PAIRS,
    ),
)
def knn_all_pairs(spark, folder):
    return sim.neighbours(title_labels(spark, folder), 5, SETTINGS).withColumn("sim", F.round("sim", 6))


@query(
    "embedding_knn",
    """select vec_id, other, round(sim, 6) as sim, cast(r as int) as rank from (
      select *, row_number() over (partition by vec_id order by sim desc, other) as r from (
        select a.vec_id, b.vec_id as other, list_cosine_similarity(cast(a.embedding as double[]), cast(b.embedding as double[])) as sim
        from embeddings a join embeddings b on a.vec_id <> b.vec_id)) where r <= 5""",
)
def embedding_knn(spark, folder):
    found = sim.vector_neighbours(table(spark, folder, "embeddings"), 5, "vec_id", "embedding")
    return found.withColumn("sim", F.round("sim", 6))


LIKES = """likes as (select user_id, id, row_number() over (partition by user_id order by last_seen, id) as pos
  from (select user_id, id, max(review_date) as last_seen from reviews where rating >= 10 group by user_id, id))"""


@query(
    "knn_batch_users",
    with_views(
        """, cands as (select l.user_id, l.pos, p.other as id, p.sim, row_number() over (partition by l.user_id, l.id order by p.sim desc, p.other) as r
          from likes l join pairs p on p.id = l.id
          where not exists (select 1 from likes x where x.user_id = l.user_id and x.id = p.other)),
        once as (select user_id, id, arg_max(sim, pos) as relevance from cands where r <= 5 group by user_id, id)
        select user_id, id, round(relevance, 6) as relevance, cast(r as int) as rank from (
          select *, row_number() over (partition by user_id order by relevance desc, id) as r from once) where r <= 5""",
        *LABEL_VIEWS,
        PAIRS,
        REVIEWS,
        LIKES,
    ),
)
def knn_batch_users(spark, folder):
    likes = inter.likes(reviews(spark, folder), least=10)
    found = rec.recommend_for_users(likes, title_labels(spark, folder), 5, SETTINGS)
    return found.withColumn("relevance", F.round("relevance", 6))
