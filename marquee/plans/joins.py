"""Filters, lookups, joins, merges and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers
from ..operators import guards, interactions as inter, keyed, reviews as review_ops
from .registry import query
from .views import ITEMS, REVIEWS, clean_view, items, reviews, table, with_views


@query(
    "filter_not_null",
    with_views("select id, release_date is not null as released, rating from items where release_date is not null", ITEMS),
)
def filter_not_null(spark, folder):
    dated = items(spark, folder).where(F.col("release_date").isNotNull())
    return dated.select("id", F.col("release_date").isNotNull().alias("released"), "rating")


@query("filter_threshold", with_views("select id, num_votes from items where num_votes > 25", ITEMS))
def filter_threshold(spark, folder):
    return items(spark, folder).where(F.col("num_votes") > 25).select("id", "num_votes")


@query(
    "title_lookup",
    with_views("select id, original_title, rating from items where original_title in ('small ring', 'red widget')", ITEMS),
)
def title_lookup(spark, folder):
    found = keyed.by_title(items(spark, folder), ["small ring", "red widget"])
    return found.select("id", "original_title", "rating")


def _wanted(spark):
    """A request list in the order of the user, with an id that does not exist."""
    return spark.createDataFrame([(1, 150), (2, 3), (3, -1), (4, 42), (5, 7)], "pos int, id bigint")


@query(
    "fetch_ordered",
    with_views(
        """select pos, id, original_title, num_votes from items
        join (values (1, 150), (2, 3), (3, -1), (4, 42), (5, 7)) w(pos, wanted) on wanted = id""",
        ITEMS,
    ),
)
def fetch_ordered(spark, folder):
    found = keyed.fetch_in_order(items(spark, folder), _wanted(spark))
    return found.select("pos", "id", "original_title", "num_votes")


@query(
    "boxoffice_parse",
    with_views(
        """select id, starts_with(boxoffice_gross_worldwide, '$') as in_dollars,
          case when starts_with(boxoffice_gross_worldwide, '$') then cast(substr(boxoffice_gross_worldwide, 2) as bigint) end as gross
        from items""",
        ITEMS,
    ),
)
def boxoffice_parse(spark, folder):
    gross = F.col("boxoffice_gross_worldwide")
    return items(spark, folder).select(
        "id", numbers.in_dollars(gross).alias("in_dollars"), numbers.dollars(gross).alias("gross")
    )


@query(
    "active_users",
    with_views(
        """select r.author_clean as author, r.id, r.rating, r.order_id, r.line from reviews r
        join (select author_clean from reviews group by 1 having count(id) >= 40) a on a.author_clean = r.author_clean""",
        REVIEWS,
    ),
)
def active_users(spark, folder):
    active = inter.active_authors(clean_view(reviews(spark, folder)), least=40)
    return active.select("author", "id", "rating", "order_id", "line")


@query(
    "semi_join",
    with_views("select id, original_title from items where id in (select p from sold)", ITEMS,
               "sold as (select distinct l_partkey as p from lineitem where l_discount >= 0.10)"),
)
def semi_join(spark, folder):
    sold = table(spark, folder, "lineitem").where("l_discount >= 0.10").select(F.col("l_partkey").alias("id"))
    return keyed.only_in(items(spark, folder), sold).select("id", "original_title")


@query(
    "anti_join",
    with_views("select id, original_title from items where id not in (select p from sold)", ITEMS,
               "sold as (select distinct l_partkey as p from lineitem where l_discount >= 0.10 and l_tax >= 0.08)"),
)
def anti_join(spark, folder):
    sold = table(spark, folder, "lineitem").where("l_discount >= 0.10 and l_tax >= 0.08")
    return keyed.not_in(items(spark, folder), sold.select(F.col("l_partkey").alias("id"))).select("id", "original_title")


@query(
    "upsert_last_wins",
    """select o_custkey, o_orderkey, o_orderstatus, o_totalprice from (
      select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as r from orders) where r = 1""",
)
def upsert_last_wins(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice"
    )
    return keyed.last_wins(orders, "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "merge_pages",
    with_views(
        """select id, coalesce(p.original_title, i.genre_1) as label, p.id is null as from_first
        from items i left join (select id, original_title from items where genre_3 is not null) p using (id)""",
        ITEMS,
    ),
)
def merge_pages(spark, folder):
    titles = items(spark, folder)
    first = titles.select("id", F.col("genre_1").alias("label"), F.lit(True).alias("from_first"))
    second = titles.where(F.col("genre_3").isNotNull()).select(
        "id", F.col("original_title").alias("label"), F.lit(False).alias("from_first")
    )
    return keyed.merge_pages([first, second], "id")


@query(
    "hash_partition",
    with_views(
        """select cast(('0x' || substr(md5(cast(r.id as varchar)), 1, 8))::bigint % 10 as int) as part,
          count(*) as n_reviews, count(distinct r.id) as n_titles
        from reviews r join items i on i.id = r.id where i.num_votes > 25 group by 1""",
        ITEMS,
        REVIEWS,
    ),
)
def hash_partition(spark, folder):
    titles = items(spark, folder).where(F.col("num_votes") > 25)
    placed = review_ops.reviews_of_titles(reviews(spark, folder), titles, parts=10)
    return placed.groupBy("part").agg(
        F.count("*").alias("n_reviews"), F.countDistinct("id").alias("n_titles")
    )


@query(
    "work_batch",
    with_views(
        "select id, original_title from items where id not in (select p from done) order by id limit 50",
        ITEMS,
        "done as (select distinct l_partkey as p from lineitem where l_discount >= 0.10 and l_tax >= 0.08)",
    ),
)
def work_batch(spark, folder):
    done = table(spark, folder, "lineitem").where("l_discount >= 0.10 and l_tax >= 0.08")
    batch = keyed.unfinished(items(spark, folder), done.select(F.col("l_partkey").alias("id")), batch=50)
    return batch.select("id", "original_title")


@query(
    "union_all",
    """select c_custkey as key, c_name as name, c_acctbal as balance from customer
    union all select s_suppkey, s_name, s_acctbal from supplier""",
)
def union_all(spark, folder):
    customer, supplier = table(spark, folder, "customer"), table(spark, folder, "supplier")
    buyers = customer.select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    sellers = supplier.select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")
    )
    return buyers.unionByName(sellers)


def _two_lists(spark, folder):
    titles = items(spark, folder)
    requested = titles.select(F.col("genre_1").alias("name")).union(titles.select("main_genre"))
    valid = titles.select(F.col("main_genre").alias("name"))
    return requested, valid


@query(
    "intersect_keys",
    with_views(
        "select genre_1 as name from items intersect select main_genre from items union select main_genre from items",
        ITEMS,
    ),
)
def intersect_keys(spark, folder):
    requested, valid = _two_lists(spark, folder)
    return keyed.valid_names(requested, valid)


@query(
    "except_keys",
    with_views("select genre_1 as name from items except select main_genre from items", ITEMS),
)
def except_keys(spark, folder):
    requested, valid = _two_lists(spark, folder)
    return keyed.unknown_names(requested, valid)


@query(
    "default_column",
    with_views("select id, 0 as reviews_collected_flg from items", ITEMS),
)
def default_column(spark, folder):
    titles = guards.require_columns(items(spark, folder), "id").select("id")
    return guards.with_default(titles, "reviews_collected_flg", 0)
