"""Counts, means, quantiles, distributions and monthly series."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from ..functions import numbers
from ..operators import distributions, features, groups, interactions as inter, keyed, order_statistics, ranking
from ..storage import stored
from .registry import query
from .views import ITEMS, REVIEWS, clean_view, items, reviews, table, with_views


@query(
    "count_by_key",
    with_views(
        """select country_of_origin_1, count(main_genre) as n from items
        where country_of_origin_1 is not null group by country_of_origin_1""",
        ITEMS,
    ),
)
def count_by_key(spark, folder):
    return groups.count_by(items(spark, folder), "country_of_origin_1", "main_genre").orderBy(
        F.col("n").desc(), "country_of_origin_1"
    )


@query(
    "mean_by_key",
    with_views(
        """select main_genre, round(avg(rating), 6) as mean_rating, round(avg(num_votes), 6) as mean_votes
        from items where main_genre is not null group by main_genre""",
        ITEMS,
    ),
)
def mean_by_key(spark, folder):
    means = groups.means_by(items(spark, folder), "main_genre", {"mean_rating": "rating", "mean_votes": "num_votes"})
    return means.select("main_genre", *[F.round(c, 6).alias(c) for c in ("mean_rating", "mean_votes")]).orderBy(
        F.col("mean_rating").desc(), "main_genre"
    )


GENRE_COMBINATIONS = """combos as (
  select array_to_string(list_sort(list_filter([genre_1, genre_2, genre_3], lambda x: x is not null)), ', ') as genres,
    round(avg(rating), 6) as mean_rating, cast(sum(num_votes) as bigint) as total_num_votes,
    count(*) as n_titles, cast(sum(user_review_num) as bigint) as total_user_review_num
  from items where genre_1 is not null group by 1 having sum(num_votes) > 100
)"""


@query(
    "genre_combo",
    with_views(
        """select 'mean_rating' as ranking, * from
          (select * from combos order by mean_rating desc, genres limit 10)
        union all select 'total_num_votes', * from
          (select * from combos order by total_num_votes desc, genres limit 10)
        union all select 'n_titles', * from (select * from combos order by n_titles desc, genres limit 10)""",
        ITEMS,
        GENRE_COMBINATIONS,
    ),
)
def genre_combo(spark, folder):
    combos = groups.genre_combinations(items(spark, folder), votes_above=100)
    combos = combos.withColumn("mean_rating", F.round("mean_rating", 6))
    picks = {by: (by, 10) for by in ("mean_rating", "total_num_votes", "n_titles")}
    return ranking.several_tops(combos, picks, tie="genres").drop("ranked_by")


@query(
    "company_stats",
    with_views(
        """select production_company_1, round(avg(rating), 6) as mean_rating, count(original_title) as n_titles,
          cast(sum(num_votes) as bigint) as total_num_votes
        from items where production_company_1 is not null group by production_company_1
        having count(original_title) > 5 and sum(num_votes) > 200""",
        ITEMS,
    ),
)
def company_stats(spark, folder):
    stats = groups.company_stats(items(spark, folder), titles_above=5, votes_above=200)
    return stats.withColumn("mean_rating", F.round("mean_rating", 6))


@query(
    "quantiles",
    with_views(
        """, marks as (select unnest([0.02, 0.25, 0.5, 0.75, 0.98, 0.99]::double[]) as q)
        select measure, q, round(list_extract(found, i), 6) as value from (
          select 'num_votes' as measure, quantile_cont(cast(num_votes as double), [0.02, 0.25, 0.5, 0.75, 0.98, 0.99]) as found from items
          union all
          select 'price', quantile_cont(o_totalprice, [0.02, 0.25, 0.5, 0.75, 0.98, 0.99]) from orders
        ) cross join (select q, row_number() over (order by q) as i from marks)""",
        ITEMS,
    ),
)
def quantiles(spark, folder):
    marks = [0.02, 0.25, 0.5, 0.75, 0.98, 0.99]
    # Two independent sets of short jobs, side by side.
    find = inheritable_thread_target(spark)(order_statistics.quantiles)
    with ThreadPoolExecutor(2) as pool:
        votes = pool.submit(find, items(spark, folder), "num_votes", marks)
        prices = pool.submit(find, table(spark, folder, "orders"), "o_totalprice", marks)
    votes, prices = votes.result(), prices.result()
    both = votes.withColumn("measure", F.lit("num_votes")).unionByName(
        prices.withColumn("measure", F.lit("price"))
    )
    return both.select("measure", "q", F.round("value", 6).alias("value"))


@query(
    "nearest_quantile",
    with_views(
        """, grosses as (
          select cast(round_even(cast(year(release_date) as double), -1) as int) as decade,
            cast(substr(boxoffice_gross_worldwide, 2) as bigint) as gross
          from items where release_date is not null and starts_with(boxoffice_gross_worldwide, '$')
        ), ranked as (
          select decade, gross, row_number() over (partition by decade order by gross) - 1 as r,
            count(*) over (partition by decade) as n from grosses
        ), marks as (
          select unnest([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]::double[]) as q
        ), places as (
          select decade, q, floor(q * (n - 1)) as low, q * (n - 1) - floor(q * (n - 1)) as part
          from (select distinct decade, n from ranked) cross join marks
        )
        select p.decade, p.q, r.gross as value from places p join ranked r on r.decade = p.decade
          and r.r = p.low + case when p.part > 0.5 or (p.part = 0.5 and p.q > 0.5) then 1 else 0 end""",
        ITEMS,
    ),
)
def nearest_quantile(spark, folder):
    return order_statistics.quantiles(
        features.decade_gross(items(spark, folder)), "gross", [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0], ("decade",), nearest=True
    )


@query(
    "author_activity",
    with_views(
        """select count(*) as n_authors, round(avg(n), 6) as mean_reviews, quantile_cont(cast(n as double), 0.5) as median_reviews,
          max(n) as max_reviews, quantile_cont(cast(n as double), 0.99) as q99,
          count(*) filter (where n < (select quantile_cont(cast(n as double), 0.99) from counts)) as n_below_q99
        from counts""",
        REVIEWS,
        "counts as (select author_clean as author, count(*) as n from reviews group by 1)",
    ),
)
def author_activity(spark, folder):
    counts = clean_view(reviews(spark, folder)).groupBy("author").agg(F.count("*").alias("n"))
    counts = stored(counts)
    median, q99 = order_statistics.column_quantiles(counts, {"n": [0.5, 0.99]})["n"]
    return counts.agg(
        F.count("*").alias("n_authors"),
        F.round(F.avg("n"), 6).alias("mean_reviews"),
        F.lit(median).alias("median_reviews"),
        F.max("n").alias("max_reviews"),
        F.lit(q99).alias("q99"),
        F.count_if(F.col("n") < q99).alias("n_below_q99"),
    )


@query(
    "reviews_per_title",
    with_views("select id, count(author) as n from reviews group by id", REVIEWS),
)
def reviews_per_title(spark, folder):
    return groups.count_by(reviews(spark, folder), "id", "author")


QUARTER_SQL = """select {columns} from items, (select
  quantile_cont(cast(num_votes as double), 0.02) as v_low, quantile_cont(cast(num_votes as double), 0.98) as v_high,
  quantile_cont(runtime, 0.02) as r_low, quantile_cont(runtime, 0.98) as r_high from items) e
  where num_votes between v_low and v_high and runtime between r_low and r_high"""
TRIM = {"num_votes": (0.02, 0.98), "runtime": (0.02, 0.98)}


@query("quantile_trim", with_views(QUARTER_SQL.format(columns="id, num_votes, runtime"), ITEMS))
def quantile_trim(spark, folder):
    titles = stored(items(spark, folder).select("id", "num_votes", "runtime"))
    return distributions.between_quantiles(titles, TRIM)


HISTOGRAM_SQL = """, vals as (select rating as v from items where rating is not null),
lim as (select min(v) as low, max(v) as high, (max(v) - min(v)) / 20 as w, count(*) as total from vals),
cells as (select least(cast(floor((v - low) / w) as int), 19) as bin, count(*) as n from vals, lim group by 1),
bins as (select cast(range as int) as bin from range(20))
select b.bin, round(low + b.bin * w, 6) as "left", coalesce(c.n, 0) as n,
  round(coalesce(c.n, 0) / (total * w), 6) as density
from bins b left join cells c on c.bin = b.bin cross join lim"""


@query("histogram", with_views(HISTOGRAM_SQL, ITEMS))
def histogram(spark, folder):
    bins = distributions.histogram(items(spark, folder), "rating", 20)
    return bins.select("bin", F.round("left", 6).alias("left"), "n", F.round("density", 6).alias("density"))


KDE_SQL = """, vals as (select rating as v from items where rating is not null),
lim as (select min(v) as low, max(v) - min(v) as reach, count(*) as total, stddev_samp(v) * power(count(*), -0.2) as h from vals),
grid as (select cast(range as int) as i, (low - reach / 2) + reach * 2 / 99 * range as x from range(100), lim)
select i, round(x, 6) as x, round(sum(exp(-power((x - v) / h, 2) / 2) / (h * total * sqrt(2 * pi()))), 6) as density
from vals cross join grid cross join lim group by i, x"""


@query("kde", with_views(KDE_SQL, ITEMS))
def kde(spark, folder):
    curve = distributions.density(items(spark, folder), "rating", points=100)
    return curve.select("i", F.round("x", 6).alias("x"), F.round("density", 6).alias("density"))


def _month_text(frame):
    return frame.withColumn("month", F.date_format("month", "yyyy-MM-dd"))


@query(
    "monthly_stats",
    """with months as (select last_day(cast(o_orderdate as date)) as month, round(avg(o_totalprice), 6) as mean_price,
        count(*) as n_orders from orders group by 1),
      calendar as (select last_day(cast(unnest(generate_series(
        (select date_trunc('month', min(month)) from months), (select max(month) from months), interval 1 month)) as date)) as month)
      select strftime(c.month, '%Y-%m-%d') as month, mean_price, coalesce(n_orders, 0) as n_orders
      from calendar c left join months m on m.month = c.month""",
)
def monthly_stats(spark, folder):
    series = distributions.monthly(
        table(spark, folder, "orders"),
        "o_orderdate",
        {"mean_price": F.round(F.avg("o_totalprice"), 6), "n_orders": F.count("*")},
        counts=("n_orders",),
    )
    return _month_text(series)


@query(
    "gap_fill",
    with_views(
        """select strftime(c.month, '%Y-%m-%d') as month, mean_rating, coalesce(n_titles, 0) as n_titles
        from calendar c left join months m on m.month = c.month""",
        ITEMS,
        """months as (select last_day(release_date) as month, round(avg(rating), 6) as mean_rating,
            count(original_title) as n_titles from items where num_votes > 25 and release_date is not null group by 1)""",
        """calendar as (select last_day(cast(unnest(generate_series((select date_trunc('month', min(month)) from months),
            (select max(month) from months), interval 1 month)) as date)) as month)""",
    ),
)
def gap_fill(spark, folder):
    series = distributions.monthly(
        items(spark, folder).where(F.col("num_votes") > 25),
        "release_date",
        {"mean_rating": F.round(F.avg("rating"), 6), "n_titles": F.count("original_title")},
        counts=("n_titles",),
    )
    return _month_text(series)


@query(
    "like_ratio",
    with_views(
        """select strftime(last_day(review_date), '%Y-%m-%d') as month,
          round(avg(case when total_votes <> 0 then upvotes / cast(total_votes as double) end), 6) as mean_ratio
        from reviews group by 1""",
        REVIEWS,
    ),
)
def like_ratio(spark, folder):
    rated = clean_view(reviews(spark, folder)).withColumn(
        "like_ratio", numbers.ratio(F.col("upvotes"), F.col("total_votes"))
    )
    series = distributions.monthly(rated, "review_date", {"mean_ratio": F.round(F.avg("like_ratio"), 6)})
    return _month_text(series)


@query(
    "text_length",
    """with lengths as (select doc_id, length(text) as n_characters from documents)
      select doc_id, cast(n_characters as int) as n_characters from lengths
      where n_characters < (select quantile_cont(cast(n_characters as double), 0.98) from lengths)""",
)
def text_length(spark, folder):
    lengths = table(spark, folder, "documents").select("doc_id", F.length("text").alias("n_characters"))
    return distributions.below_quantile(lengths, "n_characters", 0.98)


@query("distinct_count", with_views("select count(distinct id) as n_distinct from reviews", REVIEWS))
def distinct_count(spark, folder):
    return groups.distinct_count(reviews(spark, folder), "id")


@query(
    "interactions",
    with_views("select distinct author_clean as author, id, rating from reviews", REVIEWS),
)
def interactions(spark, folder):
    return inter.interactions(clean_view(reviews(spark, folder)))


@query(
    "pivot_bounded",
    with_views(
        """select user_id, max(case when main_genre = 'ECONOMY' then rating end) as economy,
          max(case when main_genre = 'PROMO' then rating end) as promo,
          max(case when main_genre = 'SMALL' then rating end) as small
        from reviews join (select p_partkey, p_type as main_genre from part) on p_partkey = id group by user_id""",
        REVIEWS,
    ),
)
def pivot_bounded(spark, folder):
    kinds = table(spark, folder, "part").select(F.col("p_partkey").alias("id"), F.lower("p_type").alias("kind"))
    rated = reviews(spark, folder).join(kinds, "id")
    return groups.pivot_bounded(rated, "user_id", "kind", ["economy", "promo", "small"], "rating")


@query(
    "sparsity",
    with_views(
        """select count(*) as cells, count(distinct author) as authors, count(distinct id) as titles,
          round(100 * (1 - count(*) / (count(distinct author) * count(distinct id))), 6) as sparsity
        from (select distinct author_clean as author, id from reviews)""",
        REVIEWS,
    ),
)
def sparsity(spark, folder):
    found = inter.sparsity(clean_view(reviews(spark, folder)))
    return found.withColumn("sparsity", F.round("sparsity", 6))


@query(
    "progress",
    with_views(
        """select count(*) as total, count(release_date) as done, count(*) - count(release_date) as open,
          count(*) = count(release_date) as complete from items""",
        ITEMS,
    ),
)
def progress(spark, folder):
    return keyed.progress(items(spark, folder), F.col("release_date").isNotNull())


@query(
    "collect_set",
    with_views(
        """select distinct id % 7 as part, main_genre as member from items where main_genre is not null""", ITEMS
    ),
)
def collect_set(spark, folder):
    grouped = items(spark, folder).select((F.col("id") % 7).alias("part"), F.col("main_genre").alias("member"))
    return groups.members(grouped, "part", "member")


@query(
    "rolling_mean",
    with_views(
        """select runtime, n_titles, round(avg(mean_rating) over (order by runtime rows between 4 preceding and current row), 6)
          as rolling_mean from (select runtime, count(rating) as n_titles, avg(rating) as mean_rating from trimmed group by runtime)""",
        ITEMS,
        f"trimmed as ({QUARTER_SQL.format(columns='items.*')})",
    ),
)
def rolling_mean(spark, folder):
    titles = stored(items(spark, folder).select("num_votes", "runtime", "rating"))
    kept = distributions.between_quantiles(titles, TRIM)
    steps = kept.groupBy("runtime").agg(F.count("rating").alias("n_titles"), F.avg("rating").alias("mean_rating"))
    rolled = distributions.rolling_mean(steps, "runtime", "mean_rating", 5)
    return rolled.select("runtime", "n_titles", F.round("rolling_mean", 6).alias("rolling_mean"))
