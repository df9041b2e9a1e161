"""Catalogue-shaped views over the test tables, as DataFrames and, for the oracles, as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(view: DataFrame) -> DataFrame:
    """A view that is read several times, written once to the shared checkpoint folder."""
    ensure_checkpoint_dir(view.sparkSession)
    return view.checkpoint()


def words(*parts: Column | str) -> Column:
    """Columns and literal texts glued together."""
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _whole(amount: Column) -> Column:
    """Half-up rounding of a positive number; `round` on doubles goes through decimals and is slow."""
    return F.floor(amount + 0.5)


def items(spark: SparkSession, folder: str) -> DataFrame:
    """One row per part, dressed as a title."""
    part, lineitem = table(spark, folder, "part"), table(spark, folder, "lineitem")
    nation = table(spark, folder, "nation")
    sold = (
        lineitem.groupBy("l_partkey")
        .agg(
            F.avg(_whole(F.col("l_discount") * 100).cast("int")).alias("rating"),
            F.count("*").alias("num_votes"),
            F.sum(_whole(F.col("l_extendedprice"))).alias("gross"),
            F.count_if(F.col("l_returnflag") == "R").alias("user_review_num"),
            F.count_if(F.col("l_returnflag") == "A").alias("critic_review_num"),
        )
    )
    key = F.col("p_partkey")
    language = (
        F.when(key % 4 == 0, "en").when(key % 4 == 1, "fr").when(key % 4 == 2, "de")
    )
    released = F.when(
        key % 17 != 0,
        F.make_date((1899 + F.col("p_size") * 2).cast("int"), (1 + key % 12).cast("int"), F.lit(1)),
    )
    currency = F.when(key % 5 != 0, "$").otherwise("EUR ")
    return (
        part.join(sold, key == F.col("l_partkey"), "left")
        .join(nation, F.col("n_nationkey") == key % 25, "left")
        .select(
            key.alias("id"),
            F.col("p_name").alias("original_title"),
            F.col("p_type").alias("main_genre"),
            F.split_part("p_name", F.lit(" "), F.lit(1)).alias("genre_1"),
            F.split_part("p_name", F.lit(" "), F.lit(2)).alias("genre_2"),
            F.when(F.col("p_size") % 2 == 0, F.col("p_type")).alias("genre_3"),
            F.col("p_brand").alias("production_company_1"),
            F.col("n_name").alias("country_of_origin_1"),
            language.alias("original_language"),
            "rating",
            "num_votes",
            "user_review_num",
            "critic_review_num",
            F.col("p_size").cast("double").alias("runtime"),
            released.alias("release_date"),
            F.concat(currency, F.col("gross").cast("string")).alias("boxoffice_gross_worldwide"),
            words("https://img.example.com/", key, ".jpg").alias("poster_url"),
            words("/name/nm", F.col("p_size") % 15).alias("actor_1"),
            words("/name/nm", key % 40).alias("actor_2"),
            F.when(key % 3 == 0, words("/name/nm", key % 7)).alias("actor_3"),
        )
    )


def with_maps(titles: DataFrame) -> DataFrame:
    """The rank-keyed maps of actors and of site recommendations."""
    billed = F.array(
        *[F.struct(F.lit(str(i)).alias("rank"), F.col(f"actor_{i}").alias("name")) for i in (1, 2, 3)]
    )
    linked = F.array(
        *[F.struct(F.lit(str(i)).alias("rank"), (F.col("id") + i * 11).alias("other")) for i in (1, 2, 3, 4)]
    )
    return titles.withColumns(
        {
            "actors": F.map_from_entries(F.filter(billed, lambda e: e["name"].isNotNull())),
            "imdb_recommendations": F.map_from_entries(linked),
        }
    )


ITEMS = """items as (
  select p.p_partkey as id, p.p_name as original_title, p.p_type as main_genre,
    split_part(p.p_name, ' ', 1) as genre_1, split_part(p.p_name, ' ', 2) as genre_2,
    case when p.p_size % 2 = 0 then p.p_type end as genre_3,
    p.p_brand as production_company_1, n.n_name as country_of_origin_1,
    case p.p_partkey % 4 when 0 then 'en' when 1 then 'fr' when 2 then 'de' end as original_language,
    a.rating, a.num_votes, a.user_review_num, a.critic_review_num, cast(p.p_size as double) as runtime,
    case when p.p_partkey % 17 <> 0
         then make_date(cast(1899 + p.p_size * 2 as int), cast(1 + p.p_partkey % 12 as int), 1) end as release_date,
    case when p.p_partkey % 5 <> 0 then '$' else 'EUR ' end || cast(a.gross as varchar) as boxoffice_gross_worldwide,
    'https://img.example.com/' || p.p_partkey || '.jpg' as poster_url,
    '/name/nm' || (p.p_size % 15) as actor_1, '/name/nm' || (p.p_partkey % 40) as actor_2,
    case when p.p_partkey % 3 = 0 then '/name/nm' || (p.p_partkey % 7) end as actor_3
  from part p
  left join (select l_partkey, avg(cast(round(l_discount * 100) as int)) as rating, count(*) as num_votes,
               cast(sum(cast(round(l_extendedprice) as bigint)) as bigint) as gross,
               cast(count(*) filter (where l_returnflag = 'R') as bigint) as user_review_num,
               cast(count(*) filter (where l_returnflag = 'A') as bigint) as critic_review_num
             from lineitem group by l_partkey) a on a.l_partkey = p.p_partkey
  left join nation n on n.n_nationkey = p.p_partkey % 25
)"""


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item, dressed as a raw review; the date is there already."""
    lineitem, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    part = table(spark, folder, "part")
    base = F.col("l_linenumber") * 300
    return (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("p_partkey") == F.col("l_partkey"))
        .select(
            F.col("l_partkey").alias("id"),
            F.col("o_custkey").alias("user_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line"),
            words("/user/ur", F.col("o_custkey"), "/?ref_=x").alias("author"),
            words(F.col("p_name"), "\n").alias("title"),
            words(
                "\n ", base, " out of ", base + F.col("l_orderkey") % 50, " found this helpful.\n"
            ).alias("helpfulness"),
            (F.col("l_quantity").cast("int") % 10 + 1).alias("rating"),
            F.to_date("o_orderdate").alias("review_date"),
        )
    )


def clean_view(raw: DataFrame) -> DataFrame:
    """The review view with the text fields cleaned, for statistics on authors and votes."""
    from ..operators import reviews as cleaning

    return (
        raw.transform(cleaning.split_helpfulness).transform(cleaning.clean_author).transform(cleaning.clean_title)
    )


REVIEWS = """reviews as (
  select l_partkey as id, o_custkey as user_id, l_orderkey as order_id, l_linenumber as line,
    '/user/ur' || o_custkey || '/?ref_=x' as author, '/user/ur' || o_custkey || '/' as author_clean,
    p_name || chr(10) as title, p_name as title_clean,
    chr(10) || ' ' || (l_linenumber * 300) || ' out of ' || (l_linenumber * 300 + l_orderkey % 50)
      || ' found this helpful.' || chr(10) as helpfulness,
    l_linenumber * 300 as upvotes, cast(l_linenumber * 300 + l_orderkey % 50 as int) as total_votes,
    cast(l_quantity as int) % 10 + 1 as rating, cast(o_orderdate as date) as review_date
  from lineitem join orders on l_orderkey = o_orderkey join part on p_partkey = l_partkey
)"""


def raw_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Titles as the nested text records that cleaning starts from."""
    titles = with_maps(items(spark, folder))
    minute = F.col("runtime").cast("int")
    votes = F.when(F.col("id") % 13 != 0, words(F.col("num_votes"), ".5K"))
    key = F.col("id")
    return titles.select(
        "id",
        "main_genre",
        "original_title",
        F.array_compact(F.array("genre_1", "genre_2", "genre_3", "main_genre")).alias("genres"),
        "poster_url",
        F.struct(
            words(F.col("user_review_num"), ".2K").alias("user_review_num"),
            F.col("critic_review_num").cast("string").alias("critic_review_num"),
            F.when(key % 3 == 0, "n/a").otherwise((key % 100).cast("string")).alias("metascore"),
        ).alias("review_summary"),
        F.when(
            votes.isNotNull(),
            F.struct(words(minute % 10, ".5/10").alias("avg_rating"), votes.alias("num_votes")),
        ).alias("agg_rating"),
        "actors",
        F.transform_values("imdb_recommendations", lambda _, v: words("/title/tt", v, "/")).alias(
            "imdb_recommendations"
        ),
        F.struct(
            F.array(
                F.when(key % 3 == 0, F.concat(F.date_format("release_date", "MMMM yyyy"), F.lit(" (Italy)")))
                .when(key % 3 == 1, F.concat(F.date_format("release_date", "MMMM d, yyyy"), F.lit(" (Peru)")))
                .otherwise(F.date_format("release_date", "yyyy")),
                F.lit("1 May 1999"),
            ).alias("release_date"),
            F.when(key % 2 == 0, F.array(F.col("country_of_origin_1")))
            .otherwise(F.array(F.col("country_of_origin_1"), F.lit("Italy"), F.lit("Peru"), F.lit("Chile")))
            .alias("countries_of_origin"),
            F.array(F.col("original_language"), F.lit("it")).alias("language"),
            F.array(words("Il ", F.col("original_title")), F.lit("x")).alias("also_known_as"),
            F.when(key % 7 != 0, F.array(F.col("production_company_1"), F.lit("SAFFI"))).alias(
                "production_companies"
            ),
            F.array(
                words("Old Mill, ", F.col("original_title"), ", ", F.col("country_of_origin_1")), F.lit("y")
            ).alias("filming_locations"),
            words(minute % 3 + 1, " hours ", minute % 60, " minutes").alias("runtime"),
        ).alias("details"),
        F.struct(
            words("$", key * 1000, " (estimated)").alias("budget"),
            F.lit(None).cast("string").alias("boxoffice_gross_domestic"),
            words("$", key).alias("boxoffice_gross_opening"),
            "boxoffice_gross_worldwide",
        ).alias("boxoffice"),
    )


def with_views(body: str, *views: str) -> str:
    """A query over the given views. A body that starts with a comma adds views of its own."""
    glue = "" if body.lstrip().startswith(",") else "\n"
    return "with " + ",\n".join(views) + glue + body
