"""Reading: keyed JSON in both layouts, projected columns."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F, types as T

from ..functions import text
from ..sources import keyed_json, review_files
from ..storage import shared_folder, stored
from ..streaming import loads
from .registry import query
from .views import ITEMS, REVIEWS, items, reviews, table, with_views, words

RECORD = T.StructType(
    [
        T.StructField("main_genre", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("genres", T.ArrayType(T.StringType())),
    ]
)


def _path(key):
    return F.concat(F.lit("/title/tt"), key.cast("string"), F.lit("/"))


@query(
    "read_keyed_json",
    with_views("select '/title/tt' || id || '/' as id, main_genre, rating, genre_1, genre_2 from items", ITEMS),
)
def read_keyed_json(spark, folder):
    rows = items(spark, folder).select(
        _path(F.col("id")).alias("id"), "main_genre", "rating", F.array("genre_1", "genre_2").alias("genres")
    )
    parsed = keyed_json.parse_keyed(keyed_json.as_keyed(rows), F.col("value"), RECORD)
    genre = [F.get("genres", F.lit(i)).alias(f"genre_{i + 1}") for i in (0, 1)]
    return parsed.select("id", "main_genre", "rating", *genre)


@query(
    "read_column_json",
    with_views("select '/title/tt' || id || '/' as id, main_genre, poster_url from items", ITEMS),
)
def read_column_json(spark, folder):
    rows = items(spark, folder).select(_path(F.col("id")).alias("id"), "main_genre", "poster_url")
    documents = keyed_json.as_by_column(rows)
    return keyed_json.parse_by_column(documents, F.col("value"), ["main_genre", "poster_url"])


FILES = 16


def _files(spark, rows, before: str, after: str):
    """Rows (id, text) as JSON files, each one object of many entries in loose spacing; the folder they are in."""
    folder = f"{shared_folder(spark)}/json-{uuid.uuid4().hex}"
    listed = rows.groupBy((F.col("id") % FILES).alias("file")).agg(F.array_sort(F.collect_list(F.struct("id", "text"))).alias("all"))
    text = F.concat(F.lit(before), F.array_join(F.transform("all", lambda e: e["text"]), " ,\n"), F.lit(after))
    listed.select(text.alias("value")).write.text(folder)
    return folder


@query(
    "read_keyed_file",
    with_views("select '/title/tt' || id || '/' as id, main_genre, rating, genre_1, genre_2 from items", ITEMS),
)
def read_keyed_file(spark, folder):
    record = F.to_json(F.struct("main_genre", "rating", F.array("genre_1", "genre_2").alias("genres")))
    rows = items(spark, folder).select("id", words('"', _path(F.col("id")), '" :\n ', record).alias("text"))
    parsed = keyed_json.read_keyed(spark, _files(spark, rows, "{ ", "\n}"), RECORD)
    genre = [F.get("genres", F.lit(i)).alias(f"genre_{i + 1}") for i in (0, 1)]
    return parsed.select("id", "main_genre", "rating", *genre)


@query(
    "read_column_file",
    with_views("select '/title/tt' || id || '/' as id, main_genre, poster_url from items where id % 3 <> 1", ITEMS),
)
def read_column_file(spark, folder):
    """One file holds one column of some titles; the others hold the same fields for other titles."""
    rows = items(spark, folder).where("id % 3 <> 1")
    fields = [
        rows.select("id", words('"', _path(F.col("id")), '": ', F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2)).alias("text"))
        for c in ("main_genre", "poster_url")
    ]
    paths = [_files(spark, f, f'{{"other":{{}}, "{c}" : {{ ', '}}') for f, c in zip(fields, ("main_genre", "poster_url"))]
    return keyed_json.read_by_column(spark, paths, ["main_genre", "poster_url"])


@query("read_projected", "select o_orderkey, o_totalprice from orders")
def read_projected(spark, folder):
    return review_files.read_columns(spark, [f"{folder}/orders.parquet"], ["o_orderkey", "o_totalprice"])


@query(
    "write_keyed_json",
    with_views("select '/title/tt' || id || '/' as id, main_genre, rating, genre_1, genre_2 from items", ITEMS),
)
def write_keyed_json(spark, folder):
    rows = items(spark, folder).select(
        _path(F.col("id")).alias("id"), "main_genre", "rating", F.array("genre_1", "genre_2").alias("genres")
    )
    target = f"{shared_folder(spark)}/keyed-{uuid.uuid4().hex}"
    keyed_json.write_keyed(rows, target)
    back = keyed_json.read_keyed_lines(spark, target, RECORD)
    genre = [F.get("genres", F.lit(i)).alias(f"genre_{i + 1}") for i in (0, 1)]
    return back.select("id", "main_genre", "rating", *genre)


STORES = 40  # raw reviews are kept in as many folders


def _raw_reviews(spark, folder):
    """Reviews as they are stored raw, in the folders of a few 'titles' each."""
    rows = reviews(spark, folder)
    written = F.date_format("review_date", "d MMMM yyyy")
    said = words(F.col("title"), 'said "', F.col("order_id"), '",\n', F.col("line"))
    return rows.select(
        words("/title/tt", F.col("id") % STORES, "/").alias("id"),
        said.alias("text"),
        F.col("rating").cast("string").alias("rating"),
        written.alias("date"),
        "title",
        "author",
        "helpfulness",
    )


RAW_SQL = """raw as (select '/title/tt' || (id % 40) || '/' as id, title || 'said "' || order_id || '",' || chr(10) || line as text,
  rating, review_date, title, title_clean, author, author_clean, helpfulness, upvotes, total_votes from reviews)"""


def _written_raw(spark, folder) -> str:
    target = f"{shared_folder(spark)}/raw-{uuid.uuid4().hex}"
    # A slash cannot stand in the name of a folder.
    review_files.write_raw_reviews(_raw_reviews(spark, folder).withColumn("id", text.bare_id(F.col("id"))), target)
    return target


@query(
    "review_files",
    with_views(
        """select replace(replace(id, '/title/', ''), '/', '') as id, text, cast(rating as varchar) as rating, strftime(review_date, '%-d %B %Y') as date, title, author, helpfulness from raw""",
        REVIEWS,
        RAW_SQL,
    ),
)
def review_csv_files(spark, folder):
    """Raw reviews written as CSV, a folder per title, and read back."""
    return review_files.read_raw_reviews(spark, _written_raw(spark, folder))


JOB_SQL = """select replace(replace(id, '/title/', ''), '/', '') as id, text, cast(rating as double) as rating, title_clean as title, author_clean as author, upvotes, total_votes,
  strftime(review_date, '%Y-%m-%d') as review_date from raw"""


def _job(spark, folder, form: str):
    raw = _written_raw(spark, folder)
    target = f"{shared_folder(spark)}/parts-{uuid.uuid4().hex}"
    titles = stored(_raw_reviews(spark, folder).select(text.bare_id(F.col("id")).alias("id")).distinct())
    # First some of the titles, then all of them: what is finished stays, the rest is added.
    some = titles.where(F.length("id") == 3)
    for known in (some, titles):
        review_files.run_reviews_job(spark, raw, known, target, parts=8, form=form)
    rows = review_files.read_parts(spark, target).drop("part")
    return rows.withColumn("review_date", F.date_format("review_date", "yyyy-MM-dd"))


@query("reviews_job_parquet", with_views(JOB_SQL, REVIEWS, RAW_SQL))
def reviews_job_parquet(spark, folder):
    return _job(spark, folder, "parquet")


@query("reviews_job_csv", with_views(JOB_SQL, REVIEWS, RAW_SQL))
def reviews_job_csv(spark, folder):
    return _job(spark, folder, "csv")


@query("export_casted", "select o_orderkey, cast(o_orderkey % 100 as smallint) as flag, cast(o_totalprice as float) as price from orders")
def export_casted(spark, folder):
    target = f"{shared_folder(spark)}/export-{uuid.uuid4().hex}"
    rows = table(spark, folder, "orders").select("o_orderkey", (F.col("o_orderkey") % 100).alias("flag"), F.col("o_totalprice").alias("price"))
    review_files.export_table(rows, target, {"flag": "smallint", "price": "float"})
    return spark.read.parquet(target)


@query("refresh_reviews", with_views(JOB_SQL, REVIEWS, RAW_SQL))
def refresh_reviews(spark, folder):
    """Raw review files brought into partitions in steps, by what is new or was changed since."""
    raw = _written_raw(spark, folder)
    target = f"{shared_folder(spark)}/refreshed-{uuid.uuid4().hex}"
    loads.refresh_reviews(spark, raw, target, parts=8, files_per_step=STORES * 8)
    rows = review_files.read_parts(spark, target).drop("part", "file")
    return rows.withColumn("review_date", F.date_format("review_date", "yyyy-MM-dd"))
