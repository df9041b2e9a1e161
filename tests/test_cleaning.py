"""Golden values and edge rows of the cleaning steps."""

import datetime as dt

import pytest
from pyspark.sql import Row, functions as F

from marquee.functions import arrays, dates, markup, numbers, text
from marquee.operators import guards, keyed, reviews, titles


def one(spark, value, kind, expression):
    frame = spark.createDataFrame([(value,)], f"x {kind}")
    return frame.select(expression(F.col("x")).alias("y")).first()["y"]


RAW = dict(
    id="/title/tt1/",
    main_genre="Mystery",
    original_title="The Lamp Room",
    genres=["Mystery", "Romance", "Western"],
    poster_url="p",
    review_summary=Row(user_review_num="3.4K", critic_review_num="58", metascore="41"),
    agg_rating=Row(avg_rating="6.3/10", num_votes="7.5K"),
    actors={"1": "/name/nm5000011", "2": "/name/nm5000022", "3": "/name/nm5000033"},
    imdb_recommendations={"1": "/title/tt7000001/", "2": "/title/tt7000002/"},
    details=Row(
        release_date=["March 1954 (Norway)"],
        countries_of_origin=["Norway"],
        language=["Norwegian", "English"],
        also_known_as=["Lamperommet"],
        production_companies=["Fjord Pictures", "Nine Piers"],
        filming_locations=["Pier 9, Bergen, Norway"],
        runtime="2 hours 5 minutes",
    ),
    boxoffice=Row(
        budget="$2,450,000 (estimated)",
        boxoffice_gross_domestic="$8,120,400",
        boxoffice_gross_opening="$610,025",
        boxoffice_gross_worldwide="$19,300,750",
    ),
)


@pytest.fixture(scope="module")
def raw_titles(spark):
    schema = titles.T.StructType([titles.T.StructField("id", titles.T.StringType()), *titles.RAW_TITLE.fields])
    names = schema.fieldNames()
    bare = dict(
        RAW,
        id="/title/tt2/",
        genres=[],
        review_summary=Row(user_review_num=None, critic_review_num="n/a", metascore=None),
        agg_rating=Row(avg_rating="5.9/10", num_votes="1.3M"),
        details=Row(
            release_date=None,
            countries_of_origin=["A", "B", "C", "D"],
            language=[None, "English"],
            also_known_as=[],
            production_companies=["A", "B", "C", "D"],
            filming_locations=["  "],
            runtime=None,
        ),
        boxoffice=None,
    )
    unrated = dict(RAW, id="/title/tt3/", agg_rating=None)
    rows = [tuple(r[n] for n in names) for r in (RAW, bare, unrated)]
    return spark.createDataFrame(rows, schema)


def test_clean_titles_golden(raw_titles):
    rows = {r["id"]: r for r in titles.clean_titles(raw_titles).collect()}
    assert set(rows) == {"/title/tt1/", "/title/tt2/"}
    full = rows["/title/tt1/"]
    assert (full["rating"], full["num_votes"]) == (6.3, 7500.0)
    assert (full["user_review_num"], full["critic_review_num"], full["metascore"]) == (3400.0, 58.0, 41.0)
    assert full["release_date"] == dt.date(1954, 3, 1)
    assert full["runtime"] == 125.0
    assert [full[c] for c in titles.COUNTRY_COLUMNS] == ["Norway", None, None]
    assert full["original_language"] == "Norwegian"
    assert full["also_known_as"] == "Lamperommet"
    assert [full[c] for c in titles.COMPANY_COLUMNS] == ["Fjord Pictures", "Nine Piers", None]
    assert full["filming_location"] == "Pier 9, Bergen, Norway"
    assert full["filming_country"] == "Norway"
    assert [full[c] for c in titles.GENRE_COLUMNS] == ["Mystery", "Romance", "Western"]
    assert full["budget"] == "$2,450,000 (estimated)"
    assert full["boxoffice_gross_worldwide"] == "$19,300,750"
    for gone in ("agg_rating", "review_summary", "details", "boxoffice", "genres", "language"):
        assert gone not in full


def test_clean_titles_edges(raw_titles):
    bare = {r["id"]: r for r in titles.clean_titles(raw_titles).collect()}["/title/tt2/"]
    assert bare["num_votes"] == 1_300_000.0
    assert bare["critic_review_num"] is None and bare["release_date"] is None and bare["runtime"] is None
    assert [bare[c] for c in titles.COUNTRY_COLUMNS] == ["A", "B", "C"]
    assert [bare[c] for c in titles.COMPANY_COLUMNS] == ["A", "B", "C"]
    assert bare["original_language"] == "English"
    assert bare["also_known_as"] is None and bare["filming_country"] is None
    assert bare["genre_1"] is None and bare["budget"] is None


def test_ranked_maps(raw_titles):
    wide = titles.ranked_columns(raw_titles, "actors", 3).first()
    assert (wide["1"], wide["3"]) == ("/name/nm5000011", "/name/nm5000033")
    entries = titles.ranked_entries(raw_titles, "imdb_recommendations").where("id = '/title/tt1/'").collect()
    assert {(r["rank"], r["value"]) for r in entries} == {(1, "/title/tt7000001/"), (2, "/title/tt7000002/")}


def test_clean_reviews(spark):
    rows = [
        ("/title/tt1/", "t", "8", "14 August 2016", "a\n\n", "/user/ur1/?ref_=x", "\n 12 out of 40 found this helpful.\n"),
        ("/title/tt1/", "t", None, "\n  7 June 1998\n ", "\nb", None, "\n 1,200 out of 4,000 found this helpful.\n"),
        ("/title/tt2/", "t", "9", "x", None, "/user/ur2/", "nobody yet"),
        ("/title/tt2/", "t", "9", "1 May 2001", "c", "/user/ur2/", "40,000 out of 50,000"),
    ]
    raw = spark.createDataFrame(rows, reviews.RAW_REVIEW).withColumn("Unnamed: 0", F.lit(1))
    cleaned = reviews.clean_reviews(raw)
    assert set(cleaned.columns) == {
        "id", "text", "rating", "title", "author", "upvotes", "total_votes", "review_date",
    }
    a, b, c, d = cleaned.collect()
    assert (a["upvotes"], a["total_votes"], a["title"], a["author"]) == (12, 40, "a", "/user/ur1/")
    assert a["review_date"] == dt.date(2016, 8, 14) and a["rating"] == 8.0
    assert (b["upvotes"], b["total_votes"], b["title"], b["author"]) == (1200, 4000, "\nb", None)
    assert b["review_date"] == dt.date(1998, 6, 7) and b["rating"] is None
    assert (c["upvotes"], c["total_votes"], c["title"], c["review_date"]) == (None, None, None, None)
    assert (d["upvotes"], d["total_votes"]) == (40_000, 50_000)


@pytest.mark.parametrize(
    "value, expected",
    [("July 1911 (United States)", dt.date(1911, 7, 1)), ("November 12, 2021", dt.date(2021, 11, 12)),
     ("12 November 2021 (Peru)", dt.date(2021, 11, 12)), ("1972", dt.date(1972, 1, 1)), ("soon", None), (None, None)],
)
def test_release_date(spark, value, expected):
    assert one(spark, value, "string", dates.release_date) == expected


@pytest.mark.parametrize(
    "value, expected", [("1 hour 11 minutes", 71.0), ("2 hours", 120.0), ("45 minutes", 45.0), ("long", None), (None, None)]
)
def test_runtime(spark, value, expected):
    assert one(spark, value, "string", dates.runtime_minutes) == expected


@pytest.mark.parametrize("year, decade", [(1984, 1980), (1985, 1980), (1986, 1990), (1995, 2000), (2004, 2000)])
def test_nearest_decade_rounds_half_to_even(spark, year, decade):
    assert one(spark, dt.date(year, 6, 1), "date", dates.nearest_decade) == decade


@pytest.mark.parametrize(
    "value, expected", [("2.9K", 2900.0), ("2.6M", 2_600_000.0), ("1B", 1e9), ("76", 76.0), ("n/a", None), (None, None)]
)
def test_short_form(spark, value, expected):
    assert one(spark, value, "string", numbers.short_form) == expected


@pytest.mark.parametrize("value, expected", [("$1,006,102,277", 1006102277), ("£1,000", None), ("$1.5", None), (None, None)])
def test_dollars(spark, value, expected):
    assert one(spark, value, "string", numbers.dollars) == expected


@pytest.mark.parametrize(
    "function, value, expected",
    [
        (text.main_genre, "\nAction, Drama            ", "Action"),
        (text.main_genre, "\nDrama  ", "Drama"),
        (text.link_id, "/name/nm1/?ref_=tt_cl_t_3", "/name/nm1/"),
        (text.link_rank, "/name/nm1/?ref_=tt_cl_t_3", "3"),
        (text.link_rank, "/name/nm1/", None),
        (text.bare_id, "/title/tt0079322/", "tt0079322"),
        (text.bare_id, "tt0079322", None),
        (text.last_word, "Auckland, New Zealand", "Zealand"),
        (text.last_word, " ", None),
        (text.review_total, " 1,234 Reviews ", 1234),
        (text.review_total, "no reviews", 0),
        (text.review_total, None, 0),
        (text.stated_rating, "10", 10),
        (text.stated_rating, "3 May 1999", None),
        (text.stated_rating, "x", None),
        (text.unescaped, "a &amp;lt; b &lt; &#39;", "a &lt; b < '"),
    ],
)
def test_text(spark, function, value, expected):
    assert one(spark, value, "string", function) == expected


def test_rating_parts(spark):
    assert tuple(one(spark, "IMDb RATING9.0/102.6M", "string", markup.rating_parts)) == ("9.0/10", "2.6M")
    assert one(spark, "no rating", "string", markup.rating_parts) is None


def test_actors_are_in_rank_order_and_padded(spark):
    cast = {"10": "j", "2": "b", "1": "a"}
    padded = one(spark, cast, "map<string,string>", lambda c: arrays.padded(arrays.ranked_values(c), 4))
    assert padded == ["a", "b", "j", ""]
    assert one(spark, cast, "map<string,string>", lambda c: arrays.padded(arrays.ranked_values(c), 2)) == ["a", "b"]


def test_guards(spark):
    frame = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="no column b"):
        guards.require_columns(frame, "a", "b")
    assert guards.with_default(frame, "a", 7).first()["a"] == 1
    assert guards.with_default(frame, "b", 7).first()["b"] == 7
    with pytest.raises(ValueError):
        titles.clean_titles(frame)


def test_last_wins_and_merge(spark):
    first = spark.createDataFrame([("x", 1), ("y", 1)], "id string, v int")
    second = spark.createDataFrame([("y", None), ("z", 2)], "id string, v int")
    assert {tuple(r) for r in keyed.merge_pages([first, second], "id").collect()} == {("x", 1), ("y", None), ("z", 2)}


def test_chosen_names():
    assert keyed.chosen_names(["all"], ["a", "b"]) == ["a", "b"]
    assert keyed.chosen_names(["b", "q"], ["a", "b"]) == ["b"]
    with pytest.raises(ValueError):
        keyed.chosen_names(["q"], ["a", "b"])
