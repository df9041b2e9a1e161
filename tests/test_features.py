"""One-hot rule, bins and bands on small catalogues."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marquee.operators import features as feat

COLUMNS = (
    "id int, genre_1 string, genre_2 string, genre_3 string, country_of_origin_1 string, original_language string, "
    "production_company_1 string, actors map<string,string>, rating double, runtime double, release_date date, "
    "boxoffice_gross_worldwide string"
)


def title(i, genre="Drama", country="US", language="en", company="C", actors=None, rating=5.0, runtime=None,
          released=dt.date(1994, 1, 1), gross=None):
    return (i, genre, None, None, country, language, company, actors or {}, rating, runtime or float(i),
            released, gross)


def kept(spark, values, limit):
    frame = spark.createDataFrame([("f", v) for v in values], "family string, value string")
    return {r["value"] for r in feat.frequent_categories(frame, {"f": limit}).collect()}


def test_one_hot_rule(spark):
    assert kept(spark, list("aabbc"), 3) == {"a", "b", "c"}  # no more than the limit: all stay
    assert kept(spark, list("aabbc"), 2) == {"b"}  # on a tie the later one wins
    assert kept(spark, ["a", "a", None, None, "c"], 2) == {None}  # NULL sorts last
    assert kept(spark, list("abcd") * 2 + ["d"], 3) == {"c", "d"}


def test_rating_bins_are_closed_on_the_right(spark):
    frame = spark.createDataFrame([(v,) for v in (0.0, 0.1, 4.0, 4.1, 6.0, 10.0, 11.0, None)], "r double")
    labels = [r["l"] for r in frame.select(feat.rating_label(F.col("r"), (0, 4, 6, 8, 10)).alias("l")).collect()]
    assert labels == ["None", "rating_from_0_to_4", "rating_from_0_to_4", "rating_from_4_to_6",
                      "rating_from_4_to_6", "rating_from_8_to_10", "None", "None"]


def test_decade_labels(spark):
    days = [dt.date(1985, 1, 1), dt.date(1995, 1, 1), None]
    frame = spark.createDataFrame([(d,) for d in days], "d date")
    labels = [r["l"] for r in frame.select(feat.decade_label(F.col("d")).alias("l")).collect()]
    assert labels == ["released_in_1980s", "released_in_2000s", "unknown_release_decade"]


def test_runtime_bins(spark):
    titles = spark.createDataFrame([(float(v),) for v in range(0, 101)] + [(None,)], "runtime double")
    edges = feat.fit_runtime(titles, (0, 0.25, 1))
    assert edges == [0.0, 25.0, 100.0]
    label = feat.runtime_label(F.col("runtime"), edges, (0, 0.25, 1)).alias("l")
    counts = {r["l"]: r["count"] for r in titles.select(label).groupBy("l").count().collect()}
    assert counts == {"runtime_from_q0_to_q25": 26, "runtime_from_q25_to_q100": 75, None: 1}
    with pytest.raises(ValueError, match="coincide"):
        feat.fit_runtime(titles.select(F.lit(1.0).alias("runtime")), (0, 0.5, 1))


def test_boxoffice_band(spark):
    rows = [title(i, gross=f"${i * 1000:,}") for i in range(1, 12)]
    rows += [title(20, gross="£5,000"), title(21, gross=None), title(22, gross="$5,000", released=None),
             title(23, gross="$1.5")]
    titles = spark.createDataFrame(rows, COLUMNS)
    edges = feat.fit_boxoffice(titles, (0, 0.5, 1))
    assert edges == {1990: [1000, 6000, 11000]}
    labels = feat.CatalogueFeatures(feat.FeatureSettings(boxoffice_quantiles=(0, 0.5, 1))).labels(titles)
    got = {r["id"]: r["boxoffice"] for r in labels.collect()}
    assert got[5] == "boxoffice_from_q0_to_q50" and got[6] == "boxoffice_from_q50_to_q100"
    assert got[11] == "boxoffice_from_q50_to_q100"  # the largest belongs to the last band
    assert {got[i] for i in (20, 21, 22, 23)} == {"boxoffice_unknown_q"}
    with pytest.raises(ValueError):
        feat.fit_boxoffice(titles, (0.1, 1))


def test_actor_labels(spark):
    cast = [{"1": "/name/a", "2": "/name/b"}] * 3 + [{"1": "/name/c"}] * 2 + [{}, {"1": "/name/z", "2": "/name/y", "3": "/name/x"}]
    titles = spark.createDataFrame([title(i, actors=c) for i, c in enumerate(cast)], COLUMNS)
    settings = feat.FeatureSettings(actor_categories=3)
    kept_now = feat.fit_categories(titles, feat.ACTOR_FAMILIES, settings)
    assert {f: set(v) for f, v in kept_now.items()} == {
        "actor_1": {"/name/a", "/name/c"}, "actor_2": {"", "/name/b", "/name/y"}, "actor_3": {"", "/name/x"}}
    rows = {r["id"]: r for r in feat.with_categories(titles, kept_now).collect()}
    assert (rows[0]["actor_1"], rows[0]["actor_2"], rows[0]["actor_3"], rows[0]["actor_other"]) == ("actor_a", "actor_b", None, None)
    # No actors at all, but blank is a frequent value, so this is not 'another'.
    assert (rows[5]["actor_1"], rows[5]["actor_2"], rows[5]["actor_other"]) == (None, None, None)
    assert rows[6]["actor_1"] is None and rows[6]["actor_3"] == "actor_x"


def test_unknown_and_infrequent_labels(spark):
    rows = [title(i, country=c, language=c, company=c, genre=c or "G")
            for i, c in enumerate(["a", "a", "a", None, None, "b", "c", "d"])]
    titles = spark.createDataFrame(rows, COLUMNS)
    settings = feat.FeatureSettings(genre_categories=3, country_categories=3, language_categories=3, company_categories=3)
    families = ["country", "language", "company", "genre"]
    labelled = feat.with_categories(titles, feat.fit_categories(titles, families, settings))
    got = {r["id"]: r for r in labelled.collect()}
    assert (got[0]["country"], got[3]["country"], got[5]["country"]) == (
        "originated_in_a", "originated_in_None", "originated_in_infrequent_country")
    assert (got[0]["language"], got[3]["language"], got[5]["language"]) == ("a_language", "None_language", "infrequent_language")
    assert (got[0]["company"], got[3]["company"], got[5]["company"]) == (
        "produced_by_a", "produced_by_unknown_company", "produced_by_infrequent_company")
    assert got[5]["genre"] == "infrequent_genre"


def test_weights_and_missing_features(spark):
    labels = spark.createDataFrame([(1, "x", None), (2, "x", "y")], "id int, genre string, actor_1 string")
    rows = feat.weighted_rows(labels, feat.FeatureSettings(weights={"actor": 3})).collect()
    assert {tuple(r) for r in rows} == {(1, "genre", "x", 1), (2, "genre", "x", 1), (2, "actor_1", "y", 3)}
