"""Feature families and the table of all features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays, dates, numbers
from ..operators import features as feat
from .registry import query
from .views import ITEMS, items, stored, with_maps, with_views

SETTINGS = feat.FeatureSettings()
WEIGHTED = feat.FeatureSettings(weights={"genre": 3, "actor": 2, "decade": 2})


def one_hot_sql(name: str, value: str, limit: int) -> str:
    """Views `<name>_kept`: the categories kept under the one-hot rule, NULL among them."""
    return f"""{name}_counts as (select {value} as value, count(*) as n, count(*) over () as size from items group by 1),
{name}_kept as (select value from (select *, row_number() over (order by n desc, value desc nulls first) as place
  from {name}_counts) where place <= case when size > {limit} then {limit} - 1 else {limit} end)"""


def kept_sql(name: str, value: str) -> str:
    return f"exists (select 1 from {name}_kept k where k.value is not distinct from {value})"


GENRES = "array_to_string(list_sort(list_filter([genre_1, genre_2, genre_3], lambda x: x is not null)), ', ')"
GENRE = one_hot_sql("genre", GENRES, 20)
COUNTRY = one_hot_sql("country", "country_of_origin_1", 20)
LANGUAGE = one_hot_sql("language", "original_language", 20)
COMPANY = one_hot_sql("company", "production_company_1", 20)
ACTORS = ",\n".join(one_hot_sql(f"actor{i}", f"coalesce(actor_{i}, '')", 10) for i in (1, 2, 3))

GENRE_LABEL = f"case when {kept_sql('genre', GENRES)} then {GENRES} else 'infrequent_genre' end"
COUNTRY_LABEL = f"""'originated_in_' || case when {kept_sql('country', 'country_of_origin_1')}
  then coalesce(country_of_origin_1, 'None') else 'infrequent_country' end"""
LANGUAGE_LABEL = f"""case when {kept_sql('language', 'original_language')}
  then coalesce(original_language, 'None') else 'infrequent' end || '_language'"""
COMPANY_LABEL = f"""'produced_by_' || case when {kept_sql('company', 'production_company_1')}
  then coalesce(production_company_1, 'unknown_company') else 'infrequent_company' end"""


def actor_kept(i: int) -> str:
    return kept_sql(f"actor{i}", f"coalesce(actor_{i}, '')")


def actor_label(i: int) -> str:
    return f"case when {actor_kept(i)} and actor_{i} is not null then 'actor_' || replace(actor_{i}, '/name/', '') end"


OTHER_LABEL = "case when not ({}) then 'actor_another' end".format(" or ".join(actor_kept(i) for i in (1, 2, 3)))
RATING_LABEL = """case when rating > 0 and rating <= 4 then 'rating_from_0_to_4' when rating > 4 and rating <= 6 then 'rating_from_4_to_6'
  when rating > 6 and rating <= 8 then 'rating_from_6_to_8' when rating > 8 and rating <= 10 then 'rating_from_8_to_10' else 'None' end"""
DECADE = "cast(round_even(cast(year(release_date) as double), -1) as int)"
DECADE_LABEL = f"coalesce('released_in_' || {DECADE} || 's', 'unknown_release_decade')"
QUANTILE_NAMES = ["q0", "q10", "q25", "q50", "q75", "q90", "q100"]
RUNTIME_EDGES = (
    "runtime_edges as (select quantile_cont(runtime, [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1]) as e from items)"
)
RUNTIME_LABEL = "case " + " ".join(
    f"when runtime {'>=' if i == 0 else '>'} (select e[{i + 1}] from runtime_edges) "
    f"and runtime <= (select e[{i + 2}] from runtime_edges) "
    f"then 'runtime_from_{QUANTILE_NAMES[i]}_to_{QUANTILE_NAMES[i + 1]}'"
    for i in range(6)
) + " end"
GROSS_EDGES = f"""grosses as (select {DECADE} as decade, cast(substr(boxoffice_gross_worldwide, 2) as bigint) as gross
  from items where release_date is not null and starts_with(boxoffice_gross_worldwide, '$')),
gross_ranks as (select decade, gross, row_number() over (partition by decade order by gross) - 1 as r,
  count(*) over (partition by decade) as n from grosses),
gross_marks as (select unnest([0, 0.1, 0.25, 0.5, 0.75, 0.9, 1]::double[]) as q),
gross_places as (select decade, q, floor(q * (n - 1)) as low, q * (n - 1) - floor(q * (n - 1)) as part
  from (select distinct decade, n from gross_ranks) cross join gross_marks),
gross_edges as (select p.decade, list(r.gross order by p.q) as e from gross_places p join gross_ranks r on r.decade = p.decade
  and r.r = p.low + case when p.part > 0.5 or (p.part = 0.5 and p.q > 0.5) then 1 else 0 end group by p.decade),
banded as (select id, case {{}} else 'boxoffice_unknown_q' end as boxoffice from (
  select id, case when starts_with(boxoffice_gross_worldwide, '$') then cast(substr(boxoffice_gross_worldwide, 2) as bigint) end as gross,
    {DECADE} as decade from items) t left join gross_edges g on g.decade = t.decade)""".format(
    " ".join(
        f"when gross >= e[{i + 1}] and gross < e[{i + 2}]{' + 1' if i == 5 else ''} "
        f"then 'boxoffice_from_{QUANTILE_NAMES[i]}_to_{QUANTILE_NAMES[i + 1]}'"
        for i in range(6)
    )
)
# Views up to `labels`: one row per title, one column per family.
LABEL_VIEWS = [
    ITEMS,
    GENRE,
    COUNTRY,
    LANGUAGE,
    COMPANY,
    ACTORS,
    RUNTIME_EDGES,
    GROSS_EDGES,
    f"""labels as (select items.id, boxoffice, {actor_label(1)} as actor_1, {actor_label(2)} as actor_2,
  {actor_label(3)} as actor_3, {OTHER_LABEL} as actor_other, {COUNTRY_LABEL} as country, {GENRE_LABEL} as genre,
  {LANGUAGE_LABEL} as "language", {COMPANY_LABEL} as company, {RATING_LABEL} as rating, {DECADE_LABEL} as decade,
  {RUNTIME_LABEL} as runtime from items join banded on banded.id = items.id)""",
]


def rows_sql(settings: feat.FeatureSettings) -> str:
    """View `features`: one row per title and feature."""
    parts = [
        f"select id, '{f}' as family, \"{f}\" as feature, {settings.weight(f)} as weight from labels where \"{f}\" is not null"
        for f in feat.FAMILIES
    ]
    return "features as (" + "\nunion all ".join(parts) + ")"


def catalogue(spark, folder):
    """The titles with their maps, written once: fitting and labelling read them several times."""
    return stored(with_maps(items(spark, folder)).drop(*feat.ACTOR_FAMILIES))


def _one_family(key: str, family: str, label_sql: str, *views: str):
    @query(key, with_views(f"select id, {label_sql} as feature from items", ITEMS, *views))
    def build(spark, folder):
        titles = stored(items(spark, folder))
        labelled = feat.with_categories(titles, feat.fit_categories(titles, [family], SETTINGS))
        return labelled.select("id", F.col(family).alias("feature"))

    return build


genre_features = _one_family("genre_features", "genre", GENRE_LABEL, GENRE)
country_features = _one_family("country_features", "country", COUNTRY_LABEL, COUNTRY)
language_features = _one_family("language_features", "language", LANGUAGE_LABEL, LANGUAGE)
company_features = _one_family("company_features", "company", COMPANY_LABEL, COMPANY)


@query("release_decade", with_views(f"select id, {DECADE_LABEL} as feature from items", ITEMS))
def release_decade(spark, folder):
    return items(spark, folder).select("id", feat.decade_label(F.col("release_date")).alias("feature"))


@query("rating_bins", with_views(f"select id, {RATING_LABEL} as feature from items", ITEMS))
def rating_bins(spark, folder):
    label = feat.rating_label(F.col("rating"), SETTINGS.rating_bins)
    return items(spark, folder).select("id", label.alias("feature"))


@query("runtime_bins", with_views(f"select id, {RUNTIME_LABEL} as feature from items", ITEMS, RUNTIME_EDGES))
def runtime_bins(spark, folder):
    titles = stored(items(spark, folder))
    edges = feat.fit_runtime(titles, SETTINGS.runtime_quantiles)
    label = feat.runtime_label(F.col("runtime"), edges, SETTINGS.runtime_quantiles)
    return titles.select("id", label.alias("feature"))


@query("boxoffice_band", with_views("select id, boxoffice as feature from banded", ITEMS, GROSS_EDGES))
def boxoffice_band(spark, folder):
    titles = stored(items(spark, folder))
    edges = feat.fit_boxoffice(titles, SETTINGS.boxoffice_quantiles)
    gross = numbers.dollars(F.col("boxoffice_gross_worldwide"))
    decade = dates.nearest_decade(F.col("release_date"))
    label = feat.boxoffice_label(gross, decade, edges, SETTINGS.boxoffice_quantiles)
    return titles.select("id", label.alias("feature"))


@query(
    "array_pad",
    with_views(
        "select id, coalesce(actor_1, '') as first, coalesce(actor_2, '') as second, coalesce(actor_3, '') as third from items",
        ITEMS,
    ),
)
def array_pad(spark, folder):
    titles = with_maps(items(spark, folder))
    return titles.select("id", *arrays.spread(feat.billed(titles), ["first", "second", "third"]))


@query(
    "actor_features",
    with_views(
        f"""select id, {actor_label(1)} as actor_1, {actor_label(2)} as actor_2, {actor_label(3)} as actor_3,
        {OTHER_LABEL} as actor_other from items""",
        ITEMS,
        ACTORS,
    ),
)
def actor_features(spark, folder):
    titles = catalogue(spark, folder)
    labelled = feat.with_categories(titles, feat.fit_categories(titles, feat.ACTOR_FAMILIES, SETTINGS))
    return labelled.select("id", *feat.ACTOR_FAMILIES, "actor_other")


def title_labels(spark, folder, settings=SETTINGS):
    return feat.CatalogueFeatures(settings).labels(catalogue(spark, folder))


@query("features_all", with_views("select id, family, feature, weight from features", *LABEL_VIEWS, rows_sql(WEIGHTED)))
def features_all(spark, folder):
    return feat.weighted_rows(title_labels(spark, folder, WEIGHTED), WEIGHTED)
