"""One label per title and feature family, and the weighted one-hot rows made from them.

Every family gives a title at most one label, so a title's features are a dozen columns. What the labels depend
on (frequent categories, quantile edges) is learnt by `fit`: a few aggregations whose results are bounded by the
settings and by the calendar. With them, labelling is one projection without a join or a shuffle.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Protocol

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import arrays, dates, numbers
from .guards import require_columns
from .order_statistics import quantiles

POSITIONS = 3  # billed actors that count
ACTOR_FAMILIES = [f"actor_{i}" for i in range(1, POSITIONS + 1)]
FAMILIES = [
    "boxoffice",
    *ACTOR_FAMILIES,
    "actor_other",
    "country",
    "genre",
    "language",
    "company",
    "rating",
    "decade",
    "runtime",
]


@dataclass(frozen=True)
class FeatureSettings:
    """Category limits, quantiles and bins of the catalogue model."""

    actor_categories: int = 10
    genre_categories: int = 20
    company_categories: int = 20
    country_categories: int = 20
    language_categories: int = 20
    boxoffice_quantiles: tuple[float, ...] = (0, 0.1, 0.25, 0.5, 0.75, 0.9, 1)
    runtime_quantiles: tuple[float, ...] = (0, 0.1, 0.25, 0.5, 0.75, 0.9, 1)
    rating_bins: tuple[float, ...] = (0, 4, 6, 8, 10)
    weights: dict[str, int] = field(default_factory=dict)

    def weight(self, family: str) -> int:
        """A weight of n counts the family n times in every dot product."""
        if family.startswith("actor_"):
            family = "actor"
        return self.weights.get(family, 1)

    def limit(self, family: str) -> int:
        return {
            "genre": self.genre_categories,
            "country": self.country_categories,
            "language": self.language_categories,
            "company": self.company_categories,
        }.get(family, self.actor_categories)


class FeatureExtractor(Protocol):
    """What a recommender needs of a feature model: titles in, `id` and the label columns out."""

    settings: FeatureSettings

    def labels(self, titles: DataFrame) -> DataFrame: ...


def billed(titles: DataFrame) -> Column:
    """The first actors in rank order, filled up with blanks."""
    return arrays.padded(arrays.ranked_values(F.col("actors")), POSITIONS)


def _categories(titles: DataFrame, families: list[str]) -> dict[str, Column]:
    values = {
        "genre": lambda: arrays.joined_sorted(F.col("genre_1"), F.col("genre_2"), F.col("genre_3")),
        "country": lambda: F.col("country_of_origin_1"),
        "language": lambda: F.col("original_language"),
        "company": lambda: F.col("production_company_1"),
        **{f"actor_{i + 1}": (lambda i=i: F.get(billed(titles), F.lit(i))) for i in range(POSITIONS)},
    }
    return {family: values[family]() for family in families}


def frequent_categories(values: DataFrame, limits: dict[str, int]) -> DataFrame:
    """The categories kept per family: family, value.

    `values` has the columns family and value. With more than n distinct values, the n - 1 most frequent are
    kept, on a tie the one later in sort order; with at most n, all. NULL is a category and sorts last.
    """
    counts = values.groupBy("family", "value").agg(F.count("*").alias("n"))
    most = Window.partitionBy("family").orderBy(F.col("n").desc(), F.col("value").desc_nulls_first())
    # One more than the limit shows whether there are too many; a constant bound keeps the window small.
    leading = (
        counts.withColumn("place", F.row_number().over(most))
        .where(F.col("place") <= max(limits.values()) + 1)
    )
    limit = F.element_at(F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]), F.col("family"))
    size = F.max("place").over(Window.partitionBy("family"))
    return (
        leading.withColumn("size", size)
        .where(F.col("place") <= F.when(F.col("size") > limit, limit - 1).otherwise(limit))
        .select("family", "value")
    )


def fit_categories(titles: DataFrame, families: list[str], settings: FeatureSettings) -> dict[str, list]:
    """The kept categories of each family. At most families x limit values come back, whatever the data."""
    categories = _categories(titles, families)
    pairs = F.array(
        *[F.struct(F.lit(f).alias("family"), v.alias("value")) for f, v in categories.items()]
    )
    values = titles.select(F.explode(pairs).alias("p")).select("p.family", "p.value")
    kept: dict[str, list] = {family: [] for family in families}
    for row in frequent_categories(values, {family: settings.limit(family) for family in families}).collect():
        kept[row["family"]].append(row["value"])
    return kept


def with_categories(titles: DataFrame, kept: dict[str, list]) -> DataFrame:
    """Adds the label column of each one-hot family in `kept`."""

    def frequent(family: str, value: Column) -> Column:
        named = [v for v in kept[family] if v is not None]
        return F.when(value.isNull(), F.lit(None in kept[family])).otherwise(value.isin(named))

    values = _categories(titles, list(kept))
    labels = {}
    for family, value in values.items():
        known, named = frequent(family, value), F.coalesce(value, F.lit("None"))
        if family in ACTOR_FAMILIES:
            # Neither a blank nor a rare name is a feature.
            name = F.regexp_replace(value, "^/name/", "")
            labels[family] = F.when(known & (value != ""), F.concat(F.lit("actor_"), name))
        elif family == "genre":
            labels[family] = F.when(known, named).otherwise("infrequent_genre")
        elif family == "country":
            labels[family] = F.concat(F.lit("originated_in_"), F.when(known, named).otherwise("infrequent_country"))
        elif family == "language":
            labels[family] = F.concat(F.when(known, named).otherwise("infrequent"), F.lit("_language"))
        else:
            company = F.coalesce(value, F.lit("unknown_company"))
            labels[family] = F.concat(F.lit("produced_by_"), F.when(known, company).otherwise("infrequent_company"))
    if set(ACTOR_FAMILIES) <= set(kept):
        any_kept = F.greatest(*[frequent(f, values[f]) for f in ACTOR_FAMILIES])
        labels["actor_other"] = F.when(~any_kept, F.lit("actor_another"))
    return titles.withColumns(labels)


def decade_label(release_date: Column) -> Column:
    label = F.concat(F.lit("released_in_"), dates.nearest_decade(release_date).cast("string"), F.lit("s"))
    return F.coalesce(label, F.lit("unknown_release_decade"))


def _first_label(cases: list[tuple[Column, str]], otherwise: str | None) -> Column:
    chain = F.when(cases[0][0], F.lit(cases[0][1]))
    for condition, label in cases[1:]:
        chain = chain.when(condition, F.lit(label))
    return chain if otherwise is None else chain.otherwise(F.lit(otherwise))


def rating_label(rating: Column, bins: tuple[float, ...]) -> Column:
    """Bins closed on the right; a missing rating or one outside the bins is `None`."""
    cases = [
        ((rating > low) & (rating <= high), f"rating_from_{low:g}_to_{high:g}")
        for low, high in zip(bins, bins[1:])
    ]
    return _first_label(cases, "None")


def _percent(q: float) -> str:
    return f"q{round(100 * q)}"


def fit_runtime(titles: DataFrame, fractions: tuple[float, ...]) -> list[float]:
    """Quantile edges of the runtime; edges that coincide would leave a bin empty and are an error."""
    rows = quantiles(titles, "runtime", list(fractions)).collect()
    edges = [row["value"] for row in sorted(rows, key=lambda row: row["q"])]
    if len(set(edges)) < len(edges):
        raise ValueError(f"runtime quantiles coincide: {edges}; use fewer of them")
    return edges


def runtime_label(runtime: Column, edges: list[float], fractions: tuple[float, ...]) -> Column:
    """Quantile bins closed on the right, the first one on both sides; NULL has no label."""
    cases = []
    for i, (low, high) in enumerate(zip(fractions, fractions[1:])):
        above = runtime >= edges[i] if i == 0 else runtime > edges[i]
        label = f"runtime_from_{_percent(low)}_to_{_percent(high)}"
        cases.append((above & (runtime <= edges[i + 1]), label))
    return _first_label(cases, None)


def decade_gross(titles: DataFrame) -> DataFrame:
    return titles.select(
        dates.nearest_decade(F.col("release_date")).alias("decade"),
        numbers.dollars(F.col("boxoffice_gross_worldwide")).alias("gross"),
    ).where(F.col("decade").isNotNull() & F.col("gross").isNotNull())


def fit_boxoffice(titles: DataFrame, fractions: tuple[float, ...]) -> dict[int, list[int]]:
    """Quantile edges of the gross per decade: one list per decade of the calendar."""
    if min(fractions) != 0 or max(fractions) != 1:
        raise ValueError("the box-office quantiles must begin with 0 and end with 1")
    found = quantiles(decade_gross(titles), "gross", list(fractions), ("decade",), nearest=True).collect()
    edges: dict[int, list[int]] = {}
    for row in sorted(found, key=lambda row: row["q"]):
        edges.setdefault(row["decade"], []).append(row["value"])
    return edges


def boxoffice_label(titles_gross: Column, decade: Column, edges: dict[int, list[int]], fractions) -> Column:
    """The band of a gross within its own decade; other currencies and unknown dates have none."""
    table = F.from_json(F.lit(json.dumps({str(k): v for k, v in edges.items()})), "map<string,array<bigint>>")
    here = F.try_element_at(table, decade.cast("string"))
    cases = []
    for i, (low, high) in enumerate(zip(fractions, fractions[1:])):
        top = F.get(here, F.lit(i + 1)) + (1 if i == len(fractions) - 2 else 0)
        label = f"boxoffice_from_{_percent(low)}_to_{_percent(high)}"
        cases.append(((titles_gross >= F.get(here, F.lit(i))) & (titles_gross < top), label))
    return _first_label(cases, "boxoffice_unknown_q")


@dataclass(frozen=True)
class FittedFeatures:
    """What was learnt from a catalogue; labels titles of the same or of a newer catalogue."""

    settings: FeatureSettings
    kept: dict[str, list]
    runtime_edges: list[float]
    gross_edges: dict[int, list[int]]

    def labels(self, titles: DataFrame) -> DataFrame:
        """`id` and one label column per family; NULL where a title has no feature of the family."""
        s = self.settings
        gross = numbers.dollars(F.col("boxoffice_gross_worldwide"))
        decade = dates.nearest_decade(F.col("release_date"))
        others = {
            "boxoffice": boxoffice_label(gross, decade, self.gross_edges, s.boxoffice_quantiles),
            "rating": rating_label(F.col("rating"), s.rating_bins),
            "decade": decade_label(F.col("release_date")),
            "runtime": runtime_label(F.col("runtime"), self.runtime_edges, s.runtime_quantiles),
        }
        return with_categories(titles, self.kept).select(
            "id", *[others.get(f, F.col(f)).alias(f) for f in FAMILIES]
        )


@dataclass(frozen=True)
class CatalogueFeatures:
    """The nine feature families of a title."""

    settings: FeatureSettings = FeatureSettings()

    def fit(self, titles: DataFrame) -> FittedFeatures:
        require_columns(titles, "id", "actors", "rating", "runtime", "release_date", "boxoffice_gross_worldwide")
        one_hot = ["country", "genre", "language", "company", *ACTOR_FAMILIES]
        s = self.settings
        # Three independent small results: Spark runs their jobs side by side.
        steps = [
            lambda: fit_categories(titles, one_hot, s),
            lambda: fit_runtime(titles, s.runtime_quantiles),
            lambda: fit_boxoffice(titles, s.boxoffice_quantiles),
        ]
        with ThreadPoolExecutor(len(steps)) as pool:
            waiting = [pool.submit(inheritable_thread_target(titles.sparkSession)(step)) for step in steps]
            kept, runtime_edges, gross_edges = [w.result() for w in waiting]
        return FittedFeatures(s, kept, runtime_edges, gross_edges)

    def labels(self, titles: DataFrame) -> DataFrame:
        return self.fit(titles).labels(titles)


def weighted_rows(labels: DataFrame, settings: FeatureSettings) -> DataFrame:
    """Label columns -> one row per feature: id, family, feature, weight."""
    families = [c for c in labels.columns if c != "id"]
    features = F.array(
        *[
            F.struct(
                F.lit(f).alias("family"), F.col(f).alias("feature"), F.lit(settings.weight(f)).alias("weight")
            )
            for f in families
        ]
    )
    return (
        labels.select("id", F.explode(features).alias("f"))
        .select("id", "f.*")
        .where(F.col("feature").isNotNull())
    )
