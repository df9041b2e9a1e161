"""Lists and rank-keyed maps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def spread(values: Column, names: list[str]) -> list[Column]:
    """One column per name from the first elements; NULL where the list is too short."""
    return [F.get(values, F.lit(i)).alias(name) for i, name in enumerate(names)]


def first_present(values: Column, among: int = 2) -> Column:
    return F.coalesce(*[F.get(values, F.lit(i)) for i in range(among)])


def ranked_values(ranked: Column) -> Column:
    """Values of a rank-keyed map in the order of the numeric rank."""
    entries = F.transform(
        F.map_entries(ranked),
        lambda e: F.struct(e["key"].try_cast("int").alias("rank"), e["value"].alias("value")),
    )
    return F.transform(F.array_sort(entries), lambda e: e["value"])


def padded(values: Column, size: int, filler: str = "") -> Column:
    """Exactly `size` elements: cut when longer, filled up when shorter."""
    return F.slice(F.concat(values, F.array_repeat(F.lit(filler), size)), 1, size)


def member_set(ranked: Column) -> Column:
    return F.array_distinct(F.map_values(ranked))


def joined_sorted(*labels: Column) -> Column:
    """Labels in alphabetical order, NULL ones left out, joined by a comma and a blank."""
    return F.array_join(F.array_sort(F.array_compact(F.array(*labels))), ", ")


def joined(*labels: Column) -> Column:
    return F.concat_ws(", ", *labels)
