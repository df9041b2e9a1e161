"""Dates and durations written as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import before, trimmed

# The forms a release date takes, from the most to the least precise.
RELEASE_FORMS = ["MMMM d, yyyy", "d MMMM yyyy", "MMMM yyyy", "yyyy"]


def review_date(text: Column) -> Column:
    """`31 January 2020` with any blanks around it; NULL when it is no date."""
    return F.try_to_date(trimmed(text), "d MMMM yyyy")


def release_date(text: Column) -> Column:
    """`July 1911 (United States)` -> 1911-07-01; NULL when no form fits."""
    stated = trimmed(before(text, "("))
    return F.coalesce(*[F.try_to_date(stated, form) for form in RELEASE_FORMS])


def runtime_minutes(text: Column) -> Column:
    """`1 hour 11 minutes` -> 71.0."""
    spelled = text.try_cast("interval")
    return (
        F.extract(F.lit("hour"), spelled) * 60
        + F.extract(F.lit("minute"), spelled)
        + F.extract(F.lit("day"), spelled) * 1440
        + F.extract(F.lit("second"), spelled) / 60
    ).cast("double")


def nearest_decade(date: Column) -> Column:
    """The year rounded to tens, halves to the even ten: 1985 -> 1980, 1995 -> 2000."""
    return F.bround(F.year(date), -1).cast("int")


def month_end(date: Column) -> Column:
    return F.last_day(date)
