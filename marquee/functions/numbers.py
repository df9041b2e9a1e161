"""Numbers written as text, ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The short forms used on the pages.
SHORT_FORMS = {"K": "e+03", "M": "e+06", "B": "e+09", "T": "e+12"}


def short_form(text: Column) -> Column:
    """`2.9K` -> 2900.0; NULL when the text is no number."""
    for letter, exponent in SHORT_FORMS.items():
        text = F.replace(text, F.lit(letter), F.lit(exponent))
    return text.try_cast("double")


def in_dollars(text: Column) -> Column:
    return F.startswith(text, F.lit("$"))


def dollars(text: Column) -> Column:
    """`$1,006,102,277` -> 1006102277; NULL for other currencies."""
    return F.when(in_dollars(text), F.translate(text, "$,", "").try_cast("bigint"))


def ratio(part: Column, whole: Column) -> Column:
    """NULL for a zero or missing `whole`."""
    return F.try_divide(part, whole)


def half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)
