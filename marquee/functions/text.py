"""Cleaning of identifiers, links, labels and free text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The five entities a page title or link text can hold in the stored pages.
# The ampersand comes last so that "&amp;lt;" becomes "&lt;" and not "<".
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def before(text: Column, separator: str) -> Column:
    """The part of `text` in front of the first `separator`; NULL stays NULL."""
    return F.split_part(text, F.lit(separator), F.lit(1))


def link_id(href: Column) -> Column:
    """`/name/nm1/?ref_=tt_cl_t_3` -> `/name/nm1/`."""
    return before(href, "?")


def link_rank(href: Column) -> Column:
    """`/name/nm1/?ref_=tt_cl_t_3` -> `3`; NULL for a link without a rank."""
    return F.nullif(F.split_part(href, F.lit("_t_"), F.lit(2)), F.lit(""))


def bare_id(path: Column) -> Column:
    """`/title/tt0079322/` -> `tt0079322`; NULL when the text is no title path."""
    return F.nullif(F.regexp_extract(path, "/title/([^/]+)/", 1), F.lit(""))


def without_trailing_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\n+\z", "")


def trimmed(text: Column) -> Column:
    """Blanks, tabs and newlines removed at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def last_word(text: Column) -> Column:
    """The last word of `text`; NULL for NULL and for blank text."""
    return F.nullif(F.regexp_extract(text, r"(\S+)\s*$", 1), F.lit(""))


def main_genre(text: Column) -> Column:
    """The first of a comma or blank separated list, after newlines are dropped."""
    return F.split(F.replace(text, F.lit("\n"), F.lit("")), ", | ").getItem(0)


def numbers_in(text: Column) -> Column:
    """All whole numbers in `text`, thousands commas ignored, as an array of int."""
    digits = F.regexp_extract_all(F.replace(text, F.lit(","), F.lit("")), F.lit("([0-9]+)"), F.lit(1))
    return F.transform(digits, lambda d: d.try_cast("int"))


def review_total(header: Column) -> Column:
    """`1,234 Reviews` -> 1234, and 0 when there is no such number."""
    number = before(F.translate(header, " ,", ""), "Reviews")
    return F.coalesce(number.try_cast("int"), F.lit(0))


def stated_rating(text: Column) -> Column:
    """A rating has at most two characters; anything longer is another field of the page."""
    return F.when(F.length(text) <= 2, text.try_cast("int"))


def unescaped(text: Column) -> Column:
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def tag_free(html: Column) -> Column:
    """The text of an HTML fragment: tags dropped, entities resolved."""
    return unescaped(F.regexp_replace(html, "<[^>]*>", ""))
