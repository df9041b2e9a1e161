"""Simple page rules inside the JVM, for tags that do not contain a tag of the same name."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .text import tag_free


def _opening(tag: str, attribute: str | None, value: str | None) -> str:
    if attribute is None:
        return rf"<{tag}\b[^>]*>"
    wanted = re.escape(value)
    return rf"""<{tag}\b[^>]*\b{re.escape(attribute)}\s*=\s*(?:"{wanted}"|'{wanted}')[^>]*>"""


#: A quoted attribute value with its quotes, as one group.
QUOTED = r"""("[^"]*"|'[^']*')"""


def _unquoted(value: Column) -> Column:
    return F.substring(value, F.lit(2), F.length(value) - 2)


def text_of(html: Column, tag: str, attribute: str | None = None, value: str | None = None) -> Column:
    """The text of the first such tag; NULL without one."""
    inner = F.regexp_extract(html, rf"(?s){_opening(tag, attribute, value)}(.*?)</{tag}>", 1)
    return F.nullif(tag_free(inner), F.lit(""))


def texts_of(html: Column, tag: str, attribute: str | None = None, value: str | None = None) -> Column:
    """The texts of all such tags, in page order."""
    pattern = rf"(?s){_opening(tag, attribute, value)}(.*?)</{tag}>"
    return F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), tag_free)


def attribute_of(html: Column, tag: str, name: str) -> Column:
    """An attribute of the first such tag that has it; NULL without one."""
    return F.nullif(_unquoted(F.regexp_extract(html, rf"<{tag}\b[^>]*\b{name}\s*=\s*{QUOTED}", 1)), F.lit(""))


def attributes_of(html: Column, tag: str, name: str) -> Column:
    return F.transform(F.regexp_extract_all(html, F.lit(rf"<{tag}\b[^>]*\b{name}\s*=\s*{QUOTED}"), F.lit(1)), _unquoted)


def links_of(html: Column) -> Column:
    """All links in page order, as structs of href and text."""
    pattern = rf"(?s)<a\b[^>]*\bhref\s*=\s*{QUOTED}[^>]*>(.*?)</a>"
    hrefs = F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), _unquoted)
    texts = F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(2)), tag_free)
    return F.arrays_zip(hrefs.alias("href"), texts.alias("text"))


def scores(texts: Column, names: list[str]) -> Column:
    """A struct that gives the i-th text to the i-th name: a missing text shifts the later ones."""
    return F.struct(*[F.get(texts, F.lit(i)).alias(name) for i, name in enumerate(names)])


def rating_parts(text: Column) -> Column:
    """`IMDb RATING9.0/102.6M` -> ('9.0/10', '2.6M'); NULL when there is no such rating."""
    bare = F.replace(text, F.lit("IMDb RATING"), F.lit(""))
    pattern = r"(?s)^(.*?/10)(.*)$"
    rating = F.nullif(F.regexp_extract(bare, pattern, 1), F.lit(""))
    votes = F.regexp_extract(bare, pattern, 2)
    return F.when(rating.isNotNull(), F.struct(rating.alias("avg_rating"), votes.alias("num_votes")))
