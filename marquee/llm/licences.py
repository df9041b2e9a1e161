"""Licence scan: files compared with licence texts and notices by TF-IDF cosine, then inherited from the nearest directory above.

Built-in functions only. Tokens are lower-case runs of letters, digits, dots and hyphens; each
weighs by the share of files that hold it, whatever the number of files, and shares below RAREST count as that. What is compared:

* an SPDX-License-Identifier tag is taken as written (without -only, -or-later and +), with a score of 1;
* whole texts: a licence file, and the comment at the head of any file, with the texts in licence_texts, from WHOLE on;
* notices: every line, and every stretch of as many tokens as a notice has, wherever lines break, from the threshold on; a line that is
  only a title ("MIT License") scores 1.

A file has the licence of the first of these three kinds that gives one, of the highest score within it. Units that hold too little of the
weight of every template to reach the threshold are left out before their tokens are laid out in rows, which loses nothing.

A file without a licence of its own inherits from the licence file (LICENSE, LICENCE or COPYING, with any extension) in
the nearest directory above it that has one. If no licence is recognised in that file, the effective licence is UNKNOWN: one further up
does not count. NULL and empty texts have no lines; a NULL path inherits nothing. Ties: template name,
then place. Repeated rows are one file each; several licence files of one directory: the smallest path with the best score,
those without a licence last.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .storage import stored

THRESHOLD = 0.6
WHOLE = 0.75  # whole texts of legal English have more in common than notices
ROUNDING = 1e-6  # scores are rounded to six places before they are compared
RAREST = 1e-3  # smaller shares of files weigh the same, so that names do not outweigh all else in large tables

#: Licence names and the notices that announce them (fixed values).
TEMPLATES = {
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0"],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License"],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Released under the BSD 3-Clause License",
    ],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0"],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License", "Licensed under CC BY 4.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0"],
    "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "Licensed under CC BY-SA 4.0"],
    "EPL-2.0": ["made available under the terms of the Eclipse Public License 2.0"],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "Released under the ISC License"],
    "LGPL-2.1": [
        "This library is free software under the GNU Lesser General Public License, version 2.1",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
    ],
    "LGPL-3.0": [
        "This library is free software under the GNU Lesser General Public License, version 3",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "MIT": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
}
#: Lines that are nothing but the title of a licence, as `tokens` reads them (fixed values).
TITLES = {
    "mit license": "MIT", "the mit license": "MIT", "the mit license mit": "MIT", "isc license": "ISC", "the isc license": "ISC",
    "apache license 2.0": "Apache-2.0", "apache license version 2.0": "Apache-2.0", "bsd 2-clause license": "BSD-2-Clause",
    "bsd 3-clause license": "BSD-3-Clause", "mozilla public license version 2.0": "MPL-2.0", "boost software license version 1.0": "BSL-1.0",
    "gnu general public license version 2": "GPL-2.0", "gnu general public license version 3": "GPL-3.0", "eclipse public license v 2.0": "EPL-2.0",
    "gnu lesser general public license version 2.1": "LGPL-2.1", "gnu lesser general public license version 3": "LGPL-3.0",
    "gnu affero general public license version 3": "AGPL-3.0", "the unlicense": "Unlicense",
}
LONGEST_TITLE = 200  # characters of a line that may be a title, signs and blanks around it included
TEXTS = Path(__file__).parent / "licence_texts"
SPDX = r"(?i)SPDX-License-Identifier:[ \t]*([A-Z0-9(][A-Z0-9.+-]*(?:(?:[ ]+(?:AND|OR|WITH)[ ]+|[()])[A-Z0-9.+()-]*)*)"
SPDX_EXTRA = r"(?i)-only\b|-or-later\b|\+"
COMMENT = r"^\s*(#|//|/\*|\*|--|;|%|$)"
BLOCK = r'(?s)^\s*(?:#![^\n]*\n\s*)?(?:/\*(.*?)\*/|"""(.*?)"""|<!--(.*?)-->)'
LICENCE_FILE = r"(?i)(^|/)(licen[sc]e|copying)(\.[^/]*)?$"
EDGES = ".-"
UNKNOWN = "unknown"


def tokens(line: Column) -> Column:
    """Lower-case runs of letters, digits, dots and hyphens, without dots and hyphens at the ends."""
    return F.filter(
        F.transform(F.split(F.lower(line), r"[^\p{L}\p{N}.-]+"), lambda t: F.trim(t, F.lit(EDGES))), lambda t: t != ""
    )


def _counts(notice: str) -> Counter[str]:
    """What `tokens` finds in a template, counted."""
    return Counter(filter(None, (t.strip(EDGES) for t in re.split(r"[^\w.-]+", notice.lower()))))


#: A template: kind (a whole text or a notice), licence, number.
Template = tuple[str, str, int]
Vector = dict[str, float]


def _all_templates() -> dict[Template, Counter[str]]:
    whole = {("whole", f.name.removesuffix(".txt"), 0): _counts(f.read_text()) for f in sorted(TEXTS.glob("*.txt"))}
    return whole | {("notice", name, i): _counts(x) for name, texts in TEMPLATES.items() for i, x in enumerate(texts)}


def _templates(spark: SparkSession, vectors: Mapping[Template, Vector]) -> DataFrame:
    """kind, template, number, token, t, norm: as many rows as the templates have distinct tokens."""
    rows = [(*n, t, w, math.sqrt(sum(x * x for x in v.values()))) for n, v in vectors.items() for t, w in v.items()]
    return spark.createDataFrame(rows, "kind string, template string, number int, token string, t double, norm double")


def files_with(rows: DataFrame) -> DataFrame:
    """token, df: how many files hold each token. Summed up per task before anything is moved."""
    return rows.select(F.explode(F.array_distinct(tokens(F.col("text")))).alias("token")).groupBy("token").agg(F.count("*").alias("df"))


def weight(df: Column | int, n: int) -> Column:
    """The weight of a token held by df of n files."""
    return F.log(1 + 1 / F.greatest(F.lit(df) / F.lit(float(max(n, 1))), F.lit(RAREST)))


def _weights(held: DataFrame, n: int, known: list[str]) -> dict[str, float]:
    """The weights of the templates' tokens; tokens in no file weigh as the rarest."""
    wanted = held.sparkSession.createDataFrame([(t,) for t in known], "token string")
    rows = held.join(F.broadcast(wanted), "token").select("token", weight(F.col("df"), n).alias("w")).collect()
    return dict.fromkeys(known, math.log(1 + 1 / RAREST)) | {r["token"]: r["w"] for r in rows}


def _needs(vector: Vector, threshold: float) -> tuple[set[str], int, float]:
    """What a unit needs to reach the threshold: one of these tokens, so many of the template's, and their squared weights.

    By Cauchy and Schwarz the cosine is at most the root of the share of a template's squared weights that lies on shared tokens.
    So a unit needs some token beyond the lightest ones, which together stay below the share, and as many as the heaviest need.
    """
    squares = sorted((w * w, t) for t, w in vector.items())
    needed = max(threshold - ROUNDING, 0.0) ** 2 * sum(x for x, _ in squares) * (1 - 1e-9)
    heavy, light, most, least = set(), 0.0, 0.0, 0
    for x, token in squares:
        light += x
        if light >= needed:
            heavy.add(token)
    for x, _ in reversed(squares):
        if most >= needed:
            break
        most, least = most + x, least + 1
    return heavy, least, needed


def _any(conditions: list[Column]) -> Column:
    found = F.lit(False)
    for one in conditions:
        found = found | one
    return found


def _texts(words: set[str] | Vector) -> Column:
    """A constant list."""
    return F.split(F.lit(" ".join(sorted(words))), " ")


def _may_reach(found: Column, vectors: Mapping[Template, Vector], threshold: float) -> Column:
    """Whether the tokens may reach the threshold with some template. No unit that does is left out."""
    needs = [(*_needs(v, threshold)[:2], v) for v in vectors.values()]
    heavy = sorted(set().union(*(h for h, _, _ in needs)))
    enough = [F.size(F.array_intersect(found, _texts(v))) >= least for _, least, v in needs]
    return F.exists(found, lambda t: t.isin(heavy)) & _any(enough)


def _stretches(rows: DataFrame, vectors: Mapping[Template, Vector], sizes: Mapping[Template, int], threshold: float) -> DataFrame:
    """id, place, tokens: stretches as long as a notice that may reach the threshold with it."""
    present = F.array_intersect(F.col("tokens"), _texts(set().union(*vectors.values())))
    # explode_outer, since filters on its rows are not moved below the splitting of words
    rows = rows.select("id", "tokens", F.explode_outer(F.array(present)).alias("present"))
    wanted = []
    for name, vector in vectors.items():
        heavy, least, needed = _needs(vector, threshold)
        held = F.aggregate("present", F.lit(0.0), _added(_squares(vector)))
        notice = F.struct(F.lit(sizes[name]).alias("n"), F.lit(least).alias("least"), _texts(vector).alias("words"), _texts(heavy).alias("heavy"))
        wanted.append(F.when((F.size("present") >= least) & (held >= needed), notice))
    rows = rows.where(F.size("present") > 0).select("id", "tokens", F.explode_outer(F.array(*wanted)).alias("notice"))
    rows = rows.where("notice is not null").select("id", "tokens", "notice.*")
    last = F.greatest(F.size("tokens") - F.col("n"), F.lit(0))
    hits = F.filter(F.sequence(F.lit(0), F.size("tokens") - 1), lambda i: F.array_contains("heavy", F.get("tokens", i)))
    starts = F.transform(hits, lambda i: F.sequence(F.least(F.greatest(i - F.col("n") + 1, F.lit(0)), last), F.least(i, last)))
    starts = F.array_distinct(F.flatten(starts))
    starts = F.filter(starts, lambda i: F.size(F.array_intersect(F.slice("tokens", i + 1, F.col("n")), F.col("words"))) >= F.col("least"))
    rows = rows.select("id", "tokens", "n", F.explode(starts).alias("place"))
    return rows.select("id", "place", F.slice("tokens", F.col("place") + 1, F.col("n")).alias("tokens"))


def _added(squares: Column):
    return lambda total, token: total + F.coalesce(F.try_element_at(squares, token), F.lit(0.0))


def _squares(vector: Vector) -> Column:
    squares = F.split(F.lit(" ".join(repr(w * w) for _, w in sorted(vector.items()))), " ").cast("array<double>")
    return F.map_from_arrays(_texts(vector), squares)


def _heads(rows: DataFrame) -> DataFrame:
    """id, place, tokens: licence files as a whole, and the comments at the head of all files."""
    lines = F.split("text", "\n")
    ends = F.array_position(F.transform(lines, lambda x: x.rlike(COMMENT)), False).cast("int")
    led = F.array_join(F.when(ends == 0, lines).otherwise(F.slice(lines, 1, F.greatest(ends - 1, F.lit(0)))), "\n")
    block = F.concat(*[F.regexp_extract("text", BLOCK, i) for i in (1, 2, 3)])
    whole = F.when(F.col("path").rlike(LICENCE_FILE), F.col("text"))
    heads = rows.select("id", F.posexplode(F.array(whole, F.when(block != "", block).otherwise(led))).alias("place", "said"))
    return heads.where("said <> ''").select("id", "place", tokens(F.col("said")).alias("tokens"))


def _spdx(rows: DataFrame) -> DataFrame:
    """id, rank, s, template, place of the first SPDX tag of a file."""
    tag = rows.where(F.col("text").rlike("(?i)SPDX-License-Identifier:")).select("id", F.regexp_extract("text", SPDX, 1).alias("tag"))
    name = F.regexp_replace(F.col("tag"), SPDX_EXTRA, "")
    name = F.when(name.rlike(r"^\([^()]*\)$"), F.regexp_replace(name, r"[()]", "")).otherwise(name)
    known = sorted({*TEMPLATES, *(f.name.removesuffix(".txt") for f in TEXTS.glob("*.txt"))})
    spelled = F.create_map(*[F.lit(x) for one in known for x in (one.lower(), one)])
    name = F.coalesce(F.try_element_at(spelled, F.lower(name)), name)
    return tag.select("id", F.lit(0).alias("rank"), F.lit(-1.0).alias("s"), name.alias("template"), F.lit(0).alias("place")).where("template <> ''")


def _titles(lines: DataFrame) -> DataFrame:
    """id, rank, s, template, place of lines that are the title of a licence."""
    short = lines.where(F.length("said") <= LONGEST_TITLE).where(F.col("said").rlike("(?i)licen[sc]e"))
    said = F.replace(F.array_join(tokens(F.col("said")), " "), F.lit("licence"), F.lit("license"))
    name = F.try_element_at(F.create_map(*[F.lit(x) for pair in TITLES.items() for x in pair]), said)
    return short.select("id", F.lit(2).alias("rank"), F.lit(-1.0).alias("s"), name.alias("template"), F.col("line").alias("place")).where("template is not null")


def file_licences(files: DataFrame, path: str = "path", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """row (all columns of the file as a struct), path, id, licence and score of its best unit, or NULL.

    The id is the place of a file in its scan, given once and used by all later joins: the files should come from a table,
    whose scan numbers them alike each time, and not from a shuffle.
    """
    spark = files.sparkSession
    rows = files.select(F.struct("*").alias("row"), F.col(path).alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("id", F.monotonically_increasing_id())
    n, held = rows.count(), stored(files_with(rows))
    counts = _all_templates()
    known = _weights(held, n, sorted({t for c in counts.values() for t in c}))
    vectors = {name: {t: tf * known[t] for t, tf in c.items()} for name, c in counts.items()}
    notices, whole = ({name: v for name, v in vectors.items() if name[0] == kind} for kind in ("notice", "whole"))

    lines = rows.select("id", F.posexplode(F.split("text", "\n")).alias("line", "said"))
    said = lines.select("id", F.col("line").alias("place"), tokens(F.col("said")).alias("tokens"))
    said = said.where(_may_reach(F.col("tokens"), notices, threshold))
    sizes = {name: sum(counts[name].values()) for name in notices}
    stretches = _stretches(rows.select("id", tokens(F.col("text")).alias("tokens")), notices, sizes, threshold)
    heavy = set().union(*(_needs(v, WHOLE)[0] for v in whole.values()))
    heads = _heads(rows).where(F.arrays_overlap("tokens", _texts(heavy)))
    units = heads.select(F.lit("whole").alias("kind"), "*").unionByName(said.unionByName(stretches).select(F.lit("notice").alias("kind"), "*"))
    # A notice that many files repeat is compared once.
    units = stored(units.withColumn("unit", F.md5(F.array_join("tokens", " ").cast("binary"))))
    once = units.groupBy("kind", "unit").agg(F.first("tokens").alias("tokens"))
    counted = once.select("kind", "unit", F.explode("tokens").alias("token")).groupBy("kind", "unit", "token").agg(F.count("*").alias("tf"))
    weighted = counted.join(held, "token").withColumn("w", F.col("tf") * weight(F.col("df"), n))
    length = weighted.groupBy("kind", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    products = weighted.join(F.broadcast(_templates(spark, vectors)), ["kind", "token"])
    products = products.groupBy("kind", "unit", "template", "number", "norm").agg(F.sum(F.col("w") * F.col("t")).alias("dot"))
    score = F.round(F.col("dot") / (F.col("norm") * F.col("length")), 6)
    cosines = products.join(length, ["kind", "unit"]).select("kind", "unit", "template", (-score).alias("s"))
    cosines = cosines.where(-F.col("s") >= F.when(F.col("kind") == "whole", WHOLE).otherwise(threshold))
    likeliest = cosines.groupBy("kind", "unit").agg(F.min(F.struct("s", "template")).alias("best"))
    compared = units.select("id", "kind", "unit", "place").join(likeliest, ["kind", "unit"])
    compared = compared.select("id", F.when(F.col("kind") == "whole", 1).otherwise(2).alias("rank"), "best.s", "best.template", "place")
    every = compared.unionByName(_spdx(rows)).unionByName(_titles(lines))
    best = every.groupBy("id").agg(F.min(F.struct("rank", "s", "template", "place")).alias("best"))
    found = rows.select("row", "path", "id").join(best, "id", "left")
    return found.select("row", "path", "id", F.col("best.template").alias("licence"), (-F.col("best.s")).alias("score"))


def inherit(found: DataFrame) -> DataFrame:
    """Adds effective (own or inherited licence, or UNKNOWN) and from_path (the licence file it comes from, or the file itself)."""
    folder = F.regexp_replace("path", r"[^/]*$", "")
    given = found.where(F.col("path").rlike(LICENCE_FILE)).groupBy(folder.alias("folder"))
    score, name = F.coalesce("score", F.lit(0.0)), F.coalesce("licence", F.lit(UNKNOWN))
    given = given.agg(F.min(F.struct((-score).alias("s"), F.col("path").alias("from_path"), name.alias("licence"))).alias("given"))
    parts = F.split(folder, "/")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda n: F.struct(n.alias("depth"), F.when(n == 0, "").otherwise(F.concat(F.array_join(F.slice(parts, 1, n), "/"), F.lit("/"))).alias("folder")),
    )
    bare = found.where("licence is null and path is not null").select("id", F.explode(above).alias("up"))
    nearest = bare.select("id", "up.*").join(given, "folder").groupBy("id").agg(F.max_by("given", "depth").alias("given"))
    return found.join(nearest, "id", "left").select(
        "row",
        "path",
        "licence",
        "score",
        F.coalesce("licence", "given.licence").alias("effective"),
        F.when(F.col("licence").isNotNull(), F.col("path")).otherwise(F.col("given.from_path")).alias("from_path"),
    )


def scan(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    return inherit(file_licences(files, path, text))
