"""Quality rules: a table of thresholds compiled into projections of built-in functions.

Words are runs of characters other than blank and the controls 9 to 13. NULL and empty texts have no words, fail the
base rule and are not kept. Repeated rows are judged alike, one result row each. Columns of the input other than the
text are carried along untouched by `filter_quality`; `measure` returns the id and the measures only, so
that no name can clash.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Frequent function words of English, German, French and Spanish (fixed values).
STOP_WORDS = (
    "a an and are as at be by for from has in is it of on or that the this to was were with "
    "als auf bei das dem den der des die ein eine für im ist mit nicht sich sie und von zu "
    "au aux ce dans de des du elle en est et il la le les ne pas pour que qui sur un une "
    "al como con del el en es la las lo los no para por que se su un una y"
).split()


class Rule(NamedTuple):
    """`part / whole` must lie between low and high in texts of at least `from_words` words."""

    name: str
    part: str
    whole: str
    low: float
    high: float
    from_words: int = 0


RULES = (
    Rule("word_length", "word_chars", "n_words", 1.5, 25.0),
    Rule("symbols", "n_symbols", "n_words", 0.0, 0.2),
    Rule("exclamations", "n_exclamations", "n_words", 0.0, 0.4),
    Rule("stop_words", "n_stop_words", "n_words", 0.005, 1.0, 100),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 0.0, 0.5),
)


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _repeat_words(words: Column) -> Column:
    """Words inside windows that occur twice or more. Windows are compared by 64-bit hashes."""

    def cover(places: Column) -> Column:
        step = F.transform(places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(step, F.lit(0), lambda total, s: total + s)

    def repeats(ordered: Column) -> Column:
        same = F.filter(
            ordered,
            lambda e, i: F.get(ordered, i - 1)["h"].eqNullSafe(e["h"])
            | F.get(ordered, i + 1)["h"].eqNullSafe(e["h"]),
        )
        return _let(F.sort_array(F.transform(same, lambda e: e["i"])), cover)

    def count(hashes: Column) -> Column:
        numbered = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
            _let(F.sort_array(numbered), repeats)
        )

    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) <= WINDOW, 0).otherwise(_let(hashes, count))


def measures(text: Column) -> dict[str, Column]:
    """The measures of one text, as one column each; `words` and `lines` come from `with_words`."""
    words, lines = F.col("_words"), F.col("_lines")
    length = F.length(text)
    stop = sorted(set(STOP_WORDS))
    return {
        "n_words": F.size(words),
        "word_chars": _without(text, BLANKS),
        "n_symbols": length - _without(text, SYMBOLS),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeat_words(words),
        "n_exclamations": length - _without(text, "!"),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(*stop))),
    }


def with_measures(rows: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """row (all input columns as a struct), the measures, base_failed, failed (names of rules), kept."""
    whole = F.coalesce(F.col("_text"), F.lit(""))
    split = rows.select(F.struct("*").alias("row"), F.col(text).alias("_text")).select(
        "row",
        whole.alias("_text"),
        F.filter(F.split(whole, "[ \\t-\\r]+"), lambda w: w != "").alias("_words"),
        F.filter(F.split(whole, "\n"), lambda line: F.translate(line, BLANKS, "") != "").alias("_lines"),
    )
    measured = split.select("row", *[c.cast("long").alias(name) for name, c in measures(F.col("_text")).items()])
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return measured.select("*", base.alias("base_failed"), failures(rules).alias("failed")).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed") == 0)
    )


def failures(rules: tuple[Rule, ...]) -> Column:
    """The table of thresholds as one expression: the names of the rules that a row breaks."""

    def broken(rule: Rule) -> Column:
        share = F.col(rule.part) / F.nullif(F.col(rule.whole), F.lit(0))
        outside = (F.col("n_words") >= rule.from_words) & ~share.between(rule.low, rule.high)
        return F.when(outside, F.lit(rule.name))

    return F.array_compact(F.array(*[broken(rule) for rule in rules]))


def measure(rows: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    judged = with_measures(rows, text, rules)
    return judged.select(F.col("row")[key].alias(key), *[c for c in judged.columns if c != "row"])


def filter_quality(rows: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that no rule rejects, with the columns they came with."""
    judged = with_measures(rows, text, rules).select("row", "kept", F.monotonically_increasing_id().alias("number"))
    # The number keeps the optimizer from moving the filter below the splitting, where it would split a text per window.
    return judged.where(F.col("kept") & (F.col("number") >= 0)).select("row.*")
