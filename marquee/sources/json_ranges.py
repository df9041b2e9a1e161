"""Large JSON files read by many tasks: `{id: record}` and `{field: {id: value}}`, in any spacing.

Spark cuts a file into byte ranges and reads them in pieces that end in a separator, `}` or `,`. A piece alone does not tell whether its
separator stands in a string, nor how deep. But the number of quotes before it tells the first, and then the brackets
outside of strings the second; both are sums. So a first pass adds them up per range, for a range that begins inside a string and for one
that does not; the sums of earlier ranges say how each range begins; and the second pass cuts the pieces of a range between entries.
An entry that lies across ranges is put together from its fragments. No task reads more than its range.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..storage import stored

BROADCAST_RANGES = 1 << 20  # ranges up to which their states are broadcast


@dataclass(frozen=True)
class Form:
    """How entries lie in a file: the separator that ends pieces, and the depth at which entries lie next to each other."""

    separator: str
    depth: int

    def ends(self, depth: np.ndarray, in_string: np.ndarray) -> np.ndarray:
        """Where an entry ends, given the state after each piece and its separator."""
        return ~in_string & (depth <= self.depth)


#: Entries of `{id: {...}}` end where a brace leads back to depth 1; entries of `{field: {id: value}}` at a comma of depth 2 or 1.
BY_ID, BY_FIELD = Form("}", 1), Form(",", 2)


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def pieces(spark: SparkSession, path: str, form: Form) -> DataFrame:
    """file, start (of the range), value, quotes, and the change of depth if the piece begins outside (0) or inside (1) a string."""
    rows = spark.read.option("lineSep", form.separator).text(path)
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    stretches = F.split(bare, '"', -1)
    quotes = F.size(stretches) - 1

    def change(begin: int) -> Column:
        outside = F.array_join(F.filter(stretches, lambda _, i: i % 2 == begin), "")
        own = -1 if form.separator == "}" else 0
        last = F.when((quotes + begin) % 2 == 0, own).otherwise(0)
        return (_count(outside, "{[") - _count(outside, "}]") + last).cast("bigint")

    block = F.col("_metadata.file_block_start")
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        block.alias("start"),
        "value",
        (quotes % 2).cast("bigint").alias("odd"),
        change(0).alias("change_0"),
        change(1).alias("change_1"),
    )


def _ranges(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """The stretches of rows of one range: file, start, first row, row after the last."""
    files, starts = batch.column("file").to_pylist(), batch.column("start").to_numpy()
    cuts = [0, *(i for i in range(1, len(files)) if starts[i] != starts[i - 1] or files[i] != files[i - 1]), len(files)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield files[a], int(starts[a]), a, b


def _columns(batch: pa.RecordBatch, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(batch.column(c).to_numpy()[a:b] for c in ("odd", "change_0", "change_1"))


def range_states(cut: DataFrame, form: Form) -> DataFrame:
    """file, start, and how the range begins: in_string and depth. One row per range. A file that ends within an object is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], list[int]] = {}
        for batch in batches:
            for file, start, a, b in _ranges(batch):
                odd, *changes = _columns(batch, a, b)
                done = sums.setdefault((file, start), [0, 0, 0])
                before = done[0] + np.cumsum(odd) - odd
                for begin in (0, 1):
                    inside = (before + begin) % 2 == 1
                    done[1 + begin] += int(np.where(inside, changes[1], changes[0]).sum())
                done[0] += int(odd.sum())
        keys = list(sums)
        columns = [[f for f, _ in keys], [s for _, s in keys], *([sums[k][i] for k in keys] for i in range(3))]
        kinds = [pa.string(), *[pa.int64()] * 4]
        names = ["file", "start", "odd", "change_0", "change_1"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    totals = cut.select("file", "start", "odd", "change_0", "change_1").mapInArrow(
        run, "file string, start bigint, odd bigint, change_0 bigint, change_1 bigint"
    )
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    strings = totals.withColumn("in_string", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    change = F.when(F.col("in_string") == 0, F.col("change_0")).otherwise(F.col("change_1"))
    depths = strings.withColumn("change", change).withColumn("depth", F.coalesce(F.sum("change").over(earlier), F.lit(0)))
    # The rest of a file behind its last brace is a piece too, and counts a brace that is not there.
    least = -1 if form.separator == "}" else 0
    last = F.lead("start").over(Window.partitionBy("file").orderBy("start")).isNull()
    open_end = ((F.col("in_string") + F.col("odd")) % 2 != 0) | ~(F.col("depth") + F.col("change")).between(least, 0)
    wrong = F.raise_error(F.concat(F.lit("the file ends within an object: "), F.col("file"))).cast("bigint")
    return depths.select("file", "start", "in_string", F.when(last & open_end, wrong).otherwise(F.col("depth")).alias("depth"))


def _object_ends(value: str, depth: int, inside: bool) -> list[int]:
    """The places in a piece behind which the object of a file has been closed."""
    out, skip = [], False
    for at, c in enumerate(value):
        if skip:
            skip = False
        elif c == "\\":
            skip = True
        elif c == '"':
            inside = not inside
        elif not inside and c in "{[":
            depth += 1
        elif not inside and c in "}]":
            depth -= 1
            if depth == 0:
                out.append(at + 1)
    return out


FRAGMENTS = "file string, start bigint, kind int, number bigint, name string, depth bigint, depth_after bigint, text string"
WHOLE, HEAD, TAIL, THROUGH = range(4)  # entries within a range; its beginning, its end, or all of it as a part of an entry
NAME = re.compile(r'\s*\{?\s*"((?:[^"\\]|\\.)*)"\s*:\s*\{', re.S)
BETWEEN = re.compile(r"\}\s*\{")


class _Cutter:
    """Cuts the pieces of one range after the other into entries."""

    def __init__(self, form: Form):
        self.form = form
        self.range: tuple[str, int] | None = None
        self.out: list[tuple] = []

    def begin(self, key: tuple[str, int], inside: int, depth: int) -> None:
        self.finish()
        self.range, self.inside, self.depth = key, inside, depth
        self.held: list[str] = []
        self.began, self.entries, self.name = depth, 0, None

    def finish(self) -> None:
        if self.range is not None and self.held:
            self._close(TAIL if self.entries else THROUGH, self.depth)

    def _close(self, kind: int, after: int) -> None:
        text = "".join(self.held)
        if kind == WHOLE and self.form == BY_FIELD and self.began < 2 and (named := NAME.match(text)):
            self.name = named[1]
        self.out.append((*self.range, kind, self.entries, self.name, self.began, after, text))
        self.held, self.began = [], after

    def _entry(self, after: int) -> None:
        self._close(WHOLE if self.entries else HEAD, after)
        self.entries += 1

    def add(self, values: list[str], odd: np.ndarray, zero: np.ndarray, one: np.ndarray) -> None:
        after_odd = (self.inside + np.cumsum(odd)) % 2
        before_odd = np.concatenate([[self.inside], after_odd[:-1]])
        depths = self.depth + np.cumsum(np.where(before_odd == 1, one, zero))
        before = np.concatenate([[self.depth], depths[:-1]])
        ends = self.form.ends(depths, after_odd == 1)
        for value, end, was, within, after in zip(values, ends.tolist(), before.tolist(), before_odd.tolist(), depths.tolist()):
            if self.form == BY_FIELD and BETWEEN.search(value):
                # One object ends here and another begins.
                done = 0
                for at in _object_ends(value, was, within == 1):
                    self.held.append(value[done:at] + self.form.separator)
                    self._entry(0)
                    done = at
                value = value[done:]
            self.held += [value, self.form.separator]
            if end:
                self._entry(after)
        self.depth, self.inside = int(depths[-1]), int(after_odd[-1])

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        columns = list(zip(*self.out)) or [[]] * len(kinds)
        self.out = []
        names = [c.split()[0] for c in FRAGMENTS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def fragments(cut: DataFrame, states: DataFrame, form: Form) -> DataFrame:
    """The entries of each range as texts, with the depth before and after them, and what is left at its ends."""
    left = cut.withColumn("place", F.monotonically_increasing_id())
    if states.count() <= BROADCAST_RANGES:
        rows = left.join(F.broadcast(states), ["file", "start"])
    else:
        rows = left.join(states, ["file", "start"]).repartition("file", "start").sortWithinPartitions("file", "start", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _Cutter(form)
        for batch in batches:
            values = batch.column("value").to_pylist()
            for file, start, a, b in _ranges(batch):
                if (file, start) != cutter.range:
                    cutter.begin((file, start), *(int(batch.column(c)[a].as_py()) for c in ("in_string", "depth")))
                cutter.add(values[a:b], *_columns(batch, a, b))
            if len(cutter.out) > 2_000:
                yield cutter.batch()
        cutter.finish()
        yield cutter.batch()

    return rows.select("file", "start", "value", "odd", "change_0", "change_1", "in_string", "depth").mapInArrow(run, FRAGMENTS)


def entries(spark: SparkSession, path: str, form: Form) -> tuple[DataFrame, DataFrame]:
    """The entries within ranges and those across them: file, start, number, name, depth, depth_after, text.

    An entry across ranges goes by the range in which it ends, where it is the first.
    """
    cut = pieces(spark, path, form)
    found = stored(fragments(cut, stored(range_states(cut, form)), form))
    parts = found.where(F.col("kind") != WHOLE)
    # A head ends an entry, so fragments up to and with it have one number. Only their places are put in order here.
    earlier = Window.partitionBy("file").orderBy("start", "later").rowsBetween(Window.unboundedPreceding, -1)
    places = parts.select("file", "start", "kind", (F.col("kind") == TAIL).cast("int").alias("later"))
    ended = F.coalesce(F.sum((F.col("kind") == HEAD).cast("bigint")).over(earlier), F.lit(0)).alias("entry")
    pieced = (
        parts.join(places.select("file", "start", "kind", ended), ["file", "start", "kind"])
        .groupBy("file", "entry")
        .agg(F.array_sort(F.collect_list(F.struct("start", "kind", "depth", "depth_after", "text"))).alias("parts"))
    )
    first, last = F.element_at("parts", 1), F.element_at("parts", -1)
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    across = pieced.select("file", last["start"].alias("start"), first["depth"].alias("depth"), last["depth_after"].alias("depth_after"), text.alias("text"))
    return found.where(F.col("kind") == WHOLE).drop("kind"), across


def _parsed(rows: DataFrame, kind: T.DataType | str) -> Column:
    """The JSON of an entry with the braces around it that lie outside of it."""
    before = F.when(F.col("depth") <= 0, "").when(F.col("depth") == 1, "{").otherwise(F.concat(F.lit('{"'), "name", F.lit('":{')))
    whole = F.concat(before, "body", F.repeat(F.lit("}"), F.greatest(F.col("depth_after"), F.lit(0)).cast("int")))
    parsed = F.from_json(whole, kind)
    wrong = F.raise_error(F.concat(F.lit("not an entry of a JSON object: "), F.substring("text", 1, 200)))
    return F.when(parsed.isNotNull(), parsed).otherwise(wrong)


def read_keyed_ranges(spark: SparkSession, path: str, schema: T.StructType, key: str = "id") -> DataFrame:
    """Files of `{id: record}` objects -> one row per id, a single large file by many tasks."""
    within, across = entries(spark, path, BY_ID)
    names = ["depth", "depth_after", "text"]
    rows = within.select(names).unionByName(across.select(names)).withColumn("body", F.regexp_replace("text", r"^\s*,", ""))
    # What stands between the last entry and the end of its object, and behind that, is no entry.
    rows = rows.where(~F.col("body").rlike(r"^\s*\}?\s*$")).withColumn("name", F.lit(""))
    return rows.select(F.explode(_parsed(rows, T.MapType(T.StringType(), schema))).alias(key, "record")).select(key, "record.*")


def read_by_column_ranges(spark: SparkSession, path: str, columns: list[str], key: str = "id") -> DataFrame:
    """Files of `{field: {id: value}}` objects -> one row per id with the given columns, all of them text."""
    within, across = entries(spark, path, BY_FIELD)
    across = stored(across.withColumn("name", F.when(F.col("depth") < 2, F.nullif(F.regexp_extract("text", NAME.pattern, 1), F.lit("")))))
    # The name of a field stands before its first value; other values go by the last name before them, which may lie ranges back.
    heads = across.select("file", "start", F.col("name").alias("head_name"))
    last = within.groupBy("file", "start").agg(F.max_by("name", F.when(F.col("name").isNotNull(), F.col("number"))).alias("last_name"))
    known = heads.join(last, ["file", "start"], "full")
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(F.coalesce("last_name", "head_name"), ignorenulls=True).over(earlier).alias("name_before")
    known = stored(known.select("file", "start", "head_name", before))
    if known.count() <= BROADCAST_RANGES:
        known = F.broadcast(known)
    names = ["depth", "depth_after", "text", "name"]
    named = [
        part.join(known, ["file", "start"]).withColumn("name", F.coalesce("name", *others)).select(names)
        for part, others in ((within, ["head_name", "name_before"]), (across, ["name_before"]))
    ]
    rows = named[0].unionByName(named[1]).withColumn("body", F.regexp_replace("text", r",$", "")).where(F.trim("body") != "")
    cells = (
        rows.select(F.explode(_parsed(rows, "map<string,map<string,string>>")).alias("field", "column"))
        .select("field", F.explode("column").alias(key, "value"))
        .where(F.col("field").isin(columns))
    )
    return cells.groupBy(key).pivot("field", columns).agg(F.first("value"))
