"""Values and rows at given ranks, exact, for groups of any size and any ordered type.

Rows are put in order across ranges: a range partitioning over the group and the order, so that a large group lies in many
ranges. The sizes of its ranges, added up from the first on, say which range holds a wanted rank and how far into it the
rank is. No group is sorted by one task, and nothing is looked up by an estimate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..storage import stored

RANGE, PLACE = "range_no", "place_in_range"


def ranges_of(rows: DataFrame, order: list[Column], ranges: int | None = None) -> DataFrame:
    """The rows in ranges of `order`, sorted, with the number of the range and their place in it; written once."""
    count = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(count, *order).sortWithinPartitions(*order)
    # The number of a row is made of its partition and its place there.
    return stored(ordered.withColumn(PLACE, F.monotonically_increasing_id()).withColumn(RANGE, F.shiftright(F.col(PLACE), 33)))


def range_offsets(ranged: DataFrame, keys: list[str], here: Column) -> DataFrame:
    """Per group: n, and `parts`, its ranges in order, as structs of range_no, start, here, before.

    `here` counts a range's rows and `before` those of the group's earlier ranges. A group has at most as many parts as there are ranges.
    """
    sizes = ranged.groupBy(RANGE, *keys).agg(here.alias("here"), F.min(PLACE).alias("start"))
    parts = F.array_sort(F.collect_list(F.struct(RANGE, "start", "here")))
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.expr("cast(array() as array<struct<range_no:bigint,start:bigint,here:bigint,before:bigint>>)").alias("parts"))

    def add(done: Column, part: Column) -> Column:
        one = F.struct(part[RANGE].alias(RANGE), part["start"].alias("start"), part["here"].alias("here"), done["n"].alias("before"))
        return F.struct((done["n"] + part["here"]).alias("n"), F.concat(done["parts"], F.array(one)).alias("parts"))

    return sizes.groupBy(*keys).agg(F.aggregate(parts, zero, add).alias("sums")).select(*keys, "sums.*")


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality on the keys in which NULL equals NULL; left and right must be aliased `l` and `r`."""
    both = [F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`")) for k in keys]
    return both[0] if len(both) == 1 else F.expr("true") if not both else both[0] & same_keys(left, right, keys[1:])


def first_of_groups(
    rows: DataFrame, keys: list[str], order: list[Column], size: Callable[[Column], Column], ranges: int | None = None
) -> DataFrame:
    """The first `size(n)` rows of each group of n rows in the given order, which must not leave two rows equal.

    Groups of any size; the rows of a group may have keys that are NULL.
    """
    ranged = ranges_of(rows, [*[F.col(k) for k in keys], *order], ranges)
    offsets = range_offsets(ranged, keys, F.count("*"))
    wanted = F.least(F.greatest(size(F.col("n")).cast("bigint") - F.col("p.before"), F.lit(0)), F.col("p.here"))
    kept = (
        offsets.select(*keys, "n", F.explode("parts").alias("p"))
        .select(*keys, F.col(f"p.{RANGE}").alias(RANGE), (F.col("p.start") + wanted).alias("stop"), wanted.alias("wanted"))
        .where("wanted > 0")
    )
    left, right = ranged.alias("l"), kept.alias("r")
    here = same_keys(left, right, [RANGE, *keys]) & (F.col(f"l.{PLACE}") < F.col("r.stop"))
    return left.join(right, here).select(*[F.col(f"l.`{c}`").alias(c) for c in rows.columns])


def values_at_ranks(
    rows: DataFrame,
    value: str,
    spans: Callable[[Column], list[tuple[Column, Column]]],
    keys: tuple[str, ...] = (),
    ranges: int | None = None,
) -> DataFrame:
    """The values at 0-based ascending ranks; NULL values have no rank.

    `spans(n)` lists pairs of ranks (first, last) made from the group size n; slot i of the result belongs to pair i.
    Result: keys, slot, n, first_value, last_value.
    Equal values of a group are counted before anything is put in order, so a value may be as frequent as it likes.
    """
    keys = list(keys)
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("cell")).agg(F.count("*").alias("rows_here"))
    ranged = ranges_of(counted, [*[F.col(k) for k in keys], F.col("cell")], ranges)
    offsets = range_offsets(ranged, keys, F.sum("rows_here"))
    slots = F.array(
        *[
            F.struct(F.lit(i).alias("slot"), first.cast("bigint").alias("first"), last.cast("bigint").alias("last"))
            for i, (first, last) in enumerate(spans(F.col("n")))
        ]
    )
    # Only the ranges that hold a wanted rank are looked into.
    holds = [(F.col("p.before") <= F.col(f"s.{r}")) & (F.col(f"s.{r}") < F.col("p.before") + F.col("p.here")) for r in ("first", "last")]
    wanted = (
        offsets.withColumn("slots", slots)
        .select(*keys, "n", "slots", F.explode("parts").alias("p"))
        .select(*keys, "n", "p", F.explode("slots").alias("s"))
        .where(holds[0] | holds[1])
        .select(*keys, "n", "s.*", F.col(f"p.{RANGE}").alias(RANGE), F.col("p.before").alias("before"))
    )
    looked = wanted.select(RANGE, "before", *keys).distinct()
    left, right = ranged.alias("l"), looked.alias("r")
    rows_there = left.join(right, same_keys(left, right, [RANGE, *keys])).select("l.*", "r.before")
    upward = Window.partitionBy(RANGE, *keys).orderBy("cell")
    running = rows_there.withColumn("up_to", F.col("before") + F.sum("rows_here").over(upward))
    left, right = wanted.alias("r"), running.alias("l")
    both = right.join(left, same_keys(right, left, [RANGE, *keys]))

    def at(rank: str) -> Column:
        below = F.col("l.up_to") - F.col("l.rows_here")
        return F.max(F.when((below <= F.col(f"r.{rank}")) & (F.col(f"r.{rank}") < F.col("l.up_to")), F.col("l.cell")))

    return both.groupBy(*[F.col(f"r.`{k}`").alias(k) for k in keys], F.col("r.slot").alias("slot"), F.col("r.n").alias("n")).agg(
        at("first").alias("first_value"), at("last").alias("last_value")
    )


def quantiles(
    rows: DataFrame,
    value: str,
    fractions: list[float],
    keys: tuple[str, ...] = (),
    nearest: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Exact quantiles: keys, q, value.

    Linear between the two neighbouring values, or the nearest one. A position in the middle goes to the
    upper neighbour above the median and to the lower one otherwise.
    """

    def position(n: Column, q: float) -> Column:
        return F.lit(float(q)) * (n - 1)

    def spans(n: Column) -> list[tuple[Column, Column]]:
        pairs = []
        for q in fractions:
            low = F.floor(position(n, q))
            part = position(n, q) - low
            if nearest:
                up = (part > 0.5) | ((part == 0.5) & F.lit(q > 0.5))
                pick = F.when(up, low + 1).otherwise(low)
                pairs.append((pick, pick))
            else:
                pairs.append((low, F.ceil(position(n, q))))
        return pairs

    found = values_at_ranks(rows, value, spans, keys, ranges)
    q = F.element_at(F.array(*[F.lit(float(f)) for f in fractions]), F.col("slot") + 1)
    if nearest:
        return found.select(*keys, q.alias("q"), F.col("first_value").alias("value"))
    place = q * (F.col("n") - 1)
    step = (F.col("last_value") - F.col("first_value")) * (place - F.floor(place))
    return found.select(*keys, q.alias("q"), (F.col("first_value") + step).cast("double").alias("value"))


def column_quantiles(rows: DataFrame, fractions: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """Global quantiles of several numeric columns, found together in one pass over the rows."""
    columns = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in fractions])
    long = rows.select(F.explode(columns).alias("m")).select("m.*")
    every = sorted({q for marks in fractions.values() for q in marks})
    # A few numbers per column.
    found = {(r["measure"], r["q"]): r["value"] for r in quantiles(long, "value", every, ("measure",)).collect()}
    return {c: [found.get((c, float(q))) for q in marks] for c, marks in fractions.items()}
