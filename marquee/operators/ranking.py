"""Top rows, top rows per group, shares of a group, samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .order_statistics import first_of_groups

PIECES = 4_096  # pieces of a group when its first n rows are found in two steps


def top(rows: DataFrame, n: int, by: str, tie: str = "id") -> DataFrame:
    """The n rows with the largest `by`, equal ones by the smaller `tie`, NULLs last."""
    return rows.orderBy(F.col(by).desc_nulls_last(), F.col(tie)).limit(n)


def several_tops(
    rows: DataFrame, picks: dict[str, tuple[Column | str, int]], tie: str = "id", among: dict[str, Column] | None = None
) -> DataFrame:
    """Several rankings from one pass over the rows: their columns, `ranking` (the name) and `ranked_by` (the value, as double).

    A pick is a numeric column and a number of rows, largest first, equal ones by the smaller `tie`, NULLs last. `among` names conditions that
    rows of a ranking must meet.
    """
    entries = []
    for name, (by, n) in picks.items():
        value = (F.col(by) if isinstance(by, str) else by).cast("double")
        entry = F.struct(F.lit(name).alias("ranking"), value.alias("ranked_by"), F.lit(n).alias("wanted"))
        entries.append(F.when(among[name], entry) if name in (among or {}) else entry)
    each = rows.withColumn("pick", F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())))
    most = max(n for _, n in picks.values())
    order = [F.col("ranked_by").desc_nulls_last(), F.col(tie)]
    best = top_per_group(each.select(*rows.columns, "pick.*"), ["ranking"], most, order, "place_in_ranking")
    return best.where(F.col("place_in_ranking") <= F.col("wanted")).drop("wanted", "place_in_ranking")


def top_per_group(rows: DataFrame, keys: list[str], n: int, order: list[Column], rank: str = "rank") -> DataFrame:
    """The first n rows of each group.

    Spark cuts every partition to n rows per group before the shuffle, as long as n is below a limit of the
    optimizer. For a larger n the groups are cut in two steps, first in many random pieces.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    if n > int(rows.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        plain = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]  # maps have no hash
        piece = F.pmod(F.xxhash64(*plain), F.lit(PIECES))
        within = Window.partitionBy(*keys, "piece").orderBy(*order)
        rows = (
            rows.withColumn("piece", piece)
            .withColumn("piece_rank", F.row_number().over(within))
            .where(F.col("piece_rank") <= n)
            .drop("piece", "piece_rank")
        )
    return rows.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def first_share(
    rows: DataFrame, keys: list[str], by: str, tie: str, size: Callable[[Column], Column], ranges: int | None = None
) -> DataFrame:
    """The first `size(n)` rows of each group of n rows: largest `by` first, then smallest `tie`.

    `by` and `tie` may be of any ordered type; `tie` must be unique within a group. The size of the share depends on the data, so
    rows cannot be cut before the shuffle; they are ranked across ranges, so a group may be of any size.
    """
    return first_of_groups(rows, keys, [F.col(by).desc(), F.col(tie)], size, ranges)


def percent_or_count(percent: float | None = None, count: int | None = None) -> Callable[[Column], Column]:
    """The size rule of a sample: a count when given, else a percentage of the group, rounded down."""
    if count is not None:
        return lambda n: F.least(F.lit(count), n)
    if percent is None:
        raise ValueError("give a percentage or a count")
    if not 0 <= percent <= 100:
        raise ValueError("the percentage must lie in [0, 100]")
    return lambda n: F.floor(F.lit(float(percent)) * n / 100)


def text_order(*columns: Column, seed: int = 0) -> Column:
    """A repeatable pseudo-random number in [0, 2**60) from the given columns and the seed."""
    texts = [c.cast("string") for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts, F.lit(str(seed)))), 1, 15), 16, 10).cast("bigint")


def sample_rows(rows: DataFrame, n: int, key: str = "id", seed: int = 0) -> DataFrame:
    """n rows in a repeatable random order."""
    return rows.orderBy(text_order(F.col(key), seed=seed), key).limit(n)
