"""Trimmed ranges, histograms, density, monthly series."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .order_statistics import PLACE, RANGE, column_quantiles, ranges_of


def between_quantiles(rows: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows that lie, in every listed column, between its two quantiles, both ends included."""
    edges = column_quantiles(rows, {c: list(b) for c, b in bounds.items()})
    kept = rows
    for column, (low, high) in edges.items():
        kept = kept.where(F.col(column).cast("double").between(low, high))
    return kept


def below_quantile(rows: DataFrame, column: str, fraction: float) -> DataFrame:
    ((edge,),) = column_quantiles(rows, {column: [fraction]}).values()
    return rows.where(F.col(column).cast("double") < F.lit(edge))


def histogram(rows: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins from the smallest to the largest value, the last bin closed: bin, left, n, density.

    Empty bins are kept. density integrates to one.
    """
    present = rows.where(F.col(column).isNotNull())
    measured = F.col(column).cast("double")
    limits = present.agg(F.struct(F.min(measured).alias("low"), F.max(measured).alias("high")).alias("limits"))
    limit = limits.scalar()
    width = (limit["high"] - limit["low"]) / bins
    number = F.when(width > 0, F.floor((measured - limit["low"]) / width)).otherwise(0)
    counts = (
        present.select(F.least(number, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
    )
    all_bins = rows.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    frame = (
        all_bins.join(counts, "bin", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .withColumn("left", limit["low"] + F.col("bin") * width)
    )
    return frame.select("bin", "left", "n", F.try_divide(F.col("n"), total * width).alias("density"))


CELL_ERROR = 1e-9  # of the highest value a single kernel takes


def density(rows: DataFrame, column: str, points: int = 100) -> DataFrame:
    """Gaussian kernel density at evenly spaced points: i, x, density. The bandwidth is the standard deviation times n ** -1/5.

    The rows are folded into cells that keep count, mean and variance, and the kernel is developed to the second order around a cell's mean. The
    error is then of the third order in cell width over bandwidth, z: at most z^3 / 48 * 1.39 of the highest value of a kernel, and
    the cells are made so narrow that this is at most CELL_ERROR. Their number depends on the spread of the values in
    bandwidths, not on the number of rows.
    """
    measured = F.col(column).cast("double")
    present = rows.where(measured.isNotNull()).select(measured.alias("v"))
    shape = present.agg(F.count("*").alias("n"), F.stddev_samp("v").alias("spread"), F.min("v").alias("low"), F.max("v").alias("high")).first()
    spark = rows.sparkSession
    if not shape["n"] or not shape["spread"]:
        return spark.createDataFrame([], "i int, x double, density double")
    bandwidth = shape["spread"] * shape["n"] ** -0.2
    width = bandwidth * (CELL_ERROR * 48 / 1.39) ** (1 / 3)
    # The grid covers half the value range more on each side, where the kernels fade out.
    reach = shape["high"] - shape["low"]
    start, step = shape["low"] - reach / 2, reach * 2 / (points - 1)
    cells = present.groupBy(F.floor((F.col("v") - shape["low"]) / width).alias("cell")).agg(
        F.count("*").alias("n"), F.avg("v").alias("mean"), F.coalesce(F.var_pop("v"), F.lit(0.0)).alias("variance")
    )
    z = (F.col("x") - F.col("mean")) / bandwidth
    bent = 1 + (z * z - 1) * F.col("variance") / (2 * bandwidth**2)
    kernel = F.exp(-z * z / 2) * bent / (bandwidth * shape["n"] * math.sqrt(2 * math.pi))
    return (
        cells.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", start + step * F.col("i"))
        .groupBy("i", "x")
        .agg(F.sum(F.col("n") * kernel).alias("density"))
    )


def monthly(rows: DataFrame, date: str, measures: dict[str, Column], counts: tuple[str, ...] = ()) -> DataFrame:
    """Aggregates per month, labelled by the last day, without gaps between the first and the last month.

    In a month without rows the columns named in `counts` are 0 and all others NULL.
    """
    months = (
        rows.where(F.col(date).isNotNull())
        .groupBy(F.last_day(date).alias("month"))
        .agg(*[measure.alias(name) for name, measure in measures.items()])
    )
    # One row per calendar month: bounded by the calendar, whatever the number of rows.
    calendar = months.agg(F.min("month").alias("low"), F.max("month").alias("high")).select(
        F.explode(
            F.sequence(F.trunc("low", "month"), F.trunc("high", "month"), F.expr("interval 1 month"))
        ).alias("start")
    )
    filled = calendar.select(F.last_day("start").alias("month")).join(months, "month", "left")
    return filled.withColumns({name: F.coalesce(name, F.lit(0)) for name in counts}) if counts else filled


def rolling_mean(steps: DataFrame, order: str, measured: str, size: int = 5, ranges: int | None = None) -> DataFrame:
    """Mean over the last `size` rows in the order of `order`, fewer at the start. Values of `order` must differ.

    The rows are put in order across ranges; each range also gets the last rows before it, so that no mean is cut at a border.
    """
    ranged = ranges_of(steps, [F.col(order)], ranges)
    last = Window.partitionBy(RANGE).orderBy(F.col(order).desc())
    tails = ranged.withColumn("from_end", F.row_number().over(last)).where(F.col("from_end") < size)
    # At most size - 1 rows per range; they are in order by their place, which counts through all ranges.
    ends = tails.agg(F.array_sort(F.collect_list(F.struct(PLACE, RANGE, F.col(order).alias("o"), F.col(measured).alias("m")))).alias("ends"))
    numbers = ranged.select(RANGE).distinct()
    before = F.filter("ends", lambda e: e[RANGE] < F.col(RANGE))
    halo = numbers.withColumn("ends", ends.scalar()).select(RANGE, F.explode(F.slice(F.reverse(before), 1, max(size - 1, 1))).alias("e"))
    halo = halo.select(RANGE, F.col(f"e.{PLACE}").alias(PLACE), F.col("e.m").alias("rolled"), F.lit(True).alias("halo")).where(F.lit(size > 1))
    rows = ranged.withColumn("rolled", F.col(measured)).withColumn("halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)
    window = Window.partitionBy(RANGE).orderBy(PLACE).rowsBetween(-(size - 1), 0)
    rolled = rows.withColumn("rolling_mean", F.avg("rolled").over(window)).where(~F.col("halo"))
    return rolled.select(*steps.columns, "rolling_mean")
