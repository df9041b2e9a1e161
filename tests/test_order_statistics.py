"""Exact ranks: against pandas, in one range and in many, with hot groups, texts and ties."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from marquee.operators import distributions, interactions, order_statistics, ranking

FRACTIONS = [0.0, 0.02, 0.1, 0.25, 0.5, 0.57, 0.75, 0.9, 0.98, 1.0]


def sample(kind, n, seed=3):
    rng = np.random.default_rng(seed)
    return {
        "normal": rng.normal(size=n),
        "ties": rng.integers(0, 7, n).astype(float),
        "heavy": np.where(rng.random(n) < 0.4, 5.0, np.exp(rng.normal(size=n) * 9)),
        "one": np.full(n, 2.5),
    }[kind]


@pytest.mark.parametrize("ranges", [None, 1, 23])
@pytest.mark.parametrize("kind", ["normal", "ties", "heavy", "one"])
def test_quantiles_match_pandas(spark, kind, ranges):
    values = pd.Series(sample(kind, 5000))
    frame = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(5)
    frame = frame.union(spark.createDataFrame([(None,)], "v double"))
    found = order_statistics.quantiles(frame, "v", FRACTIONS, ranges=ranges).collect()
    got = {r["q"]: r["value"] for r in found}
    for q in FRACTIONS:
        assert got[q] == pytest.approx(values.quantile(q), rel=1e-12)


@pytest.mark.parametrize("ranges", [None, 1, 23])
def test_nearest_quantiles_by_group(spark, ranges):
    rows = pd.DataFrame(
        {"k": np.r_[np.zeros(3000), np.ones(41), [2]].astype(int), "v": np.arange(3042) * 7919 % 1013}
    )
    found = order_statistics.quantiles(
        spark.createDataFrame(rows), "v", FRACTIONS, ("k",), nearest=True, ranges=ranges
    ).collect()
    got = {(r["k"], r["q"]): r["value"] for r in found}
    for (k, q), expected in rows.groupby("k")["v"].quantile(FRACTIONS, interpolation="nearest").items():
        assert got[k, q] == expected


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(st.tuples(st.sampled_from("aab"), st.integers(0, 4)), min_size=1, max_size=120),
    percent=st.sampled_from([0, 1, 10, 33.3, 50, 100]),
)
def test_first_share_is_the_same_for_hot_groups(spark, rows, percent):
    frame = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], "k string, v int, i int")
    size = ranking.percent_or_count(percent=percent)
    expected = set()
    table = pd.DataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], columns=["k", "v", "i"])
    for _, group in table.groupby("k"):
        keep = int(np.floor(percent * len(group) / 100))
        best = group.sort_values(["v", "i"], ascending=[False, True]).head(keep)
        expected |= set(best["i"])
    for ranges in (None, 17):
        got = ranking.first_share(frame, ["k"], "v", "i", size, ranges=ranges).collect()
        assert len(got) == len(expected)
        assert {r["i"] for r in got} == expected


def test_a_hot_group_of_text_ids_lies_in_many_ranges(spark):
    """Nine tenths of all rows are of one group; ids are texts, dates order them, and some groups have no name."""
    rows = spark.range(5000).select(
        F.when(F.col("id") % 10 < 9, "hot").when(F.col("id") % 20 == 19, F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("k"),
        F.date_add(F.lit("2001-02-03"), (F.col("id") * 7919 % 41).cast("int")).alias("d"),
        F.format_string("/title/tt%05d/", F.col("id") * 37 % 5000).alias("id"),
    )
    found = ranking.first_share(rows, ["k"], "d", "id", ranking.percent_or_count(percent=30), ranges=16)
    table = rows.toPandas()
    expected = set()
    for _, group in table.groupby("k", dropna=False):
        best = group.sort_values("id").sort_values("d", ascending=False, kind="stable")
        expected |= set(best.head(int(len(group) * 0.3))["id"])
    got = [r["id"] for r in found.collect()]
    assert len(got) == len(expected) and set(got) == expected
    ranged = order_statistics.ranges_of(rows, [F.col("k"), F.col("d"), F.col("id")], 16)
    assert ranged.groupBy("range_no").count().agg(F.max("count")).first()[0] < 1000
    dates = order_statistics.values_at_ranks(rows, "d", lambda n: [(F.lit(0), n - 1)], ("k",), ranges=16).collect()
    assert {(r["k"], r["first_value"], r["last_value"], r["n"]) for r in dates} == {
        (None if k != k else k, g["d"].min(), g["d"].max(), len(g)) for k, g in table.groupby("k", dropna=False)
    }


def test_several_columns_in_one_pass(spark):
    values = pd.DataFrame({"a": sample("normal", 999), "b": sample("heavy", 999, 4)})
    found = order_statistics.column_quantiles(spark.createDataFrame(values), {"a": [0.1, 0.9], "b": [0.5]})
    assert found["a"] == pytest.approx(list(values["a"].quantile([0.1, 0.9]))) and found["b"] == pytest.approx([values["b"].median()])
    none = spark.createDataFrame([], "a double, b int")
    assert order_statistics.column_quantiles(none, {"a": [0.5]}) == {"a": [None]}
    assert distributions.between_quantiles(none, {"a": (0.1, 0.9)}).count() == 0


@pytest.mark.parametrize("ranges, size", [(None, 5), (7, 5), (40, 5), (7, 1), (30, 12)])
def test_rolling_mean_across_borders(spark, ranges, size):
    values = pd.DataFrame({"runtime": np.random.default_rng(2).permutation(60) * 3, "m": sample("normal", 60)})
    found = distributions.rolling_mean(spark.createDataFrame(values).repartition(5), "runtime", "m", size, ranges).toPandas()
    expected = values.sort_values("runtime")
    got = found.sort_values("runtime")
    assert got["runtime"].tolist() == expected["runtime"].tolist()
    assert got["rolling_mean"].to_numpy() == pytest.approx(expected["m"].rolling(size, min_periods=1).mean().to_numpy())


def test_several_rankings_from_one_pass(spark):
    frame = spark.createDataFrame([(1, 5.0, 1), (2, None, 9), (3, 5.0, 3), (4, 1.0, 9)], "id int, a double, b int")
    found = ranking.several_tops(frame, {"a": ("a", 2), "b": (F.col("b"), 3), "c": ("a", 9)}, among={"c": F.col("b") > 2})
    got = {name: [(r["id"], r["ranked_by"]) for r in found.collect() if r["ranking"] == name] for name in "abc"}
    assert sorted(got["a"]) == [(1, 5.0), (3, 5.0)] and sorted(got["b"]) == [(2, 9.0), (3, 3.0), (4, 9.0)]
    assert sorted(got["c"], key=repr) == [(2, None), (3, 5.0), (4, 1.0)]


def test_first_share_by_count(spark):
    frame = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"), "id")
    kept = ranking.first_share(frame, ["k"], "v", "id", ranking.percent_or_count(count=5), ranges=9)
    assert sorted(r["id"] for r in kept.collect()) == list(range(85, 100))
    with pytest.raises(ValueError):
        ranking.percent_or_count()
    with pytest.raises(ValueError):
        ranking.percent_or_count(percent=101)


@pytest.mark.parametrize("ranges", [None, 31])
def test_holdout_is_disjoint_complete_and_repeatable(spark, ranges):
    ratings = spark.range(900).select(
        F.when(F.col("id") < 400, F.lit("hot")).otherwise(F.concat(F.lit("u"), (F.col("id") % 40).cast("string"))).alias("author"),
        (F.col("id") * 7 % 500).alias("id"),
        F.lit(4.0).alias("rating"),
    ).distinct()
    test = interactions.holdout(ratings, 0.2, seed=1, ranges=ranges)
    drawn = {(r["author"], r["id"]) for r in test.collect()}
    assert drawn == {(r["author"], r["id"]) for r in interactions.holdout(ratings.repartition(7), 0.2, seed=1).collect()}
    sizes = {r["author"]: r["count"] for r in ratings.groupBy("author").count().collect()}
    counted = pd.Series([a for a, _ in drawn]).value_counts().to_dict()
    assert counted == {a: int(0.2 * n) for a, n in sizes.items() if int(0.2 * n)}
    train, held = interactions.split(ratings, 0.2, seed=1)
    whole = {tuple(r) for r in ratings.collect()}
    assert {tuple(r) for r in train.select(*ratings.columns).collect()} | {
        tuple(r) for r in held.select(*ratings.columns).collect()
    } == whole
    assert train.count() + held.count() == len(whole)


def test_histogram_keeps_empty_bins_and_closes_the_last(spark):
    frame = spark.createDataFrame([(float(v),) for v in (0, 0, 1, 9.5, 10)], "v double")
    rows = distributions.histogram(frame, "v", 10).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [2, 1, 0, 0, 0, 0, 0, 0, 0, 2]
    assert sum(r["density"] for r in rows) == pytest.approx(1.0)


@pytest.mark.parametrize("kind", ["normal", "ties", "heavy"])
def test_density_is_close_to_the_direct_sum(spark, kind):
    values = sample(kind, 800)
    frame = spark.createDataFrame(pd.DataFrame({"v": values}))
    rows = distributions.density(frame, "v", points=40).orderBy("i").collect()
    h = values.std(ddof=1) * len(values) ** -0.2
    for r in rows:
        z = (r["x"] - values) / h
        direct = np.exp(-z * z / 2).sum() / (h * len(values) * np.sqrt(2 * np.pi))
        assert r["density"] == pytest.approx(direct, abs=1e-8)


def test_monthly_fills_gaps(spark):
    frame = spark.createDataFrame([("2020-01-15", 1.0), ("2020-01-20", 3.0), ("2020-04-01", 5.0)], "d string, v double")
    frame = frame.withColumn("d", F.to_date("d"))
    rows = distributions.monthly(frame, "d", {"mean": F.avg("v"), "n": F.count("*")}, counts=("n",)).orderBy("month").collect()
    assert [(str(r["month"]), r["mean"], r["n"]) for r in rows] == [
        ("2020-01-31", 2.0, 2), ("2020-02-29", None, 0), ("2020-03-31", None, 0), ("2020-04-30", 5.0, 1),
    ]


def test_top_breaks_ties_by_id_and_puts_nulls_last(spark):
    frame = spark.createDataFrame([(3, 5.0), (1, 5.0), (2, None), (4, 6.0)], "id int, v double")
    assert [r["id"] for r in ranking.top(frame, 3, "v").collect()] == [4, 1, 3]
    assert [r["id"] for r in ranking.top(frame, 9, "v").collect()] == [4, 1, 3, 2]


def test_sparsity_counts_cells_once(spark):
    rows = [("a", 1, 5.0), ("a", 1, 6.0), ("b", 2, 1.0), ("b", 1, None)]
    found = interactions.sparsity(spark.createDataFrame(rows, "author string, id int, rating double")).first()
    assert found["sparsity"] == 50.0


@pytest.mark.parametrize("limit", ["1000", "3"])
def test_top_per_group_in_one_or_two_steps(spark, limit):
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, limit)
    try:
        frame = spark.range(500).select((F.col("id") % 2).alias("k"), (F.col("id") * 7 % 50).alias("v"), "id")
        best = ranking.top_per_group(frame, ["k"], 20, [F.col("v").desc(), F.col("id")]).toPandas()
    finally:
        spark.conf.set(key, before)
    table = frame.toPandas().sort_values(["v", "id"], ascending=[False, True])
    for k, group in best.groupby("k"):
        assert list(group.sort_values("rank")["id"]) == list(table[table["k"] == k].head(20)["id"])
