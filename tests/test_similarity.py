"""Neighbours and recommendations against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marquee.operators import recommend as rec, similarity as sim
from marquee.operators.features import FeatureSettings

FAMILIES = ["genre", "company", "decade", "runtime"]
SETTINGS = FeatureSettings(weights={"genre": 2})


def catalogue(n, seed=0, spread=4):
    rng = np.random.default_rng(seed)
    table = pd.DataFrame({"id": rng.permutation(n * 3)[:n]})
    for family in FAMILIES:
        values = rng.integers(0, spread, n)
        table[family] = [f"{family}{v}" if v or family != "runtime" else None for v in values]
    return table


def frame(spark, table):
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in table.astype(object).itertuples(index=False)]
    return spark.createDataFrame(rows, "id long, genre string, company string, decade string, runtime string")


def cosine(a, b):
    def weight(f):
        return SETTINGS.weight(f)

    overlap = sum(weight(f) for f in FAMILIES if pd.notna(a[f]) and a[f] == b[f])
    size = [sum(weight(f) for f in FAMILIES if pd.notna(x[f])) for x in (a, b)]
    return overlap / np.sqrt(size[0] * size[1])


def brute(table, liked_id, n, without=()):
    rows = table.set_index("id")
    pairs = [(-cosine(rows.loc[liked_id], rows.loc[o]), o) for o in rows.index if o != liked_id and o not in without]
    return [(o, -s) for s, o in sorted(pairs)[:n]]


@pytest.fixture(params=[2048, 16])
def block_rows(request, monkeypatch):
    monkeypatch.setattr(sim, "ROWS_PER_BALL", request.param)
    monkeypatch.setattr(sim, "PIECE_ROWS", 2 * request.param)
    monkeypatch.setattr(sim, "CELLS_AT_ONCE", 100 * request.param)


def test_neighbours_match_brute_force(spark, block_rows):
    table = catalogue(120)
    # A third of the catalogue are copies of one title.
    table.loc[:40, FAMILIES] = table.loc[0, FAMILIES].values
    found = sim.neighbours(frame(spark, table), 4, SETTINGS).toPandas()
    assert len(found) == 4 * len(table)
    for liked_id, group in found.groupby("id"):
        group = group.sort_values("rank")
        expected = brute(table, liked_id, 4)
        assert list(group["other"]) == [o for o, _ in expected]
        assert list(group["sim"]) == pytest.approx([s for _, s in expected])


def test_neighbours_of_some(spark):
    table = catalogue(60, seed=4)
    some = table["id"].head(3).tolist()
    of = spark.createDataFrame([(i,) for i in some], "id long")
    found = sim.neighbours(frame(spark, table), 70, SETTINGS, of=of).toPandas()
    assert set(found["id"]) == set(some)
    for liked_id, group in found.groupby("id"):
        assert list(group.sort_values("rank")["other"]) == [o for o, _ in brute(table, liked_id, 70)]


def test_similar_to_one_leaves_the_title_out(spark):
    table = catalogue(80, seed=1)
    liked_id = int(table["id"].iloc[5])
    found = rec.similar_to_one(frame(spark, table), liked_id, 10, SETTINGS).orderBy("rank").toPandas()
    assert list(found["other" if "other" in found else "id"]) == [o for o, _ in brute(table, liked_id, 10)]


def liked_brute(table, liked, n):
    """Per liked title the n best others; of repeated ones the last liked title counts; then the n best."""
    relevance = {}
    for title in liked:
        for other, value in brute(table, title, n, without=liked):
            relevance[other] = value
    return sorted(relevance.items(), key=lambda p: (-p[1], p[0]))[:n]


def test_recommendations_for_a_liked_list(spark):
    table = catalogue(90, seed=2)
    liked = [int(i) for i in table["id"].head(4)]
    likes = spark.createDataFrame(list(enumerate(liked)) + [(9, -5)], "pos int, id long")
    similar = sim.similar_to(frame(spark, table), likes, 6, SETTINGS)
    found = sim.last_liked_wins(similar, 6).collect()
    expected = liked_brute(table, liked, 6)
    assert [r["id"] for r in found] == [o for o, _ in expected]
    assert [r["relevance"] for r in found] == pytest.approx([s for _, s in expected])


def test_a_long_liked_list_is_never_recommended_back(spark, monkeypatch):
    monkeypatch.setattr(sim, "LIKED_ROWS", 16)
    table = catalogue(60)
    ids = [int(i) for i in table["id"]]
    liked = ids[:40] + [10_000 + i for i in range(1_460)]
    likes = spark.createDataFrame(list(enumerate(liked)), "pos int, id long")
    found = sim.similar_to(frame(spark, table), likes, 5, SETTINGS).collect()
    assert not {r["id"] for r in found} & set(liked)
    assert {r["liked_id"] for r in found} == set(ids[:40])


@pytest.mark.parametrize("bad", [[], [[0.0] * 8], [[0.0] * 8, None] * 6, [[None] * 8, [float("nan")] * 8]])
def test_vectors_without_a_cosine_take_no_part(spark, bad):
    vectors = np.random.default_rng(3).normal(size=(20, 8)).tolist() + bad
    rows = spark.createDataFrame(list(enumerate(vectors)), "v_id long, v array<double>")
    found = sim.vector_neighbours(rows, 5, "v_id", "v").collect()
    assert len(found) == 100 and all(r["v_id"] < 20 and r["other"] < 20 for r in found)


def test_vectors_of_different_lengths_are_refused(spark):
    rows = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "v_id long, v array<double>")
    with pytest.raises(ValueError, match="numbers"):
        sim.vector_neighbours(rows, 5, "v_id", "v")


@pytest.mark.parametrize("spread, small", [(3, False), (3, True), (9, True)])
def test_recommendations_for_many_users(spark, monkeypatch, spread, small):
    if small:
        for name, value in (("BLOCK_PROFILES", 7), ("ASKS_PER_CHUNK", 5), ("CELLS_AT_ONCE", 40)):
            monkeypatch.setattr(rec, name, value)
    table = catalogue(60, seed=7, spread=spread)
    ids = [int(i) for i in table["id"]]
    rng = np.random.default_rng(1)
    chosen = {"few": ids[:2], "some": ids[10:18], "most": [int(i) for i in rng.permutation(ids)[:50]], "all": ids}
    rows = [(u, t, p) for u, titles in chosen.items() for p, t in enumerate(titles)] + [("few", -1, 99)]
    likes = spark.createDataFrame(rows, "user_id string, id long, pos int")
    found = rec.recommend_for_users(likes, frame(spark, table), 5, SETTINGS).toPandas()
    assert set(found["user_id"]) == {"few", "some", "most"}
    for user, group in found.groupby("user_id"):
        expected = liked_brute(table, chosen[user], 5)
        group = group.sort_values("rank")
        assert list(group["id"]) == [o for o, _ in expected]
        assert list(group["relevance"]) == pytest.approx([s for _, s in expected])


def test_a_user_who_liked_most_of_the_catalogue(spark, monkeypatch):
    monkeypatch.setattr(rec, "BLOCK_PROFILES", 50)
    table = catalogue(400, seed=8, spread=6)
    ids = [int(i) for i in np.random.default_rng(2).permutation(table["id"])]
    rows = [("most", t, p) for p, t in enumerate(ids[:300])] + [("one", ids[3], 0)]
    likes = spark.createDataFrame(rows, "user_id string, id long, pos int")
    found = rec.recommend_for_users(likes, frame(spark, table), 5, SETTINGS).toPandas()
    for user, liked in (("most", ids[:300]), ("one", [ids[3]])):
        expected = liked_brute(table, liked, 5)
        group = found[found["user_id"] == user].sort_values("rank")
        assert list(group["id"]) == [o for o, _ in expected]
    none = likes.limit(0)
    assert rec.recommend_for_users(none, frame(spark, table), 5, SETTINGS).count() == 0


@pytest.mark.parametrize("listed", [1_000, 40, 8])
def test_users_are_answered_from_lists_of_profiles(spark, monkeypatch, listed):
    for module, name, value in ((rec, "FEW_ASKS", 0), (rec, "MOST_LISTED", listed), (sim, "FEW_PAIRS", 0), (sim, "KEY_COST", 0), (rec, "BLOCK_PROFILES", 7)):
        monkeypatch.setattr(module, name, value, raising=False)
    table = catalogue(90, seed=7)
    table.loc[:20, FAMILIES] = table.loc[0, FAMILIES].values
    ids = [int(i) for i in table["id"]]
    chosen = {"one": ids[30:31], "copies": ids[:12], "some": ids[10:18], "most": [int(i) for i in np.random.default_rng(1).permutation(ids)[:70]], "all": ids}
    rows = [(u, t, p) for u, titles in chosen.items() for p, t in enumerate(titles)] + [("one", -1, 99), (None, ids[0], 0), ("one", None, 3)]
    likes = spark.createDataFrame(rows, "user_id string, id long, pos int")
    found = rec.recommend_for_users(likes, frame(spark, table), 5, SETTINGS)
    if listed == 1_000:  # no ask travels to every block
        assert "sequence(0" not in found._jdf.queryExecution().optimizedPlan().toString()
    found = found.toPandas()
    assert set(found["user_id"]) == set(chosen) - {"all"}
    for user, group in found.groupby("user_id"):
        expected = liked_brute(table, chosen[user], 5)
        group = group.sort_values("rank")
        assert list(group["id"]) == [o for o, _ in expected]
        assert list(group["relevance"]) == pytest.approx([s for _, s in expected])


def test_likes_without_a_user_are_nobodys(spark):
    table = catalogue(30, seed=3)
    ids = [int(i) for i in table["id"]]
    likes = spark.createDataFrame([(None, ids[0], 0), (None, ids[1], 1), (7, ids[2], 0), (7, ids[3], None)], "user_id long, id long, pos int")
    found = rec.recommend_for_users(likes, frame(spark, table), 5, SETTINGS).toPandas()
    assert set(found["user_id"]) == {7} and len(found) == 5 and not {ids[2], ids[3]} & set(found["id"])


def clustered(n, clusters, width, spread, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, width))
    return centres[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, width))


def test_balls_spare_most_comparisons_and_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(sim, "ROWS_PER_BALL", 50)
    vectors = np.vstack([clustered(1500, 30, 12, 0.05), np.random.default_rng(4).normal(size=(20, 12))])
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "v_id long, v array<double>")
    routes = []
    compare = sim.compared
    monkeypatch.setattr(sim, "compared", lambda asking, *rest: routes.append(asking.count()) or compare(asking, *rest))
    found = sim.vector_neighbours(rows, 4, "v_id", "v").toPandas()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    similarity = unit @ unit.T
    np.fill_diagonal(similarity, -2)
    best = -np.sort(-similarity, axis=1)[:, :4]
    got = found.sort_values(["v_id", "rank"])["sim"].to_numpy().reshape(-1, 4)
    assert got == pytest.approx(best, abs=1e-12)
    balls = -(-len(vectors) // 50)
    assert len(routes) == 2 and sum(routes) < 0.5 * len(vectors) * balls


def test_no_copy_of_the_catalogue_travels_for_a_liked_list(spark):
    table = frame(spark, catalogue(90, seed=2))
    likes = spark.createDataFrame([(0, 1), (1, 2)], "pos int, id long")
    plan = sim.similar_to(table, likes, 6, SETTINGS)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [block" not in plan and "ShuffledHashJoin [block" not in plan


def test_a_list_too_long_to_broadcast(spark, monkeypatch):
    table = catalogue(90, seed=2)
    liked = [int(i) for i in table["id"].head(30)]
    likes = spark.createDataFrame(list(enumerate(liked)), "pos int, id long")
    expected = sim.similar_to(frame(spark, table), likes, 6, SETTINGS).collect()
    monkeypatch.setattr(sim, "BROADCAST_LIKED", 3)
    monkeypatch.setattr(sim, "LIKED_ROWS", 8)
    found = sim.similar_to(frame(spark, table), likes, 6, SETTINGS).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, expected)) and len(found) == 180


def test_vector_neighbours(spark, block_rows):
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(70, 8))
    vectors[10:30] = vectors[10]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "v_id long, v array<double>")
    found = sim.vector_neighbours(rows, 3, "v_id", "v").toPandas()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    similarity = unit @ unit.T
    for v_id, group in found.groupby("v_id"):
        group = group.sort_values("rank")
        best = np.sort(np.delete(similarity[v_id], v_id))[::-1][:3]
        assert list(group["sim"]) == pytest.approx(list(best))
        assert v_id not in set(group["other"])


def test_popular_and_linked(spark):
    rows = [(1, 9.0, 60_000, {"1": 2, "2": 3}), (2, 9.5, 10, {}), (3, 8.0, 70_000, {"1": 1, "2": 99}), (4, None, 80_000, None)]
    titles = spark.createDataFrame(rows, "id long, rating double, num_votes long, imdb_recommendations map<string,long>")
    assert [r["id"] for r in rec.MostPopular(5).recommend(titles).collect()] == [1, 3]
    liked = spark.createDataFrame([(0, 1), (1, 3), (2, 50)], "pos int, id long")
    # Liked titles are not removed, unknown ones do not appear.
    assert [r["id"] for r in rec.LinkedBySite(5).recommend(titles, liked).collect()] == [2, 1, 3]


def test_display(spark):
    import datetime as dt

    titles = spark.createDataFrame(
        [(1, "A", "x", "y", None, dt.date(1994, 9, 23), "US", "C", 8.25, "p"), (2, "B", "x", None, None, None, None, None, 8.35, None)],
        "id long, original_title string, genre_1 string, genre_2 string, genre_3 string, release_date date, "
        "country_of_origin_1 string, production_company_1 string, rating double, poster_url string",
    )
    recommended = spark.createDataFrame([(1, 0.5), (2, 0.9), (3, 1.0)], "id long, relevance double")
    rows = rec.display(recommended, titles).collect()
    assert [r["id"] for r in rows] == [2, 1]
    assert (rows[1]["genre"], rows[1]["release_date"], rows[1]["rating"]) == ("x, y", "September 1994", 8.2)
    assert rows[0]["release_date"] is None


def test_a_recommender_of_ones_own(spark):
    class Newest:
        def recommend(self, titles, liked=None, preferences=None):
            return titles.select("id", F.col("rating").alias("relevance")).where(F.col("rating") > preferences["above"])

    titles = spark.createDataFrame(
        [(1, "A", "x", None, None, None, None, None, 8.0, None)],
        "id long, original_title string, genre_1 string, genre_2 string, genre_3 string, release_date date, "
        "country_of_origin_1 string, production_company_1 string, rating double, poster_url string",
    )
    assert rec.recommend(Newest(), titles, preferences={"above": 7}).count() == 1


def test_looks_and_users_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(rec, "BLOCK_PROFILES", 7)
    table = catalogue(60, seed=7, spread=3)
    rows = [(u, int(t), p) for u in range(6) for p, t in enumerate(table["id"][u::9])]
    likes = spark.createDataFrame(rows, "user_id string, id long, pos int")
    found = rec.recommend_for_users(likes, frame(spark, table), 3, SETTINGS)
    plan = found._jdf.queryExecution().executedPlan().toString().split("\n")
    keys = [line.split("HashedRelationBroadcastMode")[1] for line in plan if "HashedRelationBroadcastMode" in line]
    # What grows with titles, looks or users stays off the driver; only sizes go by the number of a block.
    assert keys and all("int, true] as bigint" in k for k in keys)


def test_rows_travel_by_the_width_of_the_grid(spark, monkeypatch):
    monkeypatch.setattr(sim, "ROWS_PER_BALL", 20)
    vectors = np.random.default_rng(3).normal(size=(400, 8))  # without structure: hardly a ball can be left out
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "v_id long, v array<double>")
    sent = []
    compare = sim.compared
    monkeypatch.setattr(sim, "compared", lambda asking, *rest: sent.append(asking.count()) or compare(asking, *rest))
    found = sim.vector_neighbours(rows, 3, "v_id", "v").toPandas().sort_values(["v_id", "rank"])
    assert sum(sent) <= (sim.BALLS_FIRST + 1) * len(vectors)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    similarity = unit @ unit.T
    np.fill_diagonal(similarity, -2)
    assert found["sim"].to_numpy().reshape(-1, 3) == pytest.approx(-np.sort(-similarity, axis=1)[:, :3], abs=1e-12)


@pytest.mark.parametrize("pieces", [4_096, 8])
def test_rounds_spare_most_pairs_of_titles_and_lose_nothing(spark, monkeypatch, pieces):
    monkeypatch.setattr(sim, "FEW_PAIRS", 0)
    monkeypatch.setattr(sim, "KEY_COST", 0)
    monkeypatch.setattr(sim, "PIECE_ROWS", pieces)
    rng = np.random.default_rng(6)
    titles, families = 700, [f"f{i}" for i in range(9)]
    settings = FeatureSettings(weights={"f3": 2})
    # Families with and without missing labels, one with a frequent label, one that tells nothing apart; copies; titles without labels.
    codes = rng.integers(1, 7, (titles, 9))
    codes[:, :3][rng.random((titles, 3)) < 0.4] = 0
    codes[rng.random(titles) < 0.8, 4] = 1
    codes[:, 8] = 1
    codes[100:400] = codes[rng.integers(0, 100, 300)]
    flips = rng.integers(3, 8, 300)
    codes[np.arange(100, 400), flips] = rng.integers(1, 7, 300)
    codes[400:420], codes[420:423] = codes[0], 0
    ids = rng.permutation(titles).tolist()
    rows = [(i, *(f"l{c}" if c else None for c in row)) for i, row in zip(ids, codes.tolist())]
    labels = spark.createDataFrame(rows, "id long, " + ", ".join(f"{f} string" for f in families))
    rounds, left = [], []
    met_in, compared = sim.met_in, sim.compared
    monkeypatch.setattr(sim, "met_in", lambda here, *rest: rounds.append(here) or met_in(here, *rest))
    monkeypatch.setattr(sim, "compared", lambda asking, *rest: left.append(asking.count()) or compared(asking, *rest))
    found = sim.neighbours(labels, 4, settings).toPandas().sort_values(["id", "rank"])

    weights = np.array([settings.weight(f) for f in families], float)
    present = codes != 0
    size = present @ weights
    shared = ((codes[:, None, :] == codes[None]) & present[:, None, :]) @ weights
    similarity = shared / np.sqrt(np.maximum(size[:, None] * size[None], 1e-300))
    np.fill_diagonal(similarity, -1)
    expected = {i: np.lexsort((ids, -similarity[at]))[:4] for at, i in enumerate(ids)}
    got = found.groupby("id")["other"].apply(list)
    assert got.to_dict() == {i: [ids[x] for x in best] for i, best in expected.items()}
    assert found["sim"].to_numpy() == pytest.approx(np.concatenate([similarity[ids.index(i)][expected[i]] for i in sorted(ids)]))
    # Rows that differ in `radius` families meet; of all pairs few do, and few titles are left for the others.
    looks = np.unique(codes, axis=0)
    pairs = [sum(n * n for n in pd.DataFrame(looks).groupby(key).size()) for key in rounds[0].keys]
    assert sum(pairs) < 0.2 * len(looks) ** 2 and sum(left) < 0.3 * len(looks)


@pytest.mark.parametrize("missing", [False, True])
def test_no_row_beyond_the_radius_is_more_similar(missing):
    rng = np.random.default_rng(2)
    weights = np.array([1, 2, 1, 3, 1, 1], float)
    codes = rng.integers(0 if missing else 1, 4, (300, 6))
    codes = codes[(codes != 0).any(axis=1)]
    none = (codes == 0).any(axis=0)
    families = sim.Families(weights, np.full(6, 0.3), none)
    present = codes != 0
    size = present @ weights
    for a in range(0, len(codes), 5):
        cosines = ((codes[a] == codes) & present[a]) @ weights / np.sqrt(np.maximum(size * size[a], 1e-300))
        differ = (codes[a] != codes).sum(axis=1)
        for misses in range(1, 7):
            assert (cosines[differ >= misses] <= families.most_with(misses, present[a]) + 1e-12).all()
