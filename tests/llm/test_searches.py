"""Hard negatives, lexical search and nearest vectors against plain versions, on awkward rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from marquee.llm import hard_negatives, learned_index, shared_terms

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
VECTORS = "vec_id long, embedding array<float>, label int, look string, id int, v int"  # the last three names clash with ours


def clustered(n: int, width: int, seed: int, spread: float = 0.15) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(1, n // 40), width))
    rows = centres[rng.integers(0, len(centres), n)] + spread * rng.normal(size=(n, width))
    return (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.float32)


def vector_rows(n: int = 400, width: int = 6) -> list[tuple]:
    rng = random.Random(5)
    rows = [(i, v.tolist(), rng.randrange(4)) for i, v in enumerate(clustered(n, width, 3))]
    for i in range(n, n + 160):  # one vector that many rows hold, with two labels
        rows.append((i, rows[7][1], i % 2))
    inf, nan = float("inf"), float("nan")
    rows += [
        (1000, None, 1), (1001, [inf] * width, 1), (1002, [nan] + [0.5] * (width - 1), 1), (1003, [None] + [0.5] * (width - 1), 1),
        (1100, rows[3][1], None), (1004, [0.0] * width, 2), (1005, [0.3, 0.4], 2), (1200, rows[7][1], 0), (None, rows[3][1], 1),
    ]
    return rows + rows[:3] + rows[-3:]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", 1, 2) for r in rows], VECTORS).repartition(3)


def taking_part(rows, zero: bool, label: bool):
    out = {}
    for i, v, y in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or (label and y is None):
            continue
        v = [float(np.float32(x)) for x in v] + [0.0] * (6 - len(v))
        if zero or any(v):
            out[i] = (v, y)
    return out


def plain_negatives(rows, anchors):
    rows = {i: (np.floor(256 * np.array(v)).astype(int), y) for i, (v, y) in taking_part(rows, True, True).items()}
    out = []
    for a in anchors:
        if a not in rows:
            continue
        score = {i: int(v @ rows[a][0]) for i, (v, _) in rows.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if rows[i][1] == rows[a][1]][:5]:
            fit = [i for i in order if rows[i][1] != rows[a][1] and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            out += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(fit[:10])]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives(spark, monkeypatch, small):
    if small:  # many blocks and groups, several sets of zone maps, several copies of each
        for name, value in (("BLOCK_ROWS", 16), ("GROUP_ROWS", 3), ("ZONES", 5), ("FIRST", 1), ("GROUPS_PER_ZONES", 2), ("GROUPS_PER_BLOCK", 2), ("ANCHORS_PER_LIST", 2)):
            monkeypatch.setattr(hard_negatives, name, value)
    rows = vector_rows()
    table = frame(spark, rows)
    anchors = [*range(0, 600, 20), 1000, 1001, 1100, 1200, 9999]
    asked = spark.createDataFrame([(a,) for a in anchors * 2], "vec_id long")
    found = [tuple(r) for r in hard_negatives.mine(table, asked).collect()]
    assert sorted(found) == plain_negatives(rows, anchors)
    assert len(found) > 100


def test_bounds_leave_blocks_unread(spark):
    """On rows in tight clusters the zone maps spare most of the reading."""
    points = clustered(3000, 4, 9, 0.02)
    order = np.argsort(hard_negatives.hilbert(np.clip((points.T + 1) * 64, 0, 127), 7))
    blocks = [np.floor(256 * points[o]) for o in np.array_split(order, 100)]
    low, high = (np.stack([f(b, axis=0) for b in blocks]) for f in (np.min, np.max))
    asked = np.floor(256 * points[:200])
    least, most = hard_negatives.bounds(asked, low, high)
    for j, block in enumerate(blocks):
        scores = asked @ block.T
        assert (least[:, j] <= scores.min(1)).all() and (scores.max(1) <= most[:, j]).all()
    floor = np.sort(asked @ np.floor(256 * points).T, axis=1)[:, -20:][:, 0].astype(np.int64)[:, None]
    lowest, top = np.full((200, 1), hard_negatives.LOWEST), np.full((200, 1), hard_negatives.HIGHEST)
    read = hard_negatives.needed(least, most, np.ones(least.shape, bool), lowest, top, floor, False)
    assert read.mean() < 0.5


def test_the_curve_visits_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    place = hard_negatives.hilbert(cells.T, 3)
    assert sorted(place) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(1) == 1).all()


def test_products_beyond_double_precision():
    a = np.array([[2.0**40, 1.0], [1e30, 0.0], [3.0, -2.0]])
    got = hard_negatives.products(a, a)
    assert got[2, 2] == 13 and got[0, 2] == 3 * 2**40 - 2 and got[1, 1] == hard_negatives.HIGHEST


def test_negatives_of_empty_tables(spark):
    table = frame(spark, vector_rows())
    none = table.limit(0)
    asked = table.select("vec_id")
    assert hard_negatives.mine(none, asked).count() == 0 and hard_negatives.mine(table, asked.limit(0)).count() == 0


def documents() -> list[tuple]:
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)] + ["Ünder", "straße", "IT", "42"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(rng.choices(words, weights, k=rng.choice([1, 3, 30, 120]))) for _ in range(150)]
    texts += [texts[0]] * 12 + [None, "", " ... \n", "it's IT, under_score w1-w2", "w59 " * 50, "zzz " * 30_000, "ünder ÜNDER under"]
    return [(i, t, "x", 1, 2) for i, t in enumerate(texts)] + [(0, texts[0], "x", 1, 2), (None, texts[5], "x", 1, 2)]


def items() -> list[tuple]:
    rng = random.Random(12)
    words = [f"w{i}" for i in range(60)] + ["Ünder", "straße", "it", "nowhere"]
    texts = [" ".join(rng.sample(words, rng.choice([1, 2, 8, 25]))) for _ in range(40)]
    texts += [None, "", "w1 w1 w1 w2", "w1 W1 w2 it's", "nowhere", texts[3], "zzz"]
    return [(f"i{i}", t) for i, t in enumerate(texts)] + [("i0", texts[0]), (None, texts[4])]


def terms(text) -> list[str]:
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")]


def plain_search(docs, asked, n=10):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    df = Counter(t for _, c in counted for t in c)
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    out = []
    for item, text in set(asked):
        wanted, scored = Counter(terms(text)), []
        for d, c in counted:
            m = 25 + (75 * sum(c.values()) * n_docs) // n_terms
            score = sum(
                k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t, k in wanted.items() if t in c
            )
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(scored, key=lambda r: (r[0], r[1], r[2] or 0))[:n])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_search(spark, monkeypatch, small):
    if small:  # many blocks, more than a task keeps, and documents in many steps
        for name, value in (("BLOCK_ITEMS", 3), ("BLOCK_BYTES", 300), ("SHARD_BYTES", 2000), ("CELLS", 500)):
            monkeypatch.setattr(shared_terms, name, value)
    docs = spark.createDataFrame(documents(), "doc_id long, text string, item string, block int, score int").repartition(4)
    asked = spark.createDataFrame(items(), "item_id string, text string")
    found = [tuple(r) for r in shared_terms.search(docs, asked, 10).collect()]
    plain = plain_search([r[:2] for r in documents()], items())
    assert sorted(found, key=repr) == plain and len(plain) > 200
    none = docs.limit(0)
    assert shared_terms.search(none, asked, 10).count() == 0 and shared_terms.search(docs, asked.limit(0), 10).count() == 0


def test_shared_sets_save_additions_and_hold_the_same_terms():
    rng = random.Random(3)
    common = [rng.sample(range(300), 12) for _ in range(5)]
    leaves = [np.array(sorted({*rng.choice(common), *rng.choice(common), *rng.sample(range(300), 6)})) for _ in range(50)]
    nodes, ends = shared_terms.shared_sets(leaves, 300)

    def spread(parts):
        return [x for p in parts for x in ([p] if p < 300 else spread(nodes[p - 300]))]

    assert [sorted(spread(e)) for e in ends] == [leaf.tolist() for leaf in leaves]
    assert all((p < 300 + k).all() for k, p in enumerate(nodes))
    assert sum(map(len, nodes)) + sum(map(len, ends)) < 0.75 * sum(map(len, leaves))


def plain_nearest(rows, asked, n=20):
    rows = taking_part(rows, False, False)
    ids = np.array(sorted(rows))
    matrix = np.array([rows[i][0] for i in ids])
    out = {}
    for q in asked:
        if q in rows:
            score = (matrix * np.array(rows[q][0])).sum(1)
            order = [k for k in np.lexsort((ids, -score)) if ids[k] != q][:n]
            out[q] = [(int(ids[k]), float(score[k])) for k in order]
    return out


def found_nearest(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def test_nearest_of_awkward_rows(spark, monkeypatch):
    """With a single part everything is read, so the answer is exact."""
    monkeypatch.setattr(learned_index, "PIECE_ROWS", 50)
    monkeypatch.setattr(learned_index, "CHUNK_ROWS", 7)
    rows = vector_rows()
    table, asked = frame(spark, rows), [*range(0, 560, 20), 1000, 1004, 1005, 1100, 1200, 5555]
    found = found_nearest(learned_index.nearest(table, spark.createDataFrame([(a,) for a in asked], "vec_id long"), 20, parts=1))
    plain = plain_nearest(rows, asked)
    assert found.keys() == plain.keys()
    for q, best in plain.items():
        assert [i for i, _ in found[q]] == [i for i, _ in best]
        assert np.allclose([s for _, s in found[q]], [s for _, s in best], rtol=1e-12)
    few = table.where("vec_id in (1, 2, 4)")
    assert {q: len(v) for q, v in found_nearest(learned_index.nearest(few, few, 20)).items()} == {1: 2, 2: 2, 4: 2}
    assert learned_index.nearest(table.limit(0), table, 20).count() == 0 and learned_index.nearest(table, few.limit(0), 20).count() == 0


def test_learned_parts_reach_the_recall_and_spare_reading(spark):
    points = clustered(6000, 16, 21)
    table = spark.createDataFrame([(i, p.tolist(), 0) for i, p in enumerate(points)], "vec_id long, embedding array<float>, label int")
    found = found_nearest(learned_index.nearest(table, table.where("vec_id % 20 = 0"), 20, sample=2500, parts=16))
    exact = points.astype(float) @ points.astype(float).T
    np.fill_diagonal(exact, -np.inf)
    met = [len({i for i, _ in found[q]} & set(np.argsort(-exact[q])[:20].tolist())) for q in range(0, 6000, 20)]
    assert np.mean(met) >= 0.9 * 20
    router = learned_index.learn(points[:2500], 16, 20)
    row, _ = router.routes(points[2500:].astype(float))
    assert len(row) < 6 * 3500
    sizes = np.bincount(router.parts(points[2500:].astype(float)), minlength=16)
    assert sizes.max() < 4 * 3500 / 16


def test_parts_are_balanced_and_cut_few_edges():
    points = clustered(1600, 8, 4).astype(float)
    graph = learned_index.neighbour_graph(points, np.arange(1600), 10)
    part = learned_index.balanced_parts(points, graph, 8, np.random.default_rng(0))
    assert (np.bincount(part) == 200).all()
    assert (part[graph] == part[:, None]).mean() > 0.8
