"""Nearest vectors by inner product, with learned partitions.

A neighbour graph over a bounded sample of the vectors is cut into balanced parts with few edges between them. A small
classifier learns from it in which parts a vector's neighbours lie. It deals every vector to its most probable part, and
sends a query to its most probable parts until their probabilities reach a mass; that mass is set on held-out rows of the
sample so that WANTED_RECALL of their neighbours are met. So a query in a cluster reads a part or two, and one without close
neighbours reads many. What a query reads is ranked by the exact measure on the original vectors.

The sample (about SAMPLE rows by a hash of the id) only shapes the parts. Every vector is indexed. Equal vectors are one entry with its
n + 1 smallest ids, since no list can need more of them, and equal queries are searched for once; a part of any size is cut into
pieces and the queries for it into chunks, and a task holds one of each.

Vectors that are NULL, zero or hold NULL or infinite numbers or NaN take no part, nor do rows without an id. Rows equal in id and
vector count once; two vectors of one id are both candidates, and neither is for the other. A shorter vector counts as if filled
up with zeros. Equal measures are ordered by id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.ranking import top_per_group
from .storage import stored

SAMPLE = 8_192  # rows that the parts are learned from
PARTS = 64
DEGREE = 10  # edges of a vector in the neighbour graph
HELD_OUT = 8  # one in so many sample rows is not learned from and sets the mass
WANTED_RECALL = 0.94
HIDDEN = 96
EPOCHS = 30
PIECE_ROWS = 4_096  # entries of a part that one task compares at once
CHUNK_ROWS = 512  # queries for a part that one task compares at once


class Router(NamedTuple):
    """The classifier: standardised input, one hidden layer, a probability for each part."""

    shift: np.ndarray
    scale: np.ndarray
    weights: tuple[np.ndarray, ...]
    mass: float

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        return _forward((vectors - self.shift) / self.scale, self.weights)[1]

    def parts(self, vectors: np.ndarray) -> np.ndarray:
        return self.probabilities(vectors).argmax(1)

    def routes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (vector, part): its most probable parts until they reach the mass."""
        order, before = _mass_before(self.probabilities(vectors))
        row, place = np.nonzero(before < self.mass)
        return row, order[row, place]


def _forward(x: np.ndarray, weights) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.maximum(x @ weights[0] + weights[1], 0)
    raised = hidden @ weights[2] + weights[3]
    raised = np.exp(raised - raised.max(1, keepdims=True))
    return hidden, raised / raised.sum(1, keepdims=True)


def _mass_before(probability: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts of each row by falling probability, and the mass of those before each."""
    order = np.argsort(-probability, axis=1, kind="stable")
    sorted_mass = np.take_along_axis(probability, order, 1)
    return order, np.cumsum(sorted_mass, 1) - sorted_mass


def neighbour_graph(vectors: np.ndarray, of: np.ndarray, degree: int) -> np.ndarray:
    """For the rows `of`, the numbers of the other rows with the largest inner products."""
    out = []
    for some in np.array_split(of, max(1, len(of) // 1024)):
        near = vectors[some] @ vectors.T
        near[np.arange(len(some)), some] = -np.inf
        out.append(np.argpartition(-near, degree - 1, axis=1)[:, :degree])
    return np.concatenate(out)


def balanced_parts(vectors: np.ndarray, graph: np.ndarray, parts: int, rng) -> np.ndarray:
    """A part for each row, of equal sizes up to one, with few edges of the graph between parts.

    It starts from halves along the widest of some directions, again and again; then rows of two parts change places as long
    as both together gain edges.
    """
    n = len(vectors)
    part = np.zeros(n, np.int64)
    pending, done = [(np.arange(n), parts)], 0
    while pending:
        rows, count = pending.pop()
        if count == 1 or len(rows) < 2:
            part[rows] = done
            done += count
            continue
        directions = vectors[rng.choice(rows, min(16, len(rows)), replace=False)]
        spread = vectors[rows] @ directions.T
        along = spread[:, spread.var(0).argmax()]
        half = count // 2
        order = rows[np.argsort(along, kind="stable")]
        cut = len(rows) * half // count
        pending += [(order[:cut], half), (order[cut:], count - half)]
    source = np.repeat(np.arange(n), graph.shape[1])
    one, other = np.concatenate([source, graph.ravel()]), np.concatenate([graph.ravel(), source])
    for _ in range(40):
        edges = np.bincount(one * parts + part[other], minlength=n * parts).reshape(n, parts)
        best = edges.argmax(1)
        gain = edges[np.arange(n), best] - edges[np.arange(n), part]
        movers = np.flatnonzero((gain > 0) & (rng.random(n) < 0.6))
        if not len(movers):
            break
        way = part[movers] * parts + best[movers]
        order = np.lexsort((-gain[movers], way))
        movers, way = movers[order], way[order]
        place = np.arange(len(way)) - np.searchsorted(way, way)
        back = best[movers] * parts + part[movers]
        returning = np.searchsorted(way, back, "right") - np.searchsorted(way, back)
        swapped = movers[place < returning]
        if not len(swapped):
            break
        part[swapped] = best[swapped]
    return part


def learn(vectors: np.ndarray, parts: int, n: int, seed: int = 7) -> Router:
    """Parts and classifier from a sample of vectors."""
    rng = np.random.default_rng(seed)
    vectors = np.asarray(vectors, np.float64)
    count, width = vectors.shape
    shift, scale = vectors.mean(0), np.maximum(vectors.std(0), 1e-12)
    parts = max(1, min(parts, count // 16))
    if parts == 1:
        return Router(shift, scale, (np.zeros((width, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)), 1.0)
    held = np.arange(count) % HELD_OUT == 0
    seen = vectors[~held]
    degree = min(DEGREE, len(seen) - 1)
    graph = neighbour_graph(seen, np.arange(len(seen)), degree)
    part = balanced_parts(seen, graph, parts, rng)
    wanted = np.zeros((len(seen), parts))
    np.add.at(wanted, (np.repeat(np.arange(len(seen)), degree + 1), np.column_stack([part, part[graph]]).ravel()), 1 / (degree + 1))
    weights = _fit((seen - shift) / scale, wanted, rng)
    router = Router(shift, scale, weights, 1.0)
    asked = np.flatnonzero(held)
    near = neighbour_graph(vectors, asked, min(n, count - 1))
    order, before = _mass_before(router.probabilities(vectors[asked]))
    mass_at = np.empty_like(before)
    np.put_along_axis(mass_at, order, before, 1)
    needed = np.take_along_axis(mass_at, router.parts(vectors)[near], 1)
    mass = np.quantile(needed, WANTED_RECALL, method="higher")
    return router._replace(mass=float(np.nextafter(mass, 2)))


def _fit(x: np.ndarray, wanted: np.ndarray, rng) -> tuple[np.ndarray, ...]:
    """Weights that minimise the cross entropy, by steps with running first and second moments."""
    sizes = [(x.shape[1], HIDDEN), (1, HIDDEN), (HIDDEN, wanted.shape[1]), (1, wanted.shape[1])]
    weights = [rng.normal(0, (2 / a) ** 0.5, (a, b)) if a > 1 else np.zeros((a, b)) for a, b in sizes]
    first, second = [np.zeros(s) for s in sizes], [np.zeros(s) for s in sizes]
    step = 0
    for epoch in range(EPOCHS):
        for some in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            step += 1
            hidden, guess = _forward(x[some], weights)
            up = (guess - wanted[some]) / len(some)
            down = (up @ weights[2].T) * (hidden > 0)
            slopes = (x[some].T @ down, down.sum(0, keepdims=True), hidden.T @ up, up.sum(0, keepdims=True))
            rate = 2e-3 * (1 - epoch / EPOCHS)
            for i, slope in enumerate(slopes):
                slope = slope + 1e-4 * weights[i]
                first[i] += 0.1 * (slope - first[i])
                second[i] += 0.001 * (slope**2 - second[i])
                weights[i] = weights[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return tuple(weights)


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """id, v of the rows that take part, v as doubles of one length."""
    fit = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    found = rows.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & fit)
    width = found.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]
    filled = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v")))
    # Adding 0 turns -0 into 0, so that equal vectors have equal bytes.
    return found.select("id", F.transform(filled, lambda x: x + F.lit(0.0)).alias("v")).dropDuplicates(["id", "v"])


def folded(vectors: DataFrame, most: int) -> DataFrame:
    """One row per distinct vector: entry (its smallest id and a hash), ids (the `most` smallest), v."""
    seen = vectors.withColumn("look", F.struct(F.xxhash64("v").alias("a"), F.xxhash64(F.lit(1), F.reverse("v")).alias("b")))
    least = top_per_group(seen, ["look"], most, [F.col("id")])
    return least.groupBy("look").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.first("v").alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fitted(entries: DataFrame, n: int, sample: int, parts: int) -> Router:
    """The router, learned in one task from about `sample` entries."""
    share = sample / max(entries.count(), 1)
    drawn = entries.where((F.abs(F.xxhash64(F.col("look.b"))) % (1 << 30)) < F.lit(int(share * (1 << 30)))) if share < 1 else entries

    def fit(table: pa.Table) -> pa.Table:
        # In the order of the hashes, so that the same rows give the same parts wherever they were read.
        router = learn(_matrix(table.sort_by("a").column("v")), parts, n)
        packed = [router.shift, router.scale, *router.weights, np.array([router.mass])]
        return pa.table({"place": range(len(packed)), "shape": [list(p.shape) for p in packed], "values": [p.ravel() for p in packed]})

    model = drawn.select(F.col("look.a").alias("a"), "v", F.lit(0).alias("one")).groupBy("one").applyInArrow(
        fit, "place bigint, shape array<bigint>, values array<double>"
    )
    rows = sorted(model.collect())
    if not rows:
        return Router(np.zeros(0), np.ones(0), (), 1.0)
    shift, scale, *weights, mass = (np.array(r["values"]).reshape(r["shape"]) for r in rows)
    return Router(shift, scale, tuple(weights), float(mass[0]))


def best_of(asked: np.ndarray, offered: np.ndarray, ties: np.ndarray, keep: int):
    """(row, column, score) of the `keep` largest inner products of each asked row, equal ones by the smaller tie.

    A matrix product finds the candidates; their scores are summed in one fixed order, so that equal pairs have equal scores.
    """
    rough = asked @ offered.T
    if rough.shape[1] > keep:
        slack = 1e-12 * (np.abs(asked).max(1) * np.abs(offered).max() * asked.shape[1])
        floor = np.partition(rough, -keep, axis=1)[:, -keep] - slack
        row, column = np.nonzero(rough >= floor[:, None])
    else:
        row, column = (x.ravel() for x in np.indices(rough.shape))
    score = np.concatenate([(asked[r] * offered[c]).sum(1) for r, c in zip(_steps(row), _steps(column))])
    order = np.lexsort((ties[column], -score, row))
    row, column, score = row[order], column[order], score[order]
    first = np.arange(len(row)) - np.searchsorted(row, row) < keep
    return row[first], column[first], score[first]


def _steps(places: np.ndarray) -> list[np.ndarray]:
    return np.array_split(places, max(1, len(places) // 65_536))


def _dealt(rows: DataFrame, sizes: DataFrame, most: int, number: str, name: str) -> DataFrame:
    """Rows of a part packed by at most about `most`, with the part's numbers of pieces and chunks."""
    piece = F.pmod(F.xxhash64("look.b", F.lit(name)), F.col(number)).cast("int")
    # At most PARTS rows.
    packed = rows.join(F.broadcast(sizes), "part").groupBy("part", piece.alias(name), "pieces", "chunks")
    return packed.agg(F.collect_list(F.struct("look", "least", "v")).alias(f"{name}_rows"))


def nearest(
    rows: DataFrame,
    asked: DataFrame,
    n: int,
    key: str = "vec_id",
    vector: str = "embedding",
    sample: int = SAMPLE,
    parts: int = PARTS,
) -> DataFrame:
    """For each asked id the n nearest rows found: query_id, rank, id (as `key`), score.

    `asked` has the column `key`; an id that `rows` does not hold gives nothing.
    """
    vectors = usable(rows, key, vector)
    entries = stored(folded(vectors, n + 1))
    wanted = asked.select(F.col(key).alias("id")).distinct()
    look = F.struct(F.xxhash64("v").alias("a"), F.xxhash64(F.lit(1), F.reverse("v")).alias("b"))
    asked_rows = stored(vectors.join(wanted, "id", "left_semi").select("id", look.alias("look")))
    asked_looks = asked_rows.select("look").distinct()
    router = fitted(entries, n, sample, parts)

    def route(several: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                vectors = _matrix(batch.column("v"))
                row, part = router.routes(vectors) if several else (np.arange(len(vectors)), router.parts(vectors))
                yield batch.take(pa.array(row)).append_column("part", pa.array(part, pa.int64()))

        return run

    entries = entries.withColumn("least", F.col("ids")[0])
    plain = entries.select("look", "least", "v")
    schema = f"look struct<a:bigint,b:bigint>, least {plain.schema['least'].dataType.simpleString()}, v array<double>, part bigint"
    indexed = stored(plain.mapInArrow(route(False), schema))
    queries = stored(plain.join(asked_looks, "look", "left_semi").mapInArrow(route(True), schema))
    pieces = indexed.groupBy("part").agg(F.ceil(F.count("*") / PIECE_ROWS).alias("pieces"))
    chunks = queries.groupBy("part").agg(F.ceil(F.count("*") / CHUNK_ROWS).alias("chunks"))
    sizes = pieces.join(chunks, "part")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    offered = _dealt(indexed, sizes, PIECE_ROWS, "pieces", "piece")
    offered = offered.withColumn("chunk", F.explode(F.sequence(F.lit(0), (F.col("chunks") - 1).cast("int"))))
    asking = _dealt(queries, sizes, CHUNK_ROWS, "chunks", "chunk")
    asking = asking.withColumn("piece", F.explode(F.sequence(F.lit(0), (F.col("pieces") - 1).cast("int"))))
    keys = ["part", "piece", "chunk"]
    both = offered.drop("pieces", "chunks").repartition(tasks, *keys).join(
        asking.drop("pieces", "chunks").repartition(tasks, *keys).hint("shuffle_hash"), keys
    )
    keep = n + 1

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                theirs, ours = batch.column("piece_rows")[i].values, batch.column("chunk_rows")[i].values
                ids = theirs.field("least")
                by_id = np.empty(len(ids), np.int64)
                by_id[pa.compute.sort_indices(ids).to_numpy()] = np.arange(len(ids))
                row, column, score = best_of(_matrix(ours.field("v")), _matrix(theirs.field("v")), by_id, keep)
                yield pa.RecordBatch.from_arrays(
                    [ours.field("look").take(pa.array(row)), *(theirs.field(c).take(pa.array(column)) for c in ("look", "least")), pa.array(score)],
                    names=["look", "other", "least", "score"],
                )

    kind = plain.schema["least"].dataType.simpleString()
    look_type = "struct<a:bigint,b:bigint>"
    found = both.select("piece_rows", "chunk_rows").mapInArrow(compare, f"look {look_type}, other {look_type}, least {kind}, score double")
    best = top_per_group(found, ["look"], keep, [F.col("score").desc(), F.col("least")])
    ids = entries.select(F.col("look").alias("other"), "ids")
    each = best.join(ids, "other").select("look", "score", F.explode("ids").alias("id"))
    lists = top_per_group(each, ["look"], keep, [F.col("score").desc(), F.col("id")]).drop("rank")
    own = asked_rows.select(F.col("id").alias("query_id"), "look")
    order = Window.partitionBy("query_id", "look").orderBy(F.col("score").desc(), F.col("id"))
    out = own.join(lists, "look").where(F.col("id") != F.col("query_id"))
    out = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return out.select("query_id", "rank", F.col("id").alias(key), "score")
