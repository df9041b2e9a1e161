"""Cosine similarity between titles and between vectors, never as an N x N table.

`similar_to` compares a list of liked titles with all titles, block by block. `neighbours` and `vector_neighbours` find the nearest
rows of every row.

Titles have few labels, and the more titles there are, the fewer labels tell a title from its nearest. So `neighbours` searches in rounds: in a
round of radius r, rows meet where they agree in all of some families. The families are dealt out so that no two rows that differ in r families or
fewer miss each other. What differs in more has a known greatest cosine; a row whose n-th is above it is finished. Few rows, or
rows that nothing spares a comparison, are left to the balls.

Vectors lie in balls around a bounded number of centres. The angle between a row and a ball's centre, less the
ball's radius, bounds how similar any of its rows can be. So each row is first compared with the balls nearest to it, and then only
with those that could hold a row as similar as its n-th. Blocks of rows and pieces of balls meet in the cells of a grid, so that a row is
sent as often as the grid is wide and not once per ball. Comparisons are
matrix products inside Spark tasks, of a bounded piece of a ball with a bounded number of rows, and return only the best.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..storage import stored
from .features import FeatureSettings
from .ranking import top_per_group

LIKED_ROWS = 512  # liked titles in one block
BROADCAST_LIKED = 50_000  # liked titles up to which their blocks are broadcast
PIECE_BYTES = 1 << 21  # of numbers in a piece of a ball
PIECE_ROWS = 4_096  # most rows of a piece
ROWS_PER_BALL = 4_096
MOST_BALLS = 256
BALLS_FIRST = 2  # balls that a row is compared with before the others are judged
SLACK = 1e-6  # more than what rounding does to a cosine on its way through an angle
COLUMN_PIECES = 64  # pieces of a column of the grid, in the memory of one task
CELLS_AT_ONCE = 1 << 23  # similarities held in memory by one task
MOST_KEYS = 24  # places that a row is sent to in a round
KEY_COST = 300  # comparisons that take as long as sending a row to one place
FIRST_COST = 6_000  # comparisons for each row that the first round may cost
FEW_PAIRS = 1 << 30  # pairs up to which all are compared rather than searched in rounds
FEW_CHUNKS = 16  # chunks of rows up to which they are compared with all others without balls


def families_of(labels: DataFrame) -> list[str]:
    return [c for c in labels.columns if c != "id"]


def total_weight(labels: DataFrame, settings: FeatureSettings) -> Column:
    """The squared norm of a title: the weights of the features it has."""
    parts = [
        F.when(F.col(f).isNotNull(), F.lit(settings.weight(f))).otherwise(0) for f in families_of(labels)
    ]
    return sum(parts[1:], parts[0])


def similar_to(labels: DataFrame, liked: DataFrame, n: int, settings: FeatureSettings) -> DataFrame:
    """The n titles most similar to each liked title, liked ones left out: liked_id, pos, id, sim, rank.

    `liked` has the columns pos and id and may be of any length: it is compared in blocks of about LIKED_ROWS, each with all
    titles. Per liked title and partition only n rows are shuffled. Equal similarities are ordered by id.
    """
    families = families_of(labels)
    norm = total_weight(labels, settings)
    known = liked.join(labels, "id").withColumn("weight", norm)
    wanted = liked.count()
    blocks = max(1, math.ceil(wanted / LIKED_ROWS))
    number = F.pmod(F.xxhash64("id", "pos"), F.lit(blocks)).cast("int")
    packed = known.groupBy(number.alias("block")).agg(
        F.collect_list(F.struct("pos", "id", "weight", *families)).alias("liked")
    )
    candidates = labels.join(liked.select("id").distinct(), "id", "left_anti").withColumn("weight", norm)
    each = candidates.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    if wanted <= BROADCAST_LIKED:
        pairs = each.join(F.broadcast(packed), "block")
    else:
        # Every slice of the catalogue meets its own copy of each block, so that no block gathers the whole catalogue.
        slices = int(labels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        copies = packed.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        pairs = each.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int")).join(copies, ["block", "slice"]).drop("slice")
    pairs = pairs.drop("block").withColumn("l", F.explode("liked"))
    shared = [
        F.when(F.col(f) == F.col(f"l.{f}"), F.lit(settings.weight(f))).otherwise(0) for f in families
    ]
    overlap = sum(shared[1:], shared[0])
    scored = pairs.select(
        F.col("l.id").alias("liked_id"),
        F.col("l.pos").alias("pos"),
        "id",
        F.try_divide(overlap, F.sqrt(F.col("weight") * F.col("l.weight"))).alias("sim"),
    )
    return top_per_group(scored, ["liked_id", "pos"], n, [F.col("sim").desc(), F.col("id")])


def best_columns(similarity: np.ndarray, ties: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the `keep` best columns of each row; equal ones by the smaller tie value, of the column or of the cell."""
    if similarity.shape[1] > keep:
        floor = np.partition(similarity, -keep, axis=1)[:, -keep]
        row, column = np.nonzero(similarity >= floor[:, None])
    else:
        row, column = np.nonzero(np.ones(similarity.shape, dtype=bool))
    tie = ties[column] if ties.ndim == 1 else ties[row, column]
    order = np.lexsort((tie, -similarity[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    first = place < keep
    return row[first], column[first]


def _shared_weight(a: np.ndarray, b: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weight of the equal codes of each row pair, as a product of one-hot matrices. Code 0 is 'missing'."""
    left, right = [], []
    for i, weight in enumerate(weights):
        labels = np.unique(b[:, i])
        labels = labels[labels != 0]
        left.append((a[:, i][:, None] == labels).astype(np.float32) * np.float32(weight))
        right.append((b[:, i][:, None] == labels).astype(np.float32))
    # Sums of small whole numbers are exact in float32.
    return (np.hstack(left) @ np.hstack(right).T).astype(np.float64)


def cosines_of_codes(weights: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """The cosine of label codes: the weight of equal ones over the root of both weights. Code 0 is 'missing'."""

    def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        size = ((a != 0) @ weights)[:, None] * ((b != 0) @ weights)[None, :]
        return _shared_weight(a, b, weights) / np.sqrt(np.maximum(size, 1e-300))

    return cosines


def cosines_of_vectors(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (a, b))
    return a @ b.T


@dataclass(frozen=True)
class Balls:
    """Centres, and the largest angle between each and the rows that are nearest to it (-1: there are none)."""

    cosines: Callable[[np.ndarray, np.ndarray], np.ndarray]
    centres: np.ndarray
    radii: np.ndarray | None = None

    def angles(self, rows: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(self.cosines(rows, self.centres), -1, 1))

    def nearest_ones(self, angle: np.ndarray) -> np.ndarray:
        """Of the rows with these angles, which balls are nearest to them."""
        angle = np.where(self.radii < 0, np.inf, angle)
        first = np.zeros(angle.shape, bool)
        np.put_along_axis(first, np.argsort(angle, axis=1, kind="stable")[:, :BALLS_FIRST], True, 1)
        return first & np.isfinite(angle)

    def most_in_others(self, rows: np.ndarray) -> np.ndarray:
        """For each row and ball the greatest cosine that it may find there; none (-inf) in the balls nearest to it and in empty ones."""
        angle = self.angles(rows)
        most = np.cos(np.minimum(np.maximum(angle - self.radii, 0), np.pi))
        return np.where(self.nearest_ones(angle) | (self.radii < 0), -np.inf, most)


def _matrix(values: pa.Array) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def choose_centres(sample: np.ndarray, wanted: int, cosines, seed: int = 5) -> np.ndarray:
    """Rows of a sample that lie apart: each is drawn by the square of its distance to those drawn before."""
    rng = np.random.default_rng(seed)
    chosen = [0]
    far = np.full(len(sample), np.inf)
    while len(chosen) < min(wanted, len(sample)):
        angle = np.arccos(np.clip(cosines(sample, sample[chosen[-1:]])[:, 0], -1, 1))
        far = np.minimum(far, np.where(angle < 1e-6, 0, angle) ** 2)
        if far.sum() <= 0:
            break
        chosen.append(int(rng.choice(len(sample), p=far / far.sum())))
    return sample[chosen]


def in_balls(rows: DataFrame, cosines) -> tuple[DataFrame, Balls] | None:
    """The rows (id, values) with the ball they are in, written once, and the balls; None for an empty table."""
    wanted = min(MOST_BALLS, max(1, math.ceil(rows.count() / ROWS_PER_BALL)))
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(4 * wanted).select("values").collect()  # a bounded sample
    if not drawn:
        return None
    balls = Balls(cosines, choose_centres(np.array([r["values"] for r in drawn]), wanted, cosines))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                angle = balls.angles(_matrix(batch.column("values")))
                ball = angle.argmin(1)
                least = angle[np.arange(len(ball)), ball]
                yield batch.append_column("ball", pa.array(ball.astype(np.int32))).append_column("angle", pa.array(least))

    fields = [*rows.schema.fields, T.StructField("ball", T.IntegerType()), T.StructField("angle", T.DoubleType())]
    members = stored(rows.mapInArrow(assign, T.StructType(fields)))
    radii = np.full(len(balls.centres), -1.0)
    for r in members.groupBy("ball").agg(F.max("angle").alias("radius")).collect():  # at most MOST_BALLS rows
        radii[r["ball"]] = r["radius"]
    return members, Balls(cosines, balls.centres, radii)


def routed(asked: DataFrame, balls: Balls) -> DataFrame:
    """id, values, ball: every asked row (id, values) with the balls nearest to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                row, ball = np.nonzero(balls.nearest_ones(balls.angles(_matrix(batch.column("values")))))
                yield batch.take(pa.array(row)).append_column("ball", pa.array(ball.astype(np.int32)))

    fields = [*asked.select("id", "values").schema.fields, T.StructField("ball", T.IntegerType())]
    return asked.select("id", "values").mapInArrow(run, T.StructType(fields))


def _piece_rows(rows: DataFrame) -> int:
    width = rows.agg(F.coalesce(F.max(F.size("values")), F.lit(1))).first()[0]
    return max(1, min(PIECE_ROWS, PIECE_BYTES // (8 * max(width, 1))))


def compared(
    asking: DataFrame, members: DataFrame, keep: int, cosines, with_itself: bool, piece_rows: int, balls: Balls | None = None
) -> DataFrame:
    """id, other, sim: the `keep` most similar members of each piece of a ball for each row that was routed to the ball; with `balls`, of
    the other balls that may hold some (see `compared_with_others`)."""
    if balls is not None:
        return compared_with_others(asking, members, keep, balls, with_itself, piece_rows)
    spark = members.sparkSession
    pieces = members.groupBy("ball").agg(F.ceil(F.count("*") / piece_rows).cast("int").alias("pieces"))
    chunks = asking.groupBy("ball").agg(F.ceil(F.count("*") / piece_rows).cast("int").alias("chunks"))
    sizes = F.broadcast(pieces.join(chunks, "ball"))  # at most MOST_BALLS rows

    def packed(rows: DataFrame, own: str, others: str, number: str, other: str, name: str) -> DataFrame:
        dealt = rows.join(sizes, "ball").withColumn(number, F.pmod(F.xxhash64("id", F.lit(name)), F.col(own)).cast("int"))
        lists = dealt.groupBy("ball", number, others).agg(F.collect_list(F.struct("id", "values")).alias(name))
        return lists.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(others) - 1))).drop(others)

    keys = ["ball", "piece", "chunk"]
    theirs = packed(members.select("id", "values", "ball"), "pieces", "chunks", "piece", "chunk", "theirs")
    ours = packed(asking, "chunks", "pieces", "chunk", "piece", "ours")
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    both = ours.repartition(tasks, *keys).join(theirs.repartition(tasks, *keys).hint("shuffle_hash"), keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ours, theirs = batch.column("ours")[i].values, batch.column("theirs")[i].values
                our_ids, ids = ours.field("id"), theirs.field("id")
                a, b = _matrix(ours.field("values")), _matrix(theirs.field("values"))
                ties = np.empty(len(ids), np.int64)
                ties[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
                own = pc.index_in(our_ids, ids).fill_null(-1).to_numpy(zero_copy_only=False)
                for some in _slices(len(a), len(b)):
                    similarity = cosines(a[some], b)
                    if not with_itself:
                        there = np.flatnonzero(own[some] >= 0)
                        similarity[there, own[some][there]] = -np.inf
                    row, column = best_columns(similarity, ties, keep)
                    found = np.isfinite(similarity[row, column])
                    row, column = row[found], column[found]
                    yield pa.RecordBatch.from_arrays(
                        [our_ids.take(pa.array(row + (some.start or 0))), ids.take(pa.array(column)), pa.array(similarity[row, column])],
                        names=["id", "other", "sim"],
                    )

    kind = members.schema["id"].dataType.simpleString()
    return both.select("ours", "theirs").mapInArrow(run, f"id {kind}, other {kind}, sim double")


def compared_with_others(asked: DataFrame, members: DataFrame, keep: int, balls: Balls, with_itself: bool, piece_rows: int) -> DataFrame:
    """id, other, sim: for each asked row (id, values, ball, least) the `keep` most similar members of balls that may hold one as
    similar as `least`, other than the balls nearest to it; per cell of a square grid.

    Rows of a ball lie in blocks, members in pieces. A block is sent to the cells of its line, a piece to those of its column, so a row is
    sent as often as the grid is wide, however many balls it must be compared with. A cell remembers the best of each row of a block from piece
    to piece, and goes on only with rows for which the next piece may hold better ones.
    """
    spark = members.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pieces = members.groupBy("ball").agg(F.ceil(F.count("*") / piece_rows).cast("int").alias("parts"))
    sizes = F.broadcast(pieces)  # at most MOST_BALLS rows
    # A column of the grid lies in the memory of a task: at most COLUMN_PIECES pieces.
    wide = max(math.ceil(math.sqrt(2 * tasks)), math.ceil(members.count() / piece_rows / COLUMN_PIECES), 1)
    grid = F.sequence(F.lit(0), F.lit(wide - 1))

    def packed(rows: DataFrame, line: str, across: str, name: str, *columns: str) -> DataFrame:
        part = F.pmod(F.xxhash64("id", F.lit(name)), F.col("parts")).cast("int").alias("part")
        lists = rows.join(sizes, "ball").select("ball", part, *columns).groupBy("ball", "part").agg(F.collect_list(F.struct(*columns)).alias(name))
        placed = lists.withColumn(line, F.pmod(F.xxhash64("ball", "part"), F.lit(wide)).cast("int"))
        return placed.withColumn(across, F.explode(grid))

    ours = packed(asked, "line", "column", "ours", "id", "values", "least").withColumnRenamed("ball", "from")
    theirs = packed(members, "column", "line", "theirs", "id", "values").drop("part")
    both = ours.repartition(tasks, "line", "column").join(theirs.repartition(tasks, "line", "column").hint("shuffle_hash"), ["line", "column"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = block = None
        for batch in batches:
            for i in range(batch.num_rows):
                key = batch.column("from")[i].as_py(), batch.column("part")[i].as_py()
                if key != here:
                    if block is not None:
                        yield from block.found()
                    here, block = key, _Block(batch.column("ours")[i].values, balls, keep, with_itself)
                block.look_at(batch.column("ball")[i].as_py(), batch.column("theirs")[i].values)
        if block is not None:
            yield from block.found()

    kind = members.schema["id"].dataType.simpleString()
    return both.select("from", "part", "ball", "ours", "theirs").mapInArrow(run, f"id {kind}, other {kind}, sim double")


class _Block:
    """Asked rows and the best that was found for each of them up to now."""

    def __init__(self, ours: pa.StructArray, balls: Balls, keep: int, with_itself: bool):
        self.ids, self.values = ours.field("id"), _matrix(ours.field("values"))
        self.least = ours.field("least").to_numpy(zero_copy_only=False).copy()
        self.most = balls.most_in_others(self.values)
        self.cosines, self.keep, self.with_itself = balls.cosines, keep, with_itself
        self.row, self.other, self.sim = np.zeros(0, np.int64), self.ids.slice(0, 0), np.zeros(0)

    def look_at(self, ball: int, theirs: pa.StructArray) -> None:
        wanted = np.flatnonzero(self.most[:, ball] >= self.least - SLACK)
        if not len(wanted):
            return
        ids, values = theirs.field("id"), _matrix(theirs.field("values"))
        own = pc.index_in(self.ids.take(pa.array(wanted)), ids).fill_null(-1).to_numpy(zero_copy_only=False)
        for some in _slices(len(wanted), len(values)):
            similarity = self.cosines(self.values[wanted[some]], values)
            if not self.with_itself:
                there = np.flatnonzero(own[some] >= 0)
                similarity[there, own[some][there]] = -np.inf
            if len(values) > self.keep:  # of equal ones all are kept until they are ordered by id
                floor = np.partition(similarity, -self.keep, axis=1)[:, -self.keep]
                floor = np.maximum(floor, self.least[wanted[some]])
            else:
                floor = self.least[wanted[some]]
            row, column = np.nonzero((similarity >= floor[:, None]) & np.isfinite(similarity))
            if len(row):
                self._add(wanted[some][row], ids.take(pa.array(column)), similarity[row, column])

    def _add(self, row: np.ndarray, other: pa.Array, sim: np.ndarray) -> None:
        row, sim = np.concatenate([self.row, row]), np.concatenate([self.sim, sim])
        other = pa.concat_arrays([self.other, other])
        ties = np.empty(len(other), np.int64)
        ties[pc.sort_indices(other).to_numpy()] = np.arange(len(other))
        order = np.lexsort((ties, -sim, row))
        place = np.arange(len(order)) - np.searchsorted(row[order], row[order])
        order = order[place < self.keep]
        self.row, self.other, self.sim = row[order], other.take(pa.array(order)), sim[order]
        last = place[place < self.keep] == self.keep - 1
        self.least[self.row[last]] = np.maximum(self.least[self.row[last]], self.sim[last])

    def found(self) -> Iterator[pa.RecordBatch]:
        if len(self.row):
            yield pa.RecordBatch.from_arrays([self.ids.take(pa.array(self.row)), self.other, pa.array(self.sim)], names=["id", "other", "sim"])


def nearest(rows: DataFrame, keep: int, cosines, asked: DataFrame | None = None, with_itself: bool = False) -> DataFrame:
    """id, other, sim, rank: the `keep` most similar rows of each row (id, values), or of the ids in `asked`; equal ones by id.

    Exact: what is not compared could not be among the first.
    """
    found = in_balls(rows, cosines)
    kind = rows.schema["id"].dataType.simpleString()
    if found is None:
        return rows.sparkSession.createDataFrame([], f"id {kind}, other {kind}, sim double, rank int")
    members, balls = found
    piece_rows = _piece_rows(members)
    ours = members.select("id", "values", "ball")
    if asked is not None:
        ours = ours.join(asked.select("id").distinct(), "id", "left_semi")
    order = [F.col("sim").desc(), F.col("other")]
    none = F.lit(-2.0)  # less than any cosine
    start = routed(ours, balls)
    early = stored(top_per_group(compared(start, members, keep, cosines, with_itself, piece_rows), ["id"], keep, order))
    if len(balls.centres) <= BALLS_FIRST:
        return early
    reached = early.where(F.col("rank") == keep).select("id", F.col("sim").alias("reached"))
    then = ours.join(reached, "id", "left").withColumn("least", F.coalesce("reached", none))
    late = compared(then, members, keep, cosines, with_itself, piece_rows, balls)
    return top_per_group(early.drop("rank").unionByName(late), ["id"], keep, order)


def _slices(rows: int, columns: int) -> Iterator[slice]:
    step = max(1, CELLS_AT_ONCE // max(columns, 1))
    for start in range(0, rows, step):
        yield slice(start, start + step)


@dataclass(frozen=True)
class Families:
    """Of the codes of all rows: the weight of each family, how likely two rows have the same code in it, and whether rows have none (code 0)."""

    weights: np.ndarray
    same: np.ndarray
    missing: np.ndarray

    @classmethod
    def of(cls, rows: DataFrame, weights: np.ndarray) -> Families:
        counts = rows.select(F.posexplode("values").alias("family", "code")).groupBy("family", "code").agg(F.count("*").cast("double").alias("n"))
        found = counts.groupBy("family").agg(
            (F.sum(F.col("n") * F.col("n")) / F.sum("n") / F.sum("n")).alias("same"), F.max(F.col("code") == 0).alias("missing"), F.count("*").alias("codes")
        )
        same, missing = np.ones(len(weights)), np.zeros(len(weights), bool)
        for r in found.collect():  # a row per family
            same[r["family"]] = r["same"] if r["codes"] > 1 else 1.0
            missing[r["family"]] = r["missing"]
        return cls(weights, same, missing)

    def telling(self) -> list[int]:
        """The families in which rows differ, those first that tell the most rows apart."""
        return [int(f) for f in np.argsort(self.same, kind="stable") if self.same[f] < 1 and self.weights[f] > 0]

    def most_with(self, misses: int, present: np.ndarray) -> float:
        """The greatest cosine of a row with these families and one that differs from it in at least so many; -2 if none can."""
        whole = self.weights[present].sum()
        if whole <= 0:
            return math.inf
        telling = np.zeros(len(self.weights), bool)
        telling[self.telling()] = True
        # The other has another code, or none, or one where this row has none; the lightest families cost least.
        kinds = (present & ~self.missing, present & self.missing, ~present)
        other, none, more = (np.concatenate([[0], np.sort(self.weights[k & telling]).cumsum()]) for k in kinds)
        most = -2.0
        for i in range(min(misses, len(other) - 1) + 1):
            for j in range(min(misses - i, len(none) - 1) + 1):
                k = misses - i - j
                if k < len(more):
                    shared = whole - other[i] - none[j]
                    most = max(most, shared / math.sqrt(whole * (whole - none[j] + more[k])) if shared > 0 else 0.0)
        return most


@dataclass(frozen=True)
class Round:
    """The families by which rows meet: those of one entry of `keys` are equal in any two rows that differ in `radius` families or fewer."""

    radius: int
    keys: list[list[int]]
    sent: float  # comparisons that sending the rows is worth
    met: float  # rows that a row is expected to meet

    def cost(self, asked: int) -> float:
        return self.sent + self.met * asked

    @classmethod
    def plan(cls, radius: int, families: Families, rows: int, asked: int) -> Round | None:
        """The cheapest way of dealing the families into parts and leaving out `radius` of the parts."""
        telling, best = families.telling(), None
        for parts in range(radius + 1, len(telling) + 1):
            if math.comb(parts, radius) > MOST_KEYS:
                break
            groups: list[list[int]] = [[] for _ in range(parts)]
            for f in telling:
                # To the part that tells the fewest rows apart up to now.
                min(groups, key=lambda g: (-np.prod(families.same[g]), len(g))).append(f)
            keys = [sorted(f for g in kept for f in g) for kept in combinations(groups, parts - radius)]
            met = sum(rows * float(np.prod(families.same[key])) for key in keys)
            here = cls(radius, keys, float(rows) * len(keys) * KEY_COST, met)
            if best is None or here.cost(asked) < best.cost(asked):
                best = here
        return best


def first_radius(families: Families, rows: int, asked: int) -> int:
    """The largest radius of a round that is still cheap."""
    radius = 1
    while (then := Round.plan(radius + 1, families, rows, asked)) is not None and then.cost(asked) <= min(FIRST_COST, rows / 8) * asked:
        radius += 1
    return radius


def met_in(here: Round, rows: DataFrame, keep: int, families: Families, piece_rows: int) -> DataFrame:
    """mark, id, other, other_mark, sim, copies: for each asked row (id, values, mark, copies, asked) the `keep` most similar of each place where it meets
    others, as far as they are more similar than any row beyond the radius can be. Pairs that meet in several places come several times."""
    spark = rows.sparkSession
    keys = [F.xxhash64(F.lit(i), *[F.get("values", F.lit(f)) for f in key]) for i, key in enumerate(here.keys)]
    keyed = rows.withColumn("key", F.explode(F.array(*keys)))
    # Crowded places are cut into pieces and chunks, so that a task never compares more than one with one at once. At most rows * keys / piece_rows.
    counts = keyed.groupBy("key").agg(F.count("*").alias("n"), F.count_if("asked").alias("asking"))
    crowded = stored(
        counts.where(F.col("n") > piece_rows).select(
            "key", F.ceil(F.col("n") / piece_rows).cast("int").alias("pieces"), F.ceil(F.col("asking") / piece_rows).cast("int").alias("chunks")
        )
    )
    dealt = keyed.join(crowded, "key", "left")
    piece, chunk = (F.pmod(F.xxhash64("mark", F.lit(name)), F.greatest(F.col(name), F.lit(1))).cast("int") for name in ("pieces", "chunks"))

    def cell(a, b, asks, offers):
        return F.struct(F.xxhash64("key", a, b).alias("cell"), asks.alias("asks"), offers.alias("offers"))

    yes, no = F.lit(True), F.lit(False)
    offered = F.transform(F.sequence(F.lit(1), F.col("chunks")), lambda c: cell(c - 1, piece, no, yes))
    asking = F.transform(F.sequence(F.lit(1), F.col("pieces")), lambda p: cell(chunk, p - 1, yes, no))
    nothing = F.filter(asking, lambda c: F.lit(False))
    cells = F.when(F.col("pieces").isNull(), F.array(cell(F.lit(0), F.lit(0), F.col("asked"), yes))).otherwise(
        F.concat(F.when(F.col("chunks") > 0, offered).otherwise(nothing), F.when(F.col("asked"), asking).otherwise(nothing))
    )
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = dealt.select("id", "values", "mark", "copies", F.explode(cells).alias("c")).select("c.*", "id", "mark", "copies", "values")
    placed = placed.repartition(tasks, "cell").sortWithinPartitions("cell", "id", "mark")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors: dict[bytes, float] = {}
        left = None
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch]) if left is None else pa.concat_tables([left, pa.Table.from_batches([batch])])
                cell = table.column("cell")
                at = len(table) - 1
                last = cell[at]
                # All but the last cell, which may go on in the next batch.
                at = int(np.searchsorted(cell.to_numpy(), last.as_py()))
                if at:
                    yield from _met(table.slice(0, at), here, keep, families, floors)
                left = table.slice(at)
        if left is not None:
            yield from _met(left, here, keep, families, floors)

    kind = rows.schema["id"].dataType.simpleString()
    return placed.mapInArrow(run, f"mark bigint, id {kind}, other {kind}, other_mark bigint, sim double, copies int")


def _met(table: pa.Table, here: Round, keep: int, families: Families, floors: dict[bytes, float]) -> Iterator[pa.RecordBatch]:
    batch = table.combine_chunks().to_batches(max_chunksize=len(table))[0]
    cell, codes = batch.column("cell").to_numpy(), _matrix(batch.column("values"))
    asks, offers = (batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("asks", "offers"))
    present = (codes != 0) & (families.weights > 0)
    weight = present @ families.weights
    floor = np.full(len(codes), np.inf)
    asking = np.flatnonzero(asks)
    if len(asking):
        looks, which = np.unique(np.packbits(present[asking], axis=1), axis=0, return_inverse=True)
        for look in looks:
            if look.tobytes() not in floors:
                known = np.unpackbits(look, count=present.shape[1]).astype(bool)
                floors[look.tobytes()] = families.most_with(here.radius + 1, known) + SLACK
        floor[asking] = np.array([floors[look.tobytes()] for look in looks])[which.ravel()]
    floor[weight <= 0] = np.inf
    used = np.flatnonzero(families.weights > 0)
    mine = np.where(present, codes, 1)[:, used].T.copy()  # a missing label equals nothing
    theirs = np.where(present, codes, 0)[:, used].T.copy()
    weights = families.weights[used]
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    rows, columns, sims = [], [], []
    for start, end in zip(starts, np.r_[starts[1:], len(cell)]):
        a = start + np.flatnonzero(asks[start:end] & np.isfinite(floor[start:end]))
        if not len(a):
            continue
        b = start + np.flatnonzero(offers[start:end])
        for some in _slices(len(a), len(b)):
            r = a[some]
            shared = np.zeros((len(r), len(b)), np.float32)  # sums of small whole numbers are exact
            for f, w in enumerate(weights):
                equal = mine[f, r][:, None] == theirs[f, b]
                shared += equal if w == 1 else equal * np.float32(w)
            # First a bound in float32, then the cosine itself of what passes it.
            low = (floor[r] * np.sqrt(weight[r]) * (1 - SLACK)).astype(np.float32)[:, None]
            row, column = np.nonzero(shared >= low * np.sqrt(weight[b]).astype(np.float32))
            if not len(row):
                continue
            sim = shared[row, column].astype(np.float64) / np.sqrt(np.maximum(weight[r[row]] * weight[b[column]], 1e-300))
            above = sim > floor[r[row]]
            row, column, sim = row[above], column[above], sim[above]
            order = np.lexsort((column, -sim, row))  # columns are in the order of their ids
            row, column, sim = row[order], column[order], sim[order]
            first = np.arange(len(row)) - np.searchsorted(row, row) < keep
            rows.append(r[row[first]]), columns.append(b[column[first]]), sims.append(sim[first])
    if rows:
        row, column = pa.array(np.concatenate(rows)), pa.array(np.concatenate(columns))
        ids, marks, copies = (batch.column(c) for c in ("id", "mark", "copies"))
        yield pa.RecordBatch.from_arrays(
            [marks.take(row), ids.take(row), ids.take(column), marks.take(column), pa.array(np.concatenate(sims)), copies.take(column)],
            names=["mark", "id", "other", "other_mark", "sim", "copies"],
        )


def nearest_by_labels(rows: DataFrame, keep: int, weights: np.ndarray, asked: DataFrame | None = None) -> DataFrame:
    """id, other, sim: for each row (id, values, copies), or for the ids in `asked`, its most similar rows, itself included, as many as together hold
    `keep` copies and no more than `keep`; equal ones by id. Values are codes of labels, no two rows have all the same.

    Exact. A round finds all rows that differ in so many families or fewer; a row is finished when it has enough that are more similar than any
    other row can be. The radius grows as long as that is cheaper than to compare the rows that are left with all.
    """
    marked = rows.withColumn("mark", F.xxhash64("values"))
    if asked is None:
        current = stored(marked.withColumn("asked", F.lit(True)))
    else:
        wanted = asked.select("id").distinct().withColumn("asked", F.lit(True))
        current = stored(marked.join(wanted, "id", "left").withColumn("asked", F.coalesce("asked", F.lit(False))))
    total, left = current.agg(F.count("*"), F.count_if("asked")).first()
    families, piece_rows = Families.of(current, weights), _piece_rows(current)
    radius = first_radius(families, total, left)
    cosines, parts = cosines_of_codes(weights), []
    while left:
        here = Round.plan(radius, families, total, left)
        if here is None or left * total <= FEW_PAIRS or here.cost(left) >= float(left) * total:
            if left <= FEW_CHUNKS * piece_rows:
                whole = current.withColumn("ball", F.lit(0)).select("id", "values", "ball")
                some = current.where("asked").withColumn("ball", F.lit(0)).select("id", "values", "ball")
                rest = top_per_group(compared(some, whole, keep, cosines, True, piece_rows), ["id"], keep, [F.col("sim").desc(), F.col("other")])
            else:
                rest = nearest(current.select("id", "values"), keep, cosines, current.where("asked").select("id"), with_itself=True)
            parts.append(rest.select("id", "other", "sim"))
            break
        pairs = met_in(here, current, keep, families, piece_rows).repartition("mark").dropDuplicates(["mark", "other_mark"])
        best = top_per_group(pairs, ["mark"], keep, [F.col("sim").desc(), F.col("other")])
        enough = F.sum("copies").over(Window.partitionBy("mark")) >= keep
        finished = stored(best.withColumn("enough", enough).where("enough").select("mark", "id", "other", "sim"))
        parts.append(finished.select("id", "other", "sim"))
        gone = finished.select("mark").distinct().withColumn("gone", F.lit(True))
        then = current.join(gone, "mark", "left").withColumn("asked", F.col("asked") & F.col("gone").isNull()).drop("gone")
        current = stored(then)
        left = current.where("asked").count()
        radius += 1
    found = parts[0] if parts else current.limit(0).select("id", F.col("id").alias("other"), F.lit(0.0).alias("sim"))
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def coded_labels(labels: DataFrame) -> DataFrame:
    """id, look (one text for equal labels) and codes (a number per family, 0 for a missing label), written once."""
    families = families_of(labels)
    return stored(
        labels.select("id", F.array(*families).alias("features")).select(
            "id",
            F.md5(F.to_json(F.struct("features"))).alias("look"),
            F.transform("features", lambda x: F.when(x.isNotNull(), F.xxhash64(x)).otherwise(0)).alias("codes"),
        )
    )


def profiles_of(coded: DataFrame, keep: int) -> DataFrame:
    """One row per look: codes, profile (its smallest id), ids (its `keep` smallest, sorted)."""
    smallest = top_per_group(coded, ["look"], keep, [F.col("id")])
    return stored(
        smallest.groupBy("look").agg(
            F.first("codes").alias("codes"), F.min("id").alias("profile"), F.sort_array(F.collect_list("id")).alias("ids")
        )
    )


def title_lists(best: DataFrame, ids: DataFrame, keep: int) -> DataFrame:
    """id, entries: for each profile of `best` (id, other, sim) the `keep` titles of the profiles it names, most similar first, equal ones by id; each
    with rank, other (the title) and sim. `ids` has the titles of each profile (other, ids)."""
    titles = best.join(ids, "other").select("id", "sim", F.explode("ids").alias("other"))
    ranked = top_per_group(titles, ["id"], keep, [F.col("sim").desc(), F.col("other")])
    return ranked.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rank", "other", "sim"))).alias("entries"))


def code_weights(labels: DataFrame, settings: FeatureSettings) -> np.ndarray:
    return np.array([settings.weight(f) for f in families_of(labels)], dtype=np.float64)


def neighbours(
    labels: DataFrame, n: int, settings: FeatureSettings, of: DataFrame | None = None
) -> DataFrame:
    """The n titles most similar to each title: id, other, sim, rank; equal similarities by id.

    `of` restricts the titles that neighbours are looked up for. Titles with the same labels are folded to one
    profile that keeps its n + 1 smallest ids: no title can need more of them, so nothing is lost and a group of
    copies costs the same as a single title. A profile goes by its smallest id.
    """
    keep = n + 1
    coded = coded_labels(labels)
    profiles = profiles_of(coded, keep)
    if of is None:
        asked_titles, asked = coded, None
    else:
        asked_titles = coded.join(of.select("id"), "id", "left_semi")
        looks = asked_titles.select("look").distinct()
        asked = profiles.join(looks, "look", "left_semi").select(F.col("profile").alias("id"))
    rows = profiles.select(F.col("profile").alias("id"), F.col("codes").alias("values"), F.size("ids").alias("copies"))
    best = nearest_by_labels(rows, keep, code_weights(labels, settings), asked)
    lists = title_lists(best, profiles.select(F.col("profile").alias("other"), "ids"), keep).withColumnRenamed("id", "profile")
    lists = lists.join(profiles.select("profile", "look"), "profile")
    # A profile's list holds n + 1 titles, so n remain for a title that is on it itself.
    own = F.filter("entries", lambda e: e["other"] != F.col("id"))
    return (
        asked_titles.select("id", "look")
        .join(lists, "look")
        .select("id", F.posexplode(F.slice(own, 1, n)).alias("place", "e"))
        .select("id", F.col("e.other").alias("other"), F.col("e.sim").alias("sim"), (F.col("place") + 1).alias("rank"))
    )


def vector_neighbours(vectors: DataFrame, n: int, key: str, vector: str) -> DataFrame:
    """The n nearest vectors of every vector by cosine: key, other, sim, rank.

    NULL and zero vectors, and those with a NULL or infinite number, have no cosine and take no part. The others must be
    of one length.
    """
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("values"))
    square = F.aggregate("values", F.lit(0.0), lambda total, x: total + x * x)
    rows = rows.where((square > 0) & (square < float("inf")))
    lengths = rows.agg(F.min(F.size("values")).alias("low"), F.max(F.size("values")).alias("high")).first()
    if lengths["low"] != lengths["high"]:
        raise ValueError(f"vectors of {lengths['low']} to {lengths['high']} numbers have no cosine")
    return nearest(rows, n, cosines_of_vectors).withColumnRenamed("id", key)


def last_liked_wins(similar: DataFrame, n: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """Of the candidates of several liked titles, each counts once, with the similarity to the last liked
    title it came from; then the n best: keys, id, relevance."""
    once = similar.groupBy(*keys, "id").agg(F.max_by("sim", "pos").alias("relevance"))
    order = [F.col("relevance").desc(), F.col("id")]
    if not keys:
        return once.orderBy(*order).limit(n)
    window = Window.partitionBy(*keys).orderBy(*order)
    return once.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)
