"""Hard negatives: for each anchor and each of its best positives the best rows of other labels in a window of scores.

Every vector becomes whole numbers, so all scores are exact. The candidates are written as Parquet blocks in the order of a Hilbert
curve through their most varied dimensions, each with the smallest and largest number of every dimension and with its
labels. From these zone maps interval arithmetic gives a block's lowest and highest possible score with an anchor. Anchors are
grouped along the same curve, and a group reads the blocks that its anchors' windows need, in two rounds: first, for each anchor, the
blocks with the highest bounds; then those that could still hold one of the wanted rows, given what the first round found. The same is done
for the positives before.

Rows equal in vector and label can only be wanted by their smallest ids, so no more than those are kept; equal anchors are
searched for once. A block, a group of anchors and the zone maps of some hundred blocks are all that a task holds.

Rows without id, label or vector, or with a NULL, infinite or NaN component take no part. Repeated rows count once; rows of
one id are never positives of each other. A shorter vector counts as if filled up with zeros. Equal scores are ordered by id. Scores beyond 64
bits count as the largest or smallest number of 64 bits. An anchor without positives, and a positive without negatives, give no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..operators.ranking import top_per_group
from .storage import stored

BLOCK_ROWS = 2_048
GROUP_ROWS = 256  # anchors that are compared at once
ZONES = 512  # zone maps that are looked at at once
FIRST = 2  # blocks of each set of zone maps that an anchor reads before the others are judged
CURVE_DIMENSIONS, CURVE_BITS = 8, 7
GROUPS_PER_ZONES = 16  # groups that look at one copy of a set of zone maps
GROUPS_PER_BLOCK = 64  # groups that read one copy of a block
ANCHORS_PER_LIST = 5_000  # equal anchors that take their rows from one copy of the result
LOWEST, HIGHEST = 1 - 2**63, 2**63 - 1


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points (columns) with whole coordinates of so many bits (rows)."""
    x = cells.astype(np.int64).copy()
    bit = 1 << (bits - 1)
    while bit > 1:
        for i in range(len(x)):
            swap = np.where(x[i] & bit, 0, (x[0] ^ x[i]) & (bit - 1))
            x[0] ^= np.where(x[i] & bit, bit - 1, swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turned = np.zeros(x.shape[1], np.int64)
    bit = 1 << (bits - 1)
    while bit > 1:
        turned ^= np.where(x[-1] & bit, bit - 1, 0)
        bit >>= 1
    x ^= turned
    place = np.zeros(x.shape[1], np.int64)
    for b in reversed(range(bits)):
        for row in x:
            place = (place << 1) | ((row >> b) & 1)
    return place


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of a with those of b, which hold whole numbers."""
    largest = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if largest < 2.0**53:
        return (a @ b.T).astype(np.int64)
    wide = np.array([[int(x) for x in row] for row in a], object) @ np.array([[int(x) for x in row] for row in b], object).T
    return np.clip(wide, LOWEST, HIGHEST).astype(np.int64)


def bounds(asked: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lowest and highest score that each asked vector (row) can have in each block (column)."""
    up, down = np.maximum(asked, 0), np.minimum(asked, 0)
    both = np.hstack([up, down])
    return products(both, np.hstack([low, high])), products(both, np.hstack([high, low]))


def needed(lowest, highest, fits, low, high, floor, first: bool) -> np.ndarray:
    """Which blocks (columns) each anchor (row) reads in this round.

    `low`, `high` and `floor` have a column per window; a row below the floor is no longer wanted. `fits` says where the block has
    labels that the anchor looks for.
    """

    def reached(from_: np.ndarray) -> np.ndarray:
        some = np.zeros(lowest.shape, bool)
        for w in range(low.shape[1]):
            some |= (highest >= from_[:, w, None]) & (lowest <= high[:, w, None]) & (low[:, w, None] <= high[:, w, None])
        return some & fits

    could = reached(low)
    hope = np.full(lowest.shape, LOWEST)
    for w in range(low.shape[1]):
        hope = np.maximum(hope, np.minimum(highest, high[:, w, None]))
    order = np.argsort(np.where(could, -hope, HIGHEST), axis=1, kind="stable")
    early = np.zeros(lowest.shape, bool)
    np.put_along_axis(early, order[:, :FIRST], True, 1)
    early &= could
    return early if first else reached(np.maximum(low, floor)) & ~early


def wanted_rows(score, allowed, low, high, keep: int):
    """(anchor, window, column) of the `keep` best allowed columns of each window; columns are in the order of the ids."""
    out = []
    for i in range(len(score)):
        mine = np.flatnonzero(allowed[i] & (score[i] >= low[i].min(initial=HIGHEST)) & (score[i] <= high[i].max(initial=LOWEST)))
        mine = mine[np.argsort(-score[i, mine], kind="stable")]
        falling = -score[i, mine]
        for w in range(low.shape[1]):
            a, b = np.searchsorted(falling, -high[i, w]), np.searchsorted(falling, -low[i, w], "right")
            out.append((np.full(max(0, min(b, a + keep) - a), i), w, mine[a : min(b, a + keep)]))
    anchor = np.concatenate([np.zeros(0, np.int64), *(o[0] for o in out)])
    window = np.repeat([o[1] for o in out], [len(o[0]) for o in out]).astype(np.int64)
    return anchor, window, np.concatenate([np.zeros(0, np.int64), *(o[2] for o in out)])


def usable(rows: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """id, label, v (whole numbers, as doubles, of one length) of the rows that take part."""
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    found = rows.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    found = found.where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite)

    def whole(x: Column) -> Column:
        large = F.greatest(F.least(x * scale, F.lit(1e300)), F.lit(-1e300))
        # From 2^53 on every double is a whole number.
        return F.when(F.abs(large) < 2.0**53, F.floor(large).cast("double")).otherwise(large)

    found = found.withColumn("v", F.transform("v", whole))
    width = found.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]
    filled = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v")))
    return found.withColumn("v", filled).dropDuplicates(["id", "label", "v"])


def _kind() -> Column:
    """A name for a vector with a label."""
    return F.struct(F.xxhash64("v", "label").alias("a"), F.xxhash64(F.lit(1), F.reverse("v"), "label").alias("b"))


def _matrix(values: pa.Array) -> np.ndarray:
    """A list of lists of one length as a matrix."""
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _along_curve(rows: DataFrame, frame: tuple[np.ndarray, np.ndarray, np.ndarray], order: list[str]) -> DataFrame:
    """The rows in ranges of the curve, sorted within each."""
    dimensions, low, high = frame

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = _matrix(batch.column("v"))[:, dimensions]
                cells = np.clip((points - low) / np.maximum(high - low, 1e-9) * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1)
                place = hilbert(cells.T, CURVE_BITS) if len(dimensions) else np.zeros(len(points), np.int64)
                yield batch.append_column("place", pa.array(place))

    placed = rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("place", T.LongType())]))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartitionByRange(tasks, "place", *order).sortWithinPartitions("place", *order).withColumn(
        "at", F.spark_partition_id()
    )


def _cut(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, pa.Table]]:
    """Pieces of `size` rows, with a number that no other task gives."""
    held, done = [], 0
    for batch in batches:
        held.append(batch)
        while sum(b.num_rows for b in held) >= size:
            table = pa.Table.from_batches(held)
            yield (table.column("at")[0].as_py() << 32) + done, table.slice(0, size)
            held, done = table.slice(size).to_batches(), done + 1
    table = pa.Table.from_batches(held) if held else None
    if table is not None and table.num_rows:
        yield (table.column("at")[0].as_py() << 32) + done, table


def blocks(rows: DataFrame, frame) -> DataFrame:
    """Candidates as blocks: block, low, high, labels, ids, label, kind (of number) and values; within a block by id."""
    key, label = (rows.schema[c].dataType.simpleString() for c in ("id", "label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in _cut(batches, BLOCK_ROWS):
            table = table.sort_by("id").combine_chunks()
            values = _matrix(table.column("v").chunk(0))
            ids, labels = (table.column(c).chunk(0) for c in ("id", "label"))
            low, high = values.min(0), values.max(0)
            most = max(np.abs(low).max(initial=0), np.abs(high).max(initial=0))
            kind = next((k for k, m in (("<i1", 2**7), ("<i2", 2**15), ("<i4", 2**31)) if most < m), "<f8")
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([number]),
                    "low": [low],
                    "high": [high],
                    "labels": pa.array([labels.unique().to_pylist()], pa.list_(labels.type)),
                    "ids": pa.array([ids.to_pylist()], pa.list_(ids.type)),
                    "label": pa.array([labels.to_pylist()], pa.list_(labels.type)),
                    "kind": [kind],
                    "values": [values.astype(kind).tobytes()],
                }
            )

    schema = (
        f"block bigint, low array<double>, high array<double>, labels array<{label}>, "
        f"ids array<{key}>, label array<{label}>, kind string, values binary"
    )
    return _along_curve(rows, frame, ["id"]).mapInArrow(run, schema)


def grouped(kinds: DataFrame, frame) -> DataFrame:
    """The kinds of anchors with the number of their group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in _cut(batches, GROUP_ROWS):
            table = table.select(["look", "label", "v"]).append_column("group", pa.array([number] * table.num_rows, pa.int64()))
            yield from table.combine_chunks().to_batches()

    schema = T.StructType([*kinds.select("look", "label", "v").schema.fields, T.StructField("group", T.LongType())])
    return _along_curve(kinds, frame, ["look"]).mapInArrow(run, schema)


def _codes(labels: pa.Array, known: pa.Array) -> np.ndarray:
    """The places of labels among the known ones."""
    return pc.index_in(labels, known).fill_null(-1).to_numpy(zero_copy_only=False)


def choose(packed: DataFrame, zones: DataFrame, n_groups: int, n_blocks: int, same: bool, first: bool) -> DataFrame:
    """group, block, rows (the places in the group of the anchors that read it)."""
    sets = max(1, -(-n_blocks // ZONES))
    number = F.pmod(F.xxhash64("block"), F.lit(sets)).cast("int")
    zone_sets = zones.groupBy(number.alias("set")).agg(F.sort_array(F.collect_list(F.struct("block", "low", "high", "labels"))).alias("zones"))
    copies = max(1, -(-n_groups // GROUPS_PER_ZONES))
    copied = zone_sets.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    each = packed.withColumn("set", F.explode(F.sequence(F.lit(0), F.lit(sets - 1))))
    each = each.withColumn("copy", F.pmod(F.xxhash64("group"), F.lit(copies)).cast("int"))
    tasks = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["set", "copy"]
    both = each.repartition(tasks, *keys).hint("shuffle_hash").join(copied.repartition(tasks, *keys), keys)
    pairs = both.select("group", "anchors", "zones")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                anchors, zones = batch.column("anchors")[i].values, batch.column("zones")[i].values
                lowest, highest = bounds(*(_matrix(x) for x in (anchors.field("v"), zones.field("low"), zones.field("high"))))
                lists = zones.field("labels")
                known = anchors.field("label").unique()
                code, listed = _codes(anchors.field("label"), known), _codes(lists.flatten(), known)
                has = np.zeros((len(lists) * (len(known) + 1)), bool)
                owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                has[owner * (len(known) + 1) + listed + 1] = True
                has = has.reshape(len(lists), -1)[:, code + 1].T
                several = lists.value_lengths().to_numpy() > 1
                fits = has if same else several[None, :] | ~has
                low, high, floor = (_matrix(anchors.field(c)) for c in ("low", "high", "floor"))
                reads = needed(lowest, highest, fits, low, high, floor, first)
                some = np.flatnonzero(reads.any(0))
                yield pa.RecordBatch.from_pydict(
                    {
                        "group": pa.array([batch.column("group")[i].as_py()] * len(some), pa.int64()),
                        "block": zones.field("block").take(pa.array(some)),
                        "rows": pa.array([np.flatnonzero(reads[:, j]) for j in some], pa.list_(pa.int64())),
                    }
                )

    return pairs.mapInArrow(run, "group bigint, block bigint, rows array<bigint>")


def read(chosen: DataFrame, packed: DataFrame, stored_blocks: DataFrame, n_groups: int, same: bool, keep: int) -> DataFrame:
    """look, w, score, id: the `keep` best rows of each chosen block for each window of each anchor that reads it."""
    copies = max(1, -(-n_groups // GROUPS_PER_BLOCK))
    tasks = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = chosen.join(packed, "group").withColumn("copy", F.pmod(F.xxhash64("group"), F.lit(copies)).cast("int"))
    candidates = stored_blocks.select("block", "ids", F.col("label").alias("block_label"), "kind", "values")
    candidates = candidates.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    keys = ["block", "copy"]
    both = dealt.repartition(tasks, *keys).hint("shuffle_hash").join(candidates.repartition(tasks, *keys), keys)
    key = stored_blocks.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                anchors = batch.column("anchors")[i].values.take(batch.column("rows")[i].values)
                ids, labels = batch.column("ids")[i].values, batch.column("block_label")[i].values
                kind = batch.column("kind")[i].as_py()
                values = np.frombuffer(batch.column("values")[i].as_buffer(), kind).reshape(len(ids), -1).astype(np.float64)
                score = products(_matrix(anchors.field("v")), values)
                known = anchors.field("label").unique()
                equal = _codes(anchors.field("label"), known)[:, None] == _codes(labels, known)[None, :]
                low, high, floor = (_matrix(anchors.field(c)) for c in ("low", "high", "floor"))
                row, window, column = wanted_rows(score, equal if same else ~equal, np.maximum(low, floor), high, keep)
                yield pa.RecordBatch.from_arrays(
                    [anchors.field("look").take(pa.array(row)), pa.array(window), pa.array(score[row, column]), ids.take(pa.array(column))],
                    names=["look", "w", "score", "id"],
                )

    return both.select("anchors", "rows", "ids", "block_label", "kind", "values").mapInArrow(
        run, f"look struct<a:bigint,b:bigint>, w bigint, score bigint, id {key}"
    )


def _best(found: DataFrame, keep: int) -> DataFrame:
    return top_per_group(found, ["look", "w"], keep, [F.col("score").desc(), F.col("id")])


def _two_rounds(kinds: DataFrame, windows: DataFrame, stored_blocks: DataFrame, n_blocks: int, same: bool, keep: int) -> DataFrame:
    """look, w, score, id, rank: the `keep` best rows of every window. `windows` has look, low and high (arrays)."""
    zones = stored_blocks.select("block", "low", "high", "labels")

    def packed(state: DataFrame) -> DataFrame:
        anchors = F.sort_array(F.collect_list(F.struct("look", "label", "v", "low", "high", "floor")))
        return stored(kinds.join(state, "look").groupBy("group").agg(anchors.alias("anchors")))

    start = packed(windows.withColumn("floor", F.col("low")))
    n_groups = start.count()
    early = stored(_best(read(choose(start, zones, n_groups, n_blocks, same, True), start, stored_blocks, n_groups, same, keep), keep))
    full = early.where(F.col("rank") == keep).groupBy("look").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("reached"))
    lifted = F.transform("low", lambda x, w: F.greatest(x, F.coalesce(F.try_element_at("reached", w.cast("bigint")), x)))
    then = packed(windows.join(full, "look", "left").select("look", "low", "high", lifted.alias("floor")))
    late = read(choose(then, zones, n_groups, n_blocks, same, False), then, stored_blocks, n_groups, same, keep)
    return stored(_best(early.drop("rank").unionByName(late), keep))


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 10,
    percent: tuple[int, int] = (30, 90),
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, for the ids in `anchors` (column `key`).

    A negative's score lies between the two percentages of the positive's. The positive must be among the anchor's first
    `positives`, negatives are ranked by score; scores are inner products of the vectors times `scale`, rounded down.
    """
    all_rows = stored(usable(rows, key, vector, label, scale).withColumn("look", _kind()))
    keep = max(positives + 1, negatives)
    candidates = top_per_group(all_rows, ["look"], keep, [F.col("id")]).select("id", "label", "v")
    spread = candidates.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.variance("x").alias("s"), F.min("x"), F.max("x"))
    widest = sorted(spread.orderBy(F.desc_nulls_last("s"), "d").limit(CURVE_DIMENSIONS).collect())
    frame = tuple(np.array([r[c] for r in widest], t) for c, t in ((0, np.int64), (2, np.float64), (3, np.float64)))
    stored_blocks = stored(blocks(candidates, frame))
    n_blocks = stored_blocks.count()
    asked = all_rows.join(anchors.select(F.col(key).alias("id")).distinct(), "id", "left_semi")
    kinds = stored(grouped(asked.dropDuplicates(["look"]).select("look", "label", "v"), frame))
    all_scores = kinds.select("look", F.array(F.lit(LOWEST)).alias("low"), F.array(F.lit(HIGHEST)).alias("high"))
    best = _two_rounds(kinds, all_scores, stored_blocks, n_blocks, True, positives + 1)
    wide = F.col("score").cast("decimal(20,0)")
    low, high = (wide * F.lit(p).cast("decimal(5,0)") for p in percent)
    # 100 n >= low holds from ceil(low / 100) on, 100 n <= high up to floor(high / 100).
    hundred = F.lit(100).cast("decimal(3,0)")
    best = best.withColumn("from", F.ceil(low / hundred).cast("bigint")).withColumn("to", F.floor(high / hundred).cast("bigint"))
    # Windows of all anchors have one number of places; an empty one begins above its end.
    listed = F.array_sort(F.collect_list(F.struct("rank", "from", "to")))
    fill = F.array_repeat(F.struct(F.lit(0).alias("rank"), F.lit(HIGHEST).alias("from"), F.lit(LOWEST).alias("to")), positives + 1)
    full = best.groupBy("look").agg(F.slice(F.concat(listed, fill), 1, positives + 1).alias("windows"))
    windows = full.select("look", F.col("windows.from").alias("low"), F.col("windows.to").alias("high"))
    found = _two_rounds(kinds, windows, stored_blocks, n_blocks, False, negatives)
    negative = F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("negatives")
    per_window = found.groupBy("look", "w").agg(negative)
    positive = best.select("look", (F.col("rank") - 1).cast("bigint").alias("w"), F.col("id").alias("positive"), "score")
    entries = positive.join(per_window, ["look", "w"], "left")
    lists = entries.groupBy("look").agg(F.array_sort(F.collect_list(F.struct("w", "positive", "score", "negatives"))).alias("lists"))
    return _named(asked.select("id", "look"), lists, positives)


def _named(asked: DataFrame, lists: DataFrame, positives: int) -> DataFrame:
    """The lists of each kind of anchor for every anchor of that kind, without the anchor itself."""
    copies = asked.groupBy("look").agg(F.ceil(F.count("*") / ANCHORS_PER_LIST).cast("int").alias("copies"))
    spread = lists.join(copies, "look").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    dealt = asked.join(copies, "look").withColumn("copy", F.pmod(F.xxhash64("id"), F.col("copies")).cast("int"))
    both = dealt.drop("copies").join(spread.drop("copies"), ["look", "copy"])
    others = F.slice(F.filter("lists", lambda e: e["positive"] != F.col("id")), 1, positives)
    each = both.select("id", F.explode(others).alias("p"))
    return each.select("id", "p", F.explode("p.negatives").alias("n")).select(
        F.col("id").alias("anchor_id"),
        F.col("p.positive").alias("positive_id"),
        F.col("n.rank").alias("rank"),
        F.col("n.id").alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        F.col("n.score").alias("negative_score"),
    )
