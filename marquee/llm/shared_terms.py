"""The highest-scoring documents of many items at once, with the work that items share done once.

Items are taken in blocks of bounded text, items with common words next to each other. In each block sets of terms that
several items share are mined: the largest common set of two items becomes a node, every item and node that contains it
refers to the node instead, and so on while additions are saved. What results is a graph whose leaves are terms (a term that
an item holds k times is a leaf of its own), whose inner nodes are sums of leaves and nodes, and whose ends are the items.

A task takes the documents in shards. It finds the terms of each block in a shard, materialises the scores of every leaf for
all documents of the shard, then those of every node once, and adds them up along the graph into the scores of the items; only rows that
can still be among the first are sent on. The documents are read twice, first to count in how many of them each term occurs, and are
never shuffled. Blocks are written to the shared folder, and tasks read them there one by one.

A term is a run of ASCII digits and letters and characters outside ASCII; A-Z are lower-cased. With N documents that have a term, L terms in
all of them, n in a document, a term in df documents and tf times in this one, it counts
floor(1000 ln((2N + 2) / (2 df + 1))) * ((10^9 tf) div (1000 tf + 8 m)), m = 25 + (75 n N) div L, for each time the item holds it.

NULL and empty texts have no terms: such documents are not counted and not found, such items find nothing. Rows of items equal in id
and text count once, other rows of one id are ranked each for itself; every row of documents is a document, also a repeated one.
Equal scores are ordered by the documents' id, NULL last. Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..operators.ranking import top_per_group
from . import wordhash as wh
from .storage import each_row, stored_at

BLOCK_ITEMS = 256
BLOCK_BYTES = 1 << 18  # of text, unless one item is longer
SHARD_BYTES = 4 << 20
CELLS = 1 << 22  # scores of leaves and nodes held at a time
PLAN = (
    "block bigint, items array<{}>, terms array<bigint>, leaf_term array<int>, leaf_times array<int>, "
    "node_first array<int>, node_parts array<int>, item_first array<int>, item_parts array<int>"
)


class Plan(NamedTuple):
    """The graph of a block. Parts are numbered: leaves, then nodes, each node after its own parts."""

    terms: np.ndarray  # sorted hashes
    leaf_term: np.ndarray
    leaf_times: np.ndarray
    nodes: list[np.ndarray]
    items: list[np.ndarray]

    def additions(self) -> int:
        return sum(map(len, self.nodes)) + sum(map(len, self.items))


def term_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of the texts, and where each text's begin."""
    data, offsets = wh.text_bytes(column)
    data = wh.LOWER[data]
    words = wh.find_words(data, offsets, wh.ALPHANUMERIC)
    return wh.word_hashes(data, words), words.first


def shared_sets(leaves: list[np.ndarray], n_leaves: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Nodes and items as lists of parts, from the leaves of each item. Nodes come in an order in which they can be computed."""
    n_items = len(leaves)
    uses = np.bincount(np.concatenate(leaves), minlength=n_leaves) if leaves else np.zeros(0, np.int64)
    # A leaf of one item is never shared and stays out of the search.
    common = np.flatnonzero(uses > 1)
    column = np.full(n_leaves, -1)
    column[common] = np.arange(len(common))
    room = 64
    held = np.zeros((n_items + room, len(common) + room), np.float32)
    for i, mine in enumerate(leaves):
        held[i, column[mine[column[mine] >= 0]]] = 1
    rows, columns = n_items, len(common)  # in use
    overlap = np.triu(held[:rows, :columns] @ held[:rows, :columns].T, 1)
    while rows > 1 and (best := overlap.max()) >= 2:
        i, j = np.unravel_index(overlap.argmax(), overlap.shape)
        mine = np.flatnonzero(held[i, :columns] * held[j, :columns])
        users = np.flatnonzero(held[:rows, mine].all(1))
        same = [u for u in users if u >= n_items and held[u, :columns].sum() == len(mine)]
        if not same and len(mine) * len(users) <= len(mine) + len(users):
            overlap[i, j] = 0
            continue
        if same:
            node, users = same[0], users[users != same[0]]
        else:
            if rows == len(held) or columns == held.shape[1]:
                held = np.pad(held, ((0, len(held)), (0, room)))
                room *= 2
            node = rows
            held[node, mine] = 1
            rows, columns = rows + 1, columns + 1
            overlap = np.pad(overlap, ((0, 1), (0, 1)))
        place = len(common) + node - n_items
        held[np.ix_(users, mine)] = 0
        held[users, place] = 1
        changed = np.append(users, node)
        fresh = held[changed, :columns] @ held[:rows, :columns].T
        overlap[changed, :] = fresh
        overlap[:, changed] = fresh.T
        overlap = np.triu(overlap, 1)
    parts = np.concatenate([common, n_leaves + np.arange(columns - len(common))])
    of_row = [parts[np.flatnonzero(held[r, :columns])] for r in range(rows)]
    items = [np.concatenate([mine[column[mine] < 0], of_row[i]]) for i, mine in enumerate(leaves)]
    return _in_order(of_row[n_items:], items, n_leaves)


def _in_order(nodes: list[np.ndarray], items: list[np.ndarray], n_leaves: int):
    """Nodes numbered anew so that each comes after its parts."""
    depth = np.zeros(len(nodes), np.int64)
    while True:
        below = [1 + depth[p[p >= n_leaves] - n_leaves].max(initial=-1) for p in nodes]
        if not len(nodes) or np.array_equal(below, depth):
            break
        depth = np.array(below)
    order = np.argsort(depth, kind="stable")
    number = np.empty(len(nodes), np.int64)
    number[order] = np.arange(len(nodes))

    def anew(p: np.ndarray) -> np.ndarray:
        inner = p >= n_leaves
        return np.concatenate([p[~inner], n_leaves + number[p[inner] - n_leaves]])

    return [anew(nodes[k]) for k in order], [anew(p) for p in items]


def plan_of(texts: pa.Array) -> Plan:
    hashes, first = term_hashes(texts)
    terms, number = np.unique(hashes, return_inverse=True)
    item = np.repeat(np.arange(len(texts)), np.diff(first))
    pairs, times = np.unique(item * max(len(terms), 1) + number, return_counts=True)
    item, number = pairs // max(len(terms), 1), pairs % max(len(terms), 1)
    kinds, leaf = np.unique(np.column_stack([number, times]), axis=0, return_inverse=True)
    cuts = np.searchsorted(item, np.arange(len(texts) + 1))
    leaf = leaf.ravel()
    nodes, items = shared_sets([leaf[a:b] for a, b in zip(cuts[:-1], cuts[1:])], len(kinds))
    return Plan(terms, kinds[:, 0], kinds[:, 1], nodes, items)


def _runs(first: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
    return [values[a:b] for a, b in zip(first[:-1], first[1:])]


def _listed(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum([0, *map(len, parts)]), np.concatenate([np.zeros(0, np.int64), *parts])


def blocks(items: DataFrame, key: str, text: str) -> DataFrame:
    """The plans of all items, one row per block."""
    rows = items.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).distinct()
    kind = rows.schema["key"].dataType.simpleString()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rarest hash of an item's terms: items with much in common are likely to agree in it."""
        for batch in batches:
            hashes, first = term_hashes(batch.column("text"))
            least = [int(h.min() >> np.uint64(1)) if len(h) else 0 for h in _runs(first, wh.mixed(hashes))]
            yield batch.append_column("mark", pa.array(least, pa.int64()))

    marked = rows.mapInArrow(mark, f"key {kind}, text string, mark bigint")
    order = ["mark", F.xxhash64("text"), "key"]
    near = marked.repartitionByRange("mark").sortWithinPartitions(*order).withColumn("at", F.spark_partition_id())

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            for shard in wh.shards(batch, "text", BLOCK_BYTES):
                for start in range(0, shard.num_rows, BLOCK_ITEMS):
                    some = shard.slice(start, BLOCK_ITEMS)
                    plan = plan_of(some.column("text"))
                    node_first, node_parts = _listed(plan.nodes)
                    item_first, item_parts = _listed(plan.items)
                    values = [plan.leaf_term, plan.leaf_times, node_first, node_parts, item_first, item_parts]
                    columns = [
                        pa.array([(some.column("at")[0].as_py() << 32) + done], pa.int64()),
                        pa.array([some.column("key").to_pylist()], pa.list_(some.schema.field("key").type)),
                        pa.array([plan.terms.view(np.int64)], pa.list_(pa.int64())),
                        *(pa.array([v], pa.list_(pa.int32())) for v in values),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in PLAN.split(", ")])
                    done += 1

    return near.mapInArrow(build, PLAN.format(kind))


def _each_plan(folder: str) -> Iterator[tuple[int, pa.Array, Plan, pa.RecordBatch]]:
    for row in each_row(folder):
        get = {c: row.column(c)[0].values for c in row.schema.names if c != "block"}
        arrays = {c: v.to_numpy(zero_copy_only=False) for c, v in get.items() if c != "items"}
        yield (
            row.column("block")[0].as_py(),
            get["items"],
            Plan(
                arrays["terms"].astype(np.int64).view(np.uint64),
                arrays["leaf_term"],
                arrays["leaf_times"],
                _runs(arrays["node_first"], arrays["node_parts"]),
                _runs(arrays["item_first"], arrays["item_parts"]),
            ),
            arrays.get("df"),
        )


class _Plans:
    """The plans of a folder as often as a task needs them; the first few stay in memory."""

    def __init__(self, folder: str, most: int = 8):
        self.folder, self.most, self.kept, self.all_kept = folder, most, None, False

    def __iter__(self):
        if self.all_kept:
            yield from self.kept
            return
        kept = []
        for plan in _each_plan(self.folder):
            if len(kept) <= self.most:
                kept.append(plan)
            yield plan
        self.all_kept = len(kept) <= self.most
        self.kept = kept if self.all_kept else None


def _found_terms(terms: np.ndarray, hashes: np.ndarray, first: np.ndarray):
    """(text, term, times) of the terms that occur in the texts."""
    if not len(terms) or not len(hashes):
        return (np.zeros(0, np.int64),) * 3
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    hit = np.flatnonzero(terms[at] == hashes)
    text = np.searchsorted(first, hit, "right") - 1
    pairs, times = np.unique(text * len(terms) + at[hit], return_counts=True)
    return pairs // len(terms), pairs % len(terms), times


def counts(documents: DataFrame, text: str, folder: str) -> DataFrame:
    """block, term, n: in how many documents each term of a block occurs. Block -1: documents with terms, and their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans = _Plans(folder)
        for batch in batches:
            for shard in wh.shards(batch, "text", SHARD_BYTES):
                hashes, first = term_hashes(shard.column(0))
                block, term, n = [[-1, -1]], [[0, 1]], [[int((np.diff(first) > 0).sum()), len(hashes)]]
                for number, _, plan, _ in plans:
                    found = np.bincount(_found_terms(plan.terms, hashes, first)[1], minlength=len(plan.terms))
                    some = np.flatnonzero(found)
                    block.append(np.full(len(some), number)), term.append(plan.terms[some].view(np.int64)), n.append(found[some])
                columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in (block, term, n)]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "term", "n"])

    found = documents.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "block bigint, term bigint, n bigint")
    return found.groupBy("block", "term").agg(F.sum("n").alias("n"))


def scores(plan: Plan, weights: np.ndarray, text: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The score of each text (column) for each item (row) of the block, all additions along its graph."""
    value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[text]))
    parts = np.zeros((len(plan.leaf_term) + len(plan.nodes), len(m)), np.int64)
    # Leaves are in the order of their terms.
    low, high = np.searchsorted(plan.leaf_term, term), np.searchsorted(plan.leaf_term, term, "right")
    times = high - low
    which = np.repeat(np.arange(len(term)), times)
    leaf = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)
    parts[leaf, text[which]] = value[which] * plan.leaf_times[leaf]
    for k, mine in enumerate(plan.nodes):
        np.add.reduce(parts[mine], axis=0, out=parts[len(plan.leaf_term) + k])
    return np.stack([np.add.reduce(parts[mine], axis=0) for mine in plan.items])


def _first(found: np.ndarray, ties: np.ndarray, n: int, floor: np.ndarray):
    """(item, text) of each item's n highest scores above 0 and not below its floor, which is raised to the n-th."""
    if found.shape[1] > n:
        nth = np.partition(found, -n, axis=1)[:, -n]
        np.maximum(floor, nth, out=floor)
    item, text = np.nonzero((found >= floor[:, None]) & (found > 0))
    order = np.lexsort((ties[text], -found[item, text], item))
    item, text = item[order], text[order]
    some = np.arange(len(item)) - np.searchsorted(item, item) < n
    return item[some], text[some]


def search(
    documents: DataFrame, items: DataFrame, n: int, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The n highest-scoring documents of each item: item, rank, key, score."""
    spark = documents.sparkSession
    folder, plans = stored_at(blocks(items, item, item_text))
    counted = stored_at(counts(documents, text, folder))[1]
    totals = {r["term"]: r["n"] for r in counted.where("block = -1").collect()}  # two rows
    n_documents, n_terms = totals.get(0, 0), totals.get(1, 0)
    known = plans.select("block", F.posexplode("terms").alias("place", "term")).join(counted, ["block", "term"], "left")
    frequency = F.transform(F.array_sort(F.collect_list(F.struct("place", F.coalesce("n", F.lit(0)).alias("n")))), lambda p: p["n"])
    folder, plans = stored_at(plans.join(known.groupBy("block").agg(frequency.alias("df")), "block"))
    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kinds = [plans.schema["items"].dataType.elementType, rows.schema["key"].dataType]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans, floors = _Plans(folder), {}
        for batch in batches:
            for shard in wh.shards(batch, "text", SHARD_BYTES):
                hashes, first = term_hashes(shard.column("text"))
                sizes = np.diff(first)
                m = 25 + (75 * sizes * n_documents) // max(n_terms, 1)
                ids = shard.column("key")
                ties = np.empty(len(ids), np.int64)
                ties[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
                for block, names, plan, df in plans:
                    weights = np.floor(1000 * np.log((2 * n_documents + 2) / (2 * df + 1))).astype(np.int64)
                    floor = floors.setdefault(block, np.zeros(len(names), np.int64))
                    where, term, tf = _found_terms(plan.terms, hashes, first)
                    step = max(1, CELLS // (len(plan.leaf_term) + len(plan.nodes) + len(names)))
                    for start in range(0, len(ids), step):
                        a, b = np.searchsorted(where, [start, start + step])
                        if a == b:
                            continue
                        found = scores(plan, weights, where[a:b] - start, term[a:b], tf[a:b], m[start : start + step])
                        which, column = _first(found, ties[start : start + step], n, floor)
                        if not len(which):
                            continue
                        columns = [
                            pa.array(np.full(len(which), block)),
                            pa.array(which),
                            names.take(pa.array(which)),
                            ids.take(pa.array(start + column)),
                            pa.array(found[which, column]),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, names=["block", "place", "item", "key", "score"])

    ddl = f"block bigint, place bigint, item {kinds[0].simpleString()}, key {kinds[1].simpleString()}, score bigint"
    best = top_per_group(rows.mapInArrow(run, ddl), ["block", "place"], n, [F.col("score").desc(), F.col("key").asc_nulls_last()])
    return best.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
