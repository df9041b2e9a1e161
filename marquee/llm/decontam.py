"""Benchmark decontamination with suffix arrays of the training shards.

Each task cuts its training rows into shards of a few megabytes and gives every word its number in the vocabulary of the
benchmark, 0 for words that are not in it. A match cannot contain a 0, so only runs of numbered words that can hold a
whole window enter the shard's suffix array. Every suffix of every test item is then searched in it by bisection, for
its longest verbatim match and for the range of suffixes that begin with its window.

The benchmark lies in the shared folder in blocks of bounded size. A task takes some shards of its training rows at a time and
searches them for every block, which it reads there one after the other; the training rows are read once and never copied.

A window is 13 consecutive words of an item, or the whole item if it has fewer; items without words have none. NULL and
empty texts have no words and no hits. Repeated rows are judged alike, one result row each; items with equal texts
are both counted, repeated rows of one item once. An item without an id counts in the hits, and in the matches with a NULL id, but
has no name to stand among the items. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import wordhash as wh
from .storage import each_row, stored_at

WINDOW = 13
SHARD_BYTES = 2 << 20
BLOCK_BYTES = 4 << 20  # of benchmark text that a task holds at a time
GROUP_BYTES = 32 << 20  # of training text that is searched for one block after the other
KEPT_BLOCKS = 4  # blocks that a task keeps if there are no more

FOUND = "hits array<int>, items array<string>, matches array<struct<item_id:string,item_word:int,doc_word:int,length:int>>"
MATCHES = pa.list_(
    pa.struct([("item_id", pa.string()), ("item_word", pa.int32()), ("doc_word", pa.int32()), ("length", pa.int32())])
)


class Block(NamedTuple):
    items: list  # item ids as strings, or None
    vocabulary: np.ndarray  # sorted hashes of the words of the items
    marks: np.ndarray  # which 16-bit word hash endings occur
    sequence: np.ndarray  # word numbers of all items, a 0 after each
    starts: np.ndarray  # of the suffixes: place in the sequence
    owner: np.ndarray  # item of the suffix
    window: np.ndarray  # its item's window size, 0 if no window begins there
    shortest: int


def _block(items: list[tuple[str, str]]) -> Block | None:
    data, offsets = wh.text_bytes(pa.array([text for _, text in items], pa.string()))
    data = wh.LOWER[data]
    words = wh.find_words(data, offsets, wh.ALPHANUMERIC)
    hashes = wh.word_hashes(data, words)
    counts = words.counts()
    if not len(hashes):
        return None
    vocabulary, numbers = np.unique(hashes, return_inverse=True)
    owner = np.repeat(np.arange(len(items)), counts)
    starts = np.arange(len(hashes)) + owner
    sequence = np.zeros(len(hashes) + len(items) + 1, np.int32)
    sequence[starts] = numbers + 1
    size = np.minimum(counts, WINDOW)
    left = words.first[1:][owner] - np.arange(len(hashes))
    window = np.where(left >= size[owner], size[owner], 0)
    marks = np.zeros(1 << 16, bool)
    marks[(vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
    return Block([i for i, _ in items], vocabulary, marks, sequence, starts, owner, window, int(size[size > 0].min()))


def blocks(benchmark: DataFrame, key: str, text: str) -> DataFrame:
    """The items in blocks of bounded text, one row each (keys, texts); equal rows once."""
    rows = benchmark.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).distinct()
    ordered = rows.repartitionByRange(F.xxhash64("key", "text")).sortWithinPartitions(F.xxhash64("key", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list = []
        texts: list = []
        size = 0

        def block() -> pa.RecordBatch:
            row = pa.RecordBatch.from_pydict({"keys": pa.array([keys], pa.list_(pa.string())), "texts": pa.array([texts], pa.list_(pa.string()))})
            keys.clear(), texts.clear()
            return row

        for batch in batches:
            for k, t in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                keys.append(k), texts.append(t)
                size += len(t.encode()) + 16
                if size >= BLOCK_BYTES:
                    yield block()
                    size = 0
        if keys:
            yield block()

    return ordered.mapInArrow(run, "keys array<string>, texts array<string>")


class _Blocks:
    """The blocks of a folder, as often as a task needs them; a few stay in memory if there are no more."""

    def __init__(self, folder: str):
        self.folder, self.kept = folder, None

    def __iter__(self) -> Iterator[Block]:
        if self.kept is not None:
            yield from self.kept
            return
        first = []
        for row in each_row(self.folder):
            block = _block(list(zip(row.column("keys")[0].as_py(), row.column("texts")[0].as_py())))
            if block is not None:
                if len(first) <= KEPT_BLOCKS:
                    first.append(block)
                yield block
        if len(first) <= KEPT_BLOCKS:
            self.kept = first


def suffix_array(sequence: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """The places in the order of the suffixes that begin there, compared up to `depth` numbers, by doubling."""
    _, rank = np.unique(sequence, return_inverse=True)
    rank = rank.astype(np.int64)
    reach = 1
    while reach < depth:
        further = np.zeros(len(rank), np.int64)
        further[:-reach] = rank[reach:] + 1
        _, rank = np.unique(rank * (len(rank) + 2) + further, return_inverse=True)
        reach *= 2
    return places[np.argsort(rank[places], kind="stable")]


def _common(sequence, at, test, start, most):
    """Length of the common beginning of sequence[at:] and test[start:], at most `most`; a 0 ends it."""
    length = np.zeros(len(at), np.int64)
    going = np.flatnonzero(most > 0)
    while len(going):
        a = sequence[np.minimum(at[going] + length[going], len(sequence) - 1)]
        b = test[np.minimum(start[going] + length[going], len(test) - 1)]
        going = going[(a == b) & (a > 0)]
        length[going] += 1
        going = going[length[going] < most[going]]
    return length


def bisect(sequence, array, test, starts, depth, right: bool) -> np.ndarray:
    """For each test suffix, cut at `depth`, the number of suffixes in the array that come before it (or before or
    with it, if `right`)."""
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(array), np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        at, start, most = array[middle], starts[open_], depth[open_]
        same = _common(sequence, at, test, start, most)
        a = sequence[np.minimum(at + same, len(sequence) - 1)]
        b = test[np.minimum(start + same, len(test) - 1)]
        before = np.where(same >= most, right, a < b)
        low[open_[before]] = middle[before] + 1
        high[open_[~before]] = middle[~before]


def _runs(numbers: np.ndarray, first: np.ndarray, shortest: int):
    """The runs of numbered words of one text that can hold a window, a 0 after each, and where they stood."""
    n = len(numbers)
    inside = numbers > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = first[:-1][np.diff(first) > 0]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    stops = np.zeros(n + 1, bool)
    stops[:-1] = ~inside | begins
    stops[heads] = True
    stops[n] = True
    stop_places = np.flatnonzero(stops)
    ends = stop_places[np.searchsorted(stop_places, starts, "right")]
    long_enough = ends - starts >= shortest
    starts, ends = starts[long_enough], ends[long_enough]
    lengths = ends - starts + 1
    total = int(lengths.sum())
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    place = np.arange(total) + shift
    sequence = numbers[np.minimum(place, max(n - 1, 0))] if total else np.zeros(0, np.int32)
    last = np.cumsum(lengths) - 1
    sequence[last] = 0
    return sequence, place


def _scan(data: np.ndarray, words: wh.Words, block: Block):
    """Word-level hits of the block in one shard: (doc_word, suffix number, match length), ordered."""
    hashes = wh.word_hashes(data, words)
    numbers = np.zeros(len(hashes), np.int32)
    maybe = np.flatnonzero(block.marks[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
    found = np.searchsorted(block.vocabulary, hashes[maybe])
    found[found == len(block.vocabulary)] = 0
    right = block.vocabulary[found] == hashes[maybe]
    numbers[maybe[right]] = found[right] + 1
    sequence, place = _runs(numbers, words.first, block.shortest)
    none = np.zeros(0, np.int64)
    if not len(sequence):
        return none, none, none
    longest = int(np.diff(np.flatnonzero(np.concatenate([[0], block.sequence]) == 0)).max())
    array = suffix_array(sequence, np.flatnonzero(sequence > 0), longest)
    tests = np.flatnonzero(block.window > 0)
    starts, sizes = block.starts[tests], block.window[tests]
    low = bisect(sequence, array, block.sequence, starts, sizes, right=False)
    high = bisect(sequence, array, block.sequence, starts, sizes, right=True)
    times = high - low
    which = np.repeat(np.arange(len(tests)), times)
    at = array[np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)]
    whole = np.full(len(which), longest, np.int64)
    length = _common(sequence, at, block.sequence, starts[which], whole)
    return place[at], tests[which], length


def _judge(batch: pa.RecordBatch, block: Block, olds: list[dict]) -> list[dict]:
    """hits, items, matches of each row of one shard, with what earlier blocks found."""
    data, offsets = wh.text_bytes(batch.column(1))
    data = wh.LOWER[data]
    words = wh.find_words(data, offsets, wh.ALPHANUMERIC)
    at, suffix, length = _scan(data, words, block)
    order = np.argsort(at, kind="stable")
    at, suffix, length = at[order], suffix[order], length[order]
    doc = np.searchsorted(words.first, at, "right") - 1
    bounds = np.searchsorted(doc, np.arange(batch.num_rows + 1))
    size, owner = block.window[suffix], block.owner[suffix]
    heads = np.flatnonzero(np.diff(np.concatenate([[-1], block.owner])))
    word_in_item = np.arange(len(block.owner)) - np.repeat(heads, np.diff(np.append(heads, len(block.owner))))
    out = []
    for i, old in enumerate(olds):
        a, b = bounds[i], bounds[i + 1]
        if a == b:
            out.append(old)
            continue
        base = words.first[i]
        starts = np.concatenate([at[a:b] - base, np.array(old["hits"][0::2], np.int64)])
        ends = np.concatenate([at[a:b] - base + size[a:b], np.array(old["hits"][1::2], np.int64)])
        named = {block.items[o] for o in np.unique(owner[a:b])} - {None}
        seen = set(zip((at[a:b] - 1).tolist(), (suffix[a:b] - 1).tolist())) & set(zip(at[a:b].tolist(), suffix[a:b].tolist()))
        mine = []
        for x, s, n in zip(at[a:b].tolist(), suffix[a:b].tolist(), length[a:b].tolist()):
            if (x - 1, s - 1) not in seen or block.owner[s - 1] != block.owner[s]:
                mine.append(
                    {"item_id": block.items[block.owner[s]], "item_word": int(word_in_item[s]), "doc_word": int(x - base), "length": int(n)}
                )
        out.append({"hits": _merged(starts, ends), "items": sorted({*old["items"], *named}), "matches": old["matches"] + mine})
    return out


def _merged(starts: np.ndarray, ends: np.ndarray) -> list[int]:
    """The union of stretches as start, end, start, end and so on."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.ones(len(starts), bool)
    fresh[1:] = starts[1:] > reach[:-1]
    firsts = np.flatnonzero(fresh)
    lasts = np.append(firsts[1:], len(starts)) - 1
    return np.stack([starts[firsts], reach[lasts]], 1).ravel().tolist()


def scan(rows: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row: row (all its columns as a struct), n_words, n_hit, items (ids, sorted as strings), matches.

    `matches` are the longest verbatim matches of at least one window with their places in words.
    """
    kept = rows.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"))
    folder, _ = stored_at(blocks(benchmark, item_key, item_text))
    schema = T.StructType([kept.schema["row"], *T.StructType.fromDDL("n_words bigint, " + FOUND).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = _Blocks(folder)

        def judged(shards: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = [[{"hits": [], "items": [], "matches": []}] * shard.num_rows for shard in shards]
            for block in searched:
                found = [_judge(shard, block, old) for shard, old in zip(shards, found)]
            for shard, rows in zip(shards, found):
                data, offsets = wh.text_bytes(shard.column(1))
                counts = wh.find_words(data, offsets, wh.ALPHANUMERIC).counts()
                kinds = (("hits", pa.list_(pa.int32())), ("items", pa.list_(pa.string())), ("matches", MATCHES))
                yield pa.RecordBatch.from_arrays(
                    [shard.column(0), pa.array(counts, pa.int64()), *(pa.array([r[c] for r in rows], k) for c, k in kinds)],
                    names=["row", "n_words", "hits", "items", "matches"],
                )

        shards, size = [], 0
        for batch in batches:
            for shard in wh.shards(batch, "text", SHARD_BYTES):
                shards.append(shard)
                size += shard.column(1).nbytes
                if size >= GROUP_BYTES:
                    yield from judged(shards)
                    shards, size = [], 0
        if shards:
            yield from judged(shards)

    now = kept.mapInArrow(run, schema)
    hit = F.aggregate(
        F.transform("hits", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x).cast("bigint")),
        F.lit(0).cast("bigint"),
        lambda total, x: total + x,
    )
    return now.select("row", "n_words", hit.alias("n_hit"), "items", "matches")


def contaminated() -> Column:
    """At least one hit, and hits in 5 % of the words or more."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def decontaminate(rows: DataFrame, benchmark: DataFrame, **names: str) -> DataFrame:
    """The rows that are not contaminated, with the columns they came with."""
    return scan(rows, benchmark, **names).where(~contaminated()).select("row.*")

