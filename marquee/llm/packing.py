"""Packing of tokenised documents into sequences, as a cutting-stock problem solved by column generation.

A document is its token ids and an end id. What exceeds a sequence is cut off in whole sequences; what is left is one piece. Piece
lengths are rounded up to 256 classes. The histogram of the classes, whose size does not depend on the data, goes to the
driver, where a linear program chooses patterns (how many pieces of each class fill one sequence); a knapsack finds the pattern that
pays best under the current prices. Whole multiples of the patterns are kept, the few pieces that rounding leaves go first-fit
into further patterns. Pieces are ranked within their class, and ranges of ranks are assigned to the copies of each pattern.

Added tokens spelled out in a text get their own id, as `tokenizers` does by default. NULL and empty texts are the end id alone. Every input row is a document of its own, repeated or not.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from . import wordhash as wh
from .storage import stored

LENGTH = 1024
CLASSES = 256
END = 0
SHARD_BYTES = 1 << 20
LONG = 200_000  # characters; the patterns of tiktoken cannot take blanks without end
#: How a byte-level vocabulary cuts texts before merging (fixed value).
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ROUNDS = 2_000
SMOOTH = 0.9
AT_ONCE = 8  # patterns that one round of the knapsack may add
GAP = 1e-4  # of the linear program's value, at which no further pattern is sought


def _byte_signs() -> dict[str, int]:
    """The signs by which a byte-level vocabulary writes the 256 bytes: printable ones as they are, the rest from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or (161 <= b and b != 173)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def _by_ranks(path: str):
    """The same vocabulary in tiktoken, which is some times faster, or None where the ids could differ.

    tiktoken merges the pair whose result has the lowest id. That is the order of the merges if there is nothing but bytes
    and merges and the results of the merges are numbered in order.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    model, before = found["model"], found["pre_tokenizer"] or {}
    if model["type"] != "BPE" or model.get("ignore_merges") or model.get("dropout") or found["normalizer"]:
        return None
    if before != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": before.get("trim_offsets"), "use_regex": True}:
        return None
    signs, vocabulary = _byte_signs(), model["vocab"]
    made = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [vocabulary[m] for m in made]
    if any(a >= b for a, b in zip(ids, ids[1:])) or set(vocabulary) != {*signs, *made}:
        return None
    ranks = {bytes(signs[c] for c in token): i for token, i in vocabulary.items()}
    return tiktoken.Encoding("ranks", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})


class TokenIds:
    """The ids of texts as little-endian 32-bit numbers: those that `tokenizers` gives, by whichever way is faster."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranks = _by_ranks(path)

    def of(self, text: str) -> bytes:
        if self.ranks is None or len(text) > LONG or any(a in text for a in self.added):
            ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        else:
            ids = self.ranks.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()


def classes_of(lengths: np.ndarray) -> np.ndarray:
    return -(-lengths * CLASSES // LENGTH)


def pieces(rows: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Per piece: row (all columns of its document but the text), start, length, ids_crc32, doc_tokens, and the class of its length, the
    task that cut it (part) and its number within both (nth)."""
    kept = F.struct(*[f"`{c}`" for c in rows.columns if c != text])
    given = rows.select(kept.alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    extra = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, class int, part bigint, nth bigint"
    schema = T.StructType([given.schema["row"], *T.StructType.fromDDL(extra).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TokenIds(tokenizer)
        seen = np.zeros(CLASSES + 1, np.int64)
        part = TaskContext.get().partitionId()
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            for shard in wh.shards(batch, "text", SHARD_BYTES):
                owner, start, length, crc, total = [], [], [], [], []
                for i, text in enumerate(shard.column(1).to_pylist()):
                    ids = encoder.of(text) + end
                    n = len(ids) // 4
                    for at in range(0, n, LENGTH):
                        size = min(LENGTH, n - at)
                        owner.append(i), start.append(at), length.append(size), total.append(n)
                        crc.append(zlib.crc32(ids[4 * at : 4 * (at + size)]))
                kind = classes_of(np.array(length, np.int64))
                order = np.argsort(kind, kind="stable")
                counts = np.bincount(kind, minlength=CLASSES + 1)
                nth = np.empty(len(kind), np.int64)
                nth[order] = np.arange(len(kind)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(seen, counts)
                seen += counts
                columns = [pa.array(c, pa.int64()) for c in (start, length, crc, total)]
                yield pa.RecordBatch.from_arrays(
                    [
                        shard.column(0).take(pa.array(owner, pa.int64())),
                        *columns,
                        pa.array(kind.astype(np.int32)),
                        pa.array(np.full(len(kind), part, np.int64)),
                        pa.array(nth),
                    ],
                    names=schema.names,
                )

    return given.mapInArrow(run, schema)


class Pattern(NamedTuple):
    counts: dict[int, int]  # class -> pieces in one sequence
    times: int


def _best_fills(sizes: np.ndarray, prices: np.ndarray, most: int) -> tuple[float, list[np.ndarray]]:
    """The value of the best filling of one sequence, and the best fillings that begin with different classes, by
    dynamic programming over the room."""
    value, choice = np.zeros(CLASSES + 1), np.full(CLASSES + 1, -1)
    for room in range(1, CLASSES + 1):
        fits = int(np.searchsorted(sizes, room, "right"))
        value[room] = value[room - 1]
        if fits:
            gain = prices[:fits] + value[room - sizes[:fits]]
            best = int(gain.argmax())
            if gain[best] > value[room]:
                value[room], choice[room] = gain[best], best
    starts = prices + value[CLASSES - sizes]
    fills = []
    for first in np.argsort(-starts)[:most]:
        counts, room = np.zeros(len(sizes)), CLASSES - sizes[first]
        counts[first] = 1
        while room > 0:
            if choice[room] < 0:
                room -= 1
            else:
                counts[choice[room]] += 1
                room -= sizes[choice[room]]
        fills.append(counts)
    return float(value[CLASSES]), fills


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Their product by plain loops: threads of a linear algebra library can hang beside the JVM."""
    return np.einsum("ij,j->i", matrix, vector)


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """By elimination with the largest pivot of each column."""
    n = len(matrix)
    work = np.concatenate([matrix, np.eye(n)], axis=1)
    for j in range(n):
        i = j + int(np.abs(work[j:, j]).argmax())
        work[[i, j]] = work[[j, i]]
        work[j] /= work[j, j]
        rest = work[:, j].copy()
        rest[j] = 0
        live = np.flatnonzero(rest)
        work[live] -= rest[live, None] * work[j]
    return work[:, n:].copy()


def solve(demand: dict[int, int]) -> list[Pattern]:
    """Patterns with whole multiplicities that hold exactly the demanded pieces."""
    sizes = np.array(sorted(c for c, n in demand.items() if n > 0), np.int64)
    if not len(sizes):
        return []
    wanted = np.array([demand[int(c)] for c in sizes], float)
    columns = np.diag(np.floor(CLASSES / sizes).astype(float))
    inverse = np.diag(1 / np.diag(columns))
    # A little noise keeps the simplex method from standing still where several amounts are 0 at once.
    target = wanted * (1 + 1e-4 * np.random.default_rng(1).random(len(sizes)))
    costs, amounts = np.ones(len(sizes)), _times(inverse, target)
    best, centre = 0.0, np.zeros(len(sizes))

    def enter(column: np.ndarray, cost: float) -> bool:
        step = _times(inverse, column)
        ratio = np.where(step > 1e-9, amounts / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            return False
        amounts[:] = np.maximum(amounts - step * ratio[out], 0)
        amounts[out], columns[:, out], costs[out] = ratio[out], column, cost
        pivot = inverse[out] / step[out]
        inverse[:] -= np.outer(step, pivot)
        inverse[out] = pivot
        return True

    for turn in range(ROUNDS):
        if turn % 20 == 0:
            inverse = _inverse(columns)
            amounts = np.maximum(_times(inverse, target), 0)
        prices = _times(inverse.T, costs)
        for _ in range(len(sizes)):  # more pieces than demanded may be cut
            least = int(prices.argmin())
            if prices[least] > -1e-7 or not enter(-np.eye(len(sizes))[least], 0.0):
                break
            prices = _times(inverse.T, costs)
        prices = np.maximum(prices, 0)
        # Prices swing from round to round; those half way to the best ones so far find better patterns.
        for weight in (SMOOTH, 0.0):
            asked = weight * centre + (1 - weight) * prices
            value, fills = _best_fills(sizes, asked, AT_ONCE)
            if (asked * target).sum() > best * value:
                best, centre = (asked * target).sum() / value, asked / value
            fills = [c for c in fills if (prices * c).sum() > 1 + 1e-7]
            if fills:
                break
        if not fills or (costs * amounts).sum() - best <= GAP * best:
            break
        for column in fills:
            if (_times(inverse.T, costs) * column).sum() > 1 + 1e-7:
                enter(column, 1.0)
    left = wanted.astype(np.int64).copy()
    found = []
    for j in np.argsort(-amounts * costs):
        times = int(amounts[j] * costs[j] + 1e-6)
        if times > 0:
            counts = np.minimum(columns[:, j].astype(np.int64), left // times)
            uses = np.flatnonzero(counts)
            if len(uses):
                left -= times * counts
                found.append(Pattern({int(sizes[i]): int(counts[i]) for i in uses}, times))
    return found + _first_fit(dict(zip(sizes.tolist(), left.tolist())))


def _first_fit(left: dict[int, int]) -> list[Pattern]:
    """First fit, longest first, for what rounding leaves over; equal sequences are one pattern."""
    made: dict[tuple, int] = {}
    while any(left.values()):
        room, counts = CLASSES, {}
        for size in sorted((s for s, n in left.items() if n), reverse=True):
            take = min(left[size], room // size)
            if take:
                counts[size] = take
                room -= take * size
        times = min(left[s] // n for s, n in counts.items())
        for s, n in counts.items():
            left[s] -= times * n
        key = tuple(sorted(counts.items()))
        made[key] = made.get(key, 0) + times
    return [Pattern(dict(key), times) for key, times in made.items()]


def _ranges(patterns: list[Pattern]):
    """Ordered ranges of ranks per class: class, first rank, pieces per sequence, first sequence, place in the pattern."""
    rank, sequence, rows = dict.fromkeys(range(CLASSES + 1), 0), 0, []
    for pattern in patterns:
        for place, (size, count) in enumerate(sorted(pattern.counts.items(), reverse=True)):
            rows.append((size, rank[size], count, sequence, place))
            rank[size] += count * pattern.times
        sequence += pattern.times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(rows: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Per piece: row (its document's columns but the text), start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    cut = stored(pieces(rows, tokenizer, text))
    tasks = cut.groupBy("class", "part").agg(F.count("*").alias("n"))
    demand = {r["class"]: r["n"] for r in tasks.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    ranges = _ranges(solve(demand))
    before = F.sum("n").over(Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranked = cut.join(tasks.select("class", "part", F.coalesce(before, F.lit(0)).alias("before")), ["class", "part"])
    ranked = ranked.select(
        "row", "start", "length", "ids_crc32", "doc_tokens", "class", (F.col("before") + F.col("nth")).alias("rank")
    )
    schema = T.StructType(ranked.schema.fields[:5] + T.StructType.fromDDL("sequence_id bigint, place bigint").fields)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("class").to_numpy().astype(np.int64)
            rank = batch.column("rank").to_numpy()
            at = np.empty(len(size), np.int64)
            for c in np.unique(size):
                low, high = np.searchsorted(ranges[:, 0], [c, c + 1])
                mine = size == c
                at[mine] = low + np.searchsorted(ranges[low:high, 1], rank[mine], "right") - 1
            _, first, count, sequence, place = ranges[at].T
            nth = rank - first
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence + nth // count), pa.array(place * LENGTH + nth % count)],
                names=schema.names,
            )

    placed = ranked.mapInArrow(assign, schema)
    order = Window.partitionBy("sequence_id").orderBy("place")
    offset = F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.select("*", offset.alias("offset")).drop("place")
