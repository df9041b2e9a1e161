"""Exact removal of long passages that occur more than once, by super-k-mers.

A window is 35 consecutive words of one text. Its minimiser is the smallest hash among its runs of four words; neighbouring
windows with the same minimiser travel as one packed string (a super-k-mer) to the bucket of that minimiser. Equal windows have
equal minimisers, so a bucket sees all copies of its windows and counts them by sorting.

A task sends a string to a bucket once, however often it saw it, with a mark if it was more than once: a passage that a
third of all rows share reaches its bucket once per shard. The number of buckets follows the number of input partitions.

Words are compared by 64-bit hashes and windows by two independent 64-bit hashes. Words are runs of characters other
than blank and the controls 9 to 13, taken unchanged. NULL and empty texts have no words and nothing is removed; a repeated
row is another text, so its windows count twice. Windows are judged on the input, not on what is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from . import wordhash as wh

WINDOW = 35
RUN = 4  # words of a minimiser; WINDOW - RUN + 1 is a power of two
SHARD_BYTES = 4 << 20
BUCKETS_PER_PARTITION = 8

OCCURRENCE = np.dtype([("string", "<i4"), ("start", "<i4"), ("key", "<i8"), ("check", "<i4")])


def super_kmers(data: np.ndarray, words: wh.Words):
    """For each super-k-mer: minimiser, first word, last window."""
    hashes = wh.word_hashes(data, words)
    starts = wh.window_starts(words.first, WINDOW)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, starts
    least = wh.window_hashes(hashes, np.arange(len(hashes) - RUN + 1), RUN)
    reach = 1
    while reach < WINDOW - RUN + 1:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    minimiser = least[starts]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (minimiser[1:] != minimiser[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(starts)) - 1
    return minimiser[first], starts[first], starts[last]


def _pack(shard: pa.RecordBatch, buckets: int) -> pa.RecordBatch:
    """One row per bucket: the distinct strings that go there and where each of them stood."""
    data, offsets = wh.text_bytes(shard.column(0))
    words = wh.find_words(data, offsets, wh.NOT_BLANK)
    minimiser, first, last = super_kmers(data, words)
    bucket = (wh.mixed(minimiser) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    text = np.searchsorted(words.first, first, "right") - 1
    places = np.empty(len(first), OCCURRENCE)
    places["start"] = first - words.first[text]
    places["key"] = shard.column(1).to_numpy(zero_copy_only=False)[text]
    places["check"] = shard.column(2).to_numpy(zero_copy_only=False)[text]
    raw, begin, end = data.tobytes(), words.starts[first].tolist(), words.ends[last + WINDOW - 1].tolist()
    codec = pa.Codec("zstd", compression_level=3)
    to, sizes, packed = [], [], []
    for a, b in zip(cuts[:-1], cuts[1:]):
        mine = order[a:b]
        table: dict[bytes, int] = {}
        places["string"][mine] = [table.setdefault(raw[begin[j] : end[j]], len(table)) for j in mine.tolist()]
        lengths = np.fromiter(map(len, table), np.int32, len(table))
        body = b"".join([places[mine].tobytes(), lengths.tobytes(), *table])
        to.append(int(bucket[mine[0]]))
        sizes.append([len(mine), len(table), len(body)])
        packed.append(codec.compress(body, asbytes=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(to, pa.int32()), pa.array(sizes, pa.list_(pa.int32())), pa.array(packed, pa.binary())],
        names=["bucket", "sizes", "packed"],
    )


def _repeated(strings: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """Of (bytes, lengths, seen) of several senders: which words lie in a repeated window, and the words before each string."""
    data = np.concatenate([s[0] for s in strings])
    offsets = np.concatenate([[0], np.cumsum(np.concatenate([s[1] for s in strings]), dtype=np.int64)])
    many = np.concatenate([s[2] for s in strings]) > 1
    words = wh.find_words(data, offsets, wh.NOT_BLANK)
    hashes = wh.word_hashes(data, words)
    starts = wh.window_starts(words.first, WINDOW)
    one, two = (wh.window_hashes(hashes, starts, WINDOW, second) for second in (False, True))
    order = np.argsort(one, kind="stable")
    same = one[order[1:]] == one[order[:-1]]
    if np.any(same & (two[order[1:]] != two[order[:-1]])):
        order = np.lexsort((two, one))
        same = one[order[1:]] == one[order[:-1]]
    same &= two[order[1:]] == two[order[:-1]]
    group = np.concatenate([[0], np.cumsum(~same)])
    size = np.bincount(group, weights=1 + many[np.searchsorted(words.first, starts[order], "right") - 1])
    hit = starts[order][size[group] > 1]
    return wh.covered(hit, hit + WINDOW, len(hashes)), words.first


def _count(table: pa.Table) -> pa.Table:
    codec = pa.Codec("zstd")
    senders, strings = [], []
    for sizes, packed in zip(table.column("sizes").to_pylist(), table.column("packed")):
        body = np.frombuffer(codec.decompress(packed.as_buffer(), sizes[2]), np.uint8)
        at = sizes[0] * OCCURRENCE.itemsize
        places = body[:at].view(OCCURRENCE)
        lengths = body[at : at + 4 * sizes[1]].view(np.int32)
        strings.append((body[at + 4 * sizes[1] :], lengths, np.bincount(places["string"], minlength=sizes[1])))
        senders.append(places)
    hit, first = _repeated(strings)
    change = np.diff(hit.astype(np.int8), prepend=0, append=0)
    bounds = first[1:-1]
    begin, stop = change == 1, change == -1
    inner = bounds[(bounds > 0) & (bounds < len(hit))]
    split = inner[hit[inner] & hit[inner - 1]] if len(inner) else inner
    begin[split] = stop[split] = True
    begin, stop = np.flatnonzero(begin), np.flatnonzero(stop)
    string = np.searchsorted(first, begin, "right") - 1
    # Strings are numbered through all senders; each sender's places name its own.
    base = np.concatenate([[0], np.cumsum([len(s[1]) for s in strings])])
    places = np.concatenate(senders)
    owner = places["string"] + np.repeat(base[:-1], [len(p) for p in senders])
    low, high = np.searchsorted(string, owner), np.searchsorted(string, owner, "right")
    times = high - low
    which = np.repeat(np.arange(len(owner)), times)
    span = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)
    shift = places["start"][which] - first[owner[which]]
    return pa.table(
        {
            "key": places["key"][which],
            "check": places["check"][which],
            "start": (begin[span] + shift).astype(np.int32),
            "end": (stop[span] + shift).astype(np.int32),
        }
    )


def _identified(rows: DataFrame, text: str) -> DataFrame:
    """row, text and two hashes over the whole row, by which a text is found again."""
    everything = [F.col(f"`{c}`") for c, kind in rows.dtypes if not kind.startswith(("map", "variant"))]
    return rows.select(
        F.struct("*").alias("row"),
        F.col(text).cast("string").alias("text"),
        F.xxhash64(*everything).alias("key"),
        F.hash(*everything).alias("check"),
    )


def repeated_spans(identified: DataFrame, buckets: int) -> DataFrame:
    """key, check, and the stretches of words that lie in repeated windows, as far as one bucket knows them."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in wh.shards(batch, "text", SHARD_BYTES):
                yield _pack(shard, buckets)

    packed = identified.select("text", "key", "check").mapInArrow(pack, "bucket int, sizes array<int>, packed binary")
    return packed.groupBy("bucket").applyInArrow(_count, "key bigint, check int, start int, end int")


def remove_repeats(rows: DataFrame, text: str = "text", buckets: int | None = None) -> DataFrame:
    """Per input row: row (all its columns as a struct), n_words, n_removed, kept (the words left, joined by a blank)."""
    identified = _identified(rows, text)
    if buckets is None:
        shuffled = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(shuffled, BUCKETS_PER_PARTITION * rows.rdd.getNumPartitions())
    spans = repeated_spans(identified, buckets).groupBy("key", "check")
    # Equal rows have equal spans, and those of a million copies are as many as those of one.
    spans = spans.agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))
    flat = F.flatten(F.transform("spans", lambda s: F.array(s["start"], s["end"]))).alias("spans")
    both = identified.drop("text").join(spans.select("key", "check", flat), ["key", "check"], "left").select("row", "spans")
    schema = T.StructType(
        [both.schema["row"], *T.StructType.fromDDL("n_words bigint, n_removed bigint, kept string").fields]
    )

    place = rows.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for value, spans in zip(pc.struct_field(batch.column(0), place), batch.column(1)):
                words = str(value.as_py() or "").encode().split()
                left, at = [], 0
                stretch = spans.as_py() or []
                for start, end in zip(stretch[0::2], stretch[1::2]):
                    if start > at:
                        left += words[at:start]
                    at = max(at, end)
                left += words[at:]
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["row", "n_words", "n_removed", "kept"],
            )

    return both.mapInArrow(cut, schema)
