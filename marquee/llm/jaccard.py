"""Documents that share most of their word shingles, and the groups that such links form.

A document's set holds its distinct runs of five words; documents with equal sets are one class. Shingles are XOR-hashed into
parity sketches, of which there are two kinds.

* Blocks: every shingle falls into one block and flips bits of it. Two sets differ in at most as many blocks as there are
  shingles in only one of them. The sizes of a band differ by the root of 2; its sketches have one block for 3.5 shingles of the
  smallest size, so of two linked sets between a third and a fifth of the blocks agree, and they are joined on equal blocks.
  64 blocks of a sketch take part (short sketches: of several rounds with other seeds), so that a link at the very threshold is
  missed with a chance of 1e-6 at most, and of 1e-10 if the sets are of about equal size. A class stands in the band of its size, and in
  the one below if a partner a quarter smaller would.
* Bits: one bit per shingle and place, about as many places as shingles. The Hamming distance of two such sketches is never more
  than the number of shingles in only one set, so a pair beyond the limit is dropped without a look at the sets.

Pairs that are left are verified on the sets themselves, in an order that keeps them few. First each class is tested against one
other of its blocks, the one with which it shares most. Then each class takes part in the largest of its crowded blocks, cut into tiles of
bounded size: there pairs are verified with the sets in the tile, a union-find leaves out those that would join nothing, and only links
leave it. After that few groups are apart that should not be. All blocks that still hold several groups are compared by their sketches, and in
a tile of more than FEW_CLASSES again only as many pairs are named as could join two groups. A tile says which classes were in a pair that it
left out; where such classes of a block are in several groups after all, they are compared once more with the sets in the tile, of which
only those are sent that the sketches leave in question, and of a pair only to the smallest block that it shares. So members
of a family that are only partly close to each other cost a few tests each, and no link is lost.

Empty texts have no shingles and are linked with nothing. Repeated rows are equal texts. A row whose id is NULL
takes part; a component of such rows alone has NULL as its id. Shingles are compared by 64-bit hashes, in the last
test by 48 bits of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window, functions as F

from . import wordhash as wh
from .storage import stored

RUN = 5
PERCENT = 75
BLOCKS = 64
FILL = 3.5  # shingles of the smallest set of a band in one block
LOWEST = 2.0 ** (np.arange(96) / 2)  # size at which each band begins
SHARD_BYTES = 1 << 20
BUCKETS_PER_PARTITION = 4
HEAD_ROWS = 1 << 10  # members that one task compares with one head
TILE = 1 << 11  # classes of one block that are compared with as many others at once
TILE_BYTES = 1 << 24  # of sets in a tile
CROWD = 16  # classes of a block from which on it counts as crowded
FEW_CLASSES = 2  # classes of a tile up to which all its pairs are named
PAIRS_AT_ONCE = 1 << 20
WORDS_AT_ONCE = 1 << 22  # of sketches
FEW = 100_000  # wanted texts up to which their keys are broadcast

SHARED = np.dtype([("block", "<i8"), ("c1", "<i8"), ("c2", "<i8"), ("size", "<i4")])

def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, in a row, and where each text's begin."""
    words = wh.find_words(data, offsets, wh.NOT_BLANK)
    hashes = wh.word_hashes(data, words)
    counts = words.counts()
    starts = wh.window_starts(words.first, RUN)
    short = np.flatnonzero((counts > 0) & (counts < RUN))
    rolling = wh.Rolling(0x2545F4914F6CDD1D)
    sums = rolling.sums(hashes)
    starts = np.concatenate([starts, words.first[short]])
    ends = np.concatenate([starts[: len(starts) - len(short)] + RUN, words.first[short + 1]])
    values = rolling.between(sums, starts, ends)
    text = np.searchsorted(words.first, starts, "right") - 1
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    values, text = values[fresh], text[fresh]
    return values, np.searchsorted(text, np.arange(len(counts) + 1))


def classes(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each set."""
    out = []
    for salt in (0x1B873593CC9E2D51, 0x38495AB5A1D3F7E9):
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(wh.mixed(values ^ np.uint64(salt)), out=sums[1:])
        out.append(wh.mixed(sums[first[1:]] - sums[first[:-1]] + np.uint64(salt)).view(np.int64))
    return out[0], out[1]


def sketch_blocks(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(set, block key) for the joined blocks that hold something. A key contains band, round and block number."""
    sizes = np.diff(first)
    owners, keys = [], []
    # A set of s shingles can have partners from 0.75 s on.
    band = np.searchsorted(LOWEST, sizes, "right") - 1
    below = np.searchsorted(LOWEST, np.ceil(sizes * PERCENT / 100), "right") - 1
    for down in (0, 1):
        bands = band - down
        some = (sizes > 0) & (bands >= below)
        for b in np.unique(bands[some]):
            mine = np.flatnonzero(some & (bands == b))
            n = max(2, int(np.ceil(LOWEST[b] / FILL)))
            take = sizes[mine]
            at = np.arange(int(take.sum())) + np.repeat(first[mine] - (np.cumsum(take) - take), take)
            owner = np.repeat(mine, take)
            for turn in range(-(-BLOCKS // n)):
                salt = np.uint64((int(b) + 1) * 0x9E3779B97F4A7C15 % 2**64) + np.uint64(turn)
                value = wh.mixed(values[at] ^ salt)
                block = (value >> np.uint64(20)) % np.uint64(n)
                near = np.flatnonzero(block < BLOCKS - turn * n) if (turn + 1) * n > BLOCKS else slice(None)
                place = owner[near] * np.int64(BLOCKS) + block[near].astype(np.int64)
                order = np.argsort(place, kind="stable")
                place, parity = place[order], wh.mixed(value[near][order])
                heads = np.flatnonzero(np.diff(place, prepend=-1))
                if len(heads):
                    xored = np.bitwise_xor.reduceat(parity, heads)
                    number = (place[heads] % BLOCKS + turn * n).astype(np.uint64)
                    owners.append(place[heads] // BLOCKS)
                    keys.append(wh.mixed(wh.mixed(xored + number) ^ salt))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(owners), np.concatenate(keys).view(np.int64)


def bit_sketches(values: np.ndarray, first: np.ndarray) -> list[bytes]:
    """A parity bit for each of 64 or more places, a power of two and at least the size of the set."""
    sizes = np.diff(first)
    places = 1 << np.maximum(6, np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(places)])
    at = np.repeat(begin[:-1], sizes) + (values & np.repeat(places - 1, sizes).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(at, minlength=begin[-1]) & 1).astype(np.uint8)
    bits = np.packbits(odd).tobytes()
    return [bits[a // 8 : b // 8] for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]


def most_differences(a, b):
    """The shingles that linked sets of these sizes may have alone, together."""
    return (a + b) * (100 - PERCENT) // (100 + PERCENT)


def _packed(rows: np.ndarray, bucket: np.ndarray, kind: int):
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    return [(int(bucket[order[a]]), kind, rows[order[a:b]].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]


def _sketch(shard: pa.RecordBatch, buckets: int) -> pa.RecordBatch:
    """Rows for the buckets: of each block the first class seen here (kind 0, or 1 if the shard has more), the other
    classes (2), and what is known of each text (3)."""
    data, offsets = wh.text_bytes(shard.column(0))
    values, first = shingle_sets(wh.LOWER[data], offsets)
    c1, c2 = classes(values, first)
    sizes = np.diff(first)
    order = np.lexsort((c2, c1))
    once = np.ones(len(order), bool)
    once[1:] = (c1[order[1:]] != c1[order[:-1]]) | (c2[order[1:]] != c2[order[:-1]])
    distinct = np.sort(order[once])
    take = sizes[distinct]
    at = np.arange(int(take.sum())) + np.repeat(first[distinct] - (np.cumsum(take) - take), take)
    owner, block = sketch_blocks(values[at], np.concatenate([[0], np.cumsum(take)]))
    rows = np.empty(len(owner), SHARED)
    rows["block"], rows["c1"], rows["c2"] = block, c1[distinct][owner], c2[distinct][owner]
    rows["size"] = take[owner]
    rows = rows[np.lexsort((rows["c2"], rows["c1"], rows["block"]))]
    lead = np.ones(len(rows), bool)
    lead[1:] = rows["block"][1:] != rows["block"][:-1]
    several = np.zeros(len(rows), bool)
    several[:-1] = ~lead[1:]
    bucket = (wh.mixed(rows["block"].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    out = []
    for kind, some in enumerate((lead & ~several, lead & several)):
        out += _packed(rows[some], bucket[some], kind)
    # The rest needs no bucket of its own; it is dealt evenly.
    keys = shard.column(1).to_numpy(zero_copy_only=False)
    spread = (wh.mixed(keys.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    if not lead.all():
        out.append((int(spread[0]), 2, rows[~lead].tobytes()))
    texts = pa.record_batch(
        {
            "c1": c1,
            "c2": c2,
            "size": sizes.astype(np.int32),
            "key": keys,
            "check": shard.column(2),
            "bits": pa.array(bit_sketches(values, first), pa.binary()),
        }
    )
    out.append((int(spread[0]), 3, texts.serialize().to_pybytes()))
    columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary()))]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "kind", "packed"])


TEXTS = pa.schema(
    [("c1", pa.int64()), ("c2", pa.int64()), ("size", pa.int32()), ("key", pa.int64()), ("check", pa.int32()), ("bits", pa.binary())]
)
JOINED = "block bigint, c1 bigint, c2 bigint, size int, key bigint, check int, bits binary, is_text boolean"


def _joined(table: pa.Table) -> pa.Table:
    """The blocks of one bucket that more than one class holds, and what was only dealt here."""
    parts: list[list] = [[np.zeros(0, SHARED)], [], []]
    texts = []
    for kind, packed in zip(table.column("kind").to_pylist(), table.column("packed")):
        if kind == 3:
            texts.append(pa.ipc.read_record_batch(packed.as_buffer(), TEXTS))
        else:
            parts[kind].append(np.frombuffer(packed.as_buffer(), SHARED))
    leaders = np.concatenate(parts[0] + parts[1])
    several = np.repeat([False, True], [sum(map(len, parts[0])), sum(map(len, parts[1]))])
    order = np.argsort(leaders["block"], kind="stable")
    leaders, several = leaders[order], several[order]
    if len(leaders):
        fresh = np.append(True, leaders["block"][1:] != leaders["block"][:-1])
        group = np.cumsum(fresh) - 1
        one = leaders[np.flatnonzero(fresh)[group]]
        live = np.zeros(group[-1] + 1, bool)
        live[group[several | (leaders["c1"] != one["c1"]) | (leaders["c2"] != one["c2"])]] = True
        leaders = leaders[live[group]]
    shared = np.concatenate([leaders, *parts[2]])
    n = len(shared)
    found = pa.table(
        {
            **{c: pa.array(np.ascontiguousarray(shared[c])) for c in ("block", "c1", "c2", "size")},
            "key": pa.nulls(n, pa.int64()),
            "check": pa.nulls(n, pa.int32()),
            "bits": pa.nulls(n, pa.binary()),
            "is_text": pa.array(np.zeros(n, bool)),
        }
    )
    if not texts:
        return found
    known = pa.Table.from_batches(texts)
    known = known.append_column("is_text", pa.array(np.ones(len(known), bool)))
    known = known.append_column("block", pa.nulls(len(known), pa.int64()))
    return pa.concat_tables([found, known.select(found.column_names)])


def _class():
    return F.struct("c1", "c2")


def _hashed(rows: DataFrame, text: str) -> DataFrame:
    kept = [F.col(f"`{c}`") for c, kind in rows.dtypes if not kind.startswith(("map", "variant"))]
    return rows.select(
        F.struct("*").alias("row"),
        F.col(text).cast("string").alias("text"),
        F.xxhash64(*kept).alias("key"),
        F.hash(*kept).alias("check"),
    )


def sketched(hashed: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in wh.shards(batch, "text", SHARD_BYTES):
                yield _sketch(shard, buckets)

    packed = hashed.select("text", "key", "check").mapInArrow(run, "bucket int, kind int, packed binary")
    return packed.groupBy("bucket").applyInArrow(_joined, JOINED)


def class_sets(hashed: DataFrame, wanted: DataFrame) -> DataFrame:
    """c, shingles of the wanted texts (key, check), one row per text: 6 bytes of each shingle hash, sorted."""
    if wanted.count() <= FEW:
        wanted = F.broadcast(wanted)
    texts = hashed.select("key", "check", "text").join(wanted, ["key", "check"], "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in wh.shards(batch, "text", SHARD_BYTES):
                data, offsets = wh.text_bytes(shard.column(0))
                values, first = shingle_sets(wh.LOWER[data], offsets)
                c1, c2 = classes(values, first)
                six = np.ascontiguousarray(values.byteswap().view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(c1),
                        pa.array(c2),
                        pa.array([six[6 * a : 6 * b] for a, b in zip(first[:-1], first[1:])], pa.binary()),
                    ],
                    names=["c1", "c2", "shingles"],
                )

    return texts.mapInArrow(run, "c1 bigint, c2 bigint, shingles binary").select(_class().alias("c"), "shingles")


def _opened(shingles: bytes) -> np.ndarray:
    wide = np.zeros((len(shingles) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(shingles, np.uint8).reshape(-1, 6)
    return wide.view(">u8").ravel().astype(np.uint64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = np.intersect1d(a, b, assume_unique=True).size
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the pairs (a, b, n) of classes those that are similar enough.

    Each head a goes once to every group of up to HEAD_ROWS of its partners, each partner once per pair.
    """
    salted = _salted(pairs)
    heads = salted.select("a", "salt", F.col("a").alias("c"), F.lit(0).alias("member")).distinct()
    members = salted.select("a", "salt", F.col("b").alias("c"), F.lit(1).alias("member"))
    rows = heads.unionByName(members).join(sets, "c")
    dealt = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "member")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, head_set = None, None
        for batch in batches:
            a, b = [], []
            for group, member, c, shingles in zip(
                batch.column("a").to_pylist(), batch.column("member").to_pylist(), batch.column("c").to_pylist(), batch.column("shingles")
            ):
                values = _opened(shingles.as_py())
                if member == 0:
                    head, head_set = group, values
                    continue
                assert head == group, "a head precedes its members"
                if similar(head_set, values):
                    a.append(group), b.append(c)
            kind = batch.schema.field("a").type
            yield pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], names=["a", "b"])

    kind = "struct<c1:bigint,c2:bigint>"
    return dealt.select("a", "member", "c", "shingles").mapInArrow(verify, f"a {kind}, b {kind}")


def connected(links: DataFrame) -> DataFrame:
    """node, root (the smallest node that links lead to), for all nodes that have a link.

    Alternating large and small stars; every round is written to the shared folder.
    """
    edges, before = _signed(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        around = Window.partitionBy("u")
        large = both.withColumn("m", F.least(F.min("v").over(around), F.col("u"))).where("v > u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.withColumn("m", F.min("v").over(around))
        pairs = F.explode(F.array(*[F.struct(F.col(c).alias("u"), F.col("m").alias("v")) for c in ("u", "v")])).alias("e")
        small = down.select(pairs).select("e.*").where("u != v").distinct()
        edges, now = _signed(small)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _signed(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, stored, and their number with a sum of their hashes, which are noted while they are written."""
    seen = Observation()
    kept = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")))
    return kept, (seen.get["n"], seen.get["sum"])


def close_pairs(bits: pa.Array, size: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the pairs of rows (x, y) have sizes of linked sets and sketches that differ in no more places than theirs may.

    Sizes that fit differ by less than 2, so one sketch is at most twice as wide as the other and is then folded once.
    """
    fits = PERCENT * np.maximum(size[x], size[y]) <= 100 * np.minimum(size[x], size[y])
    lengths = np.array([len(b) // 8 for b in bits.to_pylist()], np.int64) if len(bits) else np.zeros(0, np.int64)
    flat = np.frombuffer(b"".join(bits.to_pylist()), np.uint64)
    begin = np.cumsum(lengths) - lengths
    limit = most_differences(size[x], size[y])
    for wide in np.unique(np.maximum(lengths[x[fits]], lengths[y[fits]])):
        for halved in (False, True):
            few = wide // 2 if halved else wide
            mine = np.flatnonzero(
                fits & (np.maximum(lengths[x], lengths[y]) == wide) & (np.minimum(lengths[x], lengths[y]) == few)
            )
            for some in np.array_split(mine, max(1, len(mine) * int(wide) // WORDS_AT_ONCE)):
                if len(some):
                    wider = lengths[x[some]] >= lengths[y[some]]
                    big, small = np.where(wider, x[some], y[some]), np.where(wider, y[some], x[some])
                    a = flat[begin[big][:, None] + np.arange(wide)]
                    if halved:
                        a = a[:, :few] ^ a[:, few:]
                    apart = np.bitwise_count(a ^ flat[begin[small][:, None] + np.arange(few)]).sum(1, dtype=np.int64)
                    fits[some] = apart <= limit[some]
    return fits


def _salted(pairs: DataFrame) -> DataFrame:
    """The pairs, those of one head in groups of about HEAD_ROWS. n is about how many pairs it may have."""
    return pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.greatest(F.lit(1), F.ceil(F.col("n") / HEAD_ROWS))))


def near(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs (a, b, n) of classes that `close_pairs` leaves."""
    known = members.select("c", "size", "bits")
    salted = _salted(pairs)
    heads = salted.select("a", "salt").distinct().join(known.toDF("a", "size_a", "bits_a"), "a")
    both = salted.join(heads, ["a", "salt"]).join(known.toDF("b", "size_b", "bits_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = pa.concat_arrays([batch.column("bits_a"), batch.column("bits_b")])
            size = np.concatenate([batch.column(c).to_numpy().astype(np.int64) for c in ("size_a", "size_b")])
            first = np.arange(batch.num_rows)
            keep = close_pairs(bits, size, first, first + batch.num_rows)
            yield batch.select(["a", "b", "n"]).filter(pa.array(keep))

    return both.mapInArrow(run, both.select("a", "b", "n").schema)


class Union:
    """Which of some things have been joined."""

    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x, y) -> None:
        self.up[self.find(x)] = self.find(y)


def tiles(blocks: DataFrame, by_bytes: bool = False) -> DataFrame:
    """block, u, t, side, c, root: the classes of each block (block, c, root, size) in tiles of bounded size.

    Classes of the root that most of a block have need no comparison with each other. The others (side 1) are cut into tiles u, all
    classes (side 0) into tiles t, and every tile of the one meets every tile of the other; in a block of a single tile
    all classes stand once (side 2).
    """
    weight = F.sum(F.col("size") * 6) if by_bytes else F.lit(0)
    by_root = blocks.groupBy("block", "root").agg(F.count("*").alias("n"), weight.alias("bytes"))
    most = F.max_by("root", F.struct("n", "root")).alias("main")
    sizes = by_root.groupBy("block").agg(most, F.sum("n").alias("n"), F.max("n").alias("main_n"), F.sum("bytes").alias("bytes"))
    parts = F.greatest(F.ceil(F.col("n") / TILE), F.ceil(F.col("bytes") / TILE_BYTES), F.lit(1)).cast("int")
    sizes = sizes.withColumn("ts", parts)
    sizes = sizes.withColumn("us", F.greatest(F.ceil((F.col("n") - F.col("main_n")) * F.col("ts") / F.col("n")), F.lit(1)).cast("int"))
    rows = blocks.join(sizes.select("block", "main", "ts", "us"), "block")
    t, u = (F.pmod(F.xxhash64("c", F.lit(k)), F.col(k + "s")).cast("int") for k in ("t", "u"))

    def place(u, t, side):
        return F.struct(u.alias("u"), t.alias("t"), F.lit(side).alias("side"))

    all_u = F.transform(F.sequence(F.lit(0), F.col("us") - 1), lambda k: place(k, t, 0))
    all_t = F.transform(F.sequence(F.lit(0), F.col("ts") - 1), lambda k: place(u, k, 1))
    one = F.array(place(F.lit(0), F.lit(0), 2))
    places = F.when(F.col("ts") == 1, one).when(F.col("root") == F.col("main"), all_u).otherwise(F.concat(all_u, all_t))
    return rows.withColumn("p", F.explode(places)).select("block", "p.*", "c", "root")


def diagonal(blocks: DataFrame) -> DataFrame:
    """As `tiles`, but every class only once, next to a tile of others."""
    sizes = blocks.groupBy("block").agg(F.count("*").alias("n"), F.sum(F.col("size") * 6).alias("bytes"))
    sizes = sizes.select("block", F.greatest(F.ceil(F.col("n") / TILE), F.ceil(F.col("bytes") / TILE_BYTES), F.lit(1)).cast("int").alias("ts"))
    t = F.pmod(F.xxhash64("c"), F.col("ts")).cast("int")
    return blocks.join(sizes, "block").select("block", t.alias("u"), t.alias("t"), F.lit(2).alias("side"), "c", "root")


def _tile_pairs(cuts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of places within stretches that begin at the cuts, a bounded number at a time."""
    lengths = np.diff(cuts)
    for n in np.unique(lengths[lengths > 1]):
        starts = cuts[:-1][lengths == n]
        if n <= 64:
            i, j = np.triu_indices(n, 1)
            for some in np.array_split(starts, max(1, len(starts) * len(i) // PAIRS_AT_ONCE)):
                yield (some[:, None] + i).ravel(), (some[:, None] + j).ravel()
            continue
        step = max(1, PAIRS_AT_ONCE // int(n))
        for start in starts:
            for low in range(0, int(n), step):
                i, j = np.nonzero(np.arange(low, min(low + step, n))[:, None] < np.arange(n))
                yield start + low + i, start + j


def _candidates(table: pa.Table):
    """Of a table sorted by tile: pairs of places that are to be compared, are of different roots and are close; and the size of their tile."""
    block, u, t, side, root, size = (
        table.column(c).to_numpy().astype(np.int64) for c in ("block", "u", "t", "side", "root", "size")
    )
    fresh = np.ones(len(block) + 1, bool)
    if len(block):
        fresh[1:-1] = (np.diff(block) != 0) | (np.diff(u) != 0) | (np.diff(t) != 0)
    cuts = np.flatnonzero(fresh)
    bits = table.column("bits").combine_chunks()
    for x, y in _tile_pairs(cuts):
        met = (root[x] != root[y]) & ((side[x] == 2) | (side[x] != side[y]))
        x, y = x[met], y[met]
        if len(x):
            # Only the rows that are still in question.
            some, at = np.unique(np.concatenate([x, y]), return_inverse=True)
            good = close_pairs(bits.take(pa.array(some)), size[some], at[: len(x)], at[len(x) :])
            x, y = x[good], y[good]
            tile = np.searchsorted(cuts, x, "right") - 1
            yield x, y, cuts[tile + 1] - cuts[tile]


CLASS = "struct<c1:bigint,c2:bigint>"


def _classes_of(table: pa.Table) -> tuple[np.ndarray, pa.Array]:
    """A number for the class of each row, and the classes."""
    c = table.column("c").combine_chunks()
    _, number = np.unique(np.rec.fromarrays([c.field(k).to_numpy() for k in ("c1", "c2")]), return_inverse=True)
    return number, c


def _by_tile(table: pa.Table) -> pa.Table:
    """Sorted by tile and in it by class, so that tiles with the same classes name the same pairs."""
    table = table.combine_chunks()
    c = table.column("c").combine_chunks()
    table = table.append_column("c1", c.field("c1")).append_column("c2", c.field("c2"))
    return table.sort_by([(k, "ascending") for k in ("block", "u", "t", "c1", "c2")]).combine_chunks()


def forest(dealt: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs (a, b) that could be linked in some tiles, and, as rows (a, block), the classes that have more such pairs in a block.

    Tiles of up to FEW_CLASSES classes name all such pairs, others only as many as join all that they could join.
    """
    rows = dealt.join(members.select("c", "size", "bits"), "c").withColumn("root", F.xxhash64("root"))

    def compare(table: pa.Table) -> pa.Table:
        table = _by_tile(table)
        root, block = table.column("root").to_numpy(), table.column("block").to_numpy()
        number, c = _classes_of(table)
        joined = Union()  # by all larger tiles of the task
        open_rows: set[int] = set()  # of classes with a pair that is not named
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for x, y, members in _candidates(table):
            few = members <= FEW_CLASSES
            left.append(x[few]), right.append(y[few])
            chosen = np.zeros(len(x), bool)
            crowded = np.flatnonzero(~few)
            for k, i, j, p, q in zip(crowded.tolist(), *(v[crowded].tolist() for v in (x, y, root[x], root[y]))):
                if joined.find(p) == joined.find(q):
                    open_rows.update((i, j))
                else:
                    joined.join(p, q)
                    chosen[k] = True
            left.append(x[chosen]), right.append(y[chosen])
        x, y = np.concatenate(left), np.concatenate(right)
        if len(x):  # every pair of classes once
            pairs = np.minimum(number[x], number[y]) * (number.max() + 1) + np.maximum(number[x], number[y])
            _, once = np.unique(pairs, return_index=True)
            x, y = x[once], y[once]
        rest = np.array(sorted(open_rows), np.int64)
        return pa.table(
            {
                "a": c.take(pa.array(np.concatenate([x, rest]))),
                "b": pa.concat_arrays([c.take(pa.array(y)), pa.nulls(len(rest), c.type)]),
                "block": pa.concat_arrays([pa.nulls(len(x), pa.int64()), pa.array(block[rest])]),
            }
        )

    parts = BUCKETS_PER_PARTITION * int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.withColumn("part", F.pmod(F.xxhash64("block", "u", "t"), F.lit(parts)))
    return placed.groupBy("part").applyInArrow(compare, f"a {CLASS}, b {CLASS}, block bigint")


def in_question(dealt: DataFrame, members: DataFrame) -> DataFrame:
    """The rows of the tiles (block, u, t, side, c, root) that stand in a pair to be compared there, judged by the sketches.

    A pair that shares several of the blocks counts in the smallest of them alone, so that a set is not sent to all of them.
    """
    mine = dealt.groupBy("c").agg(F.sort_array(F.collect_set("block")).alias("blocks"))
    rows = dealt.join(mine, "c").join(members.select("c", "size", "bits"), "c").withColumn("root", F.xxhash64("root"))
    rows = rows.withColumn("before", F.filter("blocks", lambda b: b < F.col("block"))).drop("blocks")

    def compare(table: pa.Table) -> pa.Table:
        table = _by_tile(table)
        before = table.column("before").combine_chunks()
        lengths, flat = before.value_lengths().to_numpy(), before.flatten().to_numpy()
        begin = np.cumsum(lengths) - lengths
        wanted = np.zeros(len(table), bool)
        for x, y, _ in _candidates(table):
            fresh = ~(wanted[x] & wanted[y])
            x, y = x[fresh], y[fresh]
            for some in np.array_split(np.arange(len(x)), max(1, len(x) * 2 * BLOCKS // WORDS_AT_ONCE)):
                first = ~_share(flat, begin, lengths, x[some], y[some])
                wanted[x[some][first]] = wanted[y[some][first]] = True
        return table.select(["block", "u", "t", "side", "c", "root"]).filter(pa.array(wanted))

    parts = BUCKETS_PER_PARTITION * int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.withColumn("part", F.pmod(F.xxhash64("block", "u", "t"), F.lit(parts)))
    return placed.groupBy("part").applyInArrow(compare, f"block bigint, u int, t int, side int, c {CLASS}, root bigint")


def _share(flat: np.ndarray, begin: np.ndarray, lengths: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the lists of x and y, each without repeats, have a value in common, for each pair (x, y)."""
    owner = np.repeat(np.tile(np.arange(len(x)), 2), lengths[np.concatenate([x, y])])
    each = lengths[np.concatenate([x, y])]
    at = np.arange(int(each.sum())) + np.repeat(begin[np.concatenate([x, y])] - (np.cumsum(each) - each), each)
    order = np.lexsort((flat[at], owner))
    owner, value = owner[order], flat[at][order]
    twice = (owner[1:] == owner[:-1]) & (value[1:] == value[:-1])
    out = np.zeros(len(x), bool)
    out[owner[1:][twice]] = True
    return out


def linked_across(dealt: DataFrame, members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that join all that is linked within each tile, verified in the tile on the sets (c, shingles)."""
    rows = dealt.join(members.select("c", "size", "bits"), "c").join(sets, "c").withColumn("root", F.xxhash64("root"))

    def compare(table: pa.Table) -> pa.Table:
        table = _by_tile(table)
        root = table.column("root").to_numpy()
        _, c = _classes_of(table)
        packed = table.column("shingles").combine_chunks()
        opened: dict[int, np.ndarray] = {}
        joined, left, right = Union(), [], []
        for x, y, _ in _candidates(table):
            for i, j, p, q in zip(*(v.tolist() for v in (x, y, root[x], root[y]))):
                if joined.find(p) == joined.find(q):
                    continue
                for k in (i, j):
                    if k not in opened:
                        opened[k] = _opened(packed[k].as_py())
                if similar(opened[i], opened[j]):
                    joined.join(p, q)
                    left.append(i), right.append(j)
        return pa.table({"a": c.take(pa.array(left, pa.int64())), "b": c.take(pa.array(right, pa.int64()))})

    return rows.groupBy("block", "u", "t").applyInArrow(compare, f"a {CLASS}, b {CLASS}")


def similar_groups(rows: DataFrame, key: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """One row per input row: the key, n_shingles, component_id (the smallest key in its group)."""
    hashed, ids, groups = _grouped(rows, key, text, buckets)
    return ids.join(groups, "root", "left").select(
        F.col("id").alias(key),
        F.col("size").cast("bigint").alias("n_shingles"),
        F.coalesce("least", "id").alias("component_id"),
    )


def first_of_groups(rows: DataFrame, key: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """One row of each group, one with the smallest key, and all rows without shingles, with the columns they came with."""
    hashed, ids, groups = _grouped(rows, key, text, buckets)
    others = ids.where("size > 0").select("key", "check", "root").distinct().join(groups, "root")
    others = others.where(F.struct("key", "check") != F.col("one")).select("key", "check")
    kept = hashed.drop("text").join(others, ["key", "check"], "left_anti")
    repeated = kept.groupBy("key", "check").agg(F.count("*").alias("n")).where("n > 1").select("key", "check")
    once = kept.join(repeated, ["key", "check"], "left_anti").select("row")
    several = kept.join(repeated, ["key", "check"], "left_semi")
    bare_text = F.coalesce(F.translate(F.col("row")[text], " \t\n\x0b\f\r", "") == "", F.lit(True))
    bare, full = several.where(bare_text).select("row"), several.where(~bare_text)
    first = full.dropDuplicates(["key", "check"]).select("row")
    return once.unionByName(bare).unionByName(first).select("row.*")


def _grouped(rows: DataFrame, key: str, text: str, buckets: int | None):
    """The hashed rows; id, key, check, size and root of each; and of each root the smallest id and one row's hashes."""
    hashed = _hashed(rows, text)
    if buckets is None:
        shuffled = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(shuffled, BUCKETS_PER_PARTITION * rows.rdd.getNumPartitions())
    base = stored(sketched(hashed, buckets))
    texts = base.where("is_text").select("key", "check", "size", "bits", _class().alias("c"))
    shared = base.where("not is_text").select("block", "size", _class().alias("c"))
    members = stored(
        texts.join(shared.select("c").distinct(), "c", "left_semi")
        .groupBy("c")
        .agg(F.first("size").alias("size"), F.first("bits").alias("bits"), F.min(F.struct("key", "check")).alias("one"))
    )

    sets = stored(class_sets(hashed, members.select("one.*")).dropDuplicates(["c"]))

    def verified(pairs: DataFrame) -> DataFrame:
        return linked(stored(pairs), sets)

    def heads(blocks: DataFrame, of: str) -> DataFrame:
        """For each class one other of its blocks: the first of the block with which it shares most blocks."""
        first = F.min(F.struct(F.col(of).alias("at"), "c", "size")).alias("lead")
        lead = blocks.groupBy("block").agg(first, F.count("*").alias("n"))
        pairs = blocks.join(lead, "block").where((F.col(of) != F.col("lead.at")) & _sizes_fit("size", "lead.size"))
        most = pairs.groupBy(F.col("lead.c").alias("a"), F.col("c").alias("b")).agg(F.count("*").alias("times"), F.max("n").alias("n"))
        best = most.groupBy("b").agg(F.max_by(F.struct("a", "n"), F.struct("times", "a")).alias("best"))
        return near(best.select("best.a", "b", "best.n"), members)

    def apart(blocks: DataFrame, links: DataFrame) -> DataFrame:
        return stored(_open_blocks(blocks.select("block", "size", "c"), connected(links)))

    links = stored(verified(heads(shared, "c")))
    blocks = apart(shared, links)
    crowded = stored(_crowded(blocks, CROWD))
    if not crowded.isEmpty():
        links = stored(links.unionByName(linked_across(diagonal(_largest(crowded)), members, sets)))
        blocks = apart(blocks, links)
    crowded = stored(_crowded(blocks, TILE))
    if not crowded.isEmpty():
        links = stored(links.unionByName(verified(heads(crowded.drop("n"), "root"))))
        blocks = apart(blocks, links)
    found = stored(forest(tiles(blocks), members))
    links = stored(links.unionByName(verified(_named_pairs(found))))
    rest = found.where("block is not null").select("block", F.col("a").alias("c")).distinct()
    blocks = apart(blocks.join(rest, ["block", "c"], "left_semi"), links)
    if not blocks.isEmpty():
        links = links.unionByName(linked_across(stored(in_question(tiles(blocks, by_bytes=True), members)), members, sets))
    roots = connected(links)

    named = texts.join(roots, F.col("c") == F.col("node"), "left")
    named = named.select("key", "check", "size", F.coalesce("root", "c").alias("root")).dropDuplicates(["key", "check"])
    ids = hashed.select(F.col("row")[key].alias("id"), "key", "check").join(named, ["key", "check"])
    least = ids.where("size > 0").groupBy("root").agg(F.min("id").alias("least"), F.min(F.struct("id", "key", "check")).alias("one"))
    return hashed, ids, least.select("root", "least", F.struct("one.key", "one.check").alias("one"))


def _sizes_fit(a: str, b: str):
    a, b = F.col(a), F.col(b)
    return (100 * F.least(a, b) >= PERCENT * F.greatest(a, b))


def _named_pairs(found: DataFrame) -> DataFrame:
    """a, b, n of pairs that tiles or heads named, each once."""
    named = found.where("b is not null")
    if "n" in named.columns:
        return named
    return named.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().withColumn("n", F.lit(TILE))


def _crowded(blocks: DataFrame, more_than: int) -> DataFrame:
    many = blocks.groupBy("block").agg(F.count("*").alias("n")).where(F.col("n") > more_than)
    return blocks.join(many, "block")


def _largest(crowded: DataFrame) -> DataFrame:
    """Every class in the largest of its blocks alone."""
    best = crowded.groupBy("c").agg(F.max_by(F.struct("block", "root", "size"), F.struct("n", "block")).alias("best"))
    return best.select("best.*", "c")


def _open_blocks(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """The blocks that classes of more than one group share, with the groups."""
    rooted = shared.join(roots, F.col("c") == F.col("node"), "left").select("block", "size", "c", F.coalesce("root", "c").alias("root"))
    mixed = rooted.groupBy("block").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    return rooted.join(mixed.select("block"), "block")
