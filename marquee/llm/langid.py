"""Language identification with error-correcting output codes over byte n-grams.

Every language has a codeword; for each bit a binary classifier, trained on texts of the languages with that bit on against the
others, gives a margin per trigram of bytes. A text gets the language whose codeword has the smallest loss, each bit
weighted by how well it tells the training texts apart; a small lead over the second is flagged as ambiguous.

Trained on at most `per_language` labelled texts of each language, chosen by a hash of the key; NULL labels are never used. A text
that is NULL or has no letter is `und` with score 0. Repeated rows are judged alike. With no labelled row at all every
text is `und`; with one language every text with a letter has that language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..operators.ranking import top_per_group
from . import wordhash as wh

PER_LANGUAGE = 2_000
GRAMS = 1 << 15
SHARD_BYTES = 2 << 20
AMBIGUOUS = 0.8
SHARPNESS = 12.0
LETTER = re.compile(r"[^\W\d_]")


class Model(NamedTuple):
    languages: list[str]
    codes: np.ndarray  # languages x bits, -1 or 1
    weights: np.ndarray  # bits x GRAMS, log ratios
    trust: np.ndarray  # of each bit


def codewords(n: int) -> np.ndarray:
    """All ways to halve up to 5 languages; for more, 4 log2(n) + 11 random halvings with a fixed seed."""
    if n <= 5:
        rows = [[1 if (half >> i) & 1 else -1 for i in range(n)] for half in range(1, 2 ** (n - 1))]
        return np.array(rows or [[1] * n]).T
    rng = np.random.default_rng(n)
    halves = [rng.permutation(np.where(np.arange(n) < n // 2, 1, -1)) for _ in range(4 * int(np.ceil(np.log2(n))) + 11)]
    return np.array(halves).T


def gram_codes(data: np.ndarray) -> np.ndarray:
    """The bucket of the trigram that begins at each byte but the last two; digits, signs and blanks are alike."""
    folded = wh.LOWER[data]
    folded = np.where(wh.ALPHANUMERIC[folded] & ~((folded >= 48) & (folded < 58)), folded, 32).astype(np.uint32)
    code = (folded[:-2] << 16) | (folded[1:-1] << 8) | folded[2:]
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(17)).astype(np.int64)


def _texts(shard: pa.RecordBatch, column: int):
    """For each text its trigram buckets, in a row, and where they begin."""
    data, offsets = wh.text_bytes(shard.column(column))
    codes = gram_codes(data) if len(data) > 2 else np.zeros(0, np.int64)
    starts = np.minimum(offsets[:-1], len(codes))
    ends = np.clip(offsets[1:] - 2, starts, len(codes))
    return codes, starts, ends


def train(rows: DataFrame, key: str, text: str, label: str, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on a bounded number of labelled rows per language; the counts come back as languages x GRAMS at most."""
    labelled = rows.where(F.col(label).isNotNull()).select(F.col(key).alias("key"), F.col(label).alias("label"))
    # The first of each language in many pieces first, so that no task ranks a whole language.
    chosen = top_per_group(labelled, ["label"], per_language, [F.xxhash64("key"), F.col("key")]).select(F.col("key").alias(key)).distinct()
    chosen = F.broadcast(chosen) if per_language <= PER_LANGUAGE else chosen
    sample = rows.where(F.col(label).isNotNull()).join(chosen, key, "left_semi")
    sample = sample.select(F.col(label).cast("string").alias("label"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for shard in wh.shards(batch, "text", SHARD_BYTES):
                codes, starts, ends = _texts(shard, 1)
                for name, a, b in zip(shard.column(0).to_pylist(), starts, ends):
                    if name not in counts:
                        counts[name] = np.zeros(GRAMS)
                    # Each text counts for one, however long it is.
                    counts[name] += np.bincount(codes[a:b], minlength=GRAMS) / max(1, b - a)
        for name, sums in counts.items():
            some = np.flatnonzero(sums)
            yield pa.RecordBatch.from_pydict(
                {"label": pa.array([name] * len(some), pa.string()), "gram": some.astype(np.int32), "weight": sums[some]}
            )

    grams = sample.mapInArrow(run, "label string, gram int, weight double").groupBy("label", "gram")
    found = grams.agg(F.sum("weight").alias("weight")).toArrow()
    languages = sorted(set(found.column("label").to_pylist()))
    place = {name: i for i, name in enumerate(languages)}
    table = np.zeros((len(languages), GRAMS))
    at = np.array([place[x] for x in found.column("label").to_pylist()], np.int64)
    table[at, found.column("gram").to_numpy()] = found.column("weight").to_numpy()
    if not languages:
        return Model([], np.zeros((0, 0), int), np.zeros((0, GRAMS), np.float32), np.zeros(0))
    table = (table + 1e-4) / (table + 1e-4).sum(1, keepdims=True)
    codes = codewords(len(languages))
    weights, trust = [], []
    for bit in codes.T:
        on = table[bit > 0].mean(0)
        off = table[bit < 0].mean(0) if (bit < 0).any() else np.full(GRAMS, 1 / GRAMS)
        ratio = np.log(on) - np.log(off)
        weights.append(ratio)
        # How far the two sides lie apart, in the mean margin of their own texts.
        trust.append((on * ratio).sum() + (off * -ratio).sum())
    trust = np.array(trust)
    return Model(languages, codes, np.array(weights, np.float32), trust / trust.sum())


def predict(rows: DataFrame, model: Model, key: str, text: str) -> DataFrame:
    """key, lang_pred, score, ambiguous; one row per input row."""
    given = rows.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in wh.shards(batch, "text", SHARD_BYTES):
                yield judge(shard)

    def judge(shard: pa.RecordBatch) -> pa.RecordBatch:
        codes, starts, ends = _texts(shard, 1)
        n = np.maximum(ends - starts, 1)
        loss = np.zeros((shard.num_rows, len(model.languages)))
        for bit, weights, trust in zip(model.codes.T, model.weights, model.trust):
            sums = np.zeros(len(codes) + 1)
            np.cumsum(weights[codes], out=sums[1:])
            margin = np.clip((sums[ends] - sums[starts]) / n, -3, 3)
            loss += trust * np.log1p(np.exp(-margin[:, None] * bit[None, :]))
        lettered = np.array([t is not None and LETTER.search(t) is not None for t in shard.column(1).to_pylist()], bool)
        if model.languages:
            chance = np.exp(-SHARPNESS * (loss - loss.min(1, keepdims=True)))
            chance /= chance.sum(1, keepdims=True)
            best = chance.argmax(1)
            score = np.where(lettered, chance[np.arange(len(best)), best], 0.0)
            names = [model.languages[i] if ok else "und" for i, ok in zip(best, lettered)]
        else:
            score, names = np.zeros(shard.num_rows), ["und"] * shard.num_rows
        return pa.RecordBatch.from_arrays(
            [shard.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(score < AMBIGUOUS)],
            names=["row", "lang_pred", "score", "ambiguous"],
        )

    extra = T.StructType.fromDDL("lang_pred string, score double, ambiguous boolean")
    found = given.mapInArrow(run, T.StructType([given.schema["row"], *extra.fields]))
    return found.select(F.col("row")[key].alias(key), "lang_pred", "score", "ambiguous")
