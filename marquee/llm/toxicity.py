"""Toxicity of texts whose insults may be disguised.

Writing is seen as a noisy channel: letters are replaced by signs that look alike, written several times, or set apart. A stretch that
looks disguised becomes a lattice of letters; Viterbi decoding under a character trigram model of the whole corpus
chooses the reading. The score comes from a logistic model over the words, and beginnings of words, of the restored text.

Words cut in two, masked letters, letters of other scripts and characters that do not show look like no disguise by themselves. So each text
is also squeezed to its bare letters, in which the words that mark toxic texts are searched. Where one is written across other
signs, the whole stretch becomes a lattice: a sign between letters is a boundary, nothing or, if it masks, any letter, each at a price. The word counts
if the best reading has it as a word.

The trigram counts cover all texts. The classifier is fitted on at most `most_labelled` labelled rows, chosen by a hash of
the key, the features being those that tell their labels apart best. NULL labels are not used; a text labelled twice
counts as toxic if one label says so. NULL and empty texts have no features and get the score of the intercept. Repeated
rows get equal scores. Without labels every score is 0.5 times the prior of 0, that is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import wordhash as wh

MOST_LABELLED = 20_000
FEATURES = 4_000
SEEN_AT_LEAST = 5
ERRORS_APART = 4.0  # standard errors by which a feature must differ between the labels
PREFIX = 5
SHARD_BYTES = 2 << 20
CACHED = 200_000

#: Signs and the letters they stand for (fixed values).
LOOKS_LIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e",
}
#: Letters of other scripts that look like Latin ones (fixed values).
CONFUSABLE = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i",
    "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "α": "a", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g",
} | {chr(0xFF41 + i): chr(97 + i) for i in range(26)}
#: Characters that take no room (fixed values).
UNSEEN = "\u00ad\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"
MASKS = "*#_"
#: Prices of readings, in nats, beyond what the trigram model says.
NO_BLANK, NO_SIGN, MASKED = 2.0, 0.5, math.log(26)
ALPHABET = "abcdefghijklmnopqrstuvwxyz"
TELLING = 10  # times as frequent in toxic texts as in others: words that are searched across signs
SHORTEST = 4  # letters of such a word
_SIGN = re.escape("".join(LOOKS_LIKE))
_LETTER = r"[^\W\d_]"
_SINGLE = rf"(?:{_LETTER}|[{_SIGN}])"
_BETWEEN = rf"(?:[^\w\n{_SIGN}]|_){{1,3}}"
_APART = rf"(?<![^\W_]){_SINGLE}(?:{_BETWEEN}{_SINGLE}){{2,}}(?![^\W_])"
#: A sign beside a letter, a letter three times, or letters set apart.
DISGUISED = re.compile(rf"(?:{_LETTER}[{_SIGN}]|[{_SIGN}]{_LETTER})|({_LETTER})\1\1|{_APART}")
TRIPLE = re.compile(rf"({_LETTER})\1\1")
APART = re.compile(_APART)
SINGLE = re.compile(_SINGLE)
INSIDE = re.compile(r"(?<=[^\W_])[._*-](?=[^\W_])")
WORD = re.compile(rf"[\w{_SIGN}]+")
PLAIN = re.compile(r"[^\W\d_]+")
EDGE = "!|($"


def _skeleton_letters() -> np.ndarray:
    """By code point the ASCII letter that a character may stand for; l and i, which the same signs stand for, are one. 0: none."""
    letters = {c: c for c in ALPHABET} | {k: v[0] for k, v in (LOOKS_LIKE | CONFUSABLE).items()}
    table = np.zeros(ord(max(letters)) + 2, np.uint8)  # the last place is for all characters beyond
    for character, letter in letters.items():
        table[ord(character)] = ord("i" if letter == "l" else letter)
    return table


SKELETON = _skeleton_letters()


def _with_places(text: str) -> tuple[str, np.ndarray]:
    """The bare letters of a lower-case text, repeated ones once, and where each of them begins in the text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = SKELETON[np.minimum(codes, len(SKELETON) - 1)]
    places = np.flatnonzero(letters)
    letters = letters[places]
    first = np.ones(len(letters), bool)
    first[1:] = letters[1:] != letters[:-1]
    return letters[first].tobytes().decode("ascii"), places[first]


def skeleton(text: str) -> str:
    """The bare letters of a lower-case text, repeated ones once."""
    return _with_places(text)[0]


class Finder:
    """Finds words in texts where other signs stand between, over or instead of their letters."""

    def __init__(self, wanted):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        found: dict[str, set[tuple[str, bool]]] = {}
        for word in wanted:
            found.setdefault(skeleton(word), set()).add((word, False))
            for i in range(1, len(word) - 1):  # a letter that a mask may cover
                found.setdefault(skeleton(word[:i] + word[i + 1 :]), set()).add((word, True))
        for form, words in found.items():
            if len(form) >= SHORTEST - 1:
                self.automaton.add_word(form, (len(form), sorted(words)))
        if len(self.automaton):
            self.automaton.make_automaton()

    def stretches(self, low: str) -> set[tuple[str, str]]:
        """Pairs (stretch of the text, word that may be hidden in it)."""
        if not len(self.automaton):
            return set()
        bare, places = _with_places(low)
        out = set()
        for end, (length, words) in self.automaton.iter(bare):
            start = int(places[end - length + 1])
            stop = int(places[end + 1]) if end + 1 < len(places) else len(low)
            inside = low[start:stop].rstrip()
            plain = inside.isascii() and inside.isalpha()
            for word, masked in words:
                if plain and not masked or masked and not any(m in inside for m in MASKS):
                    continue
                a, b = start, start + len(inside)
                while a and not low[a - 1].isspace():
                    a -= 1
                while b < len(low) and not low[b].isspace():
                    b += 1
                out.add((low[a:b], word))
        return out


def trigram_counts(rows: DataFrame, text: str = "text") -> np.ndarray:
    """27 x 27 x 27 counts over all texts: a to z, and 0 for anything else."""

    fold = np.zeros(256, np.int64)
    fold[97:123] = fold[65:91] = np.arange(1, 27)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(27**3, np.int64)
        for batch in batches:
            for shard in wh.shards(batch, "text", SHARD_BYTES):
                c = fold[wh.text_bytes(shard.column(0))[0]]
                total += np.bincount(c[:-2] * 729 + c[1:-1] * 27 + c[2:], minlength=27**3)
        yield pa.RecordBatch.from_pydict({"gram": np.arange(27**3), "n": total})

    grams = rows.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "gram bigint, n bigint")
    found = grams.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(27**3)
    out[found.column("gram").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(27, 27, 27)


class Reader:
    """Decodes disguised stretches; readings are remembered."""

    def __init__(self, counts: np.ndarray):
        smooth = counts + 0.5
        self.costs = -np.log(smooth / smooth.sum(2, keepdims=True))
        self.known: dict[str, str] = {}

    def _options(self, sign: str) -> str:
        return LOOKS_LIKE.get(sign, sign)

    def read(self, stretch: str) -> str:
        """The likeliest reading: one letter for each sign, one or two for a run of the same."""
        if stretch not in self.known:
            if len(self.known) > CACHED:
                self.known.clear()
            self.known[stretch] = self._decode(stretch)
        return self.known[stretch]

    def best(self, choices: list[list[tuple[str, float]]]) -> str:
        """The cheapest reading: of each place one of its choices (text, price), under the trigram model; a blank is a boundary of words."""
        # state: the last two letters; value: cost and the reading so far
        states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        for options in choices:
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (cost, said) in states.items():
                for letters, price in options:
                    x, y, now = a, b, cost + price
                    for letter in letters:
                        code = ord(letter) - 96 if "a" <= letter <= "z" else 0
                        now += self.costs[x, y, code]
                        x, y = y, code
                    if (x, y) not in after or now < after[x, y][0]:
                        after[x, y] = (now, said + letters)
            states = after
        ends = ((cost + self.costs[x, y, 0], said) for (x, y), (cost, said) in states.items())
        return min(ends)[1]

    def _decode(self, stretch: str) -> str:
        runs = [(m[0][0], len(m[0])) for m in re.finditer(r"(.)\1*", stretch, re.DOTALL)]
        return self.best([[(x * n, 0.0) for x in self._options(sign) for n in ((1, 2) if times > 1 else (1,))] for sign, times in runs])

    def across(self, stretch: str) -> set[str]:
        """The words of the best reading of a stretch in which any sign may be a boundary, nothing or a masked letter."""
        key = "\0" + stretch
        if key not in self.known:
            if len(self.known) > CACHED:
                self.known.clear()
            self.known[key] = self.best([self._choices(m[0][0], len(m[0])) for m in re.finditer(r"(.)\1*", stretch, re.DOTALL)])
        return set(self.known[key].split())

    def _choices(self, sign: str, times: int) -> list[tuple[str, float]]:
        if sign in UNSEEN:
            return [("", 0.0)]
        if sign.isspace():
            return [(" ", 0.0), ("", NO_BLANK)]
        counts = (1, 2) if times > 1 else (1,)
        letters = LOOKS_LIKE.get(sign) or CONFUSABLE.get(sign) or (sign if sign.isalpha() else "")
        out = [(x * n, 0.0) for x in letters for n in counts]
        if not sign.isalpha():
            out += [(" ", NO_SIGN), ("", NO_SIGN * times)]
            if sign in MASKS and times <= 2:
                out += [(x, MASKED) for x in ALPHABET] if times == 1 else [(x + y, 2 * MASKED) for x in ALPHABET for y in ALPHABET]
        return out

    def split(self, letters: str) -> set[str]:
        """Words of letters set apart: between two of them is a word boundary or nothing, as the trigram model has it.

        Also the words that all of them make, and all but the first, the last, or both.
        """
        choices: list[list[tuple[str, float]]] = []
        for m in re.finditer(r"(.)\1*", letters, re.DOTALL):
            readings = [x for sign in self._options(m[0][0]) for x in ({sign * len(m[0]), sign, sign * 2} if len(m[0]) > 2 else {sign * len(m[0])})]
            apart = [" ".join(m[0][:1] * len(m[0]))] if len(m[0]) > 1 else []
            said = [(x, 0.0) for x in [*readings, *apart]]
            choices.append(said if not choices else [*said, *((" " + x, price) for x, price in said)])
        best = self.best(choices)
        whole = {letters[i:j] for i in (0, 1) for j in (len(letters), len(letters) - 1) if j - i > 2}
        return set(best.split()) | {self.read(w) for w in whole}

    def words(self, text: str, finder: Finder | None = None) -> set[str]:
        """The distinct words of a text, those of disguised stretches also in their restored form."""
        low = text.lower()
        words = set(PLAIN.findall(low))
        if DISGUISED.search(low):
            for m in APART.finditer(low):
                words |= self.split("".join(SINGLE.findall(m[0])))
            joined = INSIDE.sub("", low)
            tokens = set(WORD.findall(joined))
            if not TRIPLE.search(joined):  # then nothing about a word of mere letters is a disguise
                tokens = {token for token in tokens if not token.isalpha()}
            for token in tokens:
                bare = token.strip(EDGE)
                if DISGUISED.search(token) and len(bare) > 2:
                    words.add(self.read(bare))
                    if token.lstrip(EDGE) != token or token.rstrip(EDGE) != token:
                        words.add(self.read(token))
        for stretch, word in finder.stretches(low) if finder else ():
            if word not in words and word in self.across(stretch):
                words.add(word)
        return words


def features(words: set[str]) -> set[str]:
    """The words, and the beginnings of longer ones."""
    return words | {"^" + w[:PREFIX] for w in words if len(w) > PREFIX}


class Model(NamedTuple):
    counts: np.ndarray
    weights: dict[str, float]
    intercept: float
    telling: tuple[str, ...] = ()  # words to be searched across signs


def train(rows: DataFrame, labels: DataFrame, key: str, text: str, label: str, counts: np.ndarray, most: int = MOST_LABELLED) -> Model:
    """Fit on at most `most` labelled rows; their feature counts are summed by Spark."""
    usable = labels.where(F.col(label).isNotNull()).groupBy(key).agg(F.max(F.col(label).cast("int")).alias("_toxic"))
    chosen = usable.orderBy(F.xxhash64(key), key).limit(most)
    sample = rows.select(key, F.col(text).cast("string").alias("_text")).join(F.broadcast(chosen), key)
    sample = sample.select(F.col("_text").alias("text"), F.col("_toxic").alias("toxic"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, seen = Reader(counts), (Counter(), Counter())
        n = [0, 0]
        for batch in batches:
            for value, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[toxic > 0].update(features(reader.words(value or "")))
                n[toxic > 0] += 1
        names = [*seen[0].keys() | seen[1].keys()]
        yield pa.RecordBatch.from_pydict(
            {
                "feature": pa.array([*names, ""], pa.string()),
                "clean": pa.array([*(seen[0][x] for x in names), n[0]], pa.int64()),
                "toxic": pa.array([*(seen[1][x] for x in names), n[1]], pa.int64()),
            }
        )

    sums = sample.mapInArrow(count, "feature string, clean bigint, toxic bigint").groupBy("feature")
    sums = sums.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    total = sums.where("feature = ''").first()
    if total is None or total["clean"] + total["toxic"] == 0:
        return Model(counts, {}, -30.0)
    n0, n1 = total["clean"], total["toxic"]
    # How far a feature's share among toxic texts lies from that among the others, in standard errors.
    share = (F.col("clean") + F.col("toxic") + 1) / (n0 + n1 + 2)
    error = F.sqrt(share * (1 - share) * (n0 + n1) / (max(n0, 1) * max(n1, 1)))
    apart = F.abs(F.col("toxic") / max(n1, 1) - F.col("clean") / max(n0, 1)) / error
    seen = sums.where(f"feature <> '' and clean + toxic >= {SEEN_AT_LEAST}").where(apart >= ERRORS_APART)
    best = seen.orderBy(apart.desc(), "feature").limit(FEATURES)
    rate = (F.col("toxic") + 0.5) / (n1 + 1) >= TELLING * (F.col("clean") + 0.5) / (n0 + 1)
    found = best.select("feature", rate.alias("telling")).collect()
    names = [r["feature"] for r in found]
    telling = tuple(r["feature"] for r in found if r["telling"] and len(r["feature"]) >= SHORTEST and set(r["feature"]) <= set(ALPHABET))
    place = {name: i for i, name in enumerate(names)}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(counts)
        for batch in batches:
            found = [sorted(place[f] for f in features(reader.words(t or "")) if f in place) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "found"])

    data = sample.mapInArrow(encode, "toxic int, found array<int>").toArrow()
    toxic = (data.column("toxic").to_numpy() > 0).astype(float)
    lists = data.column("found").combine_chunks()
    columns = lists.flatten().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(toxic)), lists.value_lengths().to_numpy(zero_copy_only=False))
    weights, intercept = _logistic(owner, columns, toxic, len(names))
    fitted = dict(zip(names, weights.tolist()))
    return Model(counts, fitted, intercept, tuple(w for w in telling if fitted[w] > 0))


def _logistic(owner: np.ndarray, columns: np.ndarray, y: np.ndarray, n: int, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse 0/1 features by gradient steps with per-feature scaling and a small penalty."""
    w, b = np.zeros(n), math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    square, square_b = np.full(n, 1e-8), 1e-8
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(owner, w[columns], len(y)), -30, 30)))
        error = p - y
        step = np.bincount(columns, error[owner], n) / len(y) + 1e-5 * w
        square += step**2
        w -= 0.3 * step / np.sqrt(square)
        step_b = error.mean()
        square_b += step_b**2
        b -= 0.1 * step_b / math.sqrt(square_b)
    return w, float(b)


def score(rows: DataFrame, model: Model, key: str, text: str) -> DataFrame:
    """key, score; one row per input row."""
    given = rows.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"))
    weights, intercept = model.weights, model.intercept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, finder, names = Reader(model.counts), Finder(model.telling), weights.keys()
        for batch in batches:
            sums = [intercept + sum(weights[f] for f in names & features(reader.words(t or "", finder))) for t in batch.column(1).to_pylist()]
            p = 1 / (1 + np.exp(-np.clip(np.array(sums, float), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], names=["row", "score"])

    found = given.mapInArrow(run, T.StructType([given.schema["row"], T.StructField("score", T.DoubleType())]))
    return found.select(F.col("row")[key].alias(key), "score")
