"""Recommenders: most popular, linked by the site, similar to what was liked."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..functions import arrays, numbers
from ..storage import stored
from .features import CatalogueFeatures, FeatureExtractor, FeatureSettings
from .guards import require_columns
from .ranking import top, top_per_group
from .similarity import (
    CELLS_AT_ONCE,
    best_columns,
    code_weights,
    coded_labels,
    cosines_of_codes,
    last_liked_wins,
    nearest_by_labels,
    profiles_of,
    similar_to,
    title_lists,
)

# The columns shown to a user.
DISPLAY = [
    "original_title",
    "genre",
    "release_date",
    "country_of_origin_1",
    "production_company_1",
    "rating",
    "poster_url",
]


class Recommender(Protocol):
    """Titles and an optional liked list (pos, id) in, `id` and `relevance` out."""

    def recommend(
        self, titles: DataFrame, liked: DataFrame | None = None, preferences: dict | None = None
    ) -> DataFrame: ...


@dataclass(frozen=True)
class MostPopular:
    top_n: int
    votes_above: float = 50_000

    def recommend(self, titles, liked=None, preferences=None) -> DataFrame:
        voted = titles.where((F.col("num_votes") > self.votes_above) & F.col("rating").isNotNull())
        return top(voted, self.top_n, "rating").select("id", F.col("rating").alias("relevance"))


@dataclass(frozen=True)
class LinkedBySite:
    """The union of the site's own recommendations for the liked titles, best rated first."""

    top_n: int

    def recommend(self, titles, liked=None, preferences=None) -> DataFrame:
        require_columns(titles, "id", "imdb_recommendations", "rating")
        chosen = titles.join(liked.select("id"), "id", "left_semi")
        linked = chosen.select(F.explode(arrays.member_set(F.col("imdb_recommendations"))).alias("id")).distinct()
        known = titles.join(linked, "id", "left_semi").where(F.col("rating").isNotNull())
        return top(known, self.top_n, "rating").select("id", F.col("rating").alias("relevance"))


@dataclass(frozen=True)
class SimilarTitles:
    """Per liked title the most similar others; a title found several times keeps the last similarity."""

    top_n: int
    features: FeatureExtractor = field(default_factory=CatalogueFeatures)

    def recommend(self, titles, liked=None, preferences=None) -> DataFrame:
        similar = similar_to(self.features.labels(titles), liked, self.top_n, self.features.settings)
        return last_liked_wins(similar, self.top_n)


def display(recommended: DataFrame, titles: DataFrame) -> DataFrame:
    """Recommendations with what a user wants to see of them, most relevant first."""
    genre = arrays.joined(F.col("genre_1"), F.col("genre_2"), F.col("genre_3"))
    shown = recommended.join(titles, "id").withColumns(
        {
            "genre": genre,
            "release_date": F.date_format("release_date", "MMMM yyyy"),
            "rating": numbers.half_even(F.col("rating"), 1),
        }
    )
    return shown.select("id", *DISPLAY, "relevance").orderBy(F.col("relevance").desc(), "id")


def recommend(
    recommender: Recommender,
    titles: DataFrame,
    liked: DataFrame | None = None,
    preferences: dict | None = None,
) -> DataFrame:
    return display(recommender.recommend(titles, liked, preferences), titles)


def similar_to_one(labels: DataFrame, title, n: int, settings: FeatureSettings) -> DataFrame:
    """The n titles most similar to one title, without the title itself."""
    spark = labels.sparkSession
    liked = spark.createDataFrame([(0, title)], f"pos int, id {labels.schema['id'].dataType.simpleString()}")
    return similar_to(labels, liked, n, settings).select("id", "sim", "rank")


BLOCK_PROFILES = 2_048  # profiles that are compared with as many others at once
BLOCK_OFFERS = 16_384  # most others in a block
ASKS_PER_CHUNK = 8_192  # (user, liked profile) pairs that one task answers at once
FEW_ASKS = 4_096  # such pairs up to which their profiles are simply compared with all others
MOST_LISTED = 1_000  # titles in the list of a profile up to which lists are made


def recommend_for_users(likes: DataFrame, labels: DataFrame, n: int, settings: FeatureSettings) -> DataFrame:
    """SimilarTitles for every user at once: user_id, id, relevance, rank.

    `likes` has the columns user_id, id and pos; rows without a user are nobody's. Titles with the same labels are one profile. Each profile that
    somebody liked gets one list of the titles most similar to it, whoever asks; a user who has liked none or few of them has n left. Who has fewer left
    asks for a list four times as long. The few who are left then, or whom lists of MOST_LISTED do not serve, have their profiles compared with all others,
    which leaves out what a user has liked. So whatever a user has liked, n titles are left if there are as many; equal ones by id.
    """
    weights = code_weights(labels, settings)
    likes = likes.where(F.col("user_id").isNotNull()).select("user_id", "id", "pos")
    coded = coded_labels(labels.where(F.col("id").isNotNull()))
    known = likes.join(coded.select("id", "look").hint("merge"), "id").groupBy("user_id", "look")
    # Titles of one profile have the same list, so of those that a user has liked the last counts.
    looks = stored(known.agg(F.collect_set("id").alias("liked"), F.count("*").alias("rows"), F.max("pos").alias("pos")))
    # So many of a profile's smallest ids that n are left of them for any user.
    most = looks.agg(F.coalesce(F.max("rows"), F.lit(0))).first()[0]
    # Profiles are numbered in the order of their smallest ids.
    ordered = profiles_of(coded, n + most).orderBy("profile", "look")
    profiles = stored(ordered.withColumn("place", F.monotonically_increasing_id()))
    asks = stored(looks.join(profiles.select("look", "place").hint("merge"), "look").select("user_id", "place", "liked", "pos"))
    titles = profiles.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    left, waiting, keep, parts = asks, asks.count(), n + 1 + math.ceil(n / 2), []
    while waiting > FEW_ASKS and keep <= MOST_LISTED:
        answered = stored(_from_lists(left, likes, profiles, n, keep, weights, keep >= titles))
        parts.append(answered)
        if keep >= titles:
            waiting = 0
            break
        done = answered.where(F.col("rank") == 1).select("user_id", "place")
        left = stored(left.join(done.hint("merge"), ["user_id", "place"], "left_anti"))
        waiting = left.count()
        keep *= 4
    if waiting or not parts:
        parts.append(_from_all(left, asks, likes, profiles, n, weights))
    similar = [part.select("user_id", "pos", "id", "sim") for part in parts]
    return last_liked_wins(functools.reduce(DataFrame.unionByName, similar), n, ("user_id",))


def _from_lists(asks: DataFrame, likes: DataFrame, profiles: DataFrame, n: int, keep: int, weights: np.ndarray, whole: bool) -> DataFrame:
    """user_id, place, pos, id, sim, rank: the n titles most similar to the profile of each ask (user_id, place, liked, pos) that its user has not liked; of asks
    to which the `keep` titles most similar to the profile leave n, or of all if these are all there are (`whole`)."""
    rows = profiles.select(F.col("place").alias("id"), F.col("codes").alias("values"), F.size("ids").alias("copies"))
    best = nearest_by_labels(rows, keep, weights, asks.select(F.col("place").alias("id")))
    lists = title_lists(best, profiles.select(F.col("place").alias("other"), "ids"), keep).withColumnRenamed("id", "place")
    others = F.filter("entries", lambda e: ~F.array_contains("liked", e["other"]))
    offered = asks.join(lists.hint("merge"), "place").select("user_id", "place", "pos", F.explode(others).alias("e"))
    offered = offered.select("user_id", "place", "pos", F.col("e.other").alias("id"), F.col("e.sim").alias("sim"))
    fresh = offered.join(likes.select("user_id", "id").hint("merge"), ["user_id", "id"], "left_anti")
    # The rows of an ask lie apart up to here, so nothing could be cut before they travel.
    ranked = top_per_group(fresh.repartition("user_id", "place"), ["user_id", "place"], n, [F.col("sim").desc(), F.col("id")])
    if whole:
        return ranked
    found = F.count("*").over(Window.partitionBy("user_id", "place"))
    return ranked.withColumn("found", found).where(F.col("found") >= n).drop("found")


def _from_all(left: DataFrame, asks: DataFrame, likes: DataFrame, profiles: DataFrame, n: int, weights: np.ndarray) -> DataFrame:
    """The same for the asks that are left, whatever has been liked: their profiles are compared with all others, block against block. For each user the n best
    profiles of the block are taken among those of which the user has not liked every title. Of equal profiles that with the smaller id counts,
    ids that the user has liked left out. `asks` are those of all users.
    """
    spark = likes.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    count = profiles.count()
    blocks = max(1, min(math.ceil(count / BLOCK_PROFILES), max(2 * tasks, math.ceil(count / BLOCK_OFFERS))))
    our_blocks = max(1, math.ceil(left.select("place").distinct().count() / BLOCK_PROFILES))
    ours, theirs = (F.pmod(F.xxhash64("place"), F.lit(many)).cast("int").alias(side) for many, side in ((our_blocks, "ours"), (blocks, "theirs")))

    asking = stored(left.select("user_id", "place").join(profiles.select("place", "codes").hint("merge"), "place").withColumn("ours", ours))
    # A row per block. Named as the side to broadcast, else Spark may choose the other, whose rows multiply only after the estimate of its size.
    sizes = F.broadcast(asking.groupBy("ours").agg(F.ceil(F.count("*") / ASKS_PER_CHUNK).cast("int").alias("chunks")))
    asking = asking.join(sizes, "ours").withColumn("chunk", F.pmod(F.xxhash64("user_id"), F.col("chunks")).cast("int"))
    # What is left to a user of the profiles they have liked titles of: the smallest id, or nothing.
    least = F.get(F.array_except("ids", "liked"), F.lit(0)).alias("least")
    theirs_liked = asks.join(left.select("user_id").distinct().hint("merge"), "user_id", "left_semi")
    touched = theirs_liked.join(profiles.select("place", "ids").hint("merge"), "place").select("user_id", "place", least, theirs)
    excluded = (
        asking.select("user_id", "ours", "chunk").distinct().join(touched.hint("merge"), "user_id")
        .groupBy("ours", "chunk", "theirs")
        .agg(F.collect_list(F.struct("user_id", "place", "least")).alias("touched"))
    )
    our_side = asking.groupBy("ours", "chunk").agg(F.collect_list(F.struct("user_id", "place", "codes")).alias("asks"))
    our_side = our_side.withColumn("theirs", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    their_side = profiles.groupBy(theirs).agg(F.collect_list(F.struct("place", "codes", "profile")).alias("offers"))
    their_side = their_side.withColumn("ours", F.explode(F.sequence(F.lit(0), F.lit(our_blocks - 1)))).join(sizes, "ours")
    their_side = their_side.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    keys = ["ours", "chunk", "theirs"]
    both = our_side.repartition(tasks, *keys).join(their_side.repartition(tasks, *keys).hint("merge"), keys)
    both = both.join(excluded.hint("merge"), keys, "left").select("asks", "offers", "touched")
    cosines = cosines_of_codes(weights)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asks, offers = batch.column("asks")[i].values, batch.column("offers")[i].values
                touched = batch.column("touched")[i].values if batch.column("touched")[i].is_valid else None
                row, column, least, sim = _answers(asks, offers, touched, n, cosines)
                yield pa.RecordBatch.from_arrays(
                    [*(asks.field(c).take(pa.array(row)) for c in ("user_id", "place")), offers.field("place").take(pa.array(column)), least, pa.array(sim)],
                    names=["user_id", "place", "other", "least", "sim"],
                )

    user, id_kind = (likes.schema[c].dataType.simpleString() for c in ("user_id", "id"))
    found = both.mapInArrow(answer, f"user_id {user}, place bigint, other bigint, least {id_kind}, sim double")
    best = top_per_group(found, ["user_id", "place"], n, [F.col("sim").desc(), F.col("least")]).drop("rank", "least")
    ids = profiles.select(F.col("place").alias("other"), "ids")
    titles = best.join(ids.hint("merge"), "other").select("user_id", "place", "sim", F.explode("ids").alias("id"))
    fresh = titles.join(likes.select("user_id", "id").hint("merge"), ["user_id", "id"], "left_anti")
    lists = top_per_group(fresh, ["user_id", "place"], n, [F.col("sim").desc(), F.col("id")])
    return lists.join(left.select("user_id", "place", "pos").hint("merge"), ["user_id", "place"])


def _answers(asks: pa.StructArray, offers: pa.StructArray, touched: pa.StructArray | None, n: int, cosines):
    """(ask, offer, smallest id, similarity): the n best offers of each ask, of those its user has not liked as a whole."""
    places = asks.field("place").dictionary_encode()
    first = np.full(len(places.dictionary), -1)
    of_ask = places.indices.to_numpy()
    first[of_ask[::-1]] = np.arange(len(of_ask))[::-1]
    codes, others = (s.field("codes") for s in (asks, offers))
    codes = codes.take(pa.array(first))
    a, b = (m.flatten().to_numpy(zero_copy_only=False).reshape(len(m), -1) for m in (codes, others))
    # Ids by which equal offers are ordered: first those of the offers, then those left of offers that users have touched.
    ids = offers.field("profile")
    users = asks.field("user_id").dictionary_encode()
    user_of = column_of = id_of = np.zeros(0, np.int64)
    if touched is not None:
        left = touched.field("least")
        id_of = np.where(left.is_valid().to_numpy(zero_copy_only=False), len(ids) + np.arange(len(left)), -1)
        ids = pa.concat_arrays([ids, left])
        user_of = pc.index_in(touched.field("user_id"), users.dictionary).fill_null(-1).to_numpy(zero_copy_only=False)
        column_of = pc.index_in(touched.field("place"), offers.field("place")).fill_null(-1).to_numpy(zero_copy_only=False)
        there = (user_of >= 0) & (column_of >= 0)
        order = np.argsort(user_of[there], kind="stable")
        user_of, column_of, id_of = (x[there][order] for x in (user_of, column_of, id_of))
    ties = np.empty(len(ids), np.int64)
    ties[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
    own_ids = np.arange(len(b))
    low, high = (np.searchsorted(user_of, users.indices.to_numpy(), side) for side in ("left", "right"))
    by_place = np.argsort(of_ask, kind="stable")
    step = max(1, CELLS_AT_ONCE // max(len(b), 1))
    ask_out, offer_out, id_out, sim_out = [], [], [], []
    for start in range(0, len(a), step):
        similarity = cosines(a[start : start + step], b)
        row, column = best_columns(similarity, ties[: len(b)], n)
        mine = by_place[slice(*np.searchsorted(of_ask[by_place], [start, start + len(similarity)]))]
        plain = mine[low[mine] == high[mine]]
        # Asks of users who have touched nothing here take the list of their profile.
        begin = np.searchsorted(row, np.arange(len(similarity) + 1))
        local = of_ask[plain] - start
        times = begin[local + 1] - begin[local]
        which = np.repeat(np.arange(len(plain)), times)
        at = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(begin[local], times)
        ask_out.append(plain[which]), offer_out.append(column[at]), id_out.append(column[at])
        sim_out.append(similarity[row[at], column[at]])
        own = mine[low[mine] < high[mine]]
        for some in np.array_split(own, len(own) * len(b) // CELLS_AT_ONCE + 1):
            if not len(some):
                continue
            masked = similarity[of_ask[some] - start].copy()
            named = np.tile(own_ids, (len(some), 1))
            times = high[some] - low[some]
            place = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low[some], times)
            cells = np.repeat(np.arange(len(some)), times), column_of[place]
            named[cells] = id_of[place]
            masked[named < 0] = -np.inf
            row, column = best_columns(masked, ties[named], n)
            sim = masked[row, column]
            there = np.isfinite(sim)
            row, column = row[there], column[there]
            ask_out.append(some[row]), offer_out.append(column), id_out.append(named[row, column]), sim_out.append(sim[there])
    least = ids.take(pa.array(np.concatenate(id_out)))
    return np.concatenate(ask_out), np.concatenate(offer_out), least, np.concatenate(sim_out)
