"""Offline ranking metrics over ``recs(list, rank, item_id)`` and ``relevant(list, item_id)``.

``keys`` names the columns that identify a list (a user, a profile, a setting and a
profile); ``relevant`` may be keyed by a subset of them. Ranks count from 1.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shelfmark.session import cut

from shelfmark.functions.vectors import unit, vector_sum


def _ideal_dcg(hits: Column, k: int) -> Column:
    """Discounts of the first ``hits`` positions (at most k), from a table of k + 1 sums."""
    sums, total = [0.0], 0.0
    for position in range(1, k + 1):
        total += 1.0 / math.log2(position + 1)
        sums.append(total)
    return F.get(F.array(*[F.lit(x) for x in sums]), hits.cast("int"))


def list_metrics(recs: DataFrame, relevant: DataFrame, ks: Sequence[int],
                 keys: Sequence[str] = ("list_id",), lists: DataFrame | None = None) -> DataFrame:
    """Precision, recall, NDCG, average precision and hit flag per list and k, in one pass.

    Precision divides by k even for a shorter list. A list without recommendations or without
    relevant items scores 0. ``lists`` may name lists that have neither.
    """
    keys, top = list(keys), max(ks)
    rel_keys = [c for c in keys if c in relevant.columns]
    relevant = relevant.select(*rel_keys, "item_id").distinct()
    sizes = relevant.groupBy(*rel_keys).agg(F.count("*").alias("n_relevant"))
    shown = recs.where(F.col("rank") <= top).select(*keys, "rank", "item_id").join(
        relevant.withColumn("hit", F.lit(1)), [*rel_keys, "item_id"], "left") \
        .withColumn("hit", F.coalesce("hit", F.lit(0)))
    upto = W.partitionBy(*keys).orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    gained = shown.select(
        *keys, "rank", "hit", (F.col("hit") / F.log2(F.col("rank") + F.lit(1.0))).alias("gain"),
        (F.col("hit") * F.sum("hit").over(upto) / F.col("rank")).alias("precision_here"))
    at = F.explode(F.array(*[F.lit(int(k)) for k in ks])).alias("k")
    per_k = gained.select("*", at).where(F.col("rank") <= F.col("k")).groupBy(*keys, "k").agg(
        F.sum("hit").alias("hits"), F.sum("gain").alias("dcg"),
        F.sum("precision_here").alias("ap_sum"))

    every = recs.select(*keys).distinct()
    if rel_keys == keys:
        every = every.unionByName(relevant.select(*keys)).distinct()
    if lists is not None:
        every = every.unionByName(lists.select(*keys)).distinct()
    joined = every.select("*", at).join(per_k, [*keys, "k"], "left").join(
        sizes, rel_keys, "left").na.fill(0, ["hits", "dcg", "ap_sum", "n_relevant"])
    best = F.least(F.col("n_relevant"), F.col("k"))
    zero = F.lit(0.0)
    ideal = _ideal_dcg(best, top)
    return joined.select(
        *keys, "k",
        (F.col("hits") / F.col("k")).alias("precision"),
        F.coalesce(F.try_divide(F.col("hits"), F.col("n_relevant")), zero).alias("recall"),
        F.coalesce(F.try_divide(F.col("dcg"), ideal), zero).alias("ndcg"),
        F.coalesce(F.try_divide(F.col("ap_sum"), best), zero).alias("average_precision"),
        (F.col("hits") > 0).cast("int").alias("hit"))


def _one(recs, relevant, k, keys, name, lists=None) -> DataFrame:
    return list_metrics(recs, relevant, [k], keys, lists).select(*keys, name)


def precision_at_k(recs, relevant, k, keys=("list_id",), lists=None) -> DataFrame:
    return _one(recs, relevant, k, keys, "precision", lists)


def recall_at_k(recs, relevant, k, keys=("list_id",), lists=None) -> DataFrame:
    return _one(recs, relevant, k, keys, "recall", lists)


def ndcg_at_k(recs, relevant, k, keys=("list_id",), lists=None) -> DataFrame:
    return _one(recs, relevant, k, keys, "ndcg", lists)


def map_at_k(recs, relevant, k, keys=("list_id",), lists=None) -> DataFrame:
    """Mean average precision over all lists; a list without relevant items counts as 0."""
    return list_metrics(recs, relevant, [k], keys, lists).agg(
        F.coalesce(F.avg("average_precision"), F.lit(0.0)).alias("map"))


def hit_rate_at_k(recs, relevant, k, keys=("list_id",), lists=None) -> DataFrame:
    return list_metrics(recs, relevant, [k], keys, lists).agg(
        F.coalesce(F.avg("hit"), F.lit(0.0)).alias("hit_rate"))


def catalog_coverage(recs: DataFrame, items: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Share of the catalog that was recommended, per key or over all lists."""
    total = items.agg(F.count("*").alias("n")).scalar()
    distinct = recs.select(*keys, "item_id").distinct()
    counted = distinct.groupBy(*keys).agg(F.count("*").alias("n_items"))
    return counted.select(
        *keys, "n_items",
        F.coalesce(F.try_divide(F.col("n_items"), total), F.lit(0.0)).alias("coverage"))


def novelty(recs: DataFrame, popularity: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of -log2(popularity) over all recommended rows with a positive popularity."""
    value = F.when(F.col("_pop") > 0, -F.log2("_pop"))
    joined = recs.select(*keys, "item_id").join(
        popularity.select("item_id", F.col("popularity_score").alias("_pop")), "item_id", "left")
    return joined.groupBy(*keys).agg(F.coalesce(F.avg(value), F.lit(0.0)).alias("novelty"))


def intra_list_similarity(recs: DataFrame, vectors: DataFrame, keys: Sequence[str] = ("list_id",),
                          k_items: int | None = None) -> DataFrame:
    """Mean cosine over all pairs of known items of a list; 0 with fewer than two.

    No pair is formed: with unit vectors u, the sum over pairs is (|sum u|^2 - sum |u|^2) / 2,
    so one partially aggregated vector sum per list is enough, however long the list is.
    """
    recs = recs if k_items is None else recs.where(F.col("rank") <= k_items)
    units = vectors.select("item_id", unit("embedding").alias("u"))
    known = recs.select(*keys, "item_id").join(units, "item_id")
    square = F.aggregate("s", F.lit(0.0), lambda acc, x: acc + x * x)
    sums = known.withColumn("own", F.aggregate("u", F.lit(0.0), lambda acc, x: acc + x * x)) \
        .groupBy(*keys).agg(F.count("*").alias("n"), F.sum("own").alias("own"),
                            vector_sum("u").alias("s"))
    scored = sums.select(*keys, "n", F.when(F.col("n") > 1, (square - F.col("own")) / (
        F.col("n") * (F.col("n") - 1))).otherwise(0.0).alias("similarity"))
    return recs.select(*keys).distinct().join(scored, list(keys), "left").select(
        *keys, F.coalesce("n", F.lit(0)).alias("n_known"),
        F.coalesce("similarity", F.lit(0.0)).alias("similarity"))


def diversity(recs: DataFrame, vectors: DataFrame, keys: Sequence[str] = ("list_id",),
              k_items: int | None = None) -> DataFrame:
    """Mean over lists with at least two known items of 1 - mean pairwise cosine."""
    per_list = intra_list_similarity(recs, vectors, keys, k_items).where("n_known >= 2")
    return per_list.agg(
        F.coalesce(F.avg(1 - F.col("similarity")), F.lit(0.0)).alias("diversity"))


def set_counts(recs: DataFrame, relevant: DataFrame, key: str) -> DataFrame:
    """Number of relevant and of recommended items per list."""
    n_rel = relevant.groupBy(key).agg(F.count("*").alias("n_relevant"))
    n_rec = recs.groupBy(key).agg(F.count("*").alias("n_recommended"))
    return n_rec.join(n_rel, key, "full").select(
        key, F.coalesce("n_relevant", F.lit(0)).alias("n_relevant"),
        F.coalesce("n_recommended", F.lit(0)).alias("n_recommended"))


def hold_out_likes(likes: DataFrame, one_in: int = 5, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(kept, held out): of the users with both, about one like in ``one_in`` is held out.

    The md5 hash of (seed, user, item) decides, so the split is the same on every run and engine. A
    repeated like counts once; likes without a user or an item are left out. Users of whom nothing, or
    everything, would be held out are in neither part.
    """
    digest = F.md5(F.concat_ws(":", F.lit(seed), "user_id", "item_id").cast("binary"))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    marked = likes.where("user_id is not null and item_id is not null").select("user_id", "item_id").distinct() \
        .withColumn("held", number % one_in == 0)
    both = marked.groupBy("user_id").agg(F.bool_or("held").alias("some"), F.bool_and("held").alias("all")) \
        .where("some and not all").select("user_id")
    split = cut(marked.join(both, "user_id", "left_semi"))
    return tuple(split.where(part).drop("held") for part in ("not held", "held"))


def mean_metrics(per_list: DataFrame) -> DataFrame:
    """Means over the lists of ``list_metrics`` per cut-off, with the number of lists."""
    return per_list.groupBy("k").agg(
        F.count("*").alias("n_lists"), *[F.avg(m).alias(m) for m in (
            "precision", "recall", "ndcg", "average_precision")], F.avg("hit").alias("hit_rate"))
