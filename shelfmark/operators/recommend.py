"""Batch recommendation: hybrid score for users, cold start, tag profiles.

``scored`` is the item table with title, popularity_score and data_confidence_score;
``vectors`` holds (item_id, embedding). Results share one schema: the list key, rank,
item_id, title, final_score, content_score, popularity_score, confidence_penalty and
data_confidence. Rows are ranked by the final score rounded to nine digits, ties by item id.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shelfmark.functions.vectors import cosine, mean_by
from shelfmark.operators.nearest import DIGITS, rank_within, weighted_topk
from shelfmark.operators.ordering import with_global_rank
from shelfmark.session import cut, cut_at, run_folder, scratch_scope

ROUND_LIKES = 1_000_000   # least likes whose vectors are shuffled at a time
Weights = tuple[float, float, float]
DEFAULT_WEIGHTS: Weights = (0.5, 0.4, 0.1)  # content, popularity, confidence penalty


def _penalty() -> Column:
    return (F.lit(100.0) - F.col("data_confidence_score")) / F.lit(100.0)


def _settings(settings: Sequence[Weights]) -> Column:
    """One row per weight setting; the list is a parameter of the call. No weight may be negative."""
    if any(weight < 0 for setting in settings for weight in setting):
        raise ValueError("weights must not be negative: the bounds of the search do not hold then")
    return F.explode(F.array(*[
        F.struct(F.lit(i).alias("setting"), F.lit(float(a)).alias("alpha"),
                 F.lit(float(b)).alias("beta"), F.lit(float(g)).alias("gamma"))
        for i, (a, b, g) in enumerate(settings)]))


def _scored_items(scored: DataFrame, vectors: DataFrame) -> DataFrame:
    return scored.select("item_id", F.col("popularity_score").alias("pop"),
                         _penalty().alias("pen")).join(
        vectors.select("item_id", "embedding"), "item_id")


def _present(ranked: DataFrame, scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The shared result schema, with title and confidence looked up."""
    return ranked.join(scored.select("item_id", "title", F.col("data_confidence_score").cast("int")
                                     .alias("data_confidence")), "item_id").select(
        *keys, "rank", "item_id", "title", "final_score", "content_score",
        "popularity_score", "confidence_penalty", "data_confidence")


def known_likes(likes: DataFrame, scored: DataFrame) -> DataFrame:
    """Likes of items that exist; other ids are ignored."""
    return likes.join(scored.select("item_id"), "item_id", "left_semi").select(
        "user_id", "item_id")


def user_profiles(likes: DataFrame, vectors: DataFrame) -> DataFrame:
    """Mean vector of each user's liked items, stored; an item liked twice weighs double.

    A like becomes a vector on its way to its user, many times as large. Users come in rounds by hash, so
    that no more than twice as many vectors as there are items, or ``ROUND_LIKES``, are on the way at a time.
    ``likes`` and ``vectors`` are read once a round, so they should be stored or cheap to make.
    """
    n_likes = likes.count()
    rounds = max(1, math.ceil(n_likes / max(ROUND_LIKES, 2 * vectors.count())))
    folder = run_folder(likes.sparkSession, "profiles")
    for number in range(rounds):
        own = likes if rounds == 1 else likes.where(F.pmod(F.xxhash64("user_id"), F.lit(rounds)) == number)
        profiles = cut_at(mean_by(own.join(vectors.select("item_id", "embedding"), "item_id"), "user_id",
                                  "embedding", n_likes // rounds), folder)
    return profiles


def liked_profile_scores(profiles: DataFrame, pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Content score of given (user_id, item_id) pairs against the users' profiles."""
    return (pairs.join(profiles, "user_id")
            .join(vectors.select("item_id", "embedding"), "item_id")
            .select("user_id", "item_id", cosine("vec", "embedding").alias("content_score")))


def similar_items(vectors: DataFrame, k: int = 20, queries: DataFrame | None = None,
                  group_size: int = 2048) -> DataFrame:
    """The k nearest items by cosine for every item (or for the ``item_id`` rows given).

    The item itself is left out by id. Exact: see ``weighted_topk``. ``vectors`` is read several times, so
    it should be stored or cheap to make.
    """
    wanted = vectors if queries is None else vectors.join(queries, "item_id", "left_semi")
    asked = wanted.select(
        F.col("item_id").alias("query_id"), F.col("embedding").alias("vec"),
        F.lit(1.0).alias("alpha"), F.lit(0.0).alias("beta"), F.lit(0.0).alias("gamma"))
    items = vectors.select("item_id", "embedding", F.lit(0.0).alias("pop"), F.lit(0.0).alias("pen"))
    itself = asked.select("query_id", F.col("query_id").alias("item_id"))
    return weighted_topk(asked, items, k, itself, group_size, stored=queries is None).select(
        F.col("query_id").alias("item_id"), "rank", F.col("item_id").alias("similar_id"),
        F.col("final_score").alias("similarity"))


def recommend_hybrid(likes: DataFrame, scored: DataFrame, vectors: DataFrame,
                     settings: Sequence[Weights] = (DEFAULT_WEIGHTS,), k: int = 20,
                     excluded: DataFrame | None = None, group_size: int = 2048) -> DataFrame:
    """Top-k per (setting, user) by alpha*content + beta*popularity - gamma*penalty.

    Liked and excluded items are left out. Users without a known like are not in the result:
    see ``recommend_cold_start``. Excluded pairs of other users are ignored.
    """
    spark = likes.sparkSession
    folder = run_folder(spark, "lists")
    with scratch_scope(spark):   # likes and profiles are not needed once the lists are found
        known = cut(known_likes(likes, scored))
        profiles = user_profiles(known, vectors)
        key = F.concat_ws(":", F.col("s.setting").cast("string"), F.col("user_id").cast("string"))
        # A user's settings leave out the same items: their owner is the id of the first.
        by = "query_id" if len(settings) == 1 else "owner"
        first = F.concat_ws(":", F.lit("0"), F.col("user_id").cast("string"))
        queries = profiles.select("user_id", "vec", _settings(settings).alias("s")).select(
            key.alias("query_id"), *([first.alias(by)] if by == "owner" else []), "vec", "s.alpha", "s.beta", "s.gamma")
        seen = known
        if excluded is not None:
            seen = seen.unionByName(excluded.select("user_id", "item_id")
                                    .join(known.select("user_id"), "user_id", "left_semi"))
        ranked = weighted_topk(queries, _scored_items(scored, vectors), k, seen.select(
            first.alias(by), "item_id"), group_size, stored=True, folder=folder)
    user_type = likes.schema["user_id"].dataType
    ranked = ranked.withColumns({
        "setting": F.split_part("query_id", F.lit(":"), F.lit(1)).cast("int"),
        "user_id": F.expr("substring(query_id, instr(query_id, ':') + 1)").cast(user_type),
        "confidence_penalty": F.col("penalty")})
    return _present(ranked, scored, ["setting", "user_id"])


def popularity_order() -> list[Column]:
    return [F.round("popularity_score", DIGITS).desc(), F.asc("item_id")]


def _top_by_popularity(scored: DataFrame, k: int) -> Column:
    """Array of the k most popular items, as a scalar subquery (k is a parameter)."""
    top = scored.select("item_id", "title", "popularity_score", "data_confidence_score").orderBy(
        *popularity_order()).limit(k)
    item = F.struct(
        -F.round("popularity_score", DIGITS), "item_id", "title", "popularity_score",
        F.col("data_confidence_score").cast("int").alias("data_confidence"))
    return top.agg(F.sort_array(F.collect_list(item))).scalar()


def _cold_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(
        *keys, F.col("rank").cast("int"), "item_id", "title",
        F.col("popularity_score").alias("final_score"), F.lit(0.0).alias("content_score"),
        "popularity_score", F.lit(0.0).alias("confidence_penalty"), "data_confidence")


def recommend_cold_start(users: DataFrame, scored: DataFrame, k: int = 20,
                         excluded: DataFrame | None = None) -> DataFrame:
    """Popularity order without the user's excluded items, top k.

    Users without exclusions share one list of k items. For the others the cut-off rank is
    derived per user from the global ranks of the excluded items, so a user is only joined
    with the items down to that rank, however many exclusions there are.
    """
    users = users.select("user_id")

    def shared_list(who: DataFrame) -> DataFrame:
        rows = who.select("user_id", F.posexplode(_top_by_popularity(scored, k)).alias("p", "x"))
        return _cold_rows(rows.select("user_id", (F.col("p") + 1).alias("rank"), "x.*"),
                          ["user_id"])

    if excluded is None:
        return shared_list(users)

    ranked = with_global_rank(
        scored.select("item_id", "title", "popularity_score",
                      F.col("data_confidence_score").cast("int").alias("data_confidence")),
        popularity_order())
    # An exclusion matters while fewer than k kept items rank above it, so its rank is below k plus
    # the exclusions of a user: those of lower items are dropped before anything is shuffled.
    pairs = cut(excluded.select("user_id", "item_id"))
    most = pairs.groupBy("user_id").count().agg(F.max("count")).first()[0] or 0
    copies = ranked.groupBy("item_id").count().agg(F.max("count")).first()[0] or 0
    head = cut(ranked.select("item_id", "global_rank").where(F.col("global_rank") < k + most * copies))
    banned = pairs.join(head, "item_id").distinct().join(users, "user_id", "left_semi")
    # Position of each exclusion among the user's exclusions, counted in two levels so that a
    # user with very many is split over ranges of 1,000 global ranks.
    banned = banned.withColumn("_bin", F.floor(F.col("global_rank") / 1000))
    earlier = W.partitionBy("user_id").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    before = banned.groupBy("user_id", "_bin").agg(F.count("*").alias("n")).select(
        "user_id", "_bin", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = W.partitionBy("user_id", "_bin").orderBy("global_rank")
    counted = banned.withColumn("nth", F.row_number().over(inside)).join(
        before, ["user_id", "_bin"]).withColumn("nth", F.col("nth") + F.col("before"))
    # An exclusion matters while fewer than k kept items rank above it.
    relevant = counted.where(F.col("global_rank") - F.col("nth") < k).select(
        "user_id", "global_rank", "nth")
    relevant = cut(relevant)
    reach = relevant.groupBy("user_id").agg((F.max("nth") + k).alias("reach"))
    slots = reach.select(
        "user_id", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("reach")))
        .alias("global_rank")).join(relevant, ["user_id", "global_rank"], "left_anti")
    # Every user needs the first ranks; the items down to the deepest cut-off are usually few
    # enough to broadcast, and the skew of the low ranks is split otherwise.
    deepest = reach.agg(F.max("reach")).scalar()
    mine = slots.join(ranked.where(F.col("global_rank") <= deepest), "global_rank").withColumn(
        "rank", F.row_number().over(W.partitionBy("user_id").orderBy("global_rank"))) \
        .where(F.col("rank") <= k)
    return shared_list(users.join(reach, "user_id", "left_anti")).unionByName(
        _cold_rows(mine, ["user_id"]))


def recommend_users(users: DataFrame, likes: DataFrame, scored: DataFrame, vectors: DataFrame,
                    weights: Weights = DEFAULT_WEIGHTS, k: int = 20,
                    excluded: DataFrame | None = None) -> DataFrame:
    """Hybrid lists for users with known likes, cold start for all other users."""
    warm = recommend_hybrid(likes, scored, vectors, (weights,), k, excluded).drop("setting")
    cold = users.select("user_id").join(
        known_likes(likes, scored).select("user_id"), "user_id", "left_anti")
    return warm.unionByName(recommend_cold_start(cold, scored, k, excluded))


def known_profile_tags(profiles: DataFrame, features: DataFrame) -> DataFrame:
    """(profile, kind, feature) rows for the profile tags that exist in the catalog.

    A name that is both a tag and a platform means the tag. Both steps are stored: they have at
    most one row per profile tag, and the file sizes let Spark broadcast them to the scans of
    the features instead of shuffling those by a possibly hot tag.
    """
    wanted = cut(profiles.select("profile", F.col("tag_id").alias("feature")).distinct())
    known = features.join(wanted.select("feature"), "feature", "left_semi").groupBy(
        "feature").agg(F.max("kind").alias("kind"))  # 'tag' sorts after 'platform'
    return cut(wanted.join(known, "feature").select("profile", "kind", "feature"))


def profile_matches(known: DataFrame, features: DataFrame) -> DataFrame:
    """Items that have at least one known tag of a profile, with the number of them."""
    return features.join(known, ["kind", "feature"]).groupBy("profile", "item_id").agg(
        F.count("*").alias("matched"))


def profile_relevant(profiles: DataFrame, features: DataFrame) -> DataFrame:
    """Relevant set of a profile: every item with any of its tags."""
    return profile_matches(known_profile_tags(profiles, features), features).select(
        "profile", "item_id")


def recommend_profile(profiles: DataFrame, features: DataFrame, scored: DataFrame,
                      settings: Sequence[Weights] = (DEFAULT_WEIGHTS,),
                      k: int = 20) -> DataFrame:
    """Top-k per (setting, profile); content is the matched share of the profile's known tags.

    Items that match nothing score the same for every profile, so only the k best of them
    can enter a list: each list is ranked from its matches and those k items, and the catalog
    is never paired with the profiles. A profile without any known tag gets the popularity
    order. Weights must not be negative.
    """
    known = known_profile_tags(profiles, features)
    present = known.groupBy("profile").agg(F.count("*").alias("present"))
    base = scored.select("item_id", "popularity_score", _penalty().alias("pen"))

    def weighted(df: DataFrame, content: Column) -> DataFrame:
        s = F.col("s")
        penalty = F.col("pen") * s.gamma
        return df.withColumn("s", _settings(settings)).select(
            s.setting.alias("setting"), *[c for c in ("profile",) if c in df.columns], "item_id",
            (s.alpha * content + s.beta * F.col("popularity_score") - penalty)
            .alias("final_score"),
            content.alias("content_score"), "popularity_score",
            penalty.alias("confidence_penalty"))

    matches = cut(profile_matches(known, features))  # ranked, and left out of the rest
    matched = weighted(matches.join(present, "profile").join(base, "item_id"),
                       F.col("matched") / F.col("present"))
    # The k best items by the score without content, per setting: k x settings rows.
    best = rank_within(weighted(base, F.lit(0.0)), ["setting"], k).drop("rank")
    shared = best.agg(F.collect_list(F.struct(*best.columns))).scalar()
    unmatched = present.select("profile", F.explode(shared).alias("x")).select(
        "profile", "x.*").join(matches, ["profile", "item_id"], "left_anti")
    ranked = rank_within(matched.unionByName(unmatched), ["setting", "profile"], k)

    unknown = profiles.select("profile").distinct().join(known, "profile", "left_anti")
    n = F.array(*[F.lit(i) for i in range(len(settings))])
    cold = unknown.select("profile", F.explode(n).alias("setting")).select(
        "setting", "profile", F.posexplode(_top_by_popularity(scored, k)).alias("p", "x"))
    cold = _cold_rows(cold.select("setting", "profile", (F.col("p") + 1).alias("rank"), "x.*"),
                      ["setting", "profile"])
    return _present(ranked, scored, ["setting", "profile"]).unionByName(cold)


def search_title(scored: DataFrame, text: str, n: int = 10) -> DataFrame:
    """Items whose title contains the text, ignoring case, most popular first."""
    return scored.where(F.contains(F.lower("title"), F.lit(text.lower()))).orderBy(
        *popularity_order()).limit(n).select(
        "item_id", "title", "popularity_score", "data_confidence_score")


def title_lookup(items: DataFrame) -> DataFrame:
    """One id per title: the smallest."""
    return items.groupBy("title").agg(F.min("item_id").alias("item_id"))


def score_progress(recs: DataFrame, key: str = "user_id") -> DataFrame:
    """Score as a share of the best score of the list, at most 1."""
    top = F.max("final_score").over(W.partitionBy(key))
    return recs.select(key, "rank", "item_id", F.least(
        F.try_divide(F.col("final_score"), top), F.lit(1.0)).alias("progress"))
