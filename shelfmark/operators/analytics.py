"""Analytic queries over the catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def _known_year(items: DataFrame) -> DataFrame:
    return items.where("release_year is not null and release_year > 0")


def items_by_year(items: DataFrame) -> DataFrame:
    return _known_year(items).groupBy("release_year").agg(
        F.count("*").alias("item_count")).orderBy("release_year")


def top_platforms(item_platforms: DataFrame, platforms: DataFrame, n: int = 10) -> DataFrame:
    # Counting per id first leaves one row per platform for the join with the names.
    per_id = item_platforms.groupBy("platform_id").agg(F.count("*").alias("items"))
    return (per_id.join(platforms, "platform_id").groupBy("name")
            .agg(F.sum("items").alias("item_count"))
            .orderBy(F.desc("item_count"), "name").limit(n))


def avg_confidence_by_category(signals: DataFrame, items: DataFrame,
                               categories: DataFrame) -> DataFrame:
    """Mean confidence per category name; an unknown category id is the null group."""
    per_id = (signals.select("item_id", "data_confidence_score")
              .join(items.where("category_id is not null").select("item_id", "category_id"),
                    "item_id")
              .groupBy("category_id")
              .agg(F.sum("data_confidence_score").alias("total"),
                   F.count("data_confidence_score").alias("known"),
                   F.count("*").alias("items")))
    named = per_id.join(categories, "category_id", "left").groupBy(
        F.col("name").alias("category")).agg(
        F.try_divide(F.sum("total"), F.sum("known")).alias("avg_confidence"),
        F.sum("items").alias("item_count"))
    return named.orderBy(F.desc_nulls_last("avg_confidence"), F.asc_nulls_first("category"))


def ranked_items_by_platform(items: DataFrame, item_platforms: DataFrame, platforms: DataFrame,
                             signals: DataFrame, n: int = 50) -> DataFrame:
    """Items ranked by critic score inside each platform; the first n rows by platform name.

    Only ranks up to n can be among the first n rows, so the rank limit goes in before the
    shuffle by platform: a platform that holds most rows sends n rows per task, not all.
    """
    scored = signals.where("best_critic_score is not null").select("item_id", "best_critic_score")
    rows = (item_platforms.join(items.select("item_id", "title"), "item_id")
            .join(scored, "item_id"))
    order = W.partitionBy("platform_id").orderBy(F.desc("best_critic_score"), F.asc("item_id"))
    ranked = rows.withColumn("rank_in_platform", F.row_number().over(order)).where(
        F.col("rank_in_platform") <= n)
    return (ranked.join(platforms.withColumnRenamed("name", "platform"), "platform_id")
            .orderBy("platform", "rank_in_platform", "platform_id").limit(n)
            .select("item_id", "title", "platform", "best_critic_score", "rank_in_platform"))


def coverage_pivot(items: DataFrame) -> DataFrame:
    """One row of catalog totals; the distinct count runs as its own two-step aggregate."""
    def with_(condition):
        return F.count_if(condition)

    totals = items.groupBy("item_id").agg(
        F.count("*").alias("n"),
        with_(F.col("category_id").isNotNull()).alias("category"),
        with_(F.col("cover_url") != "").alias("cover"),
        with_(F.col("release_year").isNotNull() & (F.col("release_year") > 0)).alias("year"))
    return totals.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_items"),
        F.sum("category").alias("with_category"), F.sum("cover").alias("with_cover"),
        F.sum("year").alias("with_year"), F.count("item_id").alias("unique_items"))


def duplicate_summary(dup_groups: DataFrame) -> DataFrame:
    return dup_groups.groupBy("status", "suggested_review").agg(
        F.count("*").alias("group_count"), F.sum("candidate_count").alias("total_candidates")
    ).orderBy(F.desc("group_count"), "status", "suggested_review")


def tag_rolling_rows(item_tags: DataFrame, items: DataFrame, n: int = 100) -> DataFrame:
    """Rows among the last six of the tag up to each item in year order; first n by year.

    The output order (year, tag, item) agrees with the window's order inside a tag, so every
    predecessor of an output row is an output row too. Taking the first n rows before the
    window therefore gives the same values and leaves only n rows to the window.
    """
    dated = item_tags.join(_known_year(items).select("item_id", "release_year"), "item_id")
    first = dated.orderBy("release_year", "tag_id", "item_id").limit(n)
    frame = W.partitionBy("tag_id").orderBy("release_year", "item_id").rowsBetween(-5, 0)
    return first.select("release_year", "tag_id", "item_id",
                        F.count("*").over(frame).alias("rolling_row_count"))


def tag_rolling_years(item_tags: DataFrame, items: DataFrame, years: int = 5) -> DataFrame:
    """Items per tag in the last ``years`` calendar years, for each (tag, year) present.

    Counts per (tag, year) come first, so the window holds at most one row per year and tag.
    """
    yearly = item_tags.join(_known_year(items).select("item_id", "release_year"), "item_id") \
        .groupBy("tag_id", "release_year").agg(F.count("*").alias("n"))
    frame = W.partitionBy("tag_id").orderBy("release_year").rangeBetween(-(years - 1), 0)
    return yearly.select("tag_id", "release_year",
                         F.sum("n").over(frame).alias("rolling_count"))


def approx_tag_diversity(item_tags: DataFrame, rsd: float = 0.05) -> DataFrame:
    """Exact and approximate distinct items per tag, over deduplicated pairs."""
    pairs = item_tags.select("tag_id", "item_id").distinct()
    return pairs.groupBy("tag_id").agg(
        F.count("*").alias("exact_item_count"),
        F.approx_count_distinct("item_id", rsd).alias("approx_item_count"),
    ).orderBy(F.desc("exact_item_count"), "tag_id")


def tag_sketches(item_tags: DataFrame, lg_k: int = 12) -> DataFrame:
    """(tag_id, sketch): a mergeable sketch of the distinct items of every tag.

    One row per tag, of at most about 2^lg_k bytes, aggregated per task before the shuffle. Kept beside a
    snapshot, it spares a later count over several snapshots the reading of their rows.
    """
    return item_tags.where(F.col("item_id").isNotNull()).groupBy("tag_id").agg(
        F.hll_sketch_agg("item_id", lg_k).alias("sketch"))


def merged_tag_diversity(sketches: DataFrame) -> DataFrame:
    """Distinct items per tag over all parts, from their sketches alone; an item in two parts counts once."""
    return sketches.groupBy("tag_id").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch", True)).alias("approx_item_count"),
        F.count("*").alias("n_parts"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, one row each."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionAll(one)
    return out
