"""Catalog quality audit: coverage, signal quality, duplicates, external matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.operators.ordering import exact_medians


def _percent(condition: Column) -> Column:
    """Share of all rows, in percent; a null condition counts as not met."""
    return F.try_divide(F.count_if(condition) * F.lit(100.0), F.count(F.lit(1)))


def _blank(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) == "")


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column."""
    return df.groupBy(column).agg(F.count("*").alias("row_count"))


def with_tag_list(items: DataFrame, item_tags: DataFrame) -> DataFrame:
    """Items with the sorted array of their distinct tags, null for items without any."""
    lists = item_tags.groupBy("item_id").agg(F.sort_array(F.collect_set("tag_id")).alias("tags"))
    return items.join(lists, "item_id", "left")


def coverage_analysis(items: DataFrame) -> DataFrame:
    """One row of coverage figures; ``items.tags`` is an array that may be null."""
    tag_count = F.when(F.col("tags").isNotNull(), F.size("tags"))
    return items.agg(
        F.count("*").alias("total_items"),
        _percent(F.col("category_id").isNull()).alias("no_category"),
        _percent(_blank("cover_url")).alias("no_cover"),
        _percent(F.col("release_year").isNull()).alias("no_year"),
        _percent(F.col("tags").isNull()).alias("no_tags"),
        _percent(F.size("tags") == 0).alias("empty_tags"),
        F.avg(tag_count).alias("avg_tags_per_item"),
        _percent(F.col("title") == "").alias("no_title"))


def tags_per_item(items: DataFrame) -> DataFrame:
    """Tag count and tag text per item; a null list has no count."""
    return items.select(
        "item_id",
        F.when(F.col("tags").isNotNull(), F.size("tags")).alias("tag_count"),
        F.array_join("tags", ",").alias("tag_text"),
        F.col("tags").isNull().alias("no_list"))


def signal_quality(signals: DataFrame) -> DataFrame:
    """One row: confidence statistics and the share of rows that carry each signal."""
    score = F.col("data_confidence_score")
    median = exact_medians(signals, ["data_confidence_score"])["data_confidence_score"]
    return signals.agg(
        F.avg(score).alias("avg_confidence"),
        F.lit(median).cast("double").alias("median_confidence"),
        F.min(score).alias("min_confidence"),
        F.max(score).alias("max_confidence"),
        _percent(score >= 70).alias("pct_high_confidence"),
        _percent((score >= 40) & (score < 70)).alias("pct_medium_confidence"),
        _percent(score < 40).alias("pct_low_confidence"),
        _percent(F.col("best_critic_score").isNotNull()).alias("has_scores_pct"),
        _percent(F.col("has_sales")).alias("has_sales_pct"),
        _percent(F.col("has_review_sentiment")).alias("has_sentiment_pct"),
        _percent(F.col("has_external_id")).alias("has_external_id_pct"),
        _percent(F.col("has_company")).alias("has_company_pct"),
        _percent(F.col("has_summary")).alias("has_summary_pct"))


def duplicate_analysis(dup_groups: DataFrame, dup_candidates: DataFrame) -> DataFrame:
    """One row of duplicate totals."""
    candidates = dup_candidates.agg(F.count("*").alias("n")).scalar()
    return dup_groups.agg(
        F.count("*").alias("total_groups"),
        F.count_if(F.col("known_year_count") > 1).alias("groups_with_diff_years"),
        F.max("candidate_count").alias("max_candidates_per_group"),
    ).withColumn("total_candidates", candidates)


def external_match_analysis(matches: DataFrame) -> DataFrame:
    score, status = F.col("confidence_score"), F.col("status")
    return matches.agg(
        F.count("*").alias("total_matches"),
        F.avg(score).alias("avg_confidence"),
        F.count_if((score >= 70) & (status == "auto_approved")).alias("high_confidence_approved"),
        F.count_if(status == "needs_review").alias("needs_review"))


def presence_split(signals: DataFrame) -> DataFrame:
    """Rows with and without a critic score, and with and without sales."""
    scores = F.col("best_critic_score").isNotNull()
    sales = F.coalesce(F.col("has_sales"), F.lit(False))
    return signals.agg(
        F.count_if(scores).alias("with_scores"), F.count_if(~scores).alias("without_scores"),
        F.count_if(sales).alias("with_sales"), F.count_if(~sales).alias("without_sales"))


def coverage_buckets(items: DataFrame, signals: DataFrame) -> DataFrame:
    """Share of items or signals that are covered, per aspect, with a traffic-light colour."""
    def long(df: DataFrame, aspects: dict[str, Column]) -> DataFrame:
        row = df.agg(*[_percent(c).alias(a) for a, c in aspects.items()])
        return row.select(F.explode(F.array(*[
            F.struct(F.lit(a).alias("aspect"), F.col(a).alias("pct")) for a in aspects]))
            .alias("x")).select("x.*")

    pct = long(items, {
        "category": F.col("category_id").isNotNull(),
        "cover": ~_blank("cover_url"),
        "year": F.col("release_year").isNotNull(),
    }).unionAll(long(signals, {
        "scores": F.col("best_critic_score").isNotNull(),
        "sales": F.col("has_sales"),
        "sentiment": F.col("has_review_sentiment"),
    }))
    colour = F.when(F.col("pct") > 50, "green").when(F.col("pct") > 20, "amber").otherwise("red")
    return pct.withColumn("light", colour)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width histogram from minimum to maximum; the last bin is closed.

    Every bin is listed. A constant column gets a range of one around its value.
    """
    value = F.col(column).cast("double")
    edges = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).select(
        F.when(F.col("lo") == F.col("hi"),
               F.struct((F.col("lo") - 0.5).alias("lo"), (F.col("hi") + 0.5).alias("hi")))
        .otherwise(F.struct("lo", "hi")))
    counted = (df.where(value.isNotNull()).select(value.alias("v"), edges.scalar().alias("e"))
               .select(F.least(
                   F.floor((F.col("v") - F.col("e.lo")) * bins / (F.col("e.hi") - F.col("e.lo"))),
                   F.lit(bins - 1)).cast("int").alias("bin"))
               .groupBy("bin").agg(F.count("*").alias("item_count")))
    width = (F.col("e.hi") - F.col("e.lo")) / bins
    return (df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
            .join(counted, "bin", "left")
            .select("bin", edges.scalar().alias("e"), "item_count")
            .select("bin",
                    (F.col("e.lo") + F.col("bin") * width).alias("bin_start"),
                    (F.col("e.lo") + (F.col("bin") + 1) * width).alias("bin_end"),
                    F.coalesce("item_count", F.lit(0)).cast("bigint").alias("item_count")))


def popularity_confidence_bins(scored: DataFrame, bins: int = 20) -> DataFrame:
    """Two-dimensional counts: the data of a popularity against confidence scatter."""
    edges = scored.agg(F.struct(F.min("popularity_score").alias("lo"),
                                F.max("popularity_score").alias("hi")))
    placed = scored.select(
        "popularity_score", "data_confidence_score", edges.scalar().alias("e"))
    share = F.try_divide(F.col("popularity_score") - F.col("e.lo"), F.col("e.hi") - F.col("e.lo"))
    x = F.coalesce(F.least(F.floor(share * bins), F.lit(bins - 1)), F.lit(0)).cast("int")
    y = F.least(F.floor(F.col("data_confidence_score") * bins / F.lit(100.0)),
                F.lit(bins - 1)).cast("int")
    return placed.groupBy(x.alias("popularity_bin"), y.alias("confidence_bin")).agg(
        F.count("*").alias("item_count"))


# Confidence segments, upper bound excluded.
CONFIDENCE_SEGMENTS = (
    (0, 30, "low"),
    (30, 60, "medium"),
    (60, 80, "high"),
    (80, 100, "very high"),
)


def segment_coverage(scored: DataFrame, recommended: DataFrame) -> DataFrame:
    """Items per confidence segment and how many of them were recommended to anyone.

    A score outside all segments (exactly 100) is shown as ``unassigned``.
    """
    score = F.col("data_confidence_score")
    label = F.lit("unassigned")
    for lo, hi, name in CONFIDENCE_SEGMENTS:
        label = F.when((score >= lo) & (score < hi), name).otherwise(label)
    shown = recommended.select("item_id").distinct().withColumn("shown", F.lit(True))
    return scored.select("item_id", label.alias("segment")).join(shown, "item_id", "left") \
        .groupBy("segment").agg(
            F.count("*").alias("total"), F.count("shown").alias("in_top"),
            (F.count("shown") / F.count("*")).alias("proportion"))
