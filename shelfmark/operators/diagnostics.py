"""Diagnostics tables and the comparison of two snapshots of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Names of the quality issues.
ISSUES = ("no_category", "no_cover", "no_year", "no_tags", "no_platforms")


def quality_gaps(items: DataFrame, item_tags: DataFrame, item_platforms: DataFrame,
                 scored: DataFrame) -> DataFrame:
    """Items with at least one issue, the list of their issues, confidence and popularity."""
    def has_row(bridge: DataFrame, flag: str) -> DataFrame:
        return bridge.select("item_id").distinct().withColumn(flag, F.lit(True))

    def blank(name: str):
        return F.col(name).isNull() | (F.col(name) == "")

    joined = (items.select("item_id", "title", "release_year", "category_id", "cover_url")
              .join(has_row(item_tags, "tagged"), "item_id", "left")
              .join(has_row(item_platforms, "placed"), "item_id", "left")
              .join(scored.select("item_id", "data_confidence_score", "popularity_score"),
                    "item_id", "left"))
    tests = {
        "no_category": blank("category_id"),
        "no_cover": blank("cover_url"),
        "no_year": F.col("release_year").isNull(),
        "no_tags": F.col("tagged").isNull(),
        "no_platforms": F.col("placed").isNull(),
    }
    issues = F.array_compact(F.array(*[F.when(tests[name], name) for name in ISSUES]))
    return joined.withColumn("missing_issues", issues).where(F.size("missing_issues") > 0).select(
        "item_id", "title", "missing_issues",
        F.coalesce("data_confidence_score", F.lit(0)).alias("data_confidence_score"),
        F.coalesce("popularity_score", F.lit(0.0)).alias("popularity_score"))


def duplicate_groups(dup_groups: DataFrame) -> DataFrame:
    return dup_groups.select(
        "group_key", "suggested_review", "status", "candidate_count").orderBy(
        F.desc("candidate_count"), "group_key")


def external_matches(matches: DataFrame, min_score: int = 70, n: int = 5000) -> DataFrame:
    """The n most confident matches at or above ``min_score``; ties by match id."""
    return matches.where(F.col("confidence_score") >= min_score).orderBy(
        F.desc("confidence_score"), F.asc("match_id")).limit(n).select(
        "item_id", "source", "source_title", "confidence_score", "matched_by")


def low_confidence_priorities(scored: DataFrame, below: int = 30) -> DataFrame:
    return scored.where(F.col("data_confidence_score") < below).select(
        "item_id", "title", F.col("data_confidence_score").cast("int").alias(
            "data_confidence_score"), "popularity_score")


def key_metrics(grid: DataFrame, scored: DataFrame, dimensions: int) -> DataFrame:
    """Best weights and their quality, catalog size and embedding size, as records.

    ``grid`` is the grid-search result, best row first by NDCG@5.
    """
    best = grid.orderBy(F.round("ndcg_at_5", 9).desc(), "setting").limit(1)
    total = scored.agg(F.count("*").cast("double").alias("n")).scalar()
    cells = [
        ("alpha_best", F.col("alpha"), "alpha of the row with the highest NDCG@5"),
        ("beta_best", F.col("beta"), "beta of the row with the highest NDCG@5"),
        ("gamma_best", F.col("gamma"), "gamma of the row with the highest NDCG@5"),
        ("ndcg_at_5_best", F.col("ndcg_at_5"), "highest NDCG@5 among all settings tried"),
        ("precision_at_5_best", F.col("precision_at_5"), "Precision@5 in the row with the highest NDCG@5"),
        ("total_items_in_catalog", F.col("total"), "number of scored item rows"),
        ("feature_dimensions", F.lit(float(dimensions)), "number of columns that the embedding was fitted to"),
    ]
    return best.withColumn("total", total).select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"),
                 F.lit(text).alias("description")) for name, value, text in cells]))
        .alias("x")).select("x.*")


def issue_counts(gaps: DataFrame, column: str = "missing_issues") -> DataFrame:
    """Items per issue; the column is an array or its comma-separated text."""
    if gaps.schema[column].dataType.typeName() == "string":
        gaps = gaps.withColumn(column, F.split(column, ","))
    return gaps.select(F.explode(column).alias("issue")).groupBy("issue").agg(
        F.count("*").alias("n"))


def snapshot_diff(prev_gaps: DataFrame | None, curr_gaps: DataFrame | None,
                  prev_low: DataFrame | None = None,
                  curr_low: DataFrame | None = None) -> DataFrame:
    """Counts per issue and of low-confidence items in two snapshots.

    ``improvement`` is before minus after, positive when an issue became rarer. A table that
    is missing (None) in either snapshot is skipped.
    """
    out = None
    if prev_gaps is not None and curr_gaps is not None:
        both = issue_counts(prev_gaps).select("issue", F.col("n").alias("b"), F.lit(0).alias("a")) \
            .unionAll(issue_counts(curr_gaps).select("issue", F.lit(0), "n"))
        counts = both.groupBy("issue").agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
        names = prev_gaps.sparkSession.createDataFrame([(i,) for i in ISSUES], "issue string")
        out = names.join(counts, "issue", "left").select(
            F.col("issue").alias("measure"), F.coalesce("b", F.lit(0)).alias("before"),
            F.coalesce("a", F.lit(0)).alias("after"))
    if prev_low is not None and curr_low is not None:
        rows = prev_low.select(F.lit(1).alias("b"), F.lit(0).alias("a")).unionAll(
            curr_low.select(F.lit(0), F.lit(1)))
        low = rows.agg(F.coalesce(F.sum("b"), F.lit(0)).alias("before"),
                       F.coalesce(F.sum("a"), F.lit(0)).alias("after")).select(
            F.lit("low_confidence_priorities").alias("measure"), "before", "after")
        out = low if out is None else out.unionByName(low)
    if out is None:
        raise ValueError("the snapshots have no table in common")
    return out.select("measure", F.col("before").cast("bigint").alias("before"),
                      F.col("after").cast("bigint").alias("after"),
                      (F.col("before") - F.col("after")).cast("bigint").alias("improvement"))
