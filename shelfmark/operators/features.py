"""Item features: signals with imputation, binary features, and the two composite scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.operators.ordering import exact_medians

MEDIAN_FILLED = ("best_critic_score", "best_user_score")

# The constant that replaces a missing signal.
CONSTANT_FILLS = {
    "critic_review_count": 0,
    "user_review_count": 0,
    "critic_positive_ratio": 0.5,
    "user_positive_ratio": 0.5,
    "max_sales_millions": 0.0,
    "total_sales_millions": 0.0,
    "data_confidence_score": 50,
    "has_external_id": False,
    "has_company": False,
    "has_age_rating": False,
    "has_summary": False,
    "has_sales": False,
    "has_review_sentiment": False,
}

# Weights of the popularity score (confidence is on a 0-100 scale).
POPULARITY_WEIGHTS = {
    "best_critic_score": 0.25,
    "best_user_score": 0.20,
    "log_sales": 0.15,
    "critic_positive_ratio": 0.15,
    "user_positive_ratio": 0.10,
    "data_confidence_score": 0.15,
}

# Weights of the richness score.
RICHNESS_WEIGHTS = {
    "has_external_id": 0.20,
    "has_company": 0.15,
    "has_age_rating": 0.15,
    "has_summary": 0.15,
    "has_sales": 0.15,
    "has_review_sentiment": 0.20,
}

ITEM_COLUMNS = ("item_id", "title", "release_year", "category_id")
SIGNAL_COLUMNS = MEDIAN_FILLED + tuple(CONSTANT_FILLS)


def join_signals(items: DataFrame, signals: DataFrame) -> DataFrame:
    """Every item with its signal row, nulls where it has none."""
    return items.select(*ITEM_COLUMNS).join(
        signals.select("item_id", *SIGNAL_COLUMNS), "item_id", "left")


def impute(joined: DataFrame, medians: Mapping[str, float | None]) -> DataFrame:
    """Fill missing signals with medians or constants and add the derived columns."""
    fills = {c: F.coalesce(F.col(c), F.lit(medians[c]).cast("double")) for c in MEDIAN_FILLED}
    for name, value in CONSTANT_FILLS.items():
        fills[name] = F.coalesce(F.col(name), F.lit(value).cast(joined.schema[name].dataType))
    fills["release_year"] = F.coalesce(F.col("release_year"), F.lit(0)).cast("int")
    return joined.withColumns(fills).withColumns({
        "log_sales": F.log10(F.col("total_sales_millions") + F.lit(0.001)),
        "total_review_count": F.col("critic_review_count") + F.col("user_review_count"),
    })


def numeric_features(items: DataFrame, signals: DataFrame) -> DataFrame:
    """Imputed signals, one row per item. Medians are those of the joined catalog.

    Runs the two median jobs of ``exact_medians``. They read the two score columns only.
    """
    joined = join_signals(items, signals)
    return impute(joined, exact_medians(joined, MEDIAN_FILLED))


def popularity() -> Column:
    parts = {
        "best_critic_score": F.coalesce("best_critic_score", F.lit(0.0)),
        "best_user_score": F.coalesce("best_user_score", F.lit(0.0)),
        "log_sales": F.coalesce("log_sales", F.lit(0.0)),
        "critic_positive_ratio": F.coalesce("critic_positive_ratio", F.lit(0.5)),
        "user_positive_ratio": F.coalesce("user_positive_ratio", F.lit(0.5)),
        "data_confidence_score": F.col("data_confidence_score") / F.lit(100.0),
    }
    terms = [parts[name] * F.lit(weight) for name, weight in POPULARITY_WEIGHTS.items()]
    return sum(terms[1:], terms[0])


def richness() -> Column:
    terms = [F.col(name).cast("int") * F.lit(weight)
             for name, weight in RICHNESS_WEIGHTS.items()]
    return sum(terms[1:], terms[0])


def with_scores(features: DataFrame) -> DataFrame:
    """Add ``popularity_score`` and ``richness_score``."""
    return features.withColumns(
        {"popularity_score": popularity(), "richness_score": richness()})


def scored_features(items: DataFrame, signals: DataFrame) -> DataFrame:
    return with_scores(numeric_features(items, signals))


def valid_item_tags(item_tags: DataFrame, tags: DataFrame) -> DataFrame:
    """Tag rows whose tag is in the tag catalog."""
    return item_tags.join(tags, "tag_id", "left_semi").select("item_id", "tag_id")


def binary_features(item_tags: DataFrame, tags: DataFrame,
                    item_platforms: DataFrame) -> DataFrame:
    """Long form of the one-hot matrix: one row per (item_id, kind, feature) that is 1."""
    tag_rows = valid_item_tags(item_tags, tags).select(
        "item_id", F.lit("tag").alias("kind"), F.col("tag_id").alias("feature"))
    platform_rows = item_platforms.select(
        "item_id", F.lit("platform").alias("kind"), F.col("platform_id").alias("feature"))
    return tag_rows.unionAll(platform_rows).distinct()


def vocabulary(features: DataFrame, kind: str, limit: int = 10_000) -> list[str]:
    """Sorted distinct features of one kind; the wide matrix has a column for each."""
    names = [r["feature"] for r in features.where(F.col("kind") == kind)
             .select("feature").distinct().limit(limit + 1).collect()]
    if len(names) > limit:
        raise ValueError(f"more than {limit} {kind} features; keep the long form")
    return sorted(names)


def one_hot(features: DataFrame, kind: str, names: Sequence[str] | None = None) -> DataFrame:
    """Wide 0/1 columns of one kind, one row per item that has any.

    The column list is passed to the pivot, so no extra distinct job runs inside it.
    """
    names = vocabulary(features, kind) if names is None else list(names)
    wide = features.where(F.col("kind") == kind).groupBy("item_id").pivot("feature", names).agg(
        F.max(F.lit(1)))
    return wide.na.fill(0, subset=names)


def wide_matrix(items: DataFrame, numeric: DataFrame, features: DataFrame) -> DataFrame:
    """Items with all one-hot columns, then all numeric columns.

    A platform named like a tag keeps its own column, with the suffix ``_right``.
    """
    tag_names, platform_names = vocabulary(features, "tag"), vocabulary(features, "platform")
    tags_wide = one_hot(features, "tag", tag_names)
    platforms_wide = one_hot(features, "platform", platform_names)
    taken = set(tag_names)
    renamed = {p: f"{p}_right" for p in platform_names if p in taken}
    if renamed:
        platforms_wide = platforms_wide.withColumnsRenamed(renamed)
    binary = tag_names + [renamed.get(p, p) for p in platform_names]
    return (items.select("item_id")
            .join(tags_wide, "item_id", "left")
            .join(platforms_wide, "item_id", "left")
            .na.fill(0, subset=binary)
            .join(numeric, "item_id"))


def top_features(features: DataFrame, kind: str = "tag", n: int = 20) -> DataFrame:
    """The most frequent features of a kind (column sums of the one-hot matrix)."""
    return (features.where(F.col("kind") == kind).groupBy("feature")
            .agg(F.count("*").alias("item_count"))
            .orderBy(F.desc("item_count"), F.asc("feature")).limit(n))


def features_with_prefix(features: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Features whose name starts with one of the prefixes, with their item count."""
    tests = [F.col("feature").startswith(p) for p in prefixes]
    match = tests[0]
    for test in tests[1:]:
        match = match | test
    return features.where(match).groupBy("kind", "feature").agg(F.count("*").alias("item_count"))


def feature_kind_counts(features: DataFrame) -> DataFrame:
    """Number of binary features per kind, plus the number of numeric features."""
    numeric = len(SIGNAL_COLUMNS) + 4  # release_year, log_sales, total_review_count, scores
    return features.select("kind", "feature").distinct().groupBy("kind").agg(
        F.count("*").alias("feature_count")).unionAll(
        features.sparkSession.range(1).select(
            F.lit("numeric").alias("kind"), F.lit(numeric).cast("bigint")))
