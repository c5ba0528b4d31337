"""Explicit schemas of the input and diagnostics tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _B = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType())


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([
        T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


TABLES: dict[str, T.StructType] = {
    "items": _schema(
        ("item_id", _L), ("title", _S), ("release_year", _I), ("category_id", _S),
        ("cover_url", _S), ("source_type", _S), ("release_state", _S)),
    "item_tags": _schema(("item_id", _L), ("tag_id", _S)),
    "tags": _schema(("tag_id", _S)),
    "item_platforms": _schema(("item_id", _L), ("platform_id", _S)),
    "platforms": _schema(("platform_id", _S), ("name", _S)),
    "categories": _schema(("category_id", _S), ("name", _S)),
    "signals": _schema(
        ("item_id", _L), ("best_critic_score", _D), ("best_user_score", _D),
        ("critic_review_count", _L), ("user_review_count", _L),
        ("critic_positive_ratio", _D), ("user_positive_ratio", _D),
        ("max_sales_millions", _D), ("total_sales_millions", _D),
        ("data_confidence_score", _I), ("has_external_id", _B), ("has_company", _B),
        ("has_age_rating", _B), ("has_summary", _B), ("has_sales", _B),
        ("has_review_sentiment", _B)),
    "dup_groups": _schema(
        ("group_key", _S), ("suggested_review", _S), ("status", _S),
        ("candidate_count", _L), ("known_year_count", _L)),
    "dup_candidates": _schema(("group_key", _S), ("item_id", _L)),
    "external_matches": _schema(
        ("match_id", _L), ("item_id", _L), ("source", _S), ("source_title", _S),
        ("confidence_score", _I), ("status", _S), ("matched_by", _S)),
    "user_likes": _schema(("user_id", _L), ("item_id", _L)),
}

# The diagnostics tables. Fields that are not nullable get the listed default on write.
DIAGNOSTICS: dict[str, T.StructType] = {
    "quality_gaps": _schema(
        ("item_id", _L, False), ("title", _S, False),
        ("missing_issues", T.ArrayType(_S), False),
        ("data_confidence_score", _I, False), ("popularity_score", T.FloatType(), False)),
    "duplicate_groups": _schema(
        ("group_key", _S, False), ("suggested_review", _S, False), ("status", _S, False),
        ("candidate_count", _L, False)),
    "external_matches": _schema(
        ("item_id", _L, False), ("source", _S, False), ("source_title", _S, False),
        ("confidence_score", _I, False), ("matched_by", _S, False)),
    "low_confidence_priorities": _schema(
        ("item_id", _L, False), ("title", _S, False),
        ("data_confidence_score", _I, False), ("popularity_score", T.FloatType(), False)),
    "key_metrics": _schema(
        ("metric", _S, False), ("value", T.FloatType(), False), ("description", _S, False)),
}

DIAGNOSTIC_KEYS = {
    "quality_gaps": "item_id",
    "duplicate_groups": "group_key",
    "low_confidence_priorities": "item_id",
    "key_metrics": "metric",
}

DIAGNOSTIC_DEFAULTS = {
    "quality_gaps": {"title": "", "data_confidence_score": 0, "popularity_score": 0.0},
    "duplicate_groups": {
        "suggested_review": "needs_review", "status": "needs_review", "candidate_count": 0},
    "external_matches": {
        "source": "", "source_title": "", "confidence_score": 0, "matched_by": ""},
    "low_confidence_priorities": {
        "title": "", "data_confidence_score": 0, "popularity_score": 0.0},
    "key_metrics": {"description": ""},
}
