"""Quality audit, features, sources and diagnostics on hand-made tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.operators import (
    analytics as an, diagnostics as dg, explain as xp, features as ft, quality as ql)
from shelfmark.operators.ordering import exact_medians, with_global_rank
from shelfmark.sources import export as xs, snapshots as sn
from shelfmark.sources.catalog import load_catalog


@pytest.mark.parametrize("accuracy", [100_000, 200])
@pytest.mark.parametrize("n", [1, 2, 5, 1000, 3001])
def test_medians_are_exact(spark, n, accuracy):
    random.seed(n)
    a = [random.choice([0.5, random.random()]) for _ in range(n)]  # a hot value
    b = [random.randint(0, 100) for _ in range(n)]
    df = spark.createDataFrame(list(zip(a, b)) + [(None, None)], "a double, b int").repartition(3)
    got = exact_medians(df, ["a", "b"], accuracy)
    assert got["a"] == pytest.approx(np.median(a)) and got["b"] == np.median(b)


def test_median_of_nothing(spark):
    assert exact_medians(spark.createDataFrame([(None,)], "a double"), ["a"]) == {"a": None}


def test_global_rank(spark):
    df = spark.range(500).withColumn("v", F.col("id") % 7)
    rows = with_global_rank(df, [F.desc("v"), F.asc("id")]).orderBy("global_rank").collect()
    assert [r["global_rank"] for r in rows] == list(range(1, 501))
    assert [r["id"] for r in rows] == [i for _, i in sorted((-(i % 7), i) for i in range(500))]


def test_null_and_empty_tag_lists(spark):
    items = spark.createDataFrame(
        [(1, "t", 2000, "c", "u", ["a", "b"]), (2, "", None, None, "", []),
         (3, "t", 0, "", None, None), (4, None, 1, "c", "u", ["a"])],
        "item_id int, title string, release_year int, category_id string, cover_url string, "
        "tags array<string>")
    row = ql.coverage_analysis(items).first()
    assert (row["no_tags"], row["empty_tags"], row["no_title"]) == (25, 25, 25)
    assert row["avg_tags_per_item"] == 1.0
    assert (row["no_category"], row["no_cover"], row["no_year"]) == (25, 50, 25)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (2.0,), (None,)], "x double")
    rows = ql.histogram(df, "x", 4).orderBy("bin").collect()
    assert [r["item_count"] for r in rows] == [1, 1, 1, 1]
    flat = ql.histogram(df.where("x = 1.0"), "x", 2).orderBy("bin").collect()
    assert [(r["bin_start"], r["bin_end"], r["item_count"]) for r in flat] == [
        (0.5, 1.0, 0), (1.0, 1.5, 1)]


def test_segment_of_full_confidence(spark):
    scored = spark.createDataFrame([(1, 100), (2, 29), (3, 30), (4, 99)],
                                   "item_id int, data_confidence_score int")
    recs = spark.createDataFrame([(1,), (1,), (4,)], "item_id int")
    rows = {r["segment"]: (r["total"], r["in_top"]) for r in ql.segment_coverage(scored, recs).collect()}
    assert rows == {"unassigned": (1, 1), "low": (1, 0), "medium": (1, 0), "very high": (1, 1)}


def test_rolling_rows_equal_full_window(spark):
    random.seed(2)
    items = spark.createDataFrame([(i, random.choice([None, 0, 1990, 1991, 1995])) for i in range(90)],
                                  "item_id int, release_year int")
    tags = spark.createDataFrame([(i, t) for i in range(90) for t in "ab" if random.random() < .7],
                                 "item_id int, tag_id string")
    full = {(r["tag_id"], r["item_id"]): r["rolling_row_count"]
            for r in an.tag_rolling_rows(tags, items, 10_000).collect()}
    part = an.tag_rolling_rows(tags, items, 25).collect()
    assert len(part) == 25
    for r in part:
        assert full[r["tag_id"], r["item_id"]] == r["rolling_row_count"]
        assert 1 <= r["rolling_row_count"] <= 6


def test_tag_named_like_a_platform(spark):
    items = spark.createDataFrame([(1, "a", 2000, "c"), (2, "b", None, None)],
                                  "item_id int, title string, release_year int, category_id string")
    features = ft.binary_features(
        spark.createDataFrame([(1, "arcade"), (1, "arcade"), (2, "gone")], "item_id int, tag_id string"),
        spark.createDataFrame([("arcade",)], "tag_id string"),
        spark.createDataFrame([(2, "arcade")], "item_id int, platform_id string"))
    assert features.count() == 2
    wide = ft.wide_matrix(items, items, features).orderBy("item_id").collect()
    assert [(r["arcade"], r["arcade_right"]) for r in wide] == [(1, 0), (0, 1)]


def test_items_without_signals_are_imputed(spark):
    items = spark.createDataFrame([(i, f"t{i}", None, None) for i in range(4)],
                                  "item_id bigint, title string, release_year int, category_id string")
    signals = spark.createDataFrame(
        [(0, 0.2, 0.4, 3, 4, 0.9, 0.8, 1.0, 2.0, 80, True, True, True, True, True, True),
         (1, 0.6, None, None, 1, None, None, None, None, None, None, None, None, None, None, None)],
        "item_id bigint, best_critic_score double, best_user_score double, critic_review_count bigint, "
        "user_review_count bigint, critic_positive_ratio double, user_positive_ratio double, "
        "max_sales_millions double, total_sales_millions double, data_confidence_score int, "
        "has_external_id boolean, has_company boolean, has_age_rating boolean, has_summary boolean, "
        "has_sales boolean, has_review_sentiment boolean")
    rows = {r["item_id"]: r for r in ft.scored_features(items, signals).collect()}
    assert rows[3]["best_critic_score"] == pytest.approx(0.4)
    assert rows[3]["best_user_score"] == pytest.approx(0.4)
    assert rows[3]["data_confidence_score"] == 50 and rows[3]["log_sales"] == pytest.approx(-3)
    assert rows[0]["richness_score"] == pytest.approx(1.0) and rows[1]["richness_score"] == 0
    assert rows[0]["total_review_count"] == 7 and rows[1]["release_year"] == 0
    assert rows[0]["popularity_score"] == pytest.approx(
        .25 * .2 + .2 * .4 + .15 * np.log10(2.001) + .15 * .9 + .1 * .8 + .15 * .8)


def test_rule_texts(spark):
    recs = spark.createDataFrame(
        [(1, 0.06, 0.6, 70, 0.03), (2, 0.05, 0.5, 69, 0.02), (3, 0.0, 0.0, 39, 0.0)],
        "item_id int, content_score double, popularity_score double, data_confidence int, "
        "confidence_penalty double")
    texts = [r["explanation"] for r in xp.explain_rules(recs).orderBy("item_id").collect()]
    assert texts == [
        "content_score 0.06 > 0.05; popularity_score 0.60 > 0.50; data_confidence 70.00 >= 70.00; "
        "confidence_penalty 0.03 > 0.02",
        "no score is out of the ordinary", "data_confidence 39.00 < 40.00"]
    assert xp.explain_rules(recs.select("item_id")).first()["explanation"] == \
        "no score is out of the ordinary"


def test_prompt_of_unknown_item(spark):
    recs = spark.createDataFrame([(9, 0.125, 0.5, 40, 0.2)],
                                 "item_id int, content_score double, popularity_score double, "
                                 "data_confidence int, final_score double")
    details = spark.createDataFrame([], "item_id int, title string, release_year int, "
                                        "category_id string, platforms array<string>")
    prompt = xp.explanation_prompts(recs, details).first()["prompt"]
    assert "item=9\ntitle=?" in prompt and "on=?" in prompt and "content_score=0.13" in prompt


def test_export_and_manifest(spark, tmp_path):
    tables = {"tags": spark.createDataFrame([("a",), ("b",)], "tag_id string"),
              "item_tags": spark.createDataFrame([(1, "a")], "item_id bigint, tag_id string")}
    manifest = {r["table_name"]: r for r in xs.export_all(tables, str(tmp_path)).collect()}
    assert manifest["tags"]["row_count"] == 2 and manifest["item_tags"]["column_names"] == [
        "item_id", "tag_id"]
    stored = load_catalog(spark, str(tmp_path), ["tags", "item_tags"])
    assert stored.tags.count() == 2
    with pytest.raises(AttributeError):
        stored.items


def gaps(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, title string, missing_issues array<string>, "
                                       "data_confidence_score int, popularity_score double")


def test_diagnostics_defaults_and_keys(spark, tmp_path):
    stored = sn.write_diagnostics(
        "quality_gaps", gaps(spark, [(1, None, None, None, None)]), str(tmp_path))
    row = stored.first()
    assert (row["title"], row["missing_issues"], row["data_confidence_score"]) == ("", [], 0)
    with pytest.raises(ValueError):
        sn.write_diagnostics("quality_gaps", gaps(spark, [(1, "a", [], 1, 1.0)] * 2), str(tmp_path))


def test_snapshots(spark, tmp_path):
    root, shots = str(tmp_path / "diag"), str(tmp_path / "shots")
    first = [(1, 'a "quoted",\ntwo-line title', ["no_cover", "no_tags"], 5, 0.5), (2, "", ["no_cover"], 5, 0.5)]
    sn.write_diagnostics("quality_gaps", gaps(spark, first), root)
    summary = {r["table_name"]: r for r in sn.take_snapshot(spark, root, shots, "2020-01-01").collect()}
    assert summary["quality_gaps"]["row_count"] == 2 and summary["quality_gaps"]["error"] is None
    assert summary["key_metrics"]["row_count"] == 0 and summary["key_metrics"]["error"]
    with pytest.raises(ValueError):
        sn.diff_latest(spark, shots)
    sn.take_snapshot(spark, root, shots, "2020-01-02")
    assert {r["improvement"] for r in sn.diff_latest(spark, shots).collect()} == {0}
    sn.write_diagnostics("quality_gaps", gaps(spark, first[1:]), root)
    sn.take_snapshot(spark, root, shots, "2020-01-03")
    diff = {r["measure"]: (r["before"], r["after"], r["improvement"])
            for r in sn.diff_latest(spark, shots).collect()}
    assert diff["no_cover"] == (2, 1, 1) and diff["no_tags"] == (1, 0, 1)
    assert diff["no_year"] == (0, 0, 0) and "low_confidence_priorities" not in diff
    back = sn.read_snapshot(spark, shots, "quality_gaps", "2020-01-01").orderBy("item_id").collect()
    assert back[0]["title"] == first[0][1] and back[1]["title"] == ""
    assert back[0]["missing_issues"] == "no_cover,no_tags"


def test_external_match_limit_is_a_total_order(spark):
    rows = [(i, i % 3, "s", "t", 70 + i % 2, "x", "m") for i in range(20)] + [
        (99, 1, "s", "t", 69, "x", "m")]
    df = spark.createDataFrame(rows, "match_id int, item_id int, source string, source_title string, "
                                     "confidence_score int, status string, matched_by string")
    got = dg.external_matches(df, 70, 12).collect()
    assert [r["confidence_score"] for r in got] == [71] * 10 + [70] * 2


def test_managed_tables(spark):
    sn.ensure_schema(spark, "diagnostics_test")
    spark.range(3).write.mode("overwrite").saveAsTable("diagnostics_test.numbers")
    rows = sn.table_summary(spark, "diagnostics_test").collect()
    assert [(r["table_name"], r["row_count"]) for r in rows] == [("numbers", 3)]
