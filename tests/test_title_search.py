"""Title search by postings against a plain loop; bucketed tables; sketches of parts."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from entrypoints.queries import bucketed_counts
from shelfmark.operators import analytics as an, title_search as ts
from shelfmark.session import run_folder
from shelfmark.sources import export as xs

ALPHABET = "abAB éß語 _%.*"
SCHEMA = "item_id bigint, title string"


def titles():
    draw = random.Random(5)
    rows = [(i * 997, "".join(draw.choices(ALPHABET, k=draw.randrange(12)))) for i in range(400)]
    return rows + [(-5, "abab tail"), (-5, "abab tail"), (3, None), (1 << 40, "x" * 5000 + "needle"),
                   (7, ""), (None, "abab")]


@pytest.fixture(scope="module")
def index(spark):
    return ts.build(spark.createDataFrame(titles(), SCHEMA), run_folder(spark, "titles"))


@pytest.mark.parametrize("text", ["", "a", "AB", "aba", "b é", "_%", "語 a", "NEEDLE", "xxxx", "nothing here", None])
def test_search_equals_a_scan(index, text):
    found = sorted((r["item_id"], r["title"]) for r in ts.search(index, text).collect())
    assert found == sorted((i, t) for i, t in titles() if i is not None and t is not None
                           and text is not None and text.lower() in t.lower())


def test_many_texts_at_once(spark, index):
    texts = [(i, t) for i, t in enumerate(["ab", "AB ", "bab", "é", None, "", "zz", "ab"])]
    scores = [(i, float(abs(i) % 7)) for i in {i for i, _ in titles() if i is not None}]
    rows = ts.search_all(index, spark.createDataFrame(texts, "query int, text string"),
                         spark.createDataFrame(scores, "item_id bigint, popularity_score double"), 5).collect()
    score = dict(scores)
    for query, text in texts:
        want = [i for i, t in titles() if i is not None and t is not None and text is not None
                and text.lower() in t.lower()]
        want.sort(key=lambda i: (-score[i], i))
        assert [r["item_id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["query"] == query] == want[:5]


def test_a_search_reads_its_grams_only(index):
    plan = ts.search(index, "aba")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(gram,aba)" in plan or "In(gram, [aba])" in plan


def test_empty_table(spark):
    empty = ts.build(spark.createDataFrame([], SCHEMA), run_folder(spark, "titles"))
    assert ts.search(empty, "abc").collect() == [] == ts.search(empty, "").collect()


def test_bucketed_tables_join_without_a_shuffle(spark):
    schema = "buckets_" + uuid.uuid4().hex
    spark.sql(f"create schema {schema}")
    try:
        matrix = xs.write_bucketed(spark.range(200).select(
            F.col("id").alias("item_id"), (F.col("id") * 1.0).alias("log_sales"),
            F.lit(0.5).alias("popularity_score")), f"{schema}.matrix", buckets=4)
        tags = xs.write_bucketed(spark.range(600).select(
            (F.col("id") % 150).alias("item_id"), F.col("id").cast("string").alias("tag_id")),
            f"{schema}.tags", buckets=4)
        # Far beyond what may be broadcast, both sides would be shuffled by item.
        plain = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            counts = bucketed_counts(matrix, tags)
            plan = counts._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "SortMergeJoin" in plan
            assert {(r["item_id"], r["n_tags"]) for r in counts.collect()} == {
                (i, 4 if i < 150 else 0) for i in range(200)}
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", plain)
    finally:
        spark.sql(f"drop schema {schema} cascade")


def test_sketches_of_parts_count_shared_items_once(spark):
    part = [spark.range(a, b).select(F.lit("t").alias("tag_id"), F.col("id").alias("item_id"))
            for a, b in ((0, 3000), (1000, 5000))]
    part[1] = part[1].unionByName(spark.createDataFrame([("u", 1), ("u", 1), ("v", None)],
                                                       "tag_id string, item_id bigint"))
    merged = {r["tag_id"]: r for r in an.merged_tag_diversity(
        an.tag_sketches(part[0]).unionByName(an.tag_sketches(part[1]))).collect()}
    assert set(merged) == {"t", "u"} and merged["u"]["approx_item_count"] == 1
    assert abs(merged["t"]["approx_item_count"] - 5000) < 250 and merged["t"]["n_parts"] == 2
