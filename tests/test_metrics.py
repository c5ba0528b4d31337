"""Ranking metrics, learning-to-rank helpers and A/B statistics on hand-made tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.functions.stats import erf
from shelfmark.operators import experiments as ex, metrics as mt, ranking as rk


def lists(spark, table):
    return spark.createDataFrame(
        [(name, n + 1, i) for name, ids in table.items() for n, i in enumerate(ids)],
        "list_id string, rank int, item_id int")


def sets(spark, table):
    return spark.createDataFrame([(name, i) for name, ids in table.items() for i in ids],
                                 "list_id string, item_id int")


RECS = {"short": [1, 2], "miss": [8, 9, 7], "twice": [1, 1, 2], "norel": [1, 2, 3],
        "long": [5, 6, 7, 8, 9, 10, 1]}
RELEVANT = {"short": [1], "miss": [1, 2], "twice": [1, 2], "long": [6, 8, 1, 20, 21, 22, 23],
            "empty": [4]}


@pytest.fixture(scope="module")
def per_list(spark):
    rows = mt.list_metrics(lists(spark, RECS), sets(spark, RELEVANT), [1, 5]).collect()
    return {(r["list_id"], r["k"]): r for r in rows}


def test_lists_without_recommendations_count(per_list):
    assert {name for name, _ in per_list} == set(RECS) | set(RELEVANT)
    row = per_list["empty", 5]
    assert (row["precision"], row["recall"], row["ndcg"], row["hit"]) == (0, 0, 0, 0)


def test_precision_divides_by_k(per_list):
    assert per_list["short", 5]["precision"] == pytest.approx(0.2)
    assert per_list["twice", 5]["precision"] == pytest.approx(0.6)


def test_recall_and_no_relevant(per_list):
    assert per_list["long", 5]["recall"] == pytest.approx(2 / 7)
    assert per_list["norel", 5]["recall"] == 0
    assert per_list["norel", 5]["average_precision"] == 0


def test_ndcg(per_list):
    gain = 1 / math.log2(3) + 1 / math.log2(5)
    ideal = sum(1 / math.log2(i + 2) for i in range(5))
    assert per_list["long", 5]["ndcg"] == pytest.approx(gain / ideal)
    assert per_list["short", 5]["ndcg"] == pytest.approx(1.0)


def test_average_precision(per_list):
    assert per_list["long", 5]["average_precision"] == pytest.approx((1 / 2 + 2 / 4) / 5)
    assert per_list["short", 1]["average_precision"] == 1.0


def test_map_and_hit_rate(spark):
    recs, relevant = lists(spark, RECS), sets(spark, RELEVANT)
    assert mt.hit_rate_at_k(recs, relevant, 5).first()["hit_rate"] == pytest.approx(3 / 6)
    mean = mt.map_at_k(recs, relevant, 5).first()["map"]
    assert mean == pytest.approx((1 + 0 + (1 + 1 + 1) / 2 + 0 + 0.2 + 0) / 6)


def test_coverage_and_novelty(spark):
    recs = lists(spark, {"a": [1, 2], "b": [2, 3, 77]})
    items = spark.range(1, 11).withColumnRenamed("id", "item_id")
    assert mt.catalog_coverage(recs, items).first()["coverage"] == pytest.approx(0.4)
    pop = spark.createDataFrame([(1, 0.5), (2, 0.25), (3, 0.0)],
                                "item_id int, popularity_score double")
    assert mt.novelty(recs, pop).first()["novelty"] == pytest.approx((1 + 2 + 2) / 3)
    assert mt.novelty(lists(spark, {"a": [3]}), pop).first()["novelty"] == 0


def test_similarity_and_diversity_match_pairs(spark):
    vectors = {1: [1.0, 0.0], 2: [1.0, 0.0], 3: [-1.0, 0.5], 4: [0.0, 0.0]}
    table = spark.createDataFrame(list(vectors.items()), "item_id int, embedding array<double>")
    recs = {"a": [1, 2, 3, 4, 99], "one": [1, 98], "same": [1, 1]}

    def cosine(a, b):
        a, b = np.array(vectors[a]), np.array(vectors[b])
        size = np.linalg.norm(a) * np.linalg.norm(b)
        return a @ b / size if size else 0.0

    known = [1, 2, 3, 4]
    expected = np.mean([cosine(a, b) for n, a in enumerate(known) for b in known[n + 1:]])
    got = {r["list_id"]: r["similarity"]
           for r in mt.intra_list_similarity(lists(spark, recs), table).collect()}
    assert got == pytest.approx({"a": expected, "one": 0.0, "same": 1.0})
    # "one" has a single known item and does not count.
    assert mt.diversity(lists(spark, recs), table).first()["diversity"] == pytest.approx(
        (1 - expected + 0) / 2)
    assert mt.diversity(lists(spark, recs), table, k_items=2).first()["diversity"] == 0


def test_labels(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.26), (3, 0.99), (4, 1.0)],
                               "item_id int, popularity_score double")
    labels = {r["item_id"]: r["label"] for r in rk.rank_labels(df).collect()}
    assert labels == {1: 0, 2: 1, 3: 3, 4: 4}
    flat = df.withColumn("popularity_score", F.lit(0.3))
    assert {r["label"] for r in rk.rank_labels(flat).collect()} == {0}


def test_group_split_keeps_groups_whole(spark):
    rows = [(f"g{i}", n) for i, size in enumerate([5, 3, 1, 1]) for n in range(size)]
    sides = {r["query_group"]: r["side"] for r in rk.group_split(
        spark.createDataFrame(rows, "query_group string, item_id int")).collect()}
    assert sides == {"g0": "train", "g1": "train", "g2": "validation", "g3": "validation"}


def tied_ndcg(labels, scores, k):
    """Mean gain inside ties, linear gains, as a plain loop."""
    discount = [1 / math.log2(i + 2) if i < k else 0.0 for i in range(len(labels))]

    def dcg(values):
        total, place = 0.0, 0
        for v in sorted(set(values), reverse=True):
            same = [l for l, s in zip(labels, values) if s == v]
            total += sum(same) / len(same) * sum(discount[place:place + len(same)])
            place += len(same)
        return total

    best = dcg(labels)
    return dcg(scores) / best if best else 0.0


def test_grouped_ndcg(spark):
    rng = np.random.default_rng(3)
    groups = {f"g{i}": (rng.integers(0, 5, n).tolist(), rng.integers(0, 4, n).tolist())
              for i, n in enumerate([2, 7, 40])}
    groups["zero"] = ([0, 0, 0], [1, 2, 3])
    groups["single"] = ([4], [1])
    rows = [(g, int(l), float(s)) for g, (ls, ss) in groups.items() for l, s in zip(ls, ss)]
    df = spark.createDataFrame(rows, "query_group string, label int, score double")
    got = {r["k"]: r for r in rk.grouped_ndcg(df, "score", (1, 3, 20)).collect()}
    for k in (1, 3, 20):
        expected = np.mean([tied_ndcg(*groups[g], k) for g in groups if g != "single"])
        assert got[k]["ndcg"] == pytest.approx(expected)
        assert got[k]["n_groups"] == 4


def units(spark, pairs):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)],
                                 "unit_id int, metric_a double, metric_b double")


def test_ab_identical_and_zero_mean(spark):
    same = units(spark, [(0.5, 0.5)] * 4)
    row = ex.ab_ztest(same).first()
    assert (row["z"], row["significant"]) == (0.0, False)
    assert row["p_value"] == pytest.approx(1.0, abs=1e-8)
    summary = ex.ab_summary(units(spark, [(0.0, 0.2), (0.0, 0.0), (0.0, 0.1)])).first()
    assert summary["lift_pct"] == 0 and summary["wins_b"] == 2 and summary["ties"] == 1


def test_ab_against_numpy(spark):
    rng = np.random.default_rng(5)
    a, b = rng.random(200), rng.random(200) + 0.05
    df = units(spark, list(zip(a.tolist(), b.tolist())))
    s = ex.ab_summary(df).first()
    assert s["std_a"] == pytest.approx(a.std()) and s["lift"] == pytest.approx((b - a).mean())
    assert s["wins_a"] + s["wins_b"] + s["ties"] == s["n_units"] == 200
    z = ex.ab_ztest(df).first()
    expected = (b - a).mean() / ((b - a).std() / math.sqrt(200))
    assert z["z"] == pytest.approx(expected)
    assert z["p_value"] == pytest.approx(1 - math.erf(abs(expected) / math.sqrt(2)), abs=1e-6)
    ci = ex.ab_bootstrap_ci(df, reps=2000).first()
    boot = rng.choice(b - a, (2000, 200)).mean(axis=1)
    lo, hi = np.percentile(boot, [2.5, 97.5])
    assert ci["ci_low"] == pytest.approx(lo, abs=0.01)
    assert ci["ci_high"] == pytest.approx(hi, abs=0.01)


def test_erf(spark):
    xs = [-2.0, -0.3, 0.0, 0.7, 3.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(
        erf(F.col("x")).alias("e")).collect()
    assert [r["e"] for r in got] == pytest.approx([math.erf(x) for x in xs], abs=2e-7)
