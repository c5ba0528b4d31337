"""The pairwise ranker and the hold-out split against plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.operators import experiments as ex, metrics as mt, ranking as rk


class Shared:
    def __init__(self, value):
        self.value = value


def ranker_rows(spark, n, groups, seed=1):
    rng = np.random.default_rng(seed)
    true = np.array([2.0, -1.5, 1.0, 0.0, 0.5])
    rows = []
    for i in range(n):
        idxs = np.flatnonzero(rng.random(5) < 0.5).tolist()
        label = int(np.clip(np.floor(true[idxs].sum() + 1.5 + 0.3 * rng.normal()), 0, 4))
        rows.append((groups[i % len(groups)], i, label, idxs))
    return spark.createDataFrame(rows, "query_group string, item_id bigint, label int, idxs array<bigint>")


def test_gradient_equals_a_loop_over_pairs(spark):
    rows = ranker_rows(spark, 60, ["a", "b"])
    buckets = rk.pair_buckets(rows, size=10)
    weights = np.array([0.3, -0.2, 0.0, 1.0, 0.1])
    found = list(rk._pair_gradient(Shared(weights))(buckets.toArrow().to_batches()))
    loss = sum(b.column("loss")[0].as_py() for b in found)
    gradient = sum(np.array(b.column("gradient")[0].as_py()) for b in found)
    plain_loss, plain = 0.0, np.zeros(5)
    stored = buckets.collect()
    assert sum(len(b.labels) for b in stored) == 60 and len(stored) > 4
    for b in stored:
        x = [np.isin(np.arange(5), i).astype(float) for i in b.inputs]
        for i, yi in enumerate(b.labels):
            for j, yj in enumerate(b.labels):
                if yi > yj:
                    gap = float(weights @ (x[i] - x[j]))
                    plain_loss += math.log1p(math.exp(-gap))
                    plain -= (x[i] - x[j]) / (1 + math.exp(gap))
    assert loss == pytest.approx(plain_loss) and gradient == pytest.approx(plain)


def test_all_pairs_of_a_large_group_count(spark):
    rng = np.random.default_rng(3)
    rows, n_features = [], 40
    for i in range(700):
        group = "large" if i < 600 else "small" if i < 640 else "other large"
        rows.append((group, None if i % 50 == 0 else i // 2, math.nan if i % 90 == 0 else float(rng.integers(0, 5)),
                     np.flatnonzero(rng.random(n_features) < 0.3).tolist()))
    buckets = rk.pair_buckets(spark.createDataFrame(
        rows, "query_group string, item_id bigint, label double, idxs array<bigint>"), size=30)
    assert buckets.where("buckets > 1").select("query_group").distinct().count() == 2
    weights = rng.normal(size=n_features) * 2
    x = np.array([np.isin(np.arange(n_features), r[3]).astype(float) for r in rows])
    score, label = x @ weights, np.array([r[2] for r in rows])
    group = np.array([r[0] for r in rows])
    better = (label[:, None] > label[None, :]) & (group[:, None] == group[None, :])
    gap = score[:, None] - score[None, :]
    push = np.where(better, 1 / (1 + np.exp(gap)), 0)
    loss, pairs, gradient = rk.pair_gradient(buckets, weights)
    assert pairs == better.sum()
    assert loss == pytest.approx(np.logaddexp(0, -gap)[better].sum(), rel=1e-12)
    assert gradient == pytest.approx((push.sum(0) - push.sum(1)) @ x, rel=1e-11, abs=1e-9)


def test_training_uses_the_pairs_across_buckets(spark, monkeypatch):
    rows, losses = ranker_rows(spark, 400, ["all"]), []
    for size in (1024, 20):                  # compared pair by pair, and as 20 buckets
        buckets = rk.pair_buckets
        monkeypatch.setattr(rk, "pair_buckets", lambda r: buckets(r, size))
        losses.append(rk.train_pair_ranker(rows, 5, steps=5))
        monkeypatch.undo()
    assert losses[0].losses == pytest.approx(losses[1].losses, rel=1e-12)
    assert losses[0].weights == pytest.approx(losses[1].weights, rel=1e-10)


def test_ranker_learns_the_order_in_one_hot_group(spark):
    rows = ranker_rows(spark, 900, ["all"])
    model = rk.train_pair_ranker(rows, 5)
    assert model.losses[-1] < 0.7 * model.losses[0]
    assert np.argmax(model.weights) == 0 and np.argmin(model.weights) == 1
    sets = rows.select("item_id", "idxs")
    items = spark.range(905).withColumnRenamed("id", "item_id")
    scores = rk.pair_scores(model, items, sets)
    assert scores.count() == 905 and scores.where("item_id >= 900 and rank_score <> 0").isEmpty()
    ranked = rows.join(scores, "item_id").withColumn("constant", F.lit(0.0))
    ndcg = {s: rk.grouped_ndcg(ranked, s, (10,)).first()["ndcg"] for s in ("rank_score", "constant")}
    assert ndcg["rank_score"] > ndcg["constant"] + 0.2


def test_ranker_without_pairs(spark):
    rows = ranker_rows(spark, 20, ["a"]).withColumn("label", F.lit(1))
    model = rk.train_pair_ranker(rows, 5)
    assert not model.weights.any() and model.losses == []
    assert len(rk.train_pair_ranker(rows.where("false"), 0).weights) == 0


def test_hold_out_keeps_both_parts_of_a_user(spark):
    likes = [(u, i) for u in range(40) for i in range(u % 9)] * 2 + [(None, 1), (1, None)]
    kept, held = (set(map(tuple, part.collect())) for part in mt.hold_out_likes(
        spark.createDataFrame(likes, "user_id bigint, item_id bigint"), 3))
    assert kept and held and not kept & held
    assert {u for u, _ in kept} == {u for u, _ in held}
    for u in {u for u, _ in kept}:
        assert {i for v, i in kept | held if v == u} == set(range(u % 9))
    again = {tuple(r) for r in mt.hold_out_likes(
        spark.createDataFrame(likes[::-1], "user_id bigint, item_id bigint"), 3)[1].collect()}
    assert again == held


def test_variants_pair_by_user(spark):
    a = spark.createDataFrame([(1, 0.5), (2, 0.25), (3, 0.0)], "user_id bigint, ndcg double")
    b = spark.createDataFrame([(1, 0.75), (2, 0.25), (4, 1.0)], "user_id bigint, ndcg double")
    row = ex.ab_summary(ex.variants_by_unit(a, b, "ndcg")).first()
    assert (row["n_units"], row["wins_b"], row["ties"], row["lift"]) == (2, 1, 1, 0.125)


def test_bootstrap_of_no_unit_and_of_null_lifts(spark):
    schema = "unit_id bigint, metric_a double, metric_b double"
    none = ex.ab_bootstrap_ci(spark.createDataFrame([], schema), reps=50).first()
    assert none["ci_low"] is None and none["n_units"] == 0
    one = ex.ab_bootstrap_ci(spark.createDataFrame([(1, 1.0, 3.0), (2, None, 1.0)], schema), reps=2001).first()
    assert one["n_units"] == 2 and one["ci_low"] == 0.0 and one["ci_high"] == 2.0
