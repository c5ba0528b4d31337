"""Top-k, recommendation and re-ranking against plain loops."""

import time
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark import session
from shelfmark.operators import embedding as em, nearest as nn, recommend as rc, rerank as rr
from shelfmark.plans import features as pf

RNG = np.random.default_rng(7)


def brute_topk(queries, items, seen, k):
    """{query: [(item, score)]} by comparing everything."""
    out = {}
    for q, vec, alpha, beta, gamma in queries:
        rows = []
        for item, emb, pop, pen in items:
            if (q, item) in seen:
                continue
            size = np.linalg.norm(vec) * np.linalg.norm(emb)
            cos = float(np.dot(vec, emb) / size) if size > 0 else 0.0
            rows.append((-round(alpha * cos + beta * pop - gamma * pen, 9), item))
        out[q] = [(i, -s) for s, i in sorted(rows)[:k]]
    return out


@pytest.mark.parametrize("group_size,block,chunk", [(1000, 4096, 8192), (20, 8, 5), (40, 4096, 8192)])
def test_weighted_topk_is_exact(spark, monkeypatch, group_size, block, chunk):
    monkeypatch.setattr(nn, "ITEM_BLOCK", block)
    monkeypatch.setattr(nn, "QUERY_CHUNK", chunk)
    centres = RNG.normal(size=(4, 6))
    items = []
    for i in range(200):
        vec = centres[i % 4] + 0.1 * RNG.normal(size=6) if i % 10 else np.zeros(6)
        vec = centres[0] if i % 3 == 0 and i % 10 else vec  # a third are identical vectors
        items.append((i, vec.tolist(), float(RNG.random()) - 0.2, float(RNG.random())))
    queries = [(f"q{j}", (centres[j % 4] if j % 7 else np.zeros(6)).tolist(), 0.5, 0.4, 0.1)
               for j in range(30)]
    seen = {(f"q{j}", int(i)) for j in range(0, 30, 2) for i in RNG.integers(0, 200, 60)}
    got = nn.weighted_topk(
        spark.createDataFrame(queries, "query_id string, vec array<double>, alpha double, "
                                       "beta double, gamma double"),
        spark.createDataFrame(items, "item_id bigint, embedding array<double>, pop double, "
                                     "pen double"),
        7, spark.createDataFrame(list(seen), "query_id string, item_id bigint"), group_size)
    expected = brute_topk(queries, items, seen, 7)
    rows = {}
    for r in got.orderBy("query_id", "rank").collect():
        rows.setdefault(r["query_id"], []).append((r["item_id"], r["final_score"]))
    assert {q: [i for i, _ in v] for q, v in rows.items()} == {
        q: [i for i, _ in v] for q, v in expected.items()}
    for q in rows:
        assert [s for _, s in rows[q]] == pytest.approx([s for _, s in expected[q]], abs=2e-9)


def topk_case(spark, monkeypatch, items, queries, k, group_size, seen=None):
    """Rows of ``weighted_topk`` by query, and how many copies of a query were sent to blocks."""
    copies, score = [], nn._score

    def counted(visits, blocks, salts, *rest):
        copies.extend(salts[g] for r in visits.select("grps").collect() for g in r["grps"])
        return score(visits, blocks, salts, *rest)

    monkeypatch.setattr(nn, "_score", counted)
    got = nn.weighted_topk(
        spark.createDataFrame(queries, "query_id long, vec array<double>, alpha double, beta double, gamma double"),
        spark.createDataFrame(items, "item_id long, embedding array<double>, pop double, pen double"), k,
        seen and spark.createDataFrame(list(seen), "query_id long, item_id long"), group_size)
    rows = {}
    for r in got.orderBy("query_id", "rank").collect():
        rows.setdefault(r["query_id"], []).append(r["item_id"])
    expected = brute_topk(queries, items, seen or set(), k)
    assert rows == {q: [i for i, _ in v] for q, v in expected.items()}
    return len(copies) / len(queries)


@pytest.mark.parametrize("most_weights", [64, 1])
def test_a_query_is_sent_to_few_blocks(spark, monkeypatch, most_weights):
    monkeypatch.setattr(nn, "ITEM_BLOCK", 8)
    monkeypatch.setattr(nn, "QUERY_CHUNK", 8)
    monkeypatch.setattr(nn, "MAX_WEIGHTS", most_weights, raising=False)
    rng = np.random.default_rng(3)
    items = [(i, (1 + 0.3 * rng.normal(size=6)).tolist(), float(rng.random()), float(rng.random())) for i in range(1500)]
    queries = [(j, (1 + 0.1 * rng.normal(size=6)).tolist(), 0.5, (0.4, 0.0)[j % 2], (0.1, 0.0)[j % 2]) for j in range(300)]
    seen = {(j, int(i)) for j in range(0, 300, 3) for i in rng.integers(0, 1500, 30)}
    copies = topk_case(spark, monkeypatch, items, queries, 5, 100, seen)
    assert copies <= (20 if most_weights > 1 else 40)   # 188 blocks of 8


def test_clustered_vectors_visit_their_own_cluster(spark, monkeypatch):
    monkeypatch.setattr(nn, "ITEM_BLOCK", 20)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 8))
    items = [(i, (centres[i % 5] + 0.02 * rng.normal(size=8)).tolist() if i % 50 else [0.0] * 8, 0.0, 0.0)
             for i in range(600)]
    queries = [(i, v, 1.0, 0.0, 0.0) for i, v, _, _ in items if i % 50]
    assert topk_case(spark, monkeypatch, items, queries, 4, 20, {(i, i) for i, *_ in queries}) <= 15   # of 30


def test_means_and_embeddings_without_sorting_rows(spark):
    """Rows that carry vectors are added up as they come: no object aggregate, which sorts them in a task's memory."""
    rng = np.random.default_rng(5)
    vectors = {i: rng.normal(size=4) for i in range(40)}
    likes = [(None if u == 3 else u, int(i)) for u in range(30) for i in rng.integers(0, 45, 60 if u == 7 else 6)]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "item_id long, embedding array<double>")
    found = rc.user_profiles(spark.createDataFrame(likes, "user_id long, item_id long"), table)
    assert "ObjectHashAggregate" not in found._jdf.queryExecution().toString()
    means = {}
    for user, item in likes:
        if item in vectors:
            means.setdefault(user, []).append(vectors[item])
    rows = {r["user_id"]: r["vec"] for r in found.collect()}
    assert set(rows) == set(means)
    for user, own in means.items():
        assert rows[user] == pytest.approx(np.mean(own, axis=0), abs=1e-12)

    names = [(i, "tag", f"t{t}") for i in range(1, 30) for t in set(rng.integers(0, 9, 4).tolist())]
    items = spark.range(30).withColumnRenamed("id", "item_id")
    model, embedded = em.content_model(items, spark.createDataFrame(names, "item_id long, kind string, feature string"), 5)
    assert "ObjectHashAggregate" not in embedded._jdf.queryExecution().toString()
    part = {r["idx"]: np.array(r["vec"]) for r in model.components.collect()}
    number = {r["feature"]: r["idx"] for r in model.features.collect()}
    for r in embedded.collect():
        own = sum((part[number[t]] for i, _, t in names if i == r["item_id"]), np.zeros(5))
        assert r["embedding"] == pytest.approx(own, abs=1e-12)


def test_cells_score_only_blocks_that_can_reach_the_floor(spark, monkeypatch):
    """Inside a cell blocks of items are left out by their bounds, and settings of a user share what it has seen."""
    monkeypatch.setattr(nn, "CELL_BLOCK", 16, raising=False)
    rng = np.random.default_rng(21)
    items = [(i, (np.zeros(6) if i % 31 == 0 else 1 + 0.3 * rng.normal(size=6)).tolist(),
              float("nan") if i % 47 == 0 else float(rng.random() ** 3), float(rng.random())) for i in range(600)]
    weights = [(0.5, 0.4, 0.1), (0.1, 0.9, 0.0), (1.0, 0.0, 0.0)]
    vecs = [(np.zeros(6) if u == 5 else 1 + 0.2 * rng.normal(size=6)).tolist() for u in range(12)]
    queries = [(f"{s}:{u}", f"0:{u}", v, *w) for s, w in enumerate(weights) for u, v in enumerate(vecs)]
    seen = {(u, int(i)) for u in range(0, 12, 2) for i in rng.integers(0, 600, 90)}
    sizes, blocks = [], nn._seen_by_block

    def counted(found, index):
        sizes.append(found.count())
        return blocks(found, index)

    monkeypatch.setattr(nn, "_seen_by_block", counted)
    got = nn.weighted_topk(
        spark.createDataFrame(queries, "query_id string, owner string, vec array<double>, alpha double, "
                                       "beta double, gamma double"),
        spark.createDataFrame(items, "item_id bigint, embedding array<double>, pop double, pen double"),
        7, spark.createDataFrame([(f"0:{u}", i) for u, i in seen], "owner string, item_id bigint"), 150)
    known = [x for x in items if x[2] == x[2]]
    expected = brute_topk([(q, *rest) for q, _, *rest in queries], known,
                          {(f"{s}:{u}", i) for s in range(3) for u, i in seen}, 7)
    rows = {}
    for r in got.orderBy("query_id", "rank").collect():
        rows.setdefault(r["query_id"], []).append(r["item_id"])
    assert rows == {q: [i for i, _ in v] for q, v in expected.items()}
    assert sizes == [len(seen)]   # not once per setting


def test_a_round_sends_a_query_to_few_groups(spark, monkeypatch):
    """However many groups there are, what is on its way at a time is few copies of a query, or few rows."""
    for name, value in (("ITEM_BLOCK", 8), ("QUERY_CHUNK", 8), ("ROUND_VISITS", 3), ("ROUND_BYTES", 1)):
        monkeypatch.setattr(nn, name, value, raising=False)
    rng = np.random.default_rng(8)
    items = [(i, rng.normal(size=5).tolist(), 0.0, 0.0) for i in range(160)]
    queries = [(i, v, 1.0, 0.0, 0.0) for i, v, _, _ in items[:30]]
    most, score = [], nn._score

    def counted(visits, *rest):
        most.append([len(r["grps"]) for r in visits.select("grps").collect()])
        return score(visits, *rest)

    monkeypatch.setattr(nn, "_score", counted)
    got = nn.weighted_topk(
        spark.createDataFrame(queries, "query_id long, vec array<double>, alpha double, beta double, gamma double"),
        spark.createDataFrame(items, "item_id long, embedding array<double>, pop double, pen double"), 4,
        spark.createDataFrame([(i, i) for i, *_ in queries] * 2, "query_id long, item_id long"), 40)
    rows = {}
    for r in got.orderBy("query_id", "rank").collect():
        rows.setdefault(r["query_id"], []).append(r["item_id"])
    expected = brute_topk(queries, items, {(i, i) for i, *_ in queries}, 4)
    assert rows == {q: [i for i, _ in v] for q, v in expected.items()}
    assert len(most) > 2   # of 20 groups
    assert all(max(n) <= 3 or sum(n) <= 2 * (len(items) + len(queries)) for n in most)


def test_search_comes_in_slices_and_leaves_only_the_lists(spark, monkeypatch, tmp_path):
    """Queries and groups come a few at a time, and of all that is stored for a search only its lists stay."""
    for name, value in (("ITEM_BLOCK", 8), ("QUERY_CHUNK", 8), ("ROUND_BYTES", 1)):
        monkeypatch.setattr(nn, name, value)
    rng = np.random.default_rng(12)
    items = [(i, rng.normal(size=5).tolist(), float(rng.random()), 0.0) for i in range(160)]
    queries = [(None if i == 3 else i, rng.normal(size=5).tolist(), 0.6, 0.4, 0.0) for i in range(40)]
    sent, score = [], nn._score

    def counted(visits, *rest):
        sent.append(visits.count())
        return score(visits, *rest)

    monkeypatch.setattr(nn, "_score", counted)
    with session.scratch_scope(spark) as scope:
        likes = spark.createDataFrame([(u, i % 160) for u in range(40) for i in (u, 3 * u)], "user_id long, item_id long")
        table = spark.createDataFrame([(i, v) for i, v, *_ in items], "item_id long, embedding array<double>")
        rated = scored(spark, [(i, f"t{i}", p, 50) for i, _, p, _ in items])
        rc.recommend_hybrid(likes, rated, table, k=4, group_size=40).collect()
        assert {f.name.split("-")[0] for f in Path(scope).iterdir()} == {"lists"}
    assert sent and max(sent) <= 20   # half of the queries
    got = nn.weighted_topk(
        spark.createDataFrame(queries, "query_id long, vec array<double>, alpha double, beta double, gamma double"),
        spark.createDataFrame(items, "item_id long, embedding array<double>, pop double, pen double"), 4, None, 40)
    rows = {}
    for r in got.orderBy("query_id", "rank").collect():
        rows.setdefault(r["query_id"], []).append(r["item_id"])
    assert rows == {q: [i for i, _ in v] for q, v in brute_topk(queries, items, set(), 4).items()}


def test_reranking_in_rounds(spark, monkeypatch):
    rng = np.random.default_rng(13)
    recs = spark.createDataFrame([(u, r + 1, int(i), float(1 - 0.1 * r)) for u in range(12)
                                  for r, i in enumerate(rng.choice(30, 5, False))],
                                 "user_id long, rank int, item_id long, final_score double")
    table = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(1, 30)], "item_id long, embedding array<double>")
    whole = sorted(map(tuple, rr.mmr_rerank(recs, table, 4, 0.5, "user_id").collect()))
    monkeypatch.setattr(rr, "ROUND_ROWS", 1, raising=False)
    stored = []
    monkeypatch.setattr(rr, "cut_at", lambda df, at: stored.append(df.count()) or session.cut_at(df, at), raising=False)
    assert sorted(map(tuple, rr.mmr_rerank(recs, table, 4, 0.5, "user_id").collect())) == whole
    assert len(stored) == 3 and sum(stored) == 48   # 60 rows, 29 vectors at a time


def test_vectors_of_queries_are_shuffled_once(spark):
    """What a query must not get comes to the cells by itself: no join has the vectors of the queries in it."""
    visits = spark.createDataFrame([(i, [1.0, float(i)], 1.0, 0.0, 0.0, None, [i % 2]) for i in range(6)],
                                   "query_id long, vec array<double>, alpha double, beta double, gamma double, "
                                   "floor double, grps array<int>")
    blocks = spark.createDataFrame([(i, [float(i), 1.0], 0.0, 0.0, i % 2, 0) for i in range(8)],
                                   "item_id long, embedding array<double>, pop double, pen double, grp int, salt int")
    seen = nn._seen_by_block(spark.createDataFrame([(0, 0), (0, 2), (1, 3), (1, 2), (9, 1), (None, 0)],
                                                   "query_id long, item_id long"), blocks)
    scored = nn._score(visits, blocks, {0: 1, 1: 1}, seen, 4, 2)
    found = {}
    for r in scored.collect():
        found.setdefault(r["query_id"], set()).add(r["item_id"])
    assert found == {q: {i for i in range(8) if i % 2 == q % 2} - {0: {0, 2}, 1: {3}}.get(q, set()) for q in range(6)}

    def joined(node):
        names = [node.output().apply(i).name() for i in range(node.output().size())]
        below = [joined(node.children().apply(i)) for i in range(node.children().size())]
        return (node.nodeName() == "Join" and "vec" in names) or any(below)

    assert not joined(scored._jdf.queryExecution().optimizedPlan())


def test_profiles_in_rounds(spark, monkeypatch):
    rng = np.random.default_rng(9)
    vectors = {i: rng.normal(size=3) for i in range(4)}
    likes = [(None if u == 5 else u, int(i)) for u in range(20) for i in rng.integers(0, 5, 4)]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "item_id long, embedding array<double>")
    monkeypatch.setattr(rc, "ROUND_LIKES", 1, raising=False)
    sent, mean_by = [], rc.mean_by

    def counted(rows, *rest):
        sent.append(rows.count())
        return mean_by(rows, *rest)

    monkeypatch.setattr(rc, "mean_by", counted)
    rows = {r["user_id"]: r["vec"] for r in rc.user_profiles(
        spark.createDataFrame(likes, "user_id long, item_id long"), table).collect()}
    means = {}
    for user, item in likes:
        if item in vectors:
            means.setdefault(user, []).append(vectors[item])
    assert set(rows) == set(means)
    for user, own in means.items():
        assert rows[user] == pytest.approx(np.mean(own, axis=0), abs=1e-12)
    assert len(sent) == 10 and sum(sent) == sum(i in vectors for _, i in likes)


def test_stored_steps_leave_no_shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    setting = spark.conf.get(session.CLEANUP)
    names = lambda: {str(f) for f in files.getAllBlocks().mkString(" ").split() if str(f).startswith("shuffle_")}
    before = names()
    rows = session.cut(spark.range(50_000).groupBy((F.col("id") % 5_000).alias("k")).count())
    for _ in range(50):
        if not names() - before:
            break
        time.sleep(0.1)
    assert not names() - before
    assert rows.count() == 5_000
    assert spark.conf.get(session.CLEANUP) == setting


def test_topk_with_fewer_items_than_k(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0], 0.0, 0.0), (2, [0.0, 0.0], 0.0, 0.0)],
                                  "item_id bigint, embedding array<double>, pop double, pen double")
    queries = spark.createDataFrame([(9, [1.0, 1.0], 1.0, 0.0, 0.0)],
                                    "query_id bigint, vec array<double>, alpha double, "
                                    "beta double, gamma double")
    rows = nn.weighted_topk(queries, items, 5).orderBy("rank").collect()
    assert [(r["item_id"], round(r["final_score"], 6)) for r in rows] == [(1, 0.707107), (2, 0.0)]


def scored(spark, rows):
    return spark.createDataFrame(
        rows, "item_id bigint, title string, popularity_score double, data_confidence_score int")


def test_similar_items_drop_themselves_among_identical_vectors(spark):
    vectors = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)],
                                    "item_id bigint, embedding array<double>")
    rows = rc.similar_items(vectors, 2).orderBy("item_id", "rank").collect()
    assert [(r["item_id"], r["similar_id"]) for r in rows] == [
        (0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1), (3, 0), (3, 1), (4, 0), (4, 1)]


def test_hybrid_ignores_unknown_likes_and_leaves_out_seen(spark):
    items = scored(spark, [(i, f"t{i}", i / 10, 50) for i in range(6)])
    vectors = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(6)],
                                    "item_id bigint, embedding array<double>")
    likes = spark.createDataFrame([(1, 0), (1, 99), (2, 99)], "user_id bigint, item_id bigint")
    banned = spark.createDataFrame([(1, 5), (7, 3)], "user_id bigint, item_id bigint")
    rows = rc.recommend_hybrid(likes, items, vectors, k=10, excluded=banned).collect()
    assert {r["user_id"] for r in rows} == {1}
    assert {r["item_id"] for r in rows} == {1, 2, 3, 4}
    everyone = spark.createDataFrame([(1,), (2,), (3,)], "user_id bigint")
    lists = rc.recommend_users(everyone, likes, items, vectors, k=2, excluded=banned).collect()
    cold = sorted((r["rank"], r["item_id"]) for r in lists if r["user_id"] == 2)
    assert cold == [(1, 5), (2, 4)]


def test_cold_start_shuffles_exclusions_of_high_ranks_only(spark, monkeypatch):
    items = scored(spark, [(i, f"t{i}", float(400 - i), 50) for i in range(400)])
    banned = [(u, i) for u in range(20) for i in (u, 399 - u, 200 + u)]
    stored, cut = [], rc.cut

    def counted(df):
        out = cut(df)
        stored.append((out.columns, out.count()))
        return out

    monkeypatch.setattr(rc, "cut", counted)
    lists = rc.recommend_cold_start(spark.range(20).withColumnRenamed("id", "user_id"), items, 2, spark.createDataFrame(
        banned, "user_id long, item_id long")).collect()
    assert {(r["user_id"], r["rank"], r["item_id"]) for r in lists} == {
        (u, n + 1, i) for u in range(20) for n, i in enumerate([i for i in range(3) if i != u][:2])}
    # Three exclusions a user: only the first 2 + 3 - 1 items can matter.
    assert [n for columns, n in stored if columns == ["item_id", "global_rank"]] == [4]


@pytest.mark.parametrize("k", [1, 3, 8])
def test_cold_start_with_exclusions(spark, k):
    pop = {i: float(RNG.integers(0, 6)) for i in range(60)}
    items = scored(spark, [(i, f"t{i}", p, 50) for i, p in pop.items()])
    banned = {(u, int(i)) for u in range(1, 6) for i in RNG.integers(0, 60, 4 * u * u)}
    banned |= {(6, i) for i in range(60)} | {(7, 999), (99, 1)}
    got = rc.recommend_cold_start(
        spark.range(8).withColumnRenamed("id", "user_id"), items, k,
        spark.createDataFrame(list(banned), "user_id bigint, item_id bigint")).collect()
    for user in range(8):
        expected = [i for _, i in sorted((-p, i) for i, p in pop.items()
                                         if (user, i) not in banned)][:k]
        mine = sorted((r["rank"], r["item_id"]) for r in got if r["user_id"] == user)
        assert mine == [(n + 1, i) for n, i in enumerate(expected)]


def test_profile_lists_equal_full_scoring(spark):
    rows = [(i, f"t{i}", float(RNG.random()) - 0.3, int(RNG.integers(0, 101))) for i in range(80)]
    tags = {(int(RNG.integers(0, 80)), t) for t in "abc" for _ in range(12)}
    platform = {(int(RNG.integers(0, 80)), t) for t in "ax" for _ in range(9)}
    features = spark.createDataFrame(
        [(i, "tag", t) for i, t in tags] + [(i, "platform", t) for i, t in platform],
        "item_id bigint, kind string, feature string")
    profiles = {"both": ["a", "x", "missing"], "tags": ["b", "c"], "none": ["missing"]}
    settings = [(0.5, 0.4, 0.1), (0.0, 1.0, 0.0), (1.0, 0.0, 0.5)]
    got = rc.recommend_profile(
        spark.createDataFrame([(p, t) for p, ts in profiles.items() for t in ts],
                              "profile string, tag_id string"),
        features, scored(spark, rows), settings, 9).collect()
    known = {i: {t for j, t in tags if j == i} | {t for j, t in platform if j == i and t == "x"}
             for i in range(80)}
    for s, (a, b, g) in enumerate(settings):
        for p, ts in profiles.items():
            present = {t for t in ts if any(t in f for f in known.values())}
            full = []
            for i, _, pop, conf in rows:
                score = pop if not present else (
                    a * len(known[i] & present) / len(present) + b * pop - (100 - conf) / 100 * g)
                full.append((-round(score, 9), i))
            mine = sorted((r["rank"], r["item_id"]) for r in got
                          if r["setting"] == s and r["profile"] == p)
            assert mine == [(n + 1, i) for n, (_, i) in enumerate(sorted(full)[:9])]


def mmr_loop(rows, vectors, k, lam):
    rows, chosen = list(rows), []
    for _ in range(min(k, len(rows))):
        best = None
        for cand in rows:
            score = cand[1]
            if chosen:
                sims = []
                for other in chosen:
                    a, b = vectors[cand[0]], vectors[other[0]]
                    size = np.linalg.norm(a) * np.linalg.norm(b)
                    sims.append(float(np.dot(a, b) / size) if size else 0.0)
                score = lam * cand[1] - (1 - lam) * max(sims)
            if best is None or round(score, 12) > round(best[1], 12):
                best = (cand, score)
        chosen.append(best[0])
        rows.remove(best[0])
    return [c[0] for c in chosen]


@pytest.mark.parametrize("lam", [0.0, 0.5, 1.0])
def test_mmr(spark, lam):
    vectors = {i: RNG.normal(size=3) if i % 5 else np.zeros(3) for i in range(30)}
    lists = {}
    for user in range(6):
        picked = RNG.permutation(30)[:user + 1]
        lists[user] = [(int(i), round(1 - n / 10, 3)) for n, i in enumerate(picked)]
    recs = spark.createDataFrame(
        [(u, n + 1, i, s) for u, rows in lists.items() for n, (i, s) in enumerate(rows)],
        "user_id int, rank int, item_id int, final_score double")
    table = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()],
                                  "item_id int, embedding array<double>")
    got = rr.mmr_rerank(recs, table, 4, lam, "user_id").collect()
    for user, rows in lists.items():
        mine = [i for _, i in sorted((r["rank"], r["item_id"]) for r in got
                                     if r["user_id"] == user)]
        assert mine == mmr_loop(rows, vectors, 4, lam)
        if lam == 1.0:
            assert mine == [i for i, _ in rows][:4]
    with pytest.raises(Exception, match="longer than 5 rows"):
        rr.mmr_rerank(recs, table, 4, lam, "user_id", longest=5).collect()


def test_svd_matches_dense_svd(spark):
    matrix = (RNG.random((40, 9)) < 0.3).astype(float)
    features = spark.createDataFrame(
        [(i, "tag", f"f{j}") for i, j in zip(*map(lambda x: x.tolist(), matrix.nonzero()))],
        "item_id bigint, kind string, feature string")
    items = spark.range(40).withColumnRenamed("id", "item_id")
    model, vectors = em.content_model(items, features, 4)
    assert model.singular_values == pytest.approx(np.linalg.svd(matrix)[1][:4])
    rows = {r["item_id"]: np.array(r["embedding"]) for r in vectors.collect()}
    assert len(rows) == 40
    _, s, vt = np.linalg.svd(matrix)
    expected = matrix @ vt[:4].T
    got = np.array([rows[i] for i in range(40)])
    assert got @ got.T == pytest.approx(expected @ expected.T, abs=1e-6)
    ratios = em.explained_variance(vectors, model, 40).orderBy("component").collect()
    dense = expected.var(axis=0) / matrix.var(axis=0).sum()
    assert [r["explained_ratio"] for r in ratios] == pytest.approx(dense.tolist())


def set_tables(spark, matrix):
    sets = spark.createDataFrame([(i, np.flatnonzero(r).tolist()) for i, r in enumerate(matrix)],
                                 "item_id bigint, idxs array<bigint>")
    index = spark.createDataFrame([("tag", f"f{j:05d}", j) for j in range(matrix.shape[1])],
                                  "kind string, feature string, idx bigint")
    return sets, index


def check_leading(matrix, values, table, r):
    _, s, vt = np.linalg.svd(matrix, full_matrices=False)
    assert np.sqrt(np.clip(values, 0, None)) == pytest.approx(s[:r], rel=1e-6, abs=1e-5)
    rows = {x["idx"]: x["vec"] for x in table.collect()}
    got = np.array([rows[j] for j in range(matrix.shape[1])])
    assert got.T @ got == pytest.approx(np.eye(got.shape[1]), abs=1e-8)
    gram = matrix.T @ matrix
    gap = np.linalg.norm(gram @ got - got * values, axis=0)
    assert gap.max() <= 1e-7 * max(values.max(), 1)
    return got


def test_a_content_model_leaves_no_copy_of_the_features(spark):
    """Features are stored while they are numbered only: a row per item and feature is dropped once the sets are there."""
    items = spark.createDataFrame([(i,) for i in range(6)], "item_id long")
    tags = spark.createDataFrame([(i, f"t{i % 3}") for i in range(6)], "item_id long, tag_id string")
    catalog = SimpleNamespace(items=items, item_tags=tags, tags=tags.select("tag_id").distinct(),
                              item_platforms=spark.createDataFrame([(0, "x")], "item_id long, platform_id string"))
    with session.scratch_scope(spark) as folder:
        _, vectors = pf.build_content_model(catalog)
        kept = [set(spark.read.parquet(str(at)).columns) for at in Path(folder).iterdir()]
        assert vectors.count() == 6 and {"item_id", "embedding"} in kept
        assert not [columns for columns in kept if {"item_id", "feature"} <= columns]


def test_krylov_iteration_with_restarts(spark):
    probs = np.linspace(0.9, 0.05, 60)
    matrix = (RNG.random((400, 60)) < probs).astype(float)
    matrix[:, :2] = 1.0
    sets, index = set_tables(spark, matrix)
    values, table, residual, passes = em.leading(index, sets, 3, max_columns=32)
    assert residual <= em.TOLERANCE and passes > 3
    check_leading(matrix, values, table, 3)
    *_, residual, passes = em.leading(index, sets, 3, max_passes=2)
    assert passes == 2 and residual > em.TOLERANCE    # told, not refused


def test_krylov_iteration_on_a_flat_spectrum(spark):
    matrix = (np.random.default_rng(11).random((3000, 1000)) < 0.02).astype(float)
    sets, index = set_tables(spark, matrix)
    values, table, residual, passes = em.leading(index, sets, 100)
    assert residual <= em.TOLERANCE and passes <= 40
    check_leading(matrix, values, table, 100)


def test_more_components_than_rank(spark):
    matrix = np.zeros((30, 40))
    matrix[:, 0] = 1
    matrix[:15, 1:4] = 1
    matrix[3, 4:] = 1
    sets, index = set_tables(spark, matrix)
    values, table, residual, _ = em.leading(index, sets, 20)
    assert residual <= em.TOLERANCE
    assert np.sqrt(np.clip(values, 0, None)) == pytest.approx(np.linalg.svd(matrix)[1][:20], abs=1e-4)


def test_model_without_features(spark):
    items = spark.range(3).withColumnRenamed("id", "item_id")
    none = spark.createDataFrame([], "item_id bigint, kind string, feature string")
    model, vectors = em.content_model(items, none, 5)
    assert model.converged and [r["embedding"] for r in vectors.collect()] == [[]] * 3


def test_liked_twice_weighs_double(spark):
    vectors = spark.createDataFrame([(1, [3.0, 0.0]), (2, [0.0, 3.0])],
                                    "item_id bigint, embedding array<double>")
    likes = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "user_id bigint, item_id bigint")
    assert rc.user_profiles(likes, vectors).first()["vec"] == pytest.approx([2.0, 1.0])


def test_title_search_and_lookup(spark):
    items = scored(spark, [(3, "Blue Ring", 0.5, 1), (1, "ring", 0.5, 2), (2, "rod", 0.9, 3),
                           (4, "Blue Ring", 0.7, 4)])
    assert [r["item_id"] for r in rc.search_title(items, "RING", 2).collect()] == [4, 1]
    found = {r["title"]: r["item_id"] for r in rc.title_lookup(items).collect()}
    assert found["Blue Ring"] == 3


def test_negative_weights_are_refused(spark):
    with pytest.raises(ValueError):
        rc._settings([(0.5, 0.4, 0.1), (0.5, -0.1, 0.1)])
