"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from shelfmark.fixtures import derive_catalog
from shelfmark.functions import vectors as vec
from shelfmark.operators import (
    analytics as an, diagnostics as dg, embedding as em, experiments as ex, explain as xp,
    features as ft, lsh, metrics as mt, quality as ql, ranking as rk, recommend as rc, rerank as rr, title_search as ts)
from shelfmark.plans import evaluation as ev, features as pf
from shelfmark.session import cut, run_folder
from shelfmark.sources import export as xs, snapshots as sn
from shelfmark.sources.catalog import Catalog, load_catalog, query

DIGITS = 9

# All tags in the catalog, some of them, none of them (cold start).
PROFILES = {
    "P1": ("small", "gear", "promo"),
    "P2": ("red", "bolt", "no_such_tag"),
    "P3": ("no_such_tag",),
}

# The weight settings of the top-1 comparison.
TOP1_SETTINGS = ev.WEIGHT_GRID[:6]

_REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def registered(fn: Callable[[Catalog], DataFrame]) -> Callable[[Catalog], DataFrame]:
    """Register ``fn(catalog)`` under its name; doubles are rounded once, at the output."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(fn(derive_catalog(spark, sf_dir)))

    _REGISTRY[fn.__name__] = run
    return fn


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.round(f.name, DIGITS).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name) for f in df.schema.fields])


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_REGISTRY)


# Shared building blocks ------------------------------------------------------------------

def _spark(c: Catalog) -> SparkSession:
    return c.items.sparkSession


def _folder(c: Catalog, name: str) -> str:
    return run_folder(_spark(c), name)


def _profiles(c: Catalog) -> DataFrame:
    return ev.profile_table(_spark(c), PROFILES)


def _profile_lists(c: Catalog, k: int = 20):
    """Profile recommendations, their relevant sets, the scored items and the features."""
    scored, features = pf.build_scored(c), pf.build_binary(c)
    recs = cut(rc.recommend_profile(_profiles(c), features, scored, k=k)).drop("setting")
    return recs, rc.profile_relevant(_profiles(c), features), scored, features


def _hybrid(c: Catalog, k: int, **options):
    scored = pf.build_scored(c)
    _, vectors = pf.build_content_model(c, keep=False)
    return rc.recommend_hybrid(c.user_likes, scored, vectors, k=k, **options), scored, vectors


# Sources and sinks -----------------------------------------------------------------------

@registered
def export_table(c):
    root = _folder(c, "export")
    xs.export_table("items", c.items, root)
    return load_catalog(_spark(c), root)["items"]


EXPORTED = ("items", "item_tags", "tags", "item_platforms", "platforms", "categories", "signals",
            "dup_groups", "dup_candidates", "external_matches", "user_likes")


@registered
def export_manifest(c):
    manifest = xs.export_all({n: c[n] for n in EXPORTED}, _folder(c, "export"))
    return manifest.select("table_name", "row_count", "column_count")


@registered
def scan_counts(c):
    names = ("items", "signals", "item_platforms", "item_tags", "dup_groups", "dup_candidates",
             "external_matches")
    root = _folder(c, "export")
    for name in names:
        xs.export_table(name, c[name], root)
    stored = load_catalog(_spark(c), root)
    return an.row_counts({n: stored[n] for n in names})


@registered
def adhoc_tag_counts(c):
    c.register_views(["item_tags"])
    return query(_spark(c), "SELECT tag_id, count(*) AS cnt FROM item_tags "
                            "GROUP BY tag_id ORDER BY cnt DESC, tag_id")


@registered
def feature_matrix_roundtrip(c):
    scored = pf.build_scored(c)
    stored = xs.write_matrix(scored, _folder(c, "matrix") + "/feature_matrix.parquet")
    return stored.select("item_id", "title", "release_year", "data_confidence_score", "log_sales",
                         "popularity_score", "richness_score")


def bucketed_counts(matrix: DataFrame, item_tags: DataFrame) -> DataFrame:
    """Features of every item with the number of its tags; a join and a grouping by item_id."""
    tags = item_tags.groupBy("item_id").agg(F.count("*").alias("n_tags"))
    return matrix.join(tags, "item_id", "left").select(
        "item_id", "log_sales", "popularity_score", F.coalesce("n_tags", F.lit(0)).alias("n_tags"))


@registered
def feature_matrix_bucketed(c):
    """The matrix and the tags as tables bucketed by item, joined without a shuffle."""
    spark, root = _spark(c), _folder(c, "bucketed")
    schema = "matrix_" + root.rsplit("-", 1)[-1]
    sn.ensure_schema(spark, schema, root)
    matrix = xs.write_bucketed(pf.build_scored(c), f"{schema}.feature_matrix", buckets=8)
    item_tags = xs.write_bucketed(c.item_tags, f"{schema}.item_tags", buckets=8)
    joined = cut(bucketed_counts(matrix, item_tags))
    sn.drop_schema(spark, schema)
    return joined


@registered
def precomputed_items(c):
    items = xs.precomputed_items(c.vectors, pf.build_scored(c))
    return items.select(
        "item_id", "title", "popularity_score", "data_confidence_score", "richness_score",
        "release_year", F.size("tags").alias("n_tags"), F.size("platforms").alias("n_platforms"),
        "category_id", "cover_url", F.size("embedding").alias("dimensions"))


def _write_gaps(c: Catalog, scored: DataFrame, root: str) -> DataFrame:
    gaps = dg.quality_gaps(c.items, c.item_tags, c.item_platforms, scored)
    return sn.write_diagnostics("quality_gaps", gaps, root)


def _gap_text(df: DataFrame) -> DataFrame:
    return df.select(
        "item_id", "title", "missing_issues", "data_confidence_score",
        F.round(F.col("popularity_score").cast("double"), 6).alias("popularity_score"))


@registered
def snapshot_flatten(c):
    return _gap_text(sn.flatten(_write_gaps(c, pf.build_scored(c), _folder(c, "diagnostics"))))


@registered
def snapshot_roundtrip(c):
    root, snapshots = _folder(c, "diagnostics"), _folder(c, "snapshots")
    _write_gaps(c, pf.build_scored(c), root)
    sn.take_snapshot(_spark(c), root, snapshots, "s1")
    return _gap_text(sn.read_snapshot(_spark(c), snapshots, "quality_gaps", "s1"))


@registered
def snapshot_summary(c):
    # key_metrics is left out on purpose: it must show up with its error.
    root, scored = _folder(c, "diagnostics"), pf.build_scored(c)
    _write_gaps(c, scored, root)
    sn.write_diagnostics("duplicate_groups", dg.duplicate_groups(c.dup_groups), root)
    sn.write_diagnostics("external_matches", dg.external_matches(c.external_matches), root)
    sn.write_diagnostics("low_confidence_priorities", dg.low_confidence_priorities(scored), root)
    summary = sn.take_snapshot(_spark(c), root, _folder(c, "snapshots"), "s1")
    return summary.select(
        "table_name", "row_count",
        F.coalesce(F.array_size("column_names"), F.lit(0)).alias("column_count"),
        F.col("error").isNotNull().alias("failed"))


# SQL analytics ---------------------------------------------------------------------------

@registered
def items_by_year(c):
    return an.items_by_year(c.items)


@registered
def top_platforms(c):
    return an.top_platforms(c.item_platforms, c.platforms)


@registered
def avg_confidence_by_category(c):
    return an.avg_confidence_by_category(c.signals, c.items, c.categories)


@registered
def ranked_items_by_platform(c):
    return an.ranked_items_by_platform(c.items, c.item_platforms, c.platforms, c.signals)


@registered
def coverage_pivot(c):
    return an.coverage_pivot(c.items)


@registered
def duplicate_summary(c):
    return an.duplicate_summary(c.dup_groups)


@registered
def tag_rolling_rows(c):
    return an.tag_rolling_rows(c.item_tags, c.items)


@registered
def tag_rolling_years(c):
    return an.tag_rolling_years(c.item_tags, c.items)


@registered
def approx_tag_diversity(c):
    counts = an.approx_tag_diversity(c.item_tags)
    off = F.abs(F.col("approx_item_count") - F.col("exact_item_count"))
    return counts.select("tag_id", "exact_item_count",
                         (off <= F.col("exact_item_count") * 0.15).alias("within_tol"))


@registered
def tag_diversity_merged(c):
    """Items per tag over two overlapping parts of the catalog, each seen once, against the exact count."""
    parts = ((c.items.source_type == "catalog"), (c.items.release_state == "released"))
    sketches = None
    for part in parts:
        stored = cut(an.tag_sketches(c.item_tags.join(c.items.where(part).select("item_id"), "item_id")))
        sketches = stored if sketches is None else sketches.unionByName(stored)
    exact = c.item_tags.join(c.items.where(parts[0] | parts[1]).select("item_id"), "item_id") \
        .distinct().groupBy("tag_id").agg(F.count("*").alias("exact_item_count"))
    off = F.abs(F.col("approx_item_count") - F.col("exact_item_count"))
    return an.merged_tag_diversity(sketches).join(exact, "tag_id", "full").select(
        "tag_id", "n_parts", "exact_item_count",
        (off <= F.col("exact_item_count") * 0.1).alias("within_tol"))


# Quality audit ---------------------------------------------------------------------------

@registered
def coverage_analysis(c):
    return ql.coverage_analysis(ql.with_tag_list(c.items, c.item_tags))


@registered
def tags_per_item(c):
    return ql.tags_per_item(ql.with_tag_list(c.items, c.item_tags))


@registered
def source_distribution(c):
    return ql.distribution(c.items, "source_type")


@registered
def release_state_distribution(c):
    return ql.distribution(c.items, "release_state")


@registered
def signal_quality(c):
    return ql.signal_quality(c.signals)


@registered
def duplicate_analysis(c):
    return ql.duplicate_analysis(c.dup_groups, c.dup_candidates)


@registered
def dup_status_distribution(c):
    return ql.distribution(c.dup_groups, "status")


@registered
def dup_review_distribution(c):
    return ql.distribution(c.dup_groups, "suggested_review")


@registered
def external_match_analysis(c):
    return ql.external_match_analysis(c.external_matches)


@registered
def match_status_distribution(c):
    return ql.distribution(c.external_matches, "status")


@registered
def match_source_distribution(c):
    return ql.distribution(c.external_matches, "source")


@registered
def presence_split(c):
    return ql.presence_split(c.signals)


@registered
def coverage_buckets(c):
    return ql.coverage_buckets(c.items, c.signals)


@registered
def confidence_histogram(c):
    return ql.histogram(c.signals, "data_confidence_score", 50)


@registered
def confidence_histogram_40(c):
    return ql.histogram(c.signals, "data_confidence_score", 40)


@registered
def popularity_histogram(c):
    return ql.histogram(pf.build_scored(c), "popularity_score", 50)


@registered
def popularity_confidence_bins(c):
    return ql.popularity_confidence_bins(pf.build_scored(c))


@registered
def segment_coverage(c):
    recs, _, scored, _ = _profile_lists(c)
    return ql.segment_coverage(scored, recs)


# Features --------------------------------------------------------------------------------

@registered
def valid_item_tags(c):
    return ft.valid_item_tags(c.item_tags, c.tags)


@registered
def feature_matrix(c):
    return pf.build_scored(c).drop("popularity_score", "richness_score")


@registered
def feature_matrix_wide(c):
    scored, features = pf.build_scored(c), pf.build_binary(c)
    return ft.wide_matrix(c.items, scored.drop("title"), features).drop(
        "category_id", *ft.SIGNAL_COLUMNS)


@registered
def tag_onehot(c):
    return ft.one_hot(pf.build_binary(c), "tag")


@registered
def platform_onehot(c):
    return ft.one_hot(pf.build_binary(c), "platform")


@registered
def top_tags(c):
    return ft.top_features(ft.binary_features(c.item_tags, c.tags, c.item_platforms), "tag", 20)


@registered
def feature_prefix_filter(c):
    features = ft.binary_features(c.item_tags, c.tags, c.item_platforms)
    return ft.features_with_prefix(features, ["NATION_1", "re", "s"])


@registered
def feature_kind_counts(c):
    return ft.feature_kind_counts(ft.binary_features(c.item_tags, c.tags, c.item_platforms))


@registered
def popularity_score(c):
    return pf.build_scored(c).select("item_id", "popularity_score")


@registered
def richness_score(c):
    return pf.build_scored(c).select("item_id", "richness_score")


@registered
def feature_cooccurrence(c):
    features = pf.build_binary(c)
    index = em.feature_index(features)
    return em.cooccurrence(em.feature_sets(features, index), index)


@registered
def svd_embedding(c):
    _, vectors = pf.build_content_model(c)
    return vectors.select("item_id", F.size("embedding").alias("dimensions"),
                          F.round(vec.dot("embedding", "embedding"), 6).alias("squared_norm"))


@registered
def svd_explained_variance(c):
    model, vectors = pf.build_content_model(c)
    return em.explained_variance(vectors, model, c.items.count())


@registered
def svd_variance_total(c):
    model, vectors = pf.build_content_model(c)
    return em.explained_variance(vectors, model, c.items.count()).agg(
        F.count("*").alias("n_components"), F.round(F.sum("variance"), 6).alias("variance"),
        F.round(F.sum("explained_ratio"), 6).alias("explained_ratio"))


@registered
def svd_truncated(c):
    """16 of 44 components: how well they are eigenvectors, and what they leave out of the matrix."""
    features = pf.build_binary(c)
    index = em.feature_index(features)
    sets = cut(em.feature_sets(features, index))
    model = em.fit_svd(sets, index, 16)
    share = float((model.singular_values ** 2).sum())
    entries = features.agg(F.count("*").alias("entries")).scalar()
    return em.residuals(sets, model).agg(
        F.count("*").alias("n_components"), (F.max("residual") <= 1e-8).alias("are_eigenvectors")).select(
        "n_components", "are_eigenvectors", F.lit(model.converged).alias("converged"),
        entries.alias("entries"), (F.lit(share) <= entries).alias("at_most_the_matrix"))


# Similarity and recommendation -----------------------------------------------------------

@registered
def pair_similarity(c):
    pairs = c.vectors.select(F.col("item_id").alias("item_a"),
                             (F.col("item_id") + 1).alias("item_b"))
    return vec.pair_similarity(pairs, c.vectors)


@registered
def similar_items(c):
    _, vectors = pf.build_content_model(c, keep=False)
    return rc.similar_items(vectors, 20)


@registered
def similar_items_lsh(c):
    """The table form against the exact one: share found, share of the pairs scored in full."""
    _, vectors = pf.build_content_model(c)
    found, cost = lsh.similar_items_lsh(vectors, 20)
    exact = cut(rc.similar_items(vectors, 20))
    recall = lsh.list_recall(cut(found), exact).scalar()
    return cost.select(
        exact.agg(F.count("*")).scalar().alias("n_rows"), (recall >= 0.95).alias("recall_at_least_95"),
        (10 * F.col("pairs_scored") <= F.col("pairs")).alias("scored_at_most_a_tenth"))


@registered
def liked_profile_scores(c):
    _, vectors = pf.build_content_model(c)
    profiles = rc.user_profiles(cut(c.user_likes), vectors)
    pairs = c.user_exclusions  # items the user knows but did not like
    return rc.liked_profile_scores(profiles, pairs, vectors)


@registered
def recommend_hybrid(c):
    recs, _, _ = _hybrid(c, 20, excluded=c.user_exclusions)
    return recs.drop("setting")


@registered
def recommend_cold_start(c):
    return rc.recommend_cold_start(c.users, pf.build_scored(c), 20, c.user_exclusions)


@registered
def recommend_users(c):
    scored = pf.build_scored(c)
    _, vectors = pf.build_content_model(c, keep=False)
    return rc.recommend_users(c.users, c.user_likes, scored, vectors, k=5)


@registered
def recommend_profile(c):
    scored, features = pf.build_scored(c), pf.build_binary(c)
    return rc.recommend_profile(_profiles(c), features, scored).drop("setting")


@registered
def weights_top1(c):
    recs, _, _ = _hybrid(c, 1, settings=TOP1_SETTINGS)
    return recs.select("setting", "user_id", "item_id", "final_score")


@registered
def mmr_rerank(c):
    recs, _, vectors = _hybrid(c, 10)
    picked = rr.mmr_rerank(recs, vectors, k=3, lam=0.5, key="user_id")
    return picked.select("user_id", "rank", "item_id", "final_score")


@registered
def mmr_rerank_full(c):
    recs, _, vectors = _hybrid(c, 20)
    return rr.mmr_rerank(recs, vectors, k=20, lam=0.3, key="user_id")


@registered
def search_title(c):
    return rc.search_title(pf.build_scored(c), "RING")


@registered
def search_title_indexed(c):
    """The same search through the posting table."""
    scored = cut(pf.build_scored(c).select("item_id", "title", "popularity_score", "data_confidence_score"))
    index = ts.build(scored, _folder(c, "titles"))
    return rc.search_title(ts.search(index, "RING").join(scored.drop("title"), "item_id"), "RING")


@registered
def search_tags_in_titles(c):
    """Every tag searched in all titles at once: its ten most popular items."""
    scored = cut(pf.build_scored(c).select("item_id", "title", "popularity_score"))
    texts = c.tags.select(F.col("tag_id").alias("query"), F.col("tag_id").alias("text"))
    return ts.search_all(ts.build(scored, _folder(c, "titles")), texts, scored).withColumnRenamed(
        "query", "tag_id")


@registered
def title_lookup(c):
    return rc.title_lookup(c.items)


@registered
def score_progress(c):
    recs, _, _ = _hybrid(c, 5)
    return rc.score_progress(recs)


# Learning to rank ------------------------------------------------------------------------

@registered
def rank_labels(c):
    return rk.rank_labels(pf.build_scored(c)).select("item_id", "label")


@registered
def query_groups(c):
    return rk.query_groups(c.items, c.item_platforms)


@registered
def group_split(c):
    return rk.group_split(rk.query_groups(c.items, c.item_platforms))


@registered
def grouped_ndcg(c):
    labelled = rk.rank_labels(pf.build_scored(c))
    rows = labelled.join(rk.query_groups(c.items, c.item_platforms), "item_id")
    return rk.grouped_ndcg(rows, "richness_score")


def _ranked(c: Catalog):
    """Rows with rank_score, the scored items with it, and the number of training pairs' steps."""
    scored = pf.build_scored(c)
    rows, sets, n_features = pf.ranker_rows(c, scored, pf.build_binary(c))
    model = rk.train_pair_ranker(rows.where("side = 'train'"), n_features)
    scores = cut(rk.pair_scores(model, c.items, sets))
    return rows.join(scores, "item_id"), scored.join(scores, "item_id")


def _rank_lists(c: Catalog) -> DataFrame:
    _, ranked = _ranked(c)
    by_rank = ranked.withColumn("popularity_score", F.col("rank_score"))
    return rc.recommend_cold_start(c.users, by_rank, 20, c.user_likes).drop(
        "content_score", "popularity_score", "confidence_penalty")


@registered
def rank_model_topk(c):
    """The ranker's 20 best items for every user, without the user's likes."""
    return _rank_lists(c)


@registered
def rank_model_lists(c):
    """What must hold for the ranker's lists: all users, full lists, nothing liked, scores descending."""
    lists = cut(_rank_lists(c))
    liked = lists.join(c.user_likes, ["user_id", "item_id"], "left_semi").agg(F.count("*")).scalar()
    steps = W.partitionBy("user_id").orderBy("rank")
    per_user = lists.withColumn("falls", F.coalesce(
        F.col("final_score") <= F.lag("final_score").over(steps), F.lit(True))).groupBy("user_id").agg(
        F.count("*").alias("n"), F.bool_and("falls").alias("falls"))
    return per_user.agg(F.count("*").alias("n_users"), F.sum("n").alias("n_rows"), F.bool_and("falls").alias(
        "descending")).select("n_users", "n_rows", "descending", liked.alias("n_liked"))


@registered
def ranker_comparison(c):
    """Mean grouped NDCG on the validation groups, against a score that is the same for all items."""
    ranked, scored = _ranked(c)
    rows = cut(ranked.where("side = 'validation'").join(
        scored.select("item_id", "popularity_score"), "item_id").withColumn("constant", F.lit(0.0)))

    def mean(score: str):
        return rk.grouped_ndcg(rows, score).agg(F.avg("ndcg"))

    constant = mean("constant").scalar()
    return mean("rank_score").select(F.lit("rank model").alias("ranker"), F.col("avg(ndcg)").alias("ndcg")).unionByName(
        mean("popularity_score").select(F.lit("popularity").alias("ranker"), F.col("avg(ndcg)").alias("ndcg"))).select(
        "ranker", (F.col("ndcg") > constant).alias("above_constant"))


# Offline evaluation ----------------------------------------------------------------------

@registered
def profile_relevant(c):
    features = ft.binary_features(c.item_tags, c.tags, c.item_platforms)
    return rc.profile_relevant(_profiles(c), features)


@registered
def profile_counts(c):
    recs, relevant, _, _ = _profile_lists(c)
    return mt.set_counts(recs, relevant, "profile")


@registered
def precision_at_k(c):
    recs, relevant, _, _ = _profile_lists(c)
    return mt.precision_at_k(recs, relevant, 5, ("profile",))


@registered
def recall_at_k(c):
    recs, relevant, _, _ = _profile_lists(c)
    return mt.recall_at_k(recs, relevant, 5, ("profile",))


@registered
def ndcg_at_k(c):
    recs, relevant, _, _ = _profile_lists(c)
    return mt.ndcg_at_k(recs, relevant, 10, ("profile",))


@registered
def map_at_k(c):
    recs, relevant, _, _ = _profile_lists(c)
    return mt.map_at_k(recs, relevant, 20, ("profile",))


@registered
def hit_rate_at_k(c):
    recs, relevant, _, _ = _profile_lists(c)
    return mt.hit_rate_at_k(recs, relevant, 20, ("profile",))


@registered
def user_list_metrics(c):
    """Metrics of popularity lists against what the users really liked."""
    scored = pf.build_scored(c)
    likers = c.user_likes.select("user_id").distinct()
    recs = rc.recommend_cold_start(likers, scored, 20, c.user_exclusions)
    return mt.list_metrics(recs, c.user_likes, [1, 5, 20], ("user_id",))


def _held_out(c: Catalog, settings):
    """Lists for users by the likes that were kept, and the likes that were held out."""
    kept, held = mt.hold_out_likes(c.user_likes)
    scored = pf.build_scored(c)
    _, vectors = pf.build_content_model(c, keep=False)
    recs = rc.recommend_hybrid(kept, scored, vectors, settings, k=20)
    return cut(recs.select("setting", "user_id", "rank", "item_id")), held


@registered
def holdout_metrics(c):
    """Hybrid lists against likes they have not seen."""
    recs, held = _held_out(c, (rc.DEFAULT_WEIGHTS,))
    return mt.mean_metrics(mt.list_metrics(recs.drop("setting"), held, [5, 10, 20], ("user_id",)))


@registered
def ab_user_variants(c):
    """Two weight settings compared per user, on the NDCG@20 of held-out likes."""
    recs, held = _held_out(c, ((0.5, 0.4, 0.1), (0.7, 0.2, 0.1)))
    a, b = (mt.ndcg_at_k(recs.where(F.col("setting") == i).drop("setting"), held, 20, ("user_id",)) for i in (0, 1))
    return ex.ab_summary(ex.variants_by_unit(a, b, "ndcg"))


@registered
def catalog_coverage(c):
    recs, _, scored, _ = _profile_lists(c)
    each = mt.catalog_coverage(recs, scored, ["profile"])
    both = mt.catalog_coverage(recs, scored).withColumn("profile", F.lit("combined"))
    return each.unionByName(both)


@registered
def novelty(c):
    recs, _, scored, _ = _profile_lists(c)
    each = mt.novelty(recs, scored, ["profile"])
    return each.unionByName(mt.novelty(recs, scored).withColumn("profile", F.lit("combined")))


@registered
def intra_list_similarity(c):
    recs, _, _, features = _profile_lists(c)
    _, vectors = em.content_model(c.items, features)
    return mt.intra_list_similarity(recs, vectors, ("profile",))


@registered
def diversity(c):
    recs, _, _, features = _profile_lists(c)
    _, vectors = em.content_model(c.items, features)
    vectors = cut(vectors)
    full = mt.diversity(recs, vectors, ("profile",)).select(
        F.lit("full list").alias("scope"), "diversity")
    return full.unionByName(mt.diversity(recs, vectors, ("profile",), 5).select(
        F.lit("first 5").alias("scope"), "diversity"))


@registered
def evaluation_table(c):
    scored, features = pf.build_scored(c), pf.build_binary(c)
    return ev.evaluate_profiles(_profiles(c), features, scored, [rc.DEFAULT_WEIGHTS]).drop(
        "setting")


# Experiments -----------------------------------------------------------------------------

def _grid(c: Catalog):
    scored, features = pf.build_scored(c), pf.build_binary(c)
    return ev.grid_search(_profiles(c), features, scored), scored


GRID_METRICS = ["precision_at_5", "ndcg_at_5", "map_at_20", "coverage", "novelty"]


@registered
def grid_search(c):
    return _grid(c)[0].select("setting", "alpha", "beta", "gamma", *GRID_METRICS)


@registered
def experiment_runs(c):
    return ex.experiment_runs(_grid(c)[0], "setting", ["alpha", "beta", "gamma"], GRID_METRICS)


@registered
def ab_summary(c):
    return ex.ab_summary(c.ab_units)


@registered
def ab_ztest(c):
    return ex.ab_ztest(c.ab_units)


@registered
def ab_bootstrap_ci(c):
    return ex.ab_bootstrap_ci(c.ab_units)


@registered
def ab_variants(c):
    """Two weight settings compared on the per-profile NDCG@10."""
    scored, features = pf.build_scored(c), pf.build_binary(c)
    recs = cut(rc.recommend_profile(
        _profiles(c), features, scored, [(0.5, 0.4, 0.1), (0.7, 0.2, 0.1)]))
    ndcg = mt.ndcg_at_k(recs, rc.profile_relevant(_profiles(c), features), 10,
                        ("setting", "profile"))
    units = ex.pair_units(ndcg.where("setting = 0"), ndcg.where("setting = 1"), "profile", "ndcg")
    return ex.ab_summary(units)


# Explanation -----------------------------------------------------------------------------

@registered
def explain_rules(c):
    recs, _, _ = _hybrid(c, 5)
    return xp.explain_rules(recs).select("user_id", "rank", "item_id", "explanation")


@registered
def template_text(c):
    recs, _, _ = _hybrid(c, 5)
    return xp.template_text(recs).select("user_id", "rank", "item_id", "explanation")


@registered
def item_details(c):
    details = xp.item_details(c.items, c.item_platforms, c.platforms)
    return details.withColumn("platforms", F.array_join("platforms", ", "))


@registered
def explanation_prompts(c):
    recs, _, _ = _hybrid(c, 5)
    recs = cut(recs)
    details = xp.item_details(c.items, c.item_platforms, c.platforms, recs)
    return xp.explanation_prompts(recs, details).select("user_id", "rank", "item_id", "prompt")


@registered
def explanation_compare(c):
    recs, _, _ = _hybrid(c, 5)
    texts = xp.explain_rules(recs).withColumnRenamed("explanation", "rule")
    texts = xp.template_text(texts).withColumnRenamed("explanation", "template")
    return xp.explanation_compare(texts, "rule", "template").select(
        "user_id", "rank", "item_id", "a_chars", "b_chars", "b_is_longer")


# Diagnostics -----------------------------------------------------------------------------

@registered
def table_summary(c):
    """Diagnostics tables saved in a schema of their own, listed with exact row counts."""
    spark = _spark(c)
    root = _folder(c, "schema")
    schema = "diagnostics_" + root.rsplit("-", 1)[-1]
    sn.ensure_schema(spark, schema, root)
    scored = pf.build_scored(c)
    for name, rows in (("quality_gaps", dg.quality_gaps(c.items, c.item_tags, c.item_platforms, scored)),
                       ("low_confidence_priorities", dg.low_confidence_priorities(scored))):
        sn.save_table(name, rows, schema)
    listed = sn.table_summary(spark, schema)
    sn.drop_schema(spark, schema)
    return listed


@registered
def quality_gaps(c):
    gaps = dg.quality_gaps(c.items, c.item_tags, c.item_platforms, pf.build_scored(c))
    return gaps.withColumn("missing_issues", F.array_join("missing_issues", ","))


@registered
def diag_duplicate_groups(c):
    return dg.duplicate_groups(c.dup_groups)


@registered
def diag_external_matches(c):
    return dg.external_matches(c.external_matches)


@registered
def low_confidence_priorities(c):
    return dg.low_confidence_priorities(pf.build_scored(c))


@registered
def key_metrics(c):
    grid, scored = _grid(c)
    model, _ = pf.build_content_model(c)
    return dg.key_metrics(grid, scored, len(model.singular_values))


@registered
def snapshot_diff(c):
    """Two snapshots: as derived, then with every tenth item categorised and fewer items of
    low confidence."""
    spark, snapshots, scored = _spark(c), _folder(c, "snapshots"), pf.build_scored(c)
    fixed = F.when(F.col("item_id") % 10 == 0, F.lit("OTHER")).otherwise(F.col("category_id"))
    for name, items, low in (
            ("s1", c.items, scored),
            ("s2", c.items.withColumn("category_id", fixed), scored.where("item_id % 7 <> 0"))):
        root = _folder(c, "diagnostics")
        sn.write_diagnostics("quality_gaps", dg.quality_gaps(
            items, c.item_tags, c.item_platforms, scored), root)
        sn.write_diagnostics("low_confidence_priorities", dg.low_confidence_priorities(low), root)
        sn.take_snapshot(spark, root, snapshots, name)
    return sn.diff_latest(spark, snapshots)
