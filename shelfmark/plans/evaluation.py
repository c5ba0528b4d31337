"""Evaluation of profile recommendations and the weight grid search."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.operators import metrics as mt
from shelfmark.operators.recommend import Weights, profile_relevant, recommend_profile
from shelfmark.session import cut

# Cut-offs of the evaluation table.
CUTOFFS = (1, 3, 5, 10, 20)

# Weight settings (content, popularity, penalty) of the grid search.
WEIGHT_GRID: tuple[Weights, ...] = (
    (0.6, 0.3, 0.1),
    (0.5, 0.4, 0.1),
    (0.4, 0.5, 0.1),
    (0.7, 0.2, 0.1),
    (0.5, 0.3, 0.2),
    (0.4, 0.4, 0.2),
    (0.3, 0.6, 0.1),
    (0.6, 0.2, 0.2),
    (0.5, 0.35, 0.15),
    (0.45, 0.45, 0.1),
)

def profile_table(spark: SparkSession, profiles: Mapping[str, Sequence[str]]) -> DataFrame:
    return spark.createDataFrame(
        [(name, tag) for name, tags in profiles.items() for tag in tags],
        "profile string, tag_id string")


def evaluation_table(recs: DataFrame, relevant: DataFrame, scored: DataFrame,
                     ks: Sequence[int] = CUTOFFS) -> DataFrame:
    """Metric records (setting, metric, k, value) averaged over the profiles.

    ``recs`` is keyed by setting and profile. MAP and hit rate use the largest cut-off;
    coverage and novelty use the full lists and have no cut-off.
    """
    top = max(ks)
    per_list = mt.list_metrics(recs, relevant, ks, ("setting", "profile"))
    means = per_list.groupBy("setting", "k").agg(*[
        F.avg(c).alias(c) for c in ("precision", "recall", "ndcg", "average_precision", "hit")])
    wanted = [F.struct(F.lit(name).alias("metric"), F.col(name).alias("value"),
                       F.lit(False).alias("top_only")) for name in ("precision", "recall", "ndcg")]
    wanted += [F.struct(F.lit(name).alias("metric"), F.col(c).alias("value"),
                        F.lit(True).alias("top_only"))
               for name, c in (("map", "average_precision"), ("hit_rate", "hit"))]
    long = means.select("setting", "k", F.explode(F.array(*wanted)).alias("x")).where(
        ~F.col("x.top_only") | (F.col("k") == top)).select(
        "setting", "x.metric", "k", "x.value")
    cover = mt.catalog_coverage(recs, scored, ["setting"]).select(
        "setting", F.lit("coverage").alias("metric"), F.lit(None).cast("int").alias("k"),
        F.col("coverage").alias("value"))
    novel = mt.novelty(recs, scored, ["setting"]).select(
        "setting", F.lit("novelty").alias("metric"), F.lit(None).cast("int").alias("k"),
        F.col("novelty").alias("value"))
    return long.unionByName(cover).unionByName(novel)


def evaluate_profiles(profiles: DataFrame, features: DataFrame, scored: DataFrame,
                      settings: Sequence[Weights], k: int = 20) -> DataFrame:
    """Recommend for every (setting, profile) in one plan and evaluate all lists together."""
    recs = cut(recommend_profile(profiles, features, scored, settings, k))
    return evaluation_table(recs, profile_relevant(profiles, features), scored)


def grid_search(profiles: DataFrame, features: DataFrame, scored: DataFrame,
                grid: Sequence[Weights] = WEIGHT_GRID, k: int = 20) -> DataFrame:
    """One row of metrics per weight setting, best NDCG@5 first.

    Features are built once; all settings share the joins and one ranking pass.
    """
    table = evaluate_profiles(profiles, features, scored, grid, k)

    def cell(metric: str, at: int | None, name: str):
        place = F.col("k").isNull() if at is None else F.col("k") == at
        return F.max(F.when((F.col("metric") == metric) & place, F.col("value"))).alias(name)

    cells = [cell(m, c, f"{m}_at_{c}") for c in CUTOFFS for m in ("precision", "recall", "ndcg")]
    cells += [cell("map", max(CUTOFFS), "map_at_20"),
              cell("hit_rate", max(CUTOFFS), "hit_rate_at_20"),
              cell("coverage", None, "coverage"), cell("novelty", None, "novelty")]
    weights = [F.array(*[F.lit(float(g[i])) for g in grid])[F.col("setting")].alias(n)
               for i, n in enumerate(("alpha", "beta", "gamma"))]
    wide = table.groupBy("setting").agg(*cells)
    return wide.select("setting", *weights, *[c for c in wide.columns if c != "setting"]).orderBy(
        F.round("ndcg_at_5", 9).desc(), "setting")
