"""Build of the scored feature matrix, computed once and reused by the later steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfmark.operators import embedding as em, features as ft, ranking as rk
from shelfmark.session import cut
from shelfmark.sources.catalog import Catalog


def build_scored(catalog: Catalog) -> DataFrame:
    """Scored numeric features. The join of items and signals is materialised once: the
    median jobs and everything built on the scores then read that, not the sources."""
    joined = cut(ft.join_signals(catalog.items, catalog.signals))
    return ft.with_scores(ft.impute(joined, ft.exact_medians(joined, ft.MEDIAN_FILLED)))


def build_binary(catalog: Catalog) -> DataFrame:
    """Long binary features, materialised once."""
    return cut(_binary(catalog))


def _binary(catalog: Catalog) -> DataFrame:
    return ft.binary_features(catalog.item_tags, catalog.tags, catalog.item_platforms)


def build_content_model(catalog: Catalog, n_components: int = 100, keep: bool = True):
    """The SVD model and the table of item embeddings: stored, or, without ``keep``, made again from the stored
    feature sets wherever it is read, if every task can have the model."""
    model, vectors = em.content_model(catalog.items, _binary(catalog), n_components)
    return model, vectors if not keep and em.fits_tasks(model) else cut(vectors)


def ranker_rows(catalog: Catalog, scored: DataFrame, features: DataFrame):
    """Labelled rows of the ranker (query_group, side, item_id, label, idxs), the items' feature
    sets and the number of features.

    The inputs are the binary features as arrays of numbers, however many there are. The label is
    made of popularity, which is no input.
    """
    index = em.feature_index(features)
    sets = cut(em.feature_sets(features, index))
    groups = rk.query_groups(catalog.items, catalog.item_platforms)
    labelled = rk.rank_labels(scored).select("item_id", "label").join(groups, "item_id").join(
        rk.group_split(groups).select("query_group", "side"), "query_group")
    rows = labelled.join(sets, "item_id", "left").withColumn(
        "idxs", F.coalesce("idxs", F.array().cast("array<bigint>")))
    return cut(rows), sets, index.count()
