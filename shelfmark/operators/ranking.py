"""Learning to rank: labels, query groups, split, model and grouped NDCG."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shelfmark.functions.vectors import vector_sum
from shelfmark.session import cut

BUCKET_ITEMS = 1024    # items of a group that one row holds; a group of one row is compared pair by pair
CELL = 1.0             # width of a cell of scores
NODES = 16             # points of a cell: the logistic curve is analytic up to pi away, the error 12.6 ** -16

def rank_labels(scored: DataFrame) -> DataFrame:
    """Relevance 0..4: floor of four times the min-max scaled popularity; constant gives 0."""
    edges = scored.agg(F.struct(F.min("popularity_score").alias("lo"),
                                F.max("popularity_score").alias("hi")))
    share = F.try_divide(F.col("popularity_score") - F.col("e.lo"), F.col("e.hi") - F.col("e.lo"))
    return scored.withColumn("e", edges.scalar()).withColumn(
        "label", F.coalesce(F.floor(share * 4), F.lit(0)).cast("int")).drop("e")


def query_groups(items: DataFrame, item_platforms: DataFrame) -> DataFrame:
    """Group of an item: its first platform in id order, ``none`` without any."""
    first = item_platforms.groupBy("item_id").agg(F.min("platform_id").alias("query_group"))
    return items.select("item_id").join(first, "item_id", "left").select(
        "item_id", F.coalesce("query_group", F.lit("none")).alias("query_group"))


def group_split(grouped: DataFrame, train_share: float = 0.8) -> DataFrame:
    """Whole groups, in name order, go to training while they fit into the share.

    The running sum is over one row per group (a platform), not over the items.
    """
    sizes = grouped.groupBy("query_group").agg(F.count("*").alias("group_size"))
    running = W.orderBy("query_group").rowsBetween(W.unboundedPreceding, 0)
    total = W.partitionBy()
    limit = F.floor(F.sum("group_size").over(total) * F.lit(train_share))
    return sizes.select(
        "query_group", "group_size",
        F.when(F.sum("group_size").over(running) <= limit, "train").otherwise("validation")
        .alias("side"))


def pair_buckets(rows: DataFrame, size: int = BUCKET_ITEMS, seed: int = 42) -> DataFrame:
    """Stored random buckets of about ``size`` items of one query group: labels and feature arrays.

    ``rows``: query_group, item_id, label, idxs. A group of any size becomes ``buckets`` rows, so that no row
    grows with its group. All pairs of a group count, whatever its buckets: see ``pair_gradient``.
    """
    sizes = rows.groupBy("query_group").agg(
        F.greatest(F.lit(1), F.round(F.count("*") / size)).cast("int").alias("buckets"))
    dealt = rows.join(sizes, "query_group").withColumn(
        "bucket", F.pmod(F.xxhash64("item_id", F.lit(seed)), F.col("buckets")))
    return cut(dealt.groupBy("query_group", "bucket").agg(
        F.first("buckets").alias("buckets"),
        F.collect_list("label").alias("labels"), F.collect_list("idxs").alias("inputs")))


def _points() -> np.ndarray:
    """The Chebyshev points of a cell, as shares of its width."""
    return (1 + np.cos((np.arange(NODES) + 0.5) * np.pi / NODES)) / 2


def _placed(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell of every score and the share that each point of the cell has in it (rows add up to 1): a smooth
    function at the score is the sum of its values at the points by these shares."""
    cell = np.floor(score / CELL)
    powers = np.arange(NODES)
    at = np.cos(powers * np.arccos(np.clip(2 * (score / CELL - cell) - 1, -1, 1))[:, None])
    points = np.cos(powers[:, None] * (powers + 0.5) * np.pi / NODES)
    return cell.astype(np.int64), at @ (points * np.where(powers > 0, 2, 1)[:, None] / NODES)


def _bucket_items(own: np.ndarray, labels, inputs):
    """Labels of a bucket's items, their scores, and the flat feature numbers with the item of each."""
    size = np.asarray(inputs.values.value_lengths())
    flat = np.asarray(inputs.values.flatten())
    of = np.repeat(np.arange(len(size)), size)
    return np.asarray(labels.values), np.bincount(of, own[flat], len(size)), flat, of


def _masses(weights):
    """Per group, label and cell the number of items and the sum of their shares of the points, of a task."""
    def run(batches):
        found = {}
        for batch in batches:
            for group, labels, inputs in zip(batch.column("query_group"), batch.column("labels"), batch.column("inputs")):
                label, score, _, _ = _bucket_items(weights.value, labels, inputs)
                known = ~np.isnan(label.astype(float))
                cell, share = _placed(score[known])
                for name in np.unique(label[known]):
                    mine = label[known] == name
                    cells, at = np.unique(cell[mine], return_inverse=True)
                    counts, sums = np.bincount(at), np.zeros((len(cells), NODES))
                    np.add.at(sums, at, share[mine])
                    for c, n, mass in zip(cells.tolist(), counts.tolist(), sums):
                        before = found.get((group.as_py(), float(name), c), (0, 0.0))
                        found[group.as_py(), float(name), c] = before[0] + n, before[1] + mass
        if found:
            groups, names, cells = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(groups, pa.string()), pa.array(names), pa.array(cells), pa.array([n for n, _ in found.values()]),
                 pa.array([mass for _, mass in found.values()], pa.list_(pa.float64()))],
                ["query_group", "label", "cell", "n", "mass"])
    return run


def _field(rows) -> tuple[tuple, float, int]:
    """What all items of a large group do to one of them, as a function of its label and score; loss and pairs.

    ``rows``: label, cell, n, mass. The function (labels, cells, values at the points) is what ``_pair_gradient``
    calls pull: the sum over better items of the chance that it is ahead of them, less that over worse
    items that they are ahead of it.
    """
    labels, cells = (np.unique([r[c] for r in rows]) for c in ("label", "cell"))
    mass, counts = np.zeros((len(labels), len(cells), NODES)), [0] * len(labels)
    for r in rows:
        i = int(np.searchsorted(labels, r["label"]))
        mass[i, np.searchsorted(cells, r["cell"])] = r["mass"]
        counts[i] += r["n"]
    points = ((cells[:, None] + _points()) * CELL).ravel()
    mass = mass.reshape(len(labels), -1)
    below = np.cumsum(mass, axis=0) - mass
    above = mass.sum(axis=0) - mass - below
    pull, loss = np.zeros(mass.shape), 0.0
    for at in range(0, len(points), 512):
        gap = points[at:at + 512, None] - points[None, :]
        ahead = 1 / (1 + np.exp(np.clip(-gap, -50, 50)))
        pull[:, at:at + 512] = above @ ahead.T - below @ (1 - ahead).T
        loss += float((mass[:, at:at + 512] * (below @ np.logaddexp(0, -gap).T)).sum())
    pairs = sum(n * sum(counts[:i]) for i, n in enumerate(counts))
    return (labels, cells, pull.reshape(len(labels), len(cells), NODES)), loss, pairs


def _pair_gradient(weights, fields=None):
    """Loss and gradient of the pairs of every bucket, one row per task; the items of a group in ``fields`` take
    theirs from there, and its loss and pairs are counted elsewhere."""
    def run(batches):
        own, known = weights.value, fields.value if fields is not None else {}
        loss, pairs, gradient = 0.0, 0, np.zeros(len(own))
        for batch in batches:
            groups = batch.column("query_group").to_pylist() if known else [None] * batch.num_rows
            for group, labels, inputs in zip(groups, batch.column("labels"), batch.column("inputs")):
                label, score, flat, of = _bucket_items(own, labels, inputs)
                if group in known:
                    names, cells, values = known[group]
                    cell, share = _placed(score)
                    real = ~np.isnan(label.astype(float))
                    pull = np.zeros(len(label))
                    pull[real] = np.einsum("np,np->n", share[real], values[
                        np.searchsorted(names, label[real]), np.searchsorted(cells, cell[real])])
                else:
                    better = label[:, None] > label[None, :]
                    gap = np.clip(score[:, None] - score[None, :], -50, 50)
                    loss += np.logaddexp(0, -gap)[better].sum()
                    push = np.where(better, 1 / (1 + np.exp(gap)), 0)
                    pull = push.sum(0) - push.sum(1)          # of each item's score
                    pairs += int(better.sum())
                gradient += np.bincount(flat, pull[of], len(own))
        yield pa.RecordBatch.from_pydict({"loss": [loss], "pairs": [pairs], "gradient": [gradient]})
    return run


def pair_gradient(buckets: DataFrame, weights: np.ndarray, large: bool = True) -> tuple[float, int, np.ndarray]:
    """Loss, number and gradient of all pairs of different labels inside the groups of ``pair_buckets``.

    A group of one bucket is compared pair by pair. In a larger one the sum over its items is a smooth
    function of the score, one per label: it is made of the items' shares of the points of ``CELL`` wide cells and
    read at the points around each item, to the rounding of doubles. So the work grows with the items, not
    with the pairs, and no pair is left out. The driver holds labels x cells x ``NODES`` numbers of each large group.
    Without ``large`` there is no such group, and no pass for it.
    """
    context = buckets.sparkSession.sparkContext
    shared = context.broadcast(weights)      # n_features numbers
    masses = buckets.where("buckets > 1").mapInArrow(
        _masses(shared), "query_group string, label double, cell long, n long, mass array<double>").groupBy(
        "query_group", "label", "cell").agg(
        F.sum("n").alias("n"), vector_sum("mass").alias("mass")).collect() if large else []
    by_group, fields, loss, pairs = {}, {}, 0.0, 0
    for r in masses:
        by_group.setdefault(r["query_group"], []).append(r)
    for group, rows in by_group.items():
        fields[group], more, n = _field(rows)
        loss, pairs = loss + more, pairs + n
    fields = context.broadcast(fields)
    found = buckets.mapInArrow(
        _pair_gradient(shared, fields), "loss double, pairs long, gradient array<double>").agg(
        F.sum("loss").alias("loss"), F.sum("pairs").alias("pairs"), vector_sum("gradient").alias("gradient")).first()
    for sent in (shared, fields):
        sent.unpersist()
    gradient = np.zeros(len(weights)) if found["gradient"] is None else np.array(found["gradient"])
    return loss + (found["loss"] or 0.0), pairs + (found["pairs"] or 0), gradient


@dataclass
class PairRanker:
    """A linear score over the features; ``losses`` is the mean loss of a pair before each step."""
    weights: np.ndarray
    losses: list[float]


def train_pair_ranker(rows: DataFrame, n_features: int, steps: int = 25, rate: float = 0.3,
                      decay: float = 1e-4) -> PairRanker:
    """Pairwise logistic loss over all pairs inside query groups, by gradient steps with a rate per weight.

    ``rows``: query_group, item_id, label, idxs (feature numbers below ``n_features``). Two passes per
    step; tasks add up their own gradients, so each sends one row of ``n_features`` numbers. Labels are
    grades: few different values. Without a pair of different labels all weights stay 0.
    """
    buckets = pair_buckets(rows)
    large = not buckets.where("buckets > 1").isEmpty()
    weights, grown, losses = np.zeros(n_features), np.full(n_features, 1e-12), []
    for _ in range(steps if n_features else 0):
        loss, pairs, gradient = pair_gradient(buckets, weights, large)
        if not pairs:
            break
        losses.append(loss / pairs)
        gradient = gradient / pairs + decay * weights
        grown += gradient ** 2
        weights = weights - rate * gradient / np.sqrt(grown)
    return PairRanker(weights, losses)


def pair_scores(model: PairRanker, items: DataFrame, sets: DataFrame) -> DataFrame:
    """item_id, rank_score of all items; one without features scores 0."""
    shared = items.sparkSession.sparkContext.broadcast(model.weights)

    def score(batches):
        for batch in batches:
            lists = batch.column("idxs")
            size = np.asarray(lists.value_lengths().fill_null(0))
            of = np.repeat(np.arange(len(size)), size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(np.bincount(
                    of, shared.value[np.asarray(lists.flatten())], len(size)))], ["item_id", "rank_score"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id").join(sets, "item_id", "left").select("item_id", "idxs").mapInArrow(
        score, f"item_id {kind}, rank_score double")


def rank_topk(ranked: DataFrame, k: int = 20, liked: DataFrame | None = None) -> DataFrame:
    """Best k items by rank score, without the liked ones."""
    if liked is not None:
        ranked = ranked.join(liked.select("item_id"), "item_id", "left_anti")
    return ranked.orderBy(F.round("rank_score", 9).desc(), F.asc("item_id")).limit(k).select(
        "item_id", "title", F.col("rank_score").alias("final_score"), "popularity_score",
        F.col("data_confidence_score").cast("int").alias("data_confidence"))


def _discount_between(first: Column, last: Column, k: int) -> Column:
    """Sum of 1/log2(position+1) over positions first..last, positions beyond k count 0."""
    sums, total = [0.0], 0.0
    for position in range(1, k + 1):
        total += 1.0 / math.log2(position + 1)
        sums.append(total)
    table = F.array(*[F.lit(x) for x in sums])
    cap = lambda c: F.least(c, F.lit(k)).cast("int")
    return F.get(table, cap(last)) - F.get(table, cap(first - 1))


def _tied_dcg(rows: DataFrame, score: str, ks: Sequence[int]) -> DataFrame:
    """DCG@k per group where equal scores share their mean gain.

    Equal scores are merged into one row before the window, and a row beyond the k-th best
    distinct score cannot start within k positions, so each group keeps at most k rows.
    """
    top = max(ks)
    merged = rows.groupBy("query_group", score).agg(
        F.count("*").alias("n"), F.sum("label").alias("gain"))
    order = W.partitionBy("query_group").orderBy(F.desc(score))
    kept = merged.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
    spread = kept.withColumn("last", F.sum("n").over(
        W.partitionBy("query_group").orderBy("place").rowsBetween(W.unboundedPreceding, 0)))
    first = F.col("last") - F.col("n") + 1
    return spread.groupBy("query_group").agg(*[
        F.sum(F.col("gain") / F.col("n") * _discount_between(first, F.col("last"), k))
        .alias(f"dcg_{k}") for k in ks])


def grouped_ndcg_rows(scored: DataFrame, score: str,
                      ks: Sequence[int] = (1, 3, 5, 10, 20)) -> DataFrame:
    """Graded NDCG per query group (linear gain); a group of zeros scores 0.

    ``scored``: query_group, label and the score column. Groups of one item are left out.
    """
    rows = scored.select("query_group", "label", F.round(score, 9).alias("score"))
    got = _tied_dcg(rows, "score", ks)
    best = _tied_dcg(rows.withColumn("ideal", F.col("label")), "ideal", ks).withColumnsRenamed(
        {f"dcg_{k}": f"ideal_{k}" for k in ks})
    sizes = rows.groupBy("query_group").agg(F.count("*").alias("group_size"))
    return got.join(best, "query_group").join(sizes, "query_group").where("group_size > 1").select(
        "query_group", "group_size", *[
            F.coalesce(F.try_divide(F.col(f"dcg_{k}"), F.col(f"ideal_{k}")), F.lit(0.0))
            .alias(f"ndcg_{k}") for k in ks])


def grouped_ndcg(scored: DataFrame, score: str,
                 ks: Sequence[int] = (1, 3, 5, 10, 20)) -> DataFrame:
    """Mean grouped NDCG per k, with the number of groups."""
    per_group = grouped_ndcg_rows(scored, score, ks)
    means = per_group.agg(F.count("*").alias("n_groups"), *[
        F.coalesce(F.avg(f"ndcg_{k}"), F.lit(0.0)).alias(f"ndcg_{k}") for k in ks])
    return means.select("n_groups", F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col(f"ndcg_{k}").alias("ndcg")) for k in ks]))
        .alias("x")).select(F.col("x.k").alias("k"), F.col("x.ndcg").alias("ndcg"), "n_groups")
