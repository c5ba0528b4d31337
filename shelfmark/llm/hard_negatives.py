"""Hard negatives by segment summaries.

Every vector is cut into segments, in levels of 1, 4, 16, ... segments, and each segment keeps its mean
and its deviation. For two vectors, a segment of length n adds n * mean * mean to the inner product, give or
take n * deviation * deviation; the sums over a level's segments bound the score from both sides. Pairs
whose bounds rule them out go no further; the rest are bounded again by the finer levels, and what
is left is scored exactly. Anchors are compared with all rows in cells of a bounded chunk of anchors and
a bounded block of rows; a cell returns the best few of each anchor, so no pair list is ever made.

Rows with a null id or label, a null vector, or a null or non-finite component take no part. Rows that
share an id are one row, that with the smallest label and then the smallest vector. Shorter vectors
count as filled up with zeros. Equal scores are ordered by the smaller id. An anchor without a row of
its label, or a positive without a fitting negative, has no result rows; neither has an empty table.
Other columns are ignored. Scores are exact integers; one that does not fit a long is an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shelfmark.llm.storage import stored

BLOCK_ROWS = 16_384        # rows of a cell
CHUNK_ANCHORS = 4_096      # anchors of a cell
FANOUT = 4                 # a segment is refined into so many
SHORTEST = 4               # components; no segment is cut below this
FIRST_SLAB, LAST_SLAB = 256, 4_096   # rows compared at once: few at first, so that floors rise early
SPARSE = 0.125             # below this share of pairs left, they are bounded one by one
MAX_TASKS = 50_000
_SLACK = 1e-9


def levels(dims: int) -> list[np.ndarray]:
    """Starts of the segments of each level."""
    out, n = [], 1
    while n == 1 or dims // n >= SHORTEST:
        out.append(np.arange(n) * dims // n)
        n *= FANOUT
    return out


def summaries(vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each level, the means and the deviations of every row's segments.

    Both are multiplied by the root of the segment's length, so that plain products of two
    summaries are the terms of the bound.
    """
    out, dims = [], vectors.shape[1]
    for starts in levels(dims):
        size = np.diff(np.append(starts, dims))
        mean = np.add.reduceat(vectors, starts, axis=1) / size
        rest = vectors - np.repeat(mean, size, axis=1)
        deviation = np.sqrt(np.add.reduceat(rest * rest, starts, axis=1) / size)
        out.append((mean * np.sqrt(size), deviation * np.sqrt(size)))
    return out


class Side:
    """The anchors or the rows of a cell: vectors, ids, labels and stored summaries."""

    def __init__(self, table: pa.Table, dims: int):
        self.id = table.column("id").to_numpy()
        self.label = table.column("label").to_numpy()
        self.vector = matrix(table.column("vector"), dims, np.int64)
        sizes = [len(s) for s in levels(dims)]
        flat = matrix(table.column("summary"), 2 * sum(sizes), np.float64)
        self.level, at = [], 0
        for n in sizes:
            self.level.append((flat[:, at:at + n], flat[:, at + n:at + 2 * n]))
            at += 2 * n
        # The error of the sums below is far smaller than this share of both lengths.
        mean, deviation = self.level[0]
        self.length = np.sqrt((mean ** 2 + deviation ** 2).sum(1))


def matrix(column: pa.ChunkedArray, width: int, kind) -> np.ndarray:
    """Lists as rows of a matrix, shorter ones filled up with zeros."""
    column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    size = np.asarray(column.value_lengths()).astype(np.int64)
    if (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width), kind)
    out[np.arange(width) < size[:, None]] = flat
    return out


class Cell:
    """Bounds and exact scores between some anchors and some rows."""

    def __init__(self, anchors: Side, rows: Side):
        self.anchors, self.rows = anchors, rows
        most = [int(np.abs(s.vector).max(initial=0)) for s in (anchors, rows)]
        reach = most[0] * most[1] * anchors.vector.shape[1]
        # Every partial sum is an integer below the mantissa, so the float product is exact.
        kind = np.float32 if reach < 2 ** 24 else np.float64 if reach < 2 ** 53 else object
        self.exact = anchors.vector.astype(kind), rows.vector.astype(kind)
        self.left = [0] * (len(anchors.level) + 1)   # pairs that came to each level; last: scored

    def bounds(self, level: int, i: np.ndarray, j: np.ndarray, pairwise: bool):
        """Middle and radius for pairs (i[n], j[n]), or for all of i with all of j."""
        a, x = self.anchors, self.rows
        (am, ad), (xm, xd) = a.level[level], x.level[level]
        if pairwise:
            return (np.einsum("nd,nd->n", am[i], xm[j]),
                    np.einsum("nd,nd->n", ad[i], xd[j]) + _SLACK * a.length[i] * x.length[j])
        return am[i] @ xm[j].T, ad[i] @ xd[j].T + _SLACK * np.outer(a.length[i], x.length[j])

    def scores(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, x = self.exact
        if a.dtype == object:
            return np.array([int(a[p] @ x[q]) for p, q in zip(i, j)], np.int64)
        if len(i) > SPARSE * len(np.unique(i)) * len(np.unique(j)):
            ui, pi = np.unique(i, return_inverse=True)
            uj, pj = np.unique(j, return_inverse=True)
            return (a[ui] @ x[uj].T)[pi, pj].astype(np.int64)
        out = np.empty(len(i), np.int64)
        for at in range(0, len(i), 65_536):
            part = slice(at, at + 65_536)
            out[part] = np.einsum("nd,nd->n", a[i[part]], x[j[part]])
        return out

    def survivors(self, i: np.ndarray, j: np.ndarray, least: np.ndarray, most: np.ndarray,
                  best: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of anchors i and rows j whose score may lie within least[i] .. most[i].

        ``best`` > 0: only the best so many of an anchor are wanted, so its floor rises to the
        best-th largest lower bound.
        """
        middle, radius = self.bounds(0, i, j, False)
        self.left[0] += middle.size
        floor = least[i]
        if 0 < best < len(j):
            sure = np.partition(middle - radius, len(j) - best, axis=1)[:, len(j) - best]
            floor = np.maximum(floor, sure)
        p, q = np.nonzero((middle + radius >= floor[:, None]) & (middle - radius <= most[i][:, None]))
        for level in range(1, len(self.anchors.level)):
            self.left[level] += len(p)
            if not len(p):
                break
            up, uq = np.unique(p), np.unique(q)
            if len(p) > SPARSE * len(up) * len(uq):
                middle, radius = self.bounds(level, i[up], j[uq], False)
                if 0 < best < len(uq):
                    # A pair that was ruled out has a bound too: the best-th of all is still sure.
                    sure = np.partition(middle - radius, len(uq) - best, axis=1)[:, len(uq) - best]
                    floor[up] = np.maximum(floor[up], sure)
                rows = np.searchsorted(up, p), np.searchsorted(uq, q)
                middle, radius = middle[rows], radius[rows]
            else:
                middle, radius = self.bounds(level, i[p], j[q], True)
            keep = (middle + radius >= floor[p]) & (middle - radius <= most[i[p]])
            p, q = p[keep], q[keep]
        self.left[-1] += len(p)
        return i[p], j[q]


def slabs(rows: np.ndarray):
    """Runs of rows that grow from FIRST_SLAB to LAST_SLAB."""
    at, size = 0, FIRST_SLAB
    while at < len(rows):
        yield rows[at:at + size]
        at, size = at + size, min(2 * size, LAST_SLAB)


def best_of(group: np.ndarray, score: np.ndarray, number: np.ndarray, k: int) -> np.ndarray:
    """Indexes of each group's k first by score, then by the smaller number; by group."""
    order = np.lexsort((number, -score, group))
    ordered = group[order]
    first = np.searchsorted(ordered, ordered, "left")
    return order[np.arange(len(order)) - first < k]


def floors(group: np.ndarray, score: np.ndarray, k: int, default: np.ndarray) -> np.ndarray:
    """The k-th score of every group that has k rows (rows come from best_of), else the default."""
    out = default.astype(np.float64).copy()
    if len(group):
        first = np.searchsorted(group, np.arange(len(default)), "left")
        n = np.searchsorted(group, np.arange(len(default)), "right") - first
        full = n >= k
        out[full] = np.maximum(out[full], score[first[full] + k - 1])
    return out


def cell_positives(anchors: Side, rows: Side, k: int, cell: Cell | None = None):
    """(anchor number, row number, score) of the k best rows of each anchor's own label."""
    cell = cell or Cell(anchors, rows)
    n = len(anchors.id)
    got = [np.zeros(0, np.int64)] * 3
    for label in np.unique(anchors.label):
        i = np.flatnonzero(anchors.label == label)
        for j in slabs(np.flatnonzero(rows.label == label)):
            least = floors(got[0], got[2], k, np.full(n, -np.inf))
            # One more than k, because the anchor itself may be among them.
            p, q = cell.survivors(i, j, least, np.full(n, np.inf), k + 1)
            other = anchors.id[p] != rows.id[q]
            p, q = p[other], q[other]
            got = [np.concatenate(x) for x in zip(got, (p, q, cell.scores(p, q)))]
            keep = best_of(got[0], got[2], rows.id[got[1]], k)
            got = [x[keep] for x in got]
    return got


def cell_negatives(anchors: Side, rows: Side, anchor: np.ndarray, low: np.ndarray, high: np.ndarray,
                   k: int, cell: Cell | None = None):
    """(range number, row number, score) of the k best rows of other labels in each range.

    Range r belongs to anchor number ``anchor[r]``, ascending, and holds scores low[r] .. high[r].
    """
    cell = cell or Cell(anchors, rows)
    n = len(anchors.id)
    first = np.searchsorted(anchor, np.arange(n), "left")
    count = np.searchsorted(anchor, np.arange(n), "right") - first
    asked = count > 0
    most = np.full(n, -np.inf)
    most[asked] = np.maximum.reduceat(high, first[asked]) if asked.any() else []
    got = [np.zeros(0, np.int64)] * 3
    for label in np.unique(anchors.label[asked]):
        i = np.flatnonzero((anchors.label == label) & asked)
        for j in slabs(np.flatnonzero(rows.label != label)):
            least = np.full(n, np.inf)
            least[asked] = np.minimum.reduceat(floors(got[0], got[2], k, low), first[asked])
            p, q = cell.survivors(i, j, least, most)
            score = cell.scores(p, q)
            pair = np.repeat(np.arange(len(p)), count[p])
            span = np.arange(len(pair)) - np.repeat(np.cumsum(count[p]) - count[p], count[p]) \
                + first[p][pair]
            fits = (score[pair] >= low[span]) & (score[pair] <= high[span])
            got = [np.concatenate(x) for x in zip(
                got, (span[fits], q[pair[fits]], score[pair[fits]]))]
            keep = best_of(got[0], got[2], rows.id[got[1]], k)
            got = [x[keep] for x in got]
    return got


def prepared(rows: DataFrame, id_col: str, vector_col: str, label_col: str,
             scale: int) -> tuple[DataFrame, int]:
    """Stored id, label, integer vector and summaries of the rows that take part; their dimension."""
    vector = F.col("vector")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) != float("inf")))
    found = (rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                         F.col(vector_col).alias("vector"))
             .where(F.col("id").isNotNull() & F.col("label").isNotNull() & vector.isNotNull())
             .where(finite).withColumn("vector", F.transform(
                 "vector", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))))
    found = stored(found, "vectors")
    if not found.groupBy("id").count().where("count > 1").isEmpty():
        found = stored(found.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("r"))
                       .select("id", "r.label", "r.vector"), "vectors")
    dims = max(1, found.agg(F.max(F.size("vector"))).first()[0] or 1)

    def summarise(batches):
        for batch in batches:
            own = matrix(pa.chunked_array([batch.column("vector")], pa.list_(pa.int64())), dims, np.float64)
            flat = np.concatenate([part for level in summaries(own) for part in level], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.FixedSizeListArray.from_arrays(
                    pa.array(flat.reshape(-1)), flat.shape[1]).cast(pa.list_(pa.float64()))],
                [*batch.schema.names, "summary"])

    return stored(found.mapInArrow(summarise, "id long, label long, vector array<long>, "
                                              "summary array<double>"), "summaries"), dims


def _cells(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int):
    """Both sides dealt to cells (chunk, block), and the number of tasks for them."""
    chunks, blocks = (max(1, math.ceil(n / size)) for n, size in (
        (n_anchors, CHUNK_ANCHORS), (n_rows, BLOCK_ROWS)))

    def dealt(key: Column, n: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    tasks = min(MAX_TASKS, chunks * blocks)
    left = anchors.select("*", dealt(F.col("id"), chunks).alias("chunk"), every(blocks).alias("block"))
    right = rows.select("*", dealt(F.col("id"), blocks).alias("block"), every(chunks).alias("chunk"))
    return (d.repartition(tasks, "chunk", "block").groupBy("chunk", "block") for d in (left, right))


def hard_negatives(rows: DataFrame, *, is_anchor: Column, id_col: str = "vec_id",
                   vector_col: str = "embedding", label_col: str = "label", scale: int = 256,
                   positives: int = 5, negatives: int = 3, low_percent: int = 50,
                   high_percent: int = 95) -> DataFrame:
    """Per anchor and positive, the best ``negatives`` rows of other labels within a share of its score.

    Components become floor(scale * x); scores are integer inner products. ``is_anchor`` is a
    condition on the column ``id``. Positives are the best ``positives`` other rows of the
    anchor's label; a negative's score is between low_percent and high_percent hundredths of the
    positive's. Returns anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score.
    """
    table, dims = prepared(rows, id_col, vector_col, label_col, scale)
    anchors = table.where(is_anchor)
    n_rows, n_anchors = table.count(), anchors.count()

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        a, x = Side(left, dims), Side(right, dims)
        p, q, score = cell_positives(a, x, positives)
        return pa.table({"anchor_id": a.id[p], "positive_id": x.id[q], "positive_score": score})

    left, right = _cells(anchors, table, n_anchors, n_rows)
    near = left.cogroup(right).applyInArrow(
        find_positives, "anchor_id long, positive_id long, positive_score long")
    turn = W.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= positives)
    asked = stored(near.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list(
        F.struct("positive_id", "positive_score"))).alias("positives")).join(anchors, "id"), "asked")

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        a, x = Side(left, dims), Side(right, dims)
        lists = left.column("positives").combine_chunks()
        of = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
        number, score = (lists.flatten().field(f).to_numpy() for f in ("positive_id", "positive_score"))
        low, high = -(-low_percent * score // 100), high_percent * score // 100
        r, q, found = cell_negatives(a, x, of, low, high, negatives)
        return pa.table({"anchor_id": a.id[of[r]], "positive_id": number[r], "positive_score": score[r],
                         "negative_id": x.id[q], "negative_score": found})

    left, right = _cells(asked, table, n_anchors, n_rows)
    far = left.cogroup(right).applyInArrow(
        find_negatives, "anchor_id long, positive_id long, positive_score long, negative_id long, "
                        "negative_score long")
    turn = W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return far.withColumn("rank", F.row_number().over(turn)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
