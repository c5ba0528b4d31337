"""Truncated SVD of the binary item-feature matrix.

The matrix is never built, nor is its d x d Gram matrix (d = number of distinct features). The right
singular vectors are the eigenvectors of that Gram matrix, found by a block Krylov iteration:
each pass multiplies the newest block of basis vectors by the Gram matrix, in two joins over the feature
sets, and adds what is new in it to the basis. The basis is a table of one row per feature, so d has no
limit; the driver holds matrices of at most ``MAX_COLUMNS`` columns. Beyond that many, the iteration starts
again from the best vectors found so far and the next block. An item's embedding is the sum of the vectors
of its features.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfmark.functions.vectors import vector_sum
from shelfmark.operators.ordering import with_global_rank
from shelfmark.session import cut, cut_at, remove, run_folder

MAX_COLUMNS = 1_024     # of the basis between two restarts (8 MB for the projected matrix)
EXTRA = 10              # vectors beyond those asked for that a restart keeps
TOLERANCE = 1e-9        # residual of every component, as a share of the largest eigenvalue
MAX_PASSES = 300
MATRIX_NUMBERS = 4_000_000   # components up to this size (32 MB) are sent to the tasks that embed items


@dataclass
class SvdModel:
    features: DataFrame          # kind, feature, idx: numbered from 0 in name order
    components: DataFrame        # idx, vec: row of the d x r matrix of right singular vectors
    singular_values: np.ndarray  # r
    feature_counts: DataFrame    # idx, n: items that have the feature
    residual: float              # largest residual, as a share of the largest eigenvalue
    passes: int
    converged: bool              # residual <= TOLERANCE; the best found so far if not


def feature_index(features: DataFrame) -> DataFrame:
    """The distinct (kind, feature) with a number ``idx`` from 0 in their order, stored."""
    names = cut(features.select("kind", "feature").distinct())
    ranked = with_global_rank(names, [F.col("kind"), F.col("feature")], "idx")
    return cut(ranked.withColumn("idx", F.col("idx") - 1))


def feature_sets(features: DataFrame, index: DataFrame) -> DataFrame:
    """One row per item: the sorted array of its feature numbers."""
    return features.join(index, ["kind", "feature"]).groupBy("item_id").agg(
        F.sort_array(F.collect_set("idx")).alias("idxs"))


def weighted_sets(sets: DataFrame) -> DataFrame:
    """Distinct feature sets with the number of items that have them."""
    return sets.groupBy("idxs").agg(F.count("*").alias("weight"))


def _rows(column, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width)


def _lists(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel()))


def _set_sums(batches):
    """For each set the weighted sum of its rows, given to its features; added up per batch and feature.

    Rows of a set follow each other. Those of a batch's last set wait for the next batch.
    """
    def given(rows: pa.Table) -> pa.RecordBatch:
        sid, weight, idx = (rows.column(c).to_numpy() for c in ("sid", "weight", "idx"))
        vec = rows.column("vec").combine_chunks()
        vec = _rows(vec, len(vec.flatten()) // len(sid))
        first = np.flatnonzero(np.append(True, sid[1:] != sid[:-1]))
        sums = np.add.reduceat(vec, first) * weight[first, None]
        own = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(sid))))
        order = np.argsort(idx, kind="stable")
        features, start = np.unique(idx[order], return_index=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(features), _lists(np.add.reduceat(sums[own[order]], start))], ["idx", "part"])

    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows])
        sid = rows.column("sid").to_numpy()
        keep = int(np.searchsorted(sid, sid[-1], "left"))
        if keep:
            yield given(rows.slice(0, keep))
        rest = rows.slice(keep)
    if rest is not None:
        yield given(rest)


def _random_block(index: DataFrame, width: int, seed: int) -> DataFrame:
    """A fixed random row of ``width`` numbers for every feature."""
    def fill(batches):
        for batch in batches:
            x = batch.column("idx").to_numpy().astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
            x = x + (np.arange(width, dtype=np.uint64) + np.uint64(seed * 100_003)) * np.uint64(0xD6E8FEB86659FD93)
            for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
                x = (x ^ (x >> np.uint64(30))) * np.uint64(factor)
            x ^= x >> np.uint64(31)
            yield pa.RecordBatch.from_arrays(
                [batch.column("idx"), _lists((x >> np.uint64(11)).astype(float) / 2.0 ** 52 - 1)], ["idx", "vec"])

    return index.select("idx").mapInArrow(fill, "idx long, vec array<double>")


class Basis:
    """Orthonormal columns V, one row ``vec`` per feature, and T = V' G V for the Gram matrix G.

    ``open`` counts the last columns that G has not been applied to yet.
    """

    def __init__(self, index: DataFrame, sets: DataFrame):
        self.index = index
        numbered = cut(weighted_sets(sets).withColumn("sid", F.monotonically_increasing_id()))
        self.entries = cut(numbered.select("sid", "weight", F.explode("idxs").alias("idx")))
        self.table, self.width, self.open = None, 0, 0
        self.projected = np.zeros((0, 0))
        self.beyond = np.zeros((0, 0))   # Gram matrix of what G makes of the last block outside V
        self.largest = 0.0

    def _product(self, block: DataFrame) -> DataFrame:
        """G times a block: sums per set, given to the set's features, and sums per feature."""
        joined = self.entries.join(block, "idx").select("sid", "weight", "idx", "vec")
        parts = joined.repartition("sid").sortWithinPartitions("sid").mapInArrow(
            _set_sums, "idx long, part array<double>")
        return parts.groupBy("idx").agg(vector_sum("part").alias("new"))

    def _products_sum(self, rows: DataFrame, make, shape: tuple[int, int]) -> np.ndarray:
        """Sum over all rows of left' right, for (left, right) = make(batch); one matrix per task."""
        def run(batches):
            total = np.zeros(shape)
            for batch in batches:
                left, right = make(batch)
                total += left.T @ right
            yield pa.RecordBatch.from_arrays([_lists(total.reshape(1, -1))], ["part"])

        found = rows.mapInArrow(run, "part array<double>").agg(vector_sum("part").alias("part")).first()[0]
        return np.array(found).reshape(shape)

    def _store(self, rows: DataFrame, make) -> None:
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column("idx"), _lists(make(batch))], ["idx", "vec"])

        self.table = cut(rows.mapInArrow(run, "idx long, vec array<double>"))

    def add(self, block: DataFrame, width: int) -> None:
        """Orthonormal columns for what ``block`` (idx, new) has beyond the basis.

        Projection and scaling are done twice; the second round works on columns of length one and
        so gives the first one's rounding error away.
        """
        m = self.width
        zero = F.array_repeat(F.lit(0.0), width)
        if m:
            rows = self.table.join(block, "idx", "left").select("idx", "vec", F.coalesce("new", zero).alias("new"))
        else:
            rows = self.index.select("idx").join(block, "idx", "left").select(
                "idx", F.array().cast("array<double>").alias("vec"), F.coalesce("new", zero).alias("new"))
        rows = cut(rows)

        def parts(batch):
            return _rows(batch.column("vec"), m) if m else np.zeros((batch.num_rows, 0)), _rows(batch.column("new"), width)

        def raw(batch):
            v, w = parts(batch)
            return np.concatenate([v, w], 1), w

        first = self._products_sum(rows, raw, (m + width, width))
        h1, own = first[:m], first[m:]
        scale = np.sqrt(np.maximum(np.diag(own).max(initial=0.0), 1e-300))
        values, turn = np.linalg.eigh((own - h1.T @ h1 + (own - h1.T @ h1).T) / 2)
        size = np.sqrt(np.maximum(values, (1e-9 * scale) ** 2))
        x1 = turn / size

        def once(batch):
            v, w = parts(batch)
            return v, (w - v @ h1) @ x1

        def again(batch):
            v, w = once(batch)
            return np.concatenate([v, w], 1), w

        second = self._products_sum(rows, again, (m + width, width))
        h2, own = second[:m], second[m:] - second[:m].T @ second[:m]
        if m and self.open:
            # V' G V for the block that was multiplied, and what is left outside V.
            done = slice(m - self.open, m)
            self.projected[:, done] = h1 + h2 @ (turn * size).T
            self.projected[done, :] = self.projected[:, done].T
            back = (turn * size).T
            self.beyond = back.T @ own @ back
        self.largest = max(self.largest, float(np.abs(self.projected).max(initial=0.0)))
        values, turn2 = np.linalg.eigh((own + own.T) / 2)
        new = values > (1e-3 if not m else 1e-6)
        # A direction whose true length is rounding error of the product is no direction.
        length = np.sqrt(np.maximum(np.einsum("ij,ij->j", turn2, (size ** 2)[:, None] * turn2) * values, 0))
        new &= length > 1e-13 * max(self.largest, scale)
        x2 = turn2[:, new] / np.sqrt(values[new])

        def final(batch):
            v, w = once(batch)
            return np.concatenate([v, (w - v @ h2) @ x2], 1)

        self._store(rows, final)
        self.open = int(new.sum())
        self.width = m + self.open
        grown = np.zeros((self.width, self.width))
        grown[:m, :m] = self.projected
        self.projected = grown

    def multiply(self) -> None:
        """Apply G to the open block and add what is new."""
        taken = self.open
        block = self.table.select("idx", F.slice("vec", self.width - taken + 1, taken).alias("vec"))
        self.add(self._product(block), taken)

    def ritz(self, r: int, done: int) -> tuple[np.ndarray, np.ndarray, float]:
        """The r largest values of the first ``done`` columns, their vectors in the basis, and the
        largest residual as a share of the largest value."""
        values, turn = np.linalg.eigh(self.projected[:done, :done])
        order = np.argsort(values)[::-1][:r]
        values, turn = values[order], turn[:, order]
        tail = turn[done - len(self.beyond):]
        gap = np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", tail, self.beyond, tail), 0))
        return values, turn, float(gap.max(initial=0.0) / max(values.max(initial=0.0), 1e-300))

    def rotate(self, turn: np.ndarray, done: int, values: np.ndarray | None = None) -> None:
        """Replace the first ``done`` columns by their combinations; open columns stay behind them."""
        m = self.width

        def run(batch):
            v = _rows(batch.column("vec"), m)
            return np.concatenate([v[:, :done] @ turn, v[:, done:]], 1)

        self._store(self.table, run)
        self.width = turn.shape[1] + m - done
        self.projected = np.zeros((self.width, self.width))
        if values is not None:
            self.projected[:len(values), :len(values)] = np.diag(values)


def _gram(sets: DataFrame, d: int) -> np.ndarray:
    """The whole d x d Gram matrix for few features: one scan, one matrix of counts per task."""
    def run(batches):
        total = np.zeros((d, d))
        for batch in batches:
            lists = batch.column("idxs")
            n = np.asarray(lists.value_lengths())
            dense = np.zeros((len(n), d))
            dense[np.repeat(np.arange(len(n)), n), np.asarray(lists.flatten())] = 1.0
            total += dense.T @ dense
        yield pa.RecordBatch.from_arrays([_lists(total.reshape(1, -1))], ["part"])

    found = sets.select("idxs").mapInArrow(run, "part array<double>").agg(vector_sum("part").alias("part")).first()[0]
    return np.array(found).reshape(d, d)


def leading(index: DataFrame, sets: DataFrame, r: int, max_columns: int = MAX_COLUMNS,
            max_passes: int = MAX_PASSES, seed: int = 42):
    """(values, table idx/vec, residual, passes): the r largest eigenvalues of the Gram matrix and
    their vectors. With at most r + EXTRA features one pass is exact."""
    d = index.count()
    r = min(r, d)
    if not r:
        return np.zeros(0), index.select("idx", F.array().cast("array<double>").alias("vec")), 0.0, 0
    if d <= r + EXTRA:   # the whole space is the first block: G itself, of a size that r bounds
        values, turn = np.linalg.eigh(_gram(sets, d))
        order = np.argsort(values)[::-1][:r]
        table = index.sparkSession.createDataFrame(
            pa.table({"idx": np.arange(d), "vec": _lists(turn[:, order])}))
        return values[order], table, 0.0, 1
    basis = Basis(index, sets)
    block = max(8, r // 2)
    basis.add(_random_block(index, block, seed).withColumnRenamed("vec", "new"), block)
    for n in range(1, max_passes + 1):
        done = basis.width
        basis.multiply()
        if done >= r:
            values, turn, residual = basis.ritz(r, done)
            if residual <= TOLERANCE or done == d or n == max_passes:
                break
        if not basis.open:   # an invariant subspace that is too small: go on beside it
            basis.add(_random_block(index, block, seed + n).withColumnRenamed("vec", "new"), block)
        elif basis.width + basis.open > max_columns:
            kept, turn, _ = basis.ritz(min(r + EXTRA, done), done)
            basis.rotate(turn, done, kept)
    basis.rotate(turn, done)
    return values, basis.table.select("idx", F.slice("vec", 1, r).alias("vec")), residual, n


def fit_svd(sets: DataFrame, index: DataFrame, n_components: int = 100, **limits) -> SvdModel:
    """Fit on the feature sets (item_id, idxs) over the numbered features."""
    counts = cut(sets.select(F.explode("idxs").alias("idx")).groupBy("idx").agg(F.count("*").alias("n")))
    values, table, residual, passes = leading(index, sets, n_components, **limits)
    # The sign of a component is free; make its largest entry positive. One row per component.
    peaks = table.select("idx", F.posexplode("vec").alias("at", "x")).groupBy("at").agg(
        F.max(F.struct(F.abs("x").alias("size"), -F.col("idx"), "x")).alias("peak")).select("at", "peak.x").collect()
    sign = np.ones(len(values))
    for row in peaks:
        sign[row["at"]] = -1.0 if row["x"] < 0 else 1.0
    signed = F.zip_with("vec", F.lit(sign.tolist()), lambda x, s: x * s) if len(sign) else F.col("vec")
    return SvdModel(index, cut(table.select("idx", signed.alias("vec"))), np.sqrt(np.clip(values, 0.0, None)),
                    counts, residual, passes, residual <= TOLERANCE)


def _summed_rows(rows: DataFrame, model: SvdModel, width: int) -> DataFrame:
    """Sum of the components' rows of each set, zeros for none, from a matrix that every task has: nothing is
    exploded or sorted."""
    table = sorted(model.components.collect(), key=lambda r: r["idx"])   # at most MATRIX_NUMBERS numbers
    shared = rows.sparkSession.sparkContext.broadcast(np.array([r["vec"] for r in table]).reshape(-1, width))

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                lists = part.column("idxs")
                n = np.asarray(lists.value_lengths().fill_null(0))
                of = np.repeat(np.arange(len(n)), n)
                total = np.zeros((len(n), width))
                if len(of):
                    first = np.flatnonzero(np.append(True, np.diff(of) > 0))
                    total[of[first]] = np.add.reduceat(shared.value[np.asarray(lists.flatten())], first)
                yield pa.RecordBatch.from_arrays([part.column("item_id"), _lists(total)], ["item_id", "embedding"])

    kind = rows.schema["item_id"].dataType.simpleString()
    return rows.select("item_id", "idxs").mapInArrow(run, f"item_id {kind}, embedding array<double>")


def fits_tasks(model: SvdModel) -> bool:
    """Whether every task can have the components as a matrix."""
    return model.features.count() * len(model.singular_values) <= MATRIX_NUMBERS


def embed(items: DataFrame, sets: DataFrame, model: SvdModel) -> DataFrame:
    """Embedding of every item; an item without features gets the zero vector."""
    width = len(model.singular_values)
    if not width:
        return items.select("item_id", F.array().cast("array<double>").alias("embedding"))
    if fits_tasks(model):
        # Stored, as numbers of features: the vectors, many times as large, are made again wherever they are read.
        return _summed_rows(cut(items.select("item_id").join(sets.hint("merge"), "item_id", "left")), model, width)
    sums = sets.select("item_id", F.explode("idxs").alias("idx")).join(model.components, "idx").groupBy(
        "item_id").agg(vector_sum("vec").alias("embedding"))
    return items.select("item_id").join(sums, "item_id", "left").select(
        "item_id", F.coalesce("embedding", F.array_repeat(F.lit(0.0), width)).alias("embedding"))


def content_model(items: DataFrame, features: DataFrame,
                  n_components: int = 100, **limits) -> tuple[SvdModel, DataFrame]:
    """Fit the SVD and embed all items: the model and ``(item_id, embedding)``."""
    folder = run_folder(items.sparkSession, "known")
    known = cut_at(features.join(items.select("item_id"), "item_id", "left_semi"), folder)
    index = feature_index(known)
    sets = cut(feature_sets(known, index))  # read by the fit and by the projection
    remove(items.sparkSession, folder)
    model = fit_svd(sets, index, n_components, **limits)
    return model, embed(items, sets, model)


def residuals(sets: DataFrame, model: SvdModel) -> DataFrame:
    """Per component, |G v - value v| as a share of the largest value, by one more product."""
    value = F.lit((model.singular_values ** 2).tolist())
    basis = Basis(model.features, sets)
    made = model.components.join(basis._product(model.components), "idx")
    gap = F.transform(F.arrays_zip("new", "vec", value.alias("value")),
                      lambda x: F.pow(x["new"] - x["value"] * x["vec"], F.lit(2.0)))
    top = float((model.singular_values ** 2).max(initial=0.0)) or 1.0
    return made.select(gap.alias("gap")).agg(vector_sum("gap").alias("gap")).select(
        F.posexplode("gap").alias("component", "gap")).select(
        "component", (F.sqrt("gap") / F.lit(top)).alias("residual"))


def cooccurrence(sets: DataFrame, index: DataFrame) -> DataFrame:
    """Items that have both features, for every pair of features that occur together."""
    labels = index.select("idx", F.concat_ws(":", "kind", "feature").alias("label"))
    pairs = weighted_sets(sets).withColumn("a", F.explode("idxs")).withColumn(
        "b", F.explode("idxs")).groupBy("a", "b").agg(F.sum("weight").alias("item_count"))
    return pairs.join(labels.toDF("a", "feature_a"), "a").join(
        labels.toDF("b", "feature_b"), "b").select("feature_a", "feature_b", "item_count")


def explained_variance(embeddings: DataFrame, model: SvdModel, n_items: int) -> DataFrame:
    """Variance of each component as a share of the variance of all features."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    share = F.col("n") / F.lit(max(n_items, 1))
    total = model.feature_counts.agg(F.sum(share * (1 - share))).first()[0] or 0.0
    stats = embeddings.agg(
        vector_to_array(Summarizer.variance(array_to_vector("embedding"))).alias("v"),
        F.count("*").alias("n"))
    population = F.col("var") * (F.col("n") - 1) / F.col("n")
    return stats.select("n", F.posexplode("v").alias("component", "var")).select(
        "component", population.alias("variance"),
        F.try_divide(population, F.lit(total)).alias("explained_ratio"))
