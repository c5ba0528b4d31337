"""Vector expressions on ``array<double>`` columns; all stay in the JVM."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F


def dot(a: str | Column, b: str | Column) -> Column:
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: str | Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: str | Column, b: str | Column) -> Column:
    """Cosine similarity; 0 when either vector is zero or holds NaN."""
    value = F.try_divide(dot(a, b), norm(a) * norm(b))
    return F.nanvl(F.coalesce(value, F.lit(0.0)), F.lit(0.0))


def unit(a: str | Column) -> Column:
    """The vector scaled to length one; a zero vector stays zero."""
    column = F.col(a) if isinstance(a, str) else a
    length = norm(column)
    return F.transform(column, lambda x: F.coalesce(F.try_divide(x, length), F.lit(0.0)))


def vector_mean(column: str) -> Column:
    """Aggregate: element-wise mean. Partially aggregated before any shuffle."""
    return vector_to_array(Summarizer.mean(array_to_vector(F.col(column))))


def vector_sum(column: str) -> Column:
    """Aggregate: element-wise sum. Partially aggregated before any shuffle."""
    return vector_to_array(Summarizer.sum(array_to_vector(F.col(column))))


def _sums_of(keys: pa.Array, counts: np.ndarray, vectors: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct keys (null is one) with the sums of their counts and vectors."""
    coded = keys.dictionary_encode("encode")
    code = coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(code, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(code[order]) > 0)) if len(code) else np.zeros(0, int)
    return (coded.dictionary.take(pa.array(code[order][first])), np.add.reduceat(counts[order], first),
            np.add.reduceat(vectors[order], first, axis=0))


def _as_batch(keys: pa.Array, counts: np.ndarray, vectors: np.ndarray, names: list[str]) -> pa.RecordBatch:
    offsets = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * vectors.shape[1])
    return pa.RecordBatch.from_arrays(
        [keys, pa.array(counts), pa.ListArray.from_arrays(offsets, pa.array(vectors.ravel()))], names)


def mean_by(rows: DataFrame, key: str, column: str, n_rows: int, task_rows: int = 262_144) -> DataFrame:
    """Element-wise mean of ``column`` per ``key``: columns key, vec.

    Rows are never sorted: a batch's rows of a key become one, and the task that gets a key adds its rows
    up as they come, so a task holds the sums of its keys only. ``n_rows``, about the number of
    rows, gives the number of tasks: one per ``task_rows``.
    """
    names = [key, "n", "part"]

    def within_batch(batches):
        for batch in batches:
            if batch.num_rows:
                flat = np.asarray(batch.column(1).flatten())
                yield _as_batch(*_sums_of(batch.column(0), np.ones(batch.num_rows, np.int64),
                                          flat.reshape(batch.num_rows, -1)), names)

    def within_task(batches):
        at, keys = {}, []
        counts, sums = np.zeros(0, np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = np.asarray(batch.column(2).flatten())
            own, n, part = _sums_of(batch.column(0), batch.column(1).to_numpy(), flat.reshape(batch.num_rows, -1))
            place = np.array([at.setdefault(x, len(at)) for x in own.to_pylist()])
            if sums is None:
                sums = np.zeros((0, part.shape[1]))
            if len(at) > len(counts):
                more = max(len(at), 2 * len(counts)) - len(counts)
                counts = np.concatenate([counts, np.zeros(more, np.int64)])
                sums = np.concatenate([sums, np.zeros((more, part.shape[1]))])
            keys.append(own.filter(pa.array(place >= sum(map(len, keys)))))
            counts[place] += n
            sums[place] += part
        if at:
            known = pa.concat_arrays(keys)
            for start in range(0, len(at), 4096):
                stop = min(start + 4096, len(at))
                n = counts[start:stop]
                yield _as_batch(known.slice(start, stop - start), n, sums[start:stop] / n[:, None], names)

    kind = rows.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n long, part array<double>"
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(n_rows / task_rows))
    return rows.select(key, column).mapInArrow(within_batch, schema).repartition(tasks, key).mapInArrow(
        within_task, schema).select(key, F.col("part").alias("vec"))


def pair_similarity(pairs: DataFrame, vectors: DataFrame, a: str = "item_a",
                    b: str = "item_b") -> DataFrame:
    """Cosine of each given pair of items; pairs with an unknown item are dropped."""
    left = vectors.select(F.col("item_id").alias(a), F.col("embedding").alias("_va"))
    right = vectors.select(F.col("item_id").alias(b), F.col("embedding").alias("_vb"))
    return pairs.join(left, a).join(right, b).select(
        *pairs.columns, cosine("_va", "_vb").alias("similarity"))
