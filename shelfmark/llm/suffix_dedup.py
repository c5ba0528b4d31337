"""Substring dedup over bytes with bucket-pointer refinement.

Every byte that lies in a string of ``WINDOW_BYTES`` bytes which also starts anywhere else is
removed, the first occurrence included. Shards come from ``repeats``. A shard sorts the suffixes of
its segments up to the window: initial buckets hold equal 8-grams; a bucket is refined by sorting
its suffixes on the bucket pointers at a later offset, which are exact to the depth reached so far,
so each pass doubles the depth and reuses the pointers that the pass before has set. Suffixes alone
in their bucket are in place and take no further part. After the pass that reaches the window,
suffixes that still share a bucket start equal strings.

Cases: a null or empty text has no bytes; a row that repeats another is another place, so both lose
what is long enough; a null id is a document like any other; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfmark.llm.repeats import (
    HOT_SEGMENTS, Kind, Units, removed_units, repeated_runs, sources, with_runs)
from shelfmark.llm.textbatch import chunks, window_starts

WINDOW_BYTES = 200
KIND = Kind("bytes", WINDOW_BYTES, 32, 1_000_000)
INITIAL = 8


def bucket_pointers(row: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``depth`` bytes, and each suffix's bucket pointer.

    A bucket pointer is the place of the bucket's first suffix in the order. Positions behind the
    end count as bytes below all others.
    """
    n = len(row)
    reach = min(INITIAL, depth)
    key = np.zeros(n, np.uint64)
    wide = np.concatenate([row, np.zeros(reach, row.dtype)]).astype(np.uint64)
    for i in range(reach):
        key = key << np.uint64(8) | wide[i:i + n]
    order = np.argsort(key, kind="stable").astype(np.int32)   # a shard has far fewer than 2**31 bytes
    ordered = key[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    del key, wide, ordered
    pointer = np.empty(n, np.int32)
    pointer[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    shared = ~(fresh & np.append(fresh[1:], True))
    active = np.flatnonzero(shared).astype(np.int32)   # places in the order that are not settled
    while reach < depth and len(active):
        offset = min(reach, depth - reach)
        suffix = order[active]
        later = suffix + offset
        second = np.where(later < n, pointer[np.minimum(later, n - 1)] + 1, 0)
        bucket = pointer[suffix]
        turn = np.lexsort((second, bucket))
        suffix, bucket, second = suffix[turn], bucket[turn], second[turn]
        order[active] = suffix
        fresh = np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (second[1:] != second[:-1])])
        pointer[suffix] = active[np.maximum.accumulate(np.where(fresh, np.arange(len(active)), 0))]
        active = active[~(fresh & np.append(fresh[1:], True))]
        reach += offset
    return order, pointer


def repeated_windows(row: np.ndarray, bounds: np.ndarray, times: np.ndarray, kind: Kind) -> np.ndarray:
    """Marks of windows (by first byte) that start at two places or more.

    Of a segment that occurs twice as a whole, every occurrence goes anyway.
    """
    starts, owner = window_starts(bounds, kind.width)
    _, pointer = bucket_pointers(row, kind.width)
    own = pointer[starts]
    often = np.bincount(own, minlength=len(row))[own] > 1
    gone = np.zeros(len(row), bool)
    gone[starts] = often & (times[owner] == 1)
    return gone


def _report(kind: Kind):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column("runs")
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for texts in chunks(batch.column("text")):
                units = Units(texts, kind)
                for i in range(texts.n):
                    place = runs[texts.first + i]
                    gone = removed_units(units, i, place.values if place.is_valid else None, kind)
                    a, b = units.offsets[i], units.offsets[i + 1]
                    n_bytes.append(b - a)
                    n_removed.append(int(gone.sum()))
                    n_spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
                    kept.append(texts.data[a:b][~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return emit


def dedup_bytes(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                kind: Kind = KIND, hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept: the bytes left) of every document."""
    texts = sources(documents, id_col, text_col)
    runs = repeated_runs(texts, kind, repeated_windows, False, hot_segments)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    return with_runs(texts, runs).mapInArrow(
        _report(kind), f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary")
