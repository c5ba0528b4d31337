"""Benchmark decontamination: containment search for short test items inside long documents.

Words are compared in lower case without punctuation; a shingle is five of them. Test items are
partitioned by size: an item of five shingles and more, up to c (c = 8, 16, 32, ...), is searched in
windows of 2c shingles that start every c, so that it makes up a fair share of some window however
long the document is. A window is a candidate for an item when any of ``HASHES`` MinHash values
agrees: if s of an item's n shingles stand in one window, none does with a chance of
(1 - s / (2c + n - s)) ** 64, which is 3.5e-8 for n = 5 and s = 4, and below 1.4e-6 for large n and
s = 0.8 n. Items of up to ``LOOKED_UP`` shingles, too small a share of such a window, are candidates
wherever any of their shingles stands, so none of them is missed. Every candidate is then verified
against the whole document by exact shingle containment.

Documents are scanned where they lie, without a shuffle; the items go to the tasks in blocks of
``BLOCK_ITEMS`` rows, so a large benchmark means more scans, not a larger broadcast.

Cases: null or empty texts and texts of fewer than five words have no shingles and match nothing;
repeated rows match alike, each on its own; an empty benchmark matches nothing; a null doc_id or
item_id is reported as it is; extra columns of either table are ignored (or kept, in the filter).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.storage import stored
from shelfmark.llm.textbatch import Texts, chunks, minima, permutations, shingles

SHINGLE_WORDS = 5
MIN_CONTAINMENT = 0.8
HASHES = 64
BASE_WINDOW = 8            # shingles between window starts in the smallest size class
LOOKED_UP = 4              # items of so many shingles are found by the shingles themselves
BLOCK_ITEMS = 10_000       # test items per scan

_MAPS = permutations(HASHES, 7)
_FILTER_BITS = 16


def normal_text(text: Column | str) -> Column:
    """Lower case, with all characters but letters, digits and white space removed."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\x09-\x0D\x20]+", "")


@dataclass
class SizeClass:
    """Items of one size class: MinHash values sorted per map, and the items they belong to."""
    span: int
    filters: np.ndarray     # per map, marks of the leading bits of the values
    values: list[np.ndarray]
    owners: list[np.ndarray]


@dataclass
class Items:
    ids: pa.Array
    sets: list[np.ndarray]   # distinct shingle hashes of each item
    classes: list[SizeClass]
    short: np.ndarray        # sorted shingle hashes of the items that are looked up
    short_owners: np.ndarray


def _distinct_shingles(texts: list[str]) -> list[np.ndarray]:
    out = []
    for part in chunks(pa.array(texts, pa.string())):
        hashes, offsets = shingles(part.words(), SHINGLE_WORDS)
        out += [np.unique(hashes[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    return out


def index_items(ids: pa.Array, texts: list[str]) -> Items:
    sets = _distinct_shingles(texts)
    classes, span = [], BASE_WINDOW
    few = [i for i, s in enumerate(sets) if 0 < len(s) <= LOOKED_UP]
    short = np.concatenate([np.zeros(0, np.uint64), *[sets[i] for i in few]])
    owners = np.repeat(np.array(few, np.int64), [len(sets[i]) for i in few])
    by_hash = np.argsort(short, kind="stable")
    left = [i for i, s in enumerate(sets) if len(s) > LOOKED_UP]
    while left:
        now = [i for i in left if len(sets[i]) <= span]
        left = [i for i in left if len(sets[i]) > span]
        if now:
            starts = np.cumsum([0, *[len(sets[i]) for i in now[:-1]]])
            signature = minima(np.concatenate([sets[i] for i in now]), starts, _MAPS)
            order = np.argsort(signature, axis=1, kind="stable")
            values = np.take_along_axis(signature, order, 1)
            filters = np.zeros((HASHES, 1 << _FILTER_BITS), bool)
            for i in range(HASHES):
                filters[i, values[i] >> np.uint32(32 - _FILTER_BITS)] = True
            classes.append(SizeClass(span, filters, list(values), list(np.array(now)[order])))
        span *= 2
    return Items(ids, sets, classes, short[by_hash], owners[by_hash])


def _pair_up(blocks: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge every two neighbouring blocks of a text."""
    counts = np.diff(offsets)
    halves = (counts + 1) // 2
    new = np.concatenate([[0], np.cumsum(halves)])
    owner = np.repeat(np.arange(len(counts)), halves)
    starts = offsets[:-1][owner] + 2 * (np.arange(new[-1]) - new[:-1][owner])
    return np.minimum.reduceat(blocks, starts, axis=1), new


def _window_candidates(hashes: np.ndarray, offsets: np.ndarray, items: Items) -> list[np.ndarray]:
    """(text number, item number) pairs of which a window and an item agree in a MinHash value."""
    counts = -(-np.diff(offsets) // BASE_WINDOW)
    blocks_at = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(counts)), counts)
    starts = offsets[:-1][owner] + BASE_WINDOW * (np.arange(blocks_at[-1]) - blocks_at[:-1][owner])
    blocks = minima(hashes, starts, _MAPS)
    span, found = BASE_WINDOW, []
    for group in items.classes:
        while span < group.span:
            blocks, blocks_at = _pair_up(blocks, blocks_at)
            span *= 2
        owner = np.repeat(np.arange(len(counts)), np.diff(blocks_at))
        # A window is a block and the next one of the same text.
        windows = blocks.copy()
        joined = np.flatnonzero(owner[1:] == owner[:-1])
        windows[:, joined] = np.minimum(blocks[:, joined], blocks[:, joined + 1])
        for i in range(HASHES):
            row = windows[i]
            hit = np.flatnonzero(group.filters[i][row >> np.uint32(32 - _FILTER_BITS)])
            if not len(hit):
                continue
            low = np.searchsorted(group.values[i], row[hit], "left")
            size = np.searchsorted(group.values[i], row[hit], "right") - low
            hit, low, size = hit[size > 0], low[size > 0], size[size > 0]
            if len(hit):
                place = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
                found.append(np.stack([np.repeat(owner[hit], size), group.owners[i][place]]))
    return found


def find_items(texts: Texts, items: Items, threshold: float) -> Iterator[tuple[int, int, int]]:
    """(text number, item number, shared shingles) of all verified matches."""
    hashes, offsets = shingles(texts.words(), SHINGLE_WORDS)
    if not len(hashes):
        return
    found = []
    low = np.searchsorted(items.short, hashes, "left")
    size = np.searchsorted(items.short, hashes, "right") - low
    hit = np.flatnonzero(size)
    if len(hit):
        low, size = low[hit], size[hit]
        place = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
        owner = np.searchsorted(offsets, hit, "right") - 1
        found.append(np.stack([np.repeat(owner, size), items.short_owners[place]]))
    if items.classes:
        found += _window_candidates(hashes, offsets, items)
    if not found:
        return
    pairs = np.unique(np.concatenate(found, axis=1), axis=1)
    at, own = -1, None
    for text, item in pairs.T.tolist():
        if text != at:
            at, own = text, np.unique(hashes[offsets[text]:offsets[text + 1]])
        wanted = items.sets[item]
        place = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
        shared = int((own[place] == wanted).sum())
        if shared >= threshold * len(wanted):
            yield text, item, shared


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_items: int) -> Iterator[Items]:
    """The items, ``block_items`` rows at a time."""
    rows = stored(benchmark.select(F.col(item_col).alias("item_id"),
                                   normal_text(text_col).alias("text"))
                  .withColumn("block", F.monotonically_increasing_id()), "items")
    # Ids grow in steps of at most the rows of a partition; blocks are cut by counting them.
    sizes = (rows.withColumn("part", F.shiftright("block", 33)).groupBy("part").count()
             .orderBy("part").collect())
    for size in sizes:
        first = size["part"] << 33
        for low in range(first, first + size["count"], block_items):
            block = rows.where(F.col("block").between(low, low + block_items - 1)).orderBy("block")
            found = block.select("item_id", "text").toArrow()
            yield index_items(found.column("item_id").combine_chunks(),
                              [t or "" for t in found.column("text").to_pylist()])


def find_leaks(documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id",
               text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               threshold: float = MIN_CONTAINMENT, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item) of every document that holds ``threshold`` of an item."""
    source = documents.select(F.col(id_col).alias("doc_id"), normal_text(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema[item_col].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, n_shared long, n_item long"
    context, out = documents.sparkSession.sparkContext, None
    for items in _blocks(benchmark, item_col, item_text_col, block_items):
        index = context.broadcast(items)

        def search(batches, index=index):
            items = index.value
            for batch in batches:
                for texts in chunks(batch.column("text")):
                    hits = list(find_items(texts, items, threshold))
                    picks = pa.array([texts.first + t for t, _, _ in hits], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(picks),
                         items.ids.take(pa.array([i for _, i, _ in hits], pa.int64())),
                         pa.array([n for _, _, n in hits], pa.int64()),
                         pa.array([len(items.sets[i]) for _, i, _ in hits], pa.int64())],
                        ["doc_id", "item_id", "n_shared", "n_item"])

        part = source.mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return documents.sparkSession.createDataFrame([], schema)
    return out


def drop_leaks(documents: DataFrame, benchmark: DataFrame, *, text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text",
               threshold: float = MIN_CONTAINMENT, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``documents`` that hold no item, unchanged."""
    context, columns = documents.sparkSession.sparkContext, documents.columns
    out = documents.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)],
                           normal_text(text_col).alias("normal"))
    for items in _blocks(benchmark, item_col, item_text_col, block_items):
        index = context.broadcast(items)

        def clean(batches, index=index):
            items = index.value
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for texts in chunks(batch.column("normal")):
                    for text, _, _ in find_items(texts, items, threshold):
                        keep[texts.first + text] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(clean, out.schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
