"""Where long passages repeat: shared ground of the two substring operators.

A text is a row of units (words or bytes); a window is ``width`` consecutive units of one text.
The m-gram of units with the least hash in a window is its minimizer. Consecutive windows with
one minimizer form a segment. Equal windows have equal minimizers at equal places, so only segments
whose minimizer occurs twice or more in the corpus can hold repeated windows, and segments can be
compared minimizer by minimizer:

1. every text yields (minimizer, segment hash, place); minimizers are counted, and segments with a
   lone one fall away (a semi-join);
2. equal segments become one distinct segment with a count and a first occurrence;
3. the distinct segments' units are fetched by one join with the texts and dealt to shards by
   minimizer; a shard finds the windows that several of its segments share;
4. runs of repeated windows go back to their texts.

A minimizer with more distinct segments than ``hot_segments`` is refined: its windows are keyed one
by one by their own hash, and those with a lone hash fall away. The threshold grows with the
number of segments, so at most ``HOT_KEYS`` minimizers are ever sent to the tasks.

A document is told by its id and 83 bits of its text's hash (``m`` and the mark in ``place``, from
two seeds), so any number of texts may share an id or have none. A null id counts as the largest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.jaccard_join import grouped
from shelfmark.llm.storage import stored
from shelfmark.llm.textbatch import (
    Texts, chunks, folded, mix, runs, window_hashes, window_starts)

PLACE_BITS = 36
HOT_SEGMENTS, HOT_KEYS = 20_000, 100_000
_POSITION = np.uint64((1 << 28) - 1)


@dataclass(frozen=True)
class Kind:
    """``unit`` (words or bytes), window width, minimizer length, units per shard."""
    unit: str
    width: int
    gram: int
    shard_units: int


class Units:
    """The units of some texts: offsets per text, hashes of m-grams and of any range."""

    def __init__(self, texts: Texts, kind: Kind):
        self.texts, self.kind = texts, kind
        if kind.unit == "bytes":
            self.offsets = texts.offsets
        else:
            self.words = texts.words()
            self.offsets = self.words.offsets
            self.values = self.words.hashes()

    def grams(self) -> np.ndarray:
        m = self.kind.gram
        if self.kind.unit == "words":
            return window_hashes(self.values, m)
        starts = np.arange(max(len(self.texts.data) - m + 1, 0))
        return self.texts.gram_hash(starts, starts + m)

    def range_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if self.kind.unit == "bytes":
            return self.texts.range_hash(starts, ends)
        owner, place = runs(ends - starts)
        return mix(folded(self.values[starts[owner] + place], ends - starts)
                   + (ends - starts).astype(np.uint64))

    def content(self, start: int, end: int) -> bytes:
        data = self.texts.data if self.kind.unit == "bytes" else self.values
        return data[start:end].tobytes()


@dataclass
class Segments:
    key: np.ndarray      # hash of the minimizer
    start: np.ndarray    # first unit
    count: np.ndarray    # windows
    owner: np.ndarray    # text number


def segments(units: Units) -> Segments:
    kind = units.kind
    starts, owner = window_starts(units.offsets, kind.width)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Segments(none.astype(np.uint64), none, none, none)
    grams = units.grams()
    span = kind.width - kind.gram + 1
    least = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while size * 2 <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < span:
        least = np.minimum(least[:len(least) - (span - size)], least[span - size:])
    place = (least[starts] & _POSITION).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
    return Segments(grams[place[first]], starts[first], np.diff(np.append(first, len(starts))),
                    owner[first])


def packed_place(mark: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Text mark (19 bits), first unit in its text (36 bits), number of windows (8 bits)."""
    return mark.astype(np.int64) << 44 | start << 8 | count


def place_start(place: np.ndarray) -> np.ndarray:
    return place >> 8 & ((1 << PLACE_BITS) - 1)


def sources(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return documents.select(
        F.col(id_col).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")).select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(2**63 - 1)).cast("long").alias("d"),
        F.xxhash64(F.lit(1), "text").alias("m"),  # the literal first: it changes the text's seed
        F.pmod(F.xxhash64("text"), F.lit(1 << 19)).alias("mark"))


_ROW = "h long, s long, d long, m long, place long"


def _segment_rows(kind: Kind):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, m, mark = (batch.column(c).to_numpy() for c in ("d", "m", "mark"))
            for texts in chunks(batch.column("text")):
                units = Units(texts, kind)
                found = segments(units)
                row = texts.first + found.owner
                yield pa.RecordBatch.from_arrays([
                    pa.array(found.key.view(np.int64)),
                    pa.array(units.range_hash(found.start, found.start + found.count + kind.width - 1)
                             .view(np.int64)),
                    pa.array(d[row]), pa.array(m[row]),
                    pa.array(packed_place(mark[row], found.start - units.offsets[found.owner],
                                          found.count))], ["h", "s", "d", "m", "place"])
    return emit


def _window_rows(kind: Kind, hot):
    """The windows of hot minimizers, each a segment of its own keyed by minimizer and content."""
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = hot.value
        for batch in batches:
            d, m, mark = (batch.column(c).to_numpy() for c in ("d", "m", "mark"))
            for texts in chunks(batch.column("text")):
                units = Units(texts, kind)
                found = segments(units)
                told = np.flatnonzero(np.isin(found.key.view(np.int64), keys))
                count = found.count[told]
                owner = np.repeat(found.owner[told], count)
                ends = np.cumsum(count)
                start = np.repeat(found.start[told] - (ends - count), count) + np.arange(count.sum())
                content = units.range_hash(start, start + kind.width)
                row = texts.first + owner
                yield pa.RecordBatch.from_arrays([
                    pa.array(mix(content ^ np.repeat(found.key[told], count)).view(np.int64)),
                    pa.array(content.view(np.int64)), pa.array(d[row]), pa.array(m[row]),
                    pa.array(packed_place(mark[row], start - units.offsets[owner],
                                          np.ones(len(start), np.int64)))],
                    ["h", "s", "d", "m", "place"])
    return emit


def _repeated(rows: DataFrame) -> DataFrame:
    """Rows whose key occurs at two places or more."""
    return rows.join(rows.groupBy("h").agg(F.count("*").alias("times")).where("times > 1")
                     .select("h"), "h", "leftsemi")


def _fetch(kind: Kind):
    """Units of the wanted segments of each text; a row that repeats an id and a text gives none again."""
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = set()
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("d", "m", "mark"))))
            fresh = [i for i, k in enumerate(keys) if not (k in known or known.add(k))]
            if len(fresh) < len(keys):
                batch = batch.take(pa.array(fresh, pa.int64()))
            if not fresh:
                continue
            d, m = (batch.column(c).to_numpy() for c in ("d", "m"))
            wanted = batch.column("wanted")
            for texts in chunks(batch.column("text")):
                units = Units(texts, kind)
                h, s, places, times, ids, hashes, content = [], [], [], [], [], [], []
                for i in range(texts.n):
                    own = wanted[texts.first + i].values
                    place = own.field("place").to_numpy()
                    start = place_start(place) + units.offsets[i]
                    end = start + (place & 255) + kind.width - 1
                    content += [units.content(a, b) for a, b in zip(start.tolist(), end.tolist())]
                    h.append(own.field("h").to_numpy())
                    s.append(own.field("s").to_numpy())
                    places.append(place)
                    times.append(own.field("times").to_numpy())
                    ids.append(np.full(len(place), d[texts.first + i]))
                    hashes.append(np.full(len(place), m[texts.first + i]))
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(np.concatenate(c)) for c in (h, s, ids, hashes, places, times)],
                     pa.array(content, pa.binary())],
                    ["h", "s", "d", "m", "place", "times", "content"])
    return emit


#: Of a shard: unit row of all its segments, segment offsets, counts of equal segments; marks for
#: every position the windows of first occurrences that have to go.
Search = Callable[[np.ndarray, np.ndarray, np.ndarray, Kind], np.ndarray]


def _search_shards(kind: Kind, search: Search):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in grouped(batches, ["shard"]):
            d, m, place, times = (
                shard.column(c).to_numpy() for c in ("d", "m", "place", "times"))
            order = np.lexsort((place, m, d))  # the order of first occurrences
            again = np.all([c[order][1:] == c[order][:-1] for c in (d, m, place)], axis=0)
            order = order[np.concatenate([[True], ~again])]  # of repeated rows one is enough
            content = shard.column("content").take(pa.array(order)).to_pylist()
            d, m, place, times = d[order], m[order], place[order], times[order]
            row = np.frombuffer(b"".join(content), np.uint8 if kind.unit == "bytes" else np.uint64)
            sizes = (place & 255) + kind.width - 1
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            gone = search(row, bounds, times, kind)
            # Runs of marked windows, segment by segment.
            starts, owner = window_starts(bounds, kind.width)
            told = np.flatnonzero(gone[starts])
            starts, owner = starts[told], owner[told]
            if not len(starts):
                continue
            first = np.concatenate([[0], np.flatnonzero(
                (starts[1:] != starts[:-1] + 1) | (owner[1:] != owner[:-1])) + 1])
            count = np.diff(np.append(first, len(starts)))
            starts, owner = starts[first], owner[first]
            yield pa.RecordBatch.from_arrays([
                pa.array(d[owner]), pa.array(m[owner]),
                pa.array(packed_place(place[owner] >> 44,
                                      place_start(place[owner]) + starts - bounds[owner], count))],
                ["d", "m", "place"])
    return emit


def repeated_runs(texts: DataFrame, kind: Kind, search: Search, keep_first: bool,
                  hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """(d, m, place) of runs of windows to remove; texts: d, m, mark, text (see ``sources``).

    ``keep_first``: windows of a first occurrence stay unless the shard search marks them; else
    all occurrences of a segment that occurs twice go.
    """
    spark = texts.sparkSession
    base = texts.select("d", "m", "mark", "text")
    # Found twice rather than stored: a row per segment of the corpus is more to write than to find.
    seen = stored(_repeated(base.mapInArrow(_segment_rows(kind), _ROW)), "repeated")
    distinct = stored(_distinct(seen), "distinct")
    sizes = distinct.groupBy("h").agg(F.count("*").alias("n"))
    total = distinct.count()
    limit = max(hot_segments, total // HOT_KEYS)
    hot = [r["h"] for r in sizes.where(F.col("n") > limit).select("h").collect()]
    if hot:
        keys = spark.sparkContext.broadcast(np.array(hot, np.int64))
        windows = _repeated(base.mapInArrow(_window_rows(kind, keys), _ROW))
        seen = stored(seen.where(~F.col("h").isin(hot)).unionByName(windows)
                      if len(hot) < 50 else seen.join(
                          spark.createDataFrame([(h,) for h in hot], "h long"), "h", "left_anti")
                      .unionByName(windows), "repeated")
        distinct = stored(_distinct(seen), "distinct")
    units = distinct.agg(F.sum(F.col("place").bitwiseAND(255) + kind.width - 1)).first()[0] or 0
    shards = max(1, -(-units // kind.shard_units))
    wanted = distinct.groupBy("d", "m", F.shiftright("place", 44).alias("mark")).agg(
        F.collect_list(F.struct("h", "s", "place", "times")).alias("wanted"))
    # Rows that repeat an id and a text are one document here.
    fetched = base.join(wanted, ["d", "m", "mark"]).select("d", "m", "mark", "text", "wanted").mapInArrow(
        _fetch(kind), "h long, s long, d long, m long, place long, times long, content binary")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards)
    marked = (fetched.withColumn("shard", F.pmod(F.xxhash64("h", F.lit(3)), F.lit(shards)))
              .select("shard", "d", "m", "place", "times", "content")
              .repartition(parts, "shard").sortWithinPartitions("shard")
              .mapInArrow(_search_shards(kind, search), "d long, m long, place long"))
    first = distinct.select("h", "s", "times", F.col("d").alias("d1"), F.col("m").alias("m1"),
                            F.col("place").alias("p1"))
    copies = seen.join(first.where("times > 1"), ["h", "s"])
    if keep_first:
        copies = copies.where("d <> d1 or m <> m1 or place <> p1")
    return stored(marked.unionByName(copies.select("d", "m", "place")), "runs")


def _distinct(seen: DataFrame) -> DataFrame:
    return seen.groupBy("h", "s").agg(
        F.min(F.struct("d", "m", "place")).alias("first"), F.count("*").alias("times")).select(
        "h", "s", "first.d", "first.m", "first.place", "times")


def with_runs(texts: DataFrame, runs: DataFrame) -> DataFrame:
    """(doc_id, text, runs: array of places) of every document."""
    # A set: rows that repeat an id and a text name the same places once each.
    by_text = runs.groupBy("d", "m", F.shiftright("place", 44).alias("mark")).agg(
        F.collect_set("place").alias("runs"))
    return texts.join(by_text, ["d", "m", "mark"], "left").select("doc_id", "text", "runs")


def removed_units(units: Units, i: int, places, kind: Kind) -> np.ndarray:
    """Marks of the units of text i that lie in a window of any run."""
    n = int(units.offsets[i + 1] - units.offsets[i])
    change = np.zeros(n + 1, np.int64)
    if places is not None and len(places):
        places = np.asarray(places, np.int64)
        start = place_start(places)
        np.add.at(change, start, 1)
        np.add.at(change, start + (places & 255) + kind.width - 1, -1)
    return np.cumsum(change[:n]) > 0
