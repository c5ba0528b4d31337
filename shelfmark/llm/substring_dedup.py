"""Substring dedup over words with a compressed FM-index per shard.

A window is ``WINDOW_WORDS`` consecutive words of one document; every word that lies in a window
whose words also start earlier is removed. Shards come from ``repeats``: they hold the distinct
segments that may share windows, in the order of their first occurrence. A shard builds an FM-index
(wavelet tree over the Burrows-Wheeler transform, sampled suffix array) of its segments and streams
them through it: backward search gives for each word the length of the longest match that ends there
and occurs twice (its matching statistics, up to the window). Intervals that reach the window
length are reported, and the earliest occurrence in each is located.

Equal segments are one before they are indexed; their later occurrences go as a whole.

Cases: a null or empty text has no words and keeps none; rows that repeat both id and text are the
same document, so neither is earlier; rows that share an id with different texts are ordered by a
hash of the text; a null id comes last; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfmark.llm.repeats import (
    HOT_SEGMENTS, Kind, Units, removed_units, repeated_runs, sources, with_runs)
from shelfmark.llm.textbatch import chunks, window_starts

WINDOW_WORDS = 20
KIND = Kind("words", WINDOW_WORDS, 5, 500_000)
SAMPLE = 4                 # every fourth word of a segment has its place stored


class WaveletTree:
    """Rank over a row of numbers, bit plane by bit plane; a plane is packed bits with counts."""

    def __init__(self, row: np.ndarray, bits: int):
        self.bits, self.planes, self.zeros = bits, [], []
        for b in reversed(range(bits)):
            ones = (row >> b & 1).astype(bool)
            pad = (-len(ones)) % 64 + 64
            words = np.packbits(np.concatenate([ones, np.zeros(pad, bool)]),
                                bitorder="little").view(np.uint64)
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(words))]).astype(np.int32)
            self.planes.append((words, counts))
            self.zeros.append(len(ones) - int(counts[-1]))
            row = np.concatenate([row[~ones], row[ones]])

    def _ones(self, plane: int, at: np.ndarray) -> np.ndarray:
        words, counts = self.planes[plane]
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return counts[block] + np.bitwise_count(words[block] & mask)

    def rank(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each value occurs before the place beside it."""
        start = np.zeros_like(at)
        for p in range(self.bits):
            bit = (value >> (self.bits - 1 - p) & 1).astype(bool)
            ones_start, ones_at = self._ones(p, start), self._ones(p, at)
            start = np.where(bit, self.zeros[p] + ones_start, start - ones_start)
            at = np.where(bit, self.zeros[p] + ones_at, at - ones_at)
        return at - start

    def access_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value at each place, and how often it occurs before."""
        value, start = np.zeros_like(at), np.zeros_like(at)
        for p in range(self.bits):
            words, _ = self.planes[p]
            bit = (words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            ones_start, ones_at = self._ones(p, start), self._ones(p, at)
            start = np.where(bit, self.zeros[p] + ones_start, start - ones_start)
            at = np.where(bit, self.zeros[p] + ones_at, at - ones_at)
            value = value << 1 | bit
        return value, at - start


def suffix_order(row: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order; no two suffixes may agree on more than ``depth`` numbers."""
    rank, reach = row.astype(np.int64), 1
    while True:
        order = np.argsort(rank, kind="stable")
        ordered = rank[order]
        new = np.empty(len(row), np.int64)
        new[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        if reach > depth or new[order[-1]] == len(row) - 1:
            return order
        later = np.zeros(len(row), np.int64)
        later[:-reach] = new[reach:] + 1
        rank = new * (len(row) + 1) + later
        reach *= 2


class FmIndex:
    """FM-index of segments of numbers; segment ends are numbers of their own."""

    def __init__(self, row: np.ndarray, bounds: np.ndarray):
        """row: word numbers from 0 on; bounds: where segments begin and end."""
        n, count = len(row), len(bounds) - 1
        # Text: each segment and its end mark. End marks are below all words and differ by place.
        self.at = np.arange(n) + np.repeat(np.arange(count), np.diff(bounds))
        text = np.empty(n + count, np.int64)
        ends = bounds[1:] + np.arange(count)
        text[ends] = np.arange(count)
        text[self.at] = row + count
        order = suffix_order(text, int(np.diff(bounds).max(initial=0)) + 1)
        before = text[order - 1]
        plain = np.where(before < count, 0, before - count + 1)  # in the transform ends are all 0
        size = int(row.max(initial=0)) + 2
        self.tree = WaveletTree(plain, max(1, int(size).bit_length()))
        self.below = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=size - 1))]) + count
        # Sampled places: segment starts (so that a walk never meets an end) and every few words.
        inside = np.zeros(n + count, np.int64)
        inside[self.at] = np.arange(n) - np.repeat(bounds[:-1], np.diff(bounds))
        kept = inside[order] % SAMPLE == 0
        self.kept = kept
        self.kept_before = np.concatenate([[0], np.cumsum(kept)]).astype(np.int32)
        self.places = order[kept].astype(np.int32)
        self.size = n + count

    def extend(self, word: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Intervals of the matches with one more word in front."""
        start = self.below[word]
        both = self.tree.rank(np.concatenate([word, word]) + 1, np.concatenate([low, high]))
        return start + both[:len(word)], start + both[len(word):]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of suffixes: steps to the left until a stored one."""
        out, steps = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        left, at = np.arange(len(rows)), rows.copy()
        while len(left):
            known = self.kept[at]
            done = left[known]
            out[done] = self.places[self.kept_before[at[known]]] + steps[done]
            left, at = left[~known], at[~known]
            steps[left] += 1
            if len(left):
                value, before = self.tree.access_rank(at)
                at = self.below[value - 1] + before
        return out


def repeated_windows(row: np.ndarray, bounds: np.ndarray, times: np.ndarray, kind: Kind) -> np.ndarray:
    """Marks of windows (by first word) that an earlier segment of the shard holds too."""
    _, number = np.unique(row, return_inverse=True)
    index = FmIndex(number, bounds)
    starts, _ = window_starts(bounds, kind.width)
    gone = np.zeros(len(row), bool)
    # Matching statistics: all windows step to the left together; a match that occurs once ends.
    alive = starts
    low = np.full(len(alive), 0)
    high = np.full(len(alive), index.size)
    for step in range(kind.width - 1, -1, -1):
        low, high = index.extend(number[alive + step], low, high)
        twice = high - low > 1
        alive, low, high = alive[twice], low[twice], high[twice]
        if not len(alive):
            return gone
    # Each interval once: the earliest of its places stays.
    first, which = np.unique(low, return_inverse=True)
    size = np.zeros(len(first), np.int64)
    size[which] = high - low
    ends = np.cumsum(size)
    rows = np.repeat(first - (ends - size), size) + np.arange(ends[-1])
    earliest = np.minimum.reduceat(index.locate(rows), ends - size)
    gone[alive] = index.at[alive] != earliest[which]
    return gone


def _report(kind: Kind):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column("runs")
            n_words, n_removed, kept_text = [], [], []
            for texts in chunks(batch.column("text")):
                units = Units(texts, kind)
                raw = texts.data.tobytes()
                for i in range(texts.n):
                    place = runs[texts.first + i]
                    gone = removed_units(units, i, place.values if place.is_valid else None, kind)
                    a, b = units.offsets[i], units.offsets[i + 1]
                    kept = np.flatnonzero(~gone) + a
                    n_words.append(b - a)
                    n_removed.append(int(gone.sum()))
                    kept_text.append(b" ".join(
                        [raw[s:e] for s, e in zip(units.words.starts[kept].tolist(),
                                                  units.words.ends[kept].tolist())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept_text, pa.binary())], ["doc_id", "n_words", "n_removed", "kept"])
    return emit


def dedup_substrings(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                     kind: Kind = KIND, hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept: the words left, joined by one space) of every document."""
    texts = sources(documents, id_col, text_col)
    runs = repeated_runs(texts, kind, repeated_windows, True, hot_segments)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    return with_runs(texts, runs).mapInArrow(
        _report(kind), f"doc_id {id_type}, n_words long, n_removed long, kept binary")
