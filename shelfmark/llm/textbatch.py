"""Vectorised views of the texts of an Arrow batch: bytes, words, word and window hashes.

A word is a maximal run of bytes other than space and tab to carriage return. All separators are
ASCII, so words are found on UTF-8 bytes. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
WINDOW_BASE = 0xD6E8FEB86659FD93


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; a task keeps the longest row asked for."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        _POWERS[base] = _powers(base, max(n, CHUNK_BYTES + 1))
    return _POWERS[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def runs(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of the given sizes laid end to end: run of each element, and its place in the run."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def folded(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One 64-bit hash per run of 64-bit values.

    Neighbours are mixed in pairs, level by level. No step is linear, so no pattern of the values,
    such as that of a word and its complement, makes two different runs alike; 2**-64 of pairs do.
    """
    out = np.zeros(len(sizes), np.uint64)
    where = np.flatnonzero(sizes)
    sizes = sizes[where]
    while len(where):
        single = sizes == 1
        ends = np.cumsum(sizes)
        out[where[single]] = values[ends[single] - 1]
        if single.all():
            break
        where, starts, sizes = where[~single], (ends - sizes)[~single], sizes[~single]
        half = (sizes + 1) // 2
        # Element 2 i of a run lies at the run's start plus twice its place among the halves.
        shift = starts - 2 * (np.cumsum(half) - half)
        left = 2 * np.arange(half.sum()) + np.repeat(shift, half)
        right = np.append(values, np.uint64(0))[left + 1]
        right[(np.cumsum(half) - 1)[sizes % 2 == 1]] = np.uint64(WINDOW_BASE)
        pair = values[left] * np.uint64(_BASE)
        pair ^= pair >> np.uint64(32)
        pair += right
        pair *= np.uint64(WINDOW_BASE)
        pair ^= pair >> np.uint64(29)
        values, sizes = pair, half
    return out


class Texts:
    """Some whole texts as one byte row; ``offsets`` has n + 1 entries."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first
        self.n = len(offsets) - 1
        self._sums = self._blocks = None

    @property
    def sums(self) -> np.ndarray:
        """Prefix sums of byte value times base**position, for hashes of all short byte ranges."""
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_BYTE_VALUES[self.data] * powers(_BASE, len(self.data)), out=self._sums[1:])
        return self._sums

    @property
    def blocks(self) -> np.ndarray:
        """The eight bytes from every position on as one number."""
        if self._blocks is None:
            padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
            self._blocks = np.ndarray(len(self.data) + 1, "<u8", padded, strides=(1,))
        return self._blocks

    def range_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of every byte range; equal bytes give equal hashes, and see ``folded``."""
        size = ends - starts
        count = (size + 7) // 8
        last = np.cumsum(count)
        values = self.blocks[8 * np.arange(count.sum()) + np.repeat(starts - 8 * (last - count), count)]
        whole = count > 0
        values[last[whole] - 1] &= np.uint64(2**64 - 1) >> (8 * (8 * count - size)[whole]).astype(np.uint64)
        return mix(folded(mix(values + np.uint64(_BASE)), count)
                   + size.astype(np.uint64) * np.uint64(WINDOW_BASE))

    def gram_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A cheaper hash for the grams at all positions, which only pick places: a sum, so strings
        built for it can be alike."""
        raw = (self.sums[ends] - self.sums[starts]) * powers(_INVERSE, len(self.data) + 1)[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(WINDOW_BASE))

    def words(self) -> "Words":
        return Words(self)


class Words:
    """Byte ranges of the words; ``offsets`` counts words per text (n + 1 entries)."""

    def __init__(self, texts: Texts):
        self.texts = texts
        inside = ~_SEPARATOR[texts.data]
        edges = texts.offsets[texts.offsets < len(texts.data)]
        start, end = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1]
        start[edges] = inside[edges]
        end[:-1] &= ~inside[1:]
        last = edges[edges > 0] - 1
        end[last] = inside[last]
        self.inside = inside
        self.starts, self.ends = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.offsets = np.searchsorted(self.starts, texts.offsets)
        self.counts = np.diff(self.offsets)

    def hashes(self) -> np.ndarray:
        return self.texts.range_hash(self.starts, self.ends)


def window_hashes(units: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive units from every position that has k units left, by doubling."""
    n = len(units)
    if n < k:
        return np.zeros(0, np.uint64)
    have, size, out, done = units, 1, None, 0
    for bit in reversed(f"{k:b}"):
        shift = np.uint64(pow(WINDOW_BASE, size, 1 << 64))
        if bit == "1":
            if out is None:
                out = have
            else:
                m = n - done - size + 1
                out = out[:m] * shift + have[done:done + m]
            done += size
        if done < k:
            have = have[:-size] * shift + have[size:]
            size *= 2
    return mix(out)


def window_starts(offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of all windows of k units that stay inside one text: unit index of the start, text number."""
    counts = np.maximum(np.diff(offsets) - (k - 1), 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    skipped = np.cumsum(counts) - counts
    return np.arange(len(owner)) - skipped[owner] + offsets[:-1][owner], owner


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The texts of an Arrow column in runs of about ``limit`` bytes; a longer text comes alone."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = (np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None
            else np.zeros(0, np.uint8))
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), n)
        yield Texts(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at], at)
        at = to


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` per text."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Marks of the units that lie in any window of ``width`` units from ``starts``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + width, n), -1)
    return np.cumsum(change[:n]) > 0


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words inside one text, in order, and their offsets per text."""
    starts, _ = window_starts(words.offsets, k)
    counts = np.maximum(words.counts - (k - 1), 0)
    hashes = window_hashes(words.hashes(), k)
    return (hashes[starts] if len(starts) else np.zeros(0, np.uint64)), \
        np.concatenate([[0], np.cumsum(counts)])


def permutations(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors (odd) and summands of n mappings of 32-bit values onto themselves."""
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 2**31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1),
            rng.integers(0, 2**32, n, dtype=np.uint32))


def minima(hashes: np.ndarray, starts: np.ndarray, maps: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Smallest mapped value (rows: maps) of each run of hashes that begins at one of ``starts``."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(maps[0]), len(starts)), np.uint32)
    for i, (factor, summand) in enumerate(zip(*maps)):
        out[i] = np.minimum.reduceat(short * factor + summand, starts)
    return out
