"""Byte-level BPE encoding and decoding with a rank queue.

The distinct unknown pre-tokens of an Arrow batch lie in one linked list of token starts, cut at
their borders. For every merge rank a bucket holds list positions whose pair has that rank; a
three-level bitmap over the ranks says which buckets are filled, and find-first-set on it gives
the lowest rank. All positions of that bucket merge in one vectorised step, left one first where
two overlap; entries that an earlier merge outdated are skipped. Work follows the number of merges,
so a very long pre-token is no special case. Where a merge makes a pair of a lower rank in the
same pre-token, one-at-a-time order could matter, and that pre-token is merged once more alone.

Cases: a null or empty text has no ids and decodes to no bytes; repeated rows are encoded alike;
an empty table gives an empty result; other columns of the input are carried only if asked for.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

MEMO_ENTRIES = 400_000     # a worker forgets its pre-tokens between batches beyond this number
NO_RANK = np.iinfo(np.int32).max


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a .tiktoken file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankQueue:
    """Buckets of list positions by rank; a three-level bitmap finds the lowest filled one."""

    def __init__(self, ranks: int):
        self.low = [0] * (ranks // 64 + 1)
        self.mid = [0] * (ranks // 4096 + 1)
        self.top = 0
        self.buckets: dict[int, list] = {}

    def bucket(self, rank: int) -> list:
        """The bucket of a rank, marked as filled."""
        found = self.buckets.get(rank)
        if found is None:
            found = self.buckets[rank] = []
            self.low[rank >> 6] |= 1 << (rank & 63)
            self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
            self.top |= 1 << (rank >> 12)
        return found

    def first(self) -> int:
        """The lowest rank with a filled bucket, or -1."""
        top = self.top
        if not top:
            return -1
        a = (top & -top).bit_length() - 1
        word = self.mid[a]
        b = a << 6 | (word & -word).bit_length() - 1
        word = self.low[b]
        return b << 6 | (word & -word).bit_length() - 1

    def take(self, rank: int) -> list:
        """Remove and return a whole bucket."""
        low = self.low[rank >> 6] = self.low[rank >> 6] & ~(1 << (rank & 63))
        if not low:
            mid = self.mid[rank >> 12] = self.mid[rank >> 12] & ~(1 << (rank >> 6 & 63))
            if not mid:
                self.top &= ~(1 << (rank >> 12))
        return self.buckets.pop(rank)


class _Numbers(dict):
    """Numbers pre-tokens in the order in which they are first asked for."""

    def __missing__(self, token: str) -> int:
        self[token] = number = len(self)
        return number


def _gather(flat: np.ndarray, offsets: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """The slices ``flat[offsets[p]:offsets[p + 1]]`` of all picks, one after another."""
    sizes = offsets[picks + 1] - offsets[picks]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(offsets[picks] - (ends - sizes), sizes) + np.arange(total)]


class Codec:
    """Encoder and decoder for one rank table and one pre-token pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.size = max(ranks.values(), default=-1) + 1
        # All pairs of tokens whose bytes together are a token, sorted for look-up.
        pairs = [(ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs], np.int32)
        self.byte_ids = np.array([ranks.get(bytes([i]), 0) for i in range(256)], np.int32)
        sizes = np.zeros(self.size + 1, np.int64)
        for token, rank in ranks.items():
            sizes[rank + 1] = len(token)
        self.token_offsets = np.cumsum(sizes)
        self.token_bytes = np.frombuffer(
            b"".join(t for t, _ in sorted(ranks.items(), key=lambda x: x[1])), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.ids, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.pair_keys):
            return np.full(len(left), NO_RANK, np.int32)
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NO_RANK)

    @staticmethod
    def _fill(queue: RankQueue, ranks: np.ndarray, positions: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist()]
        for start, end, rank in zip(starts, [*starts[1:], len(ranks)], ranks[starts].tolist()):
            queue.bucket(rank).append(positions[start:end])

    def merge_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, and the offsets of the pieces in them."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        n = int(bounds[-1])
        if not n:
            return np.zeros(0, np.int32), bounds
        token = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[bounds[1:][sizes > 0] - 1] = -1
        before[bounds[:-1][sizes > 0]] = -1
        alive = np.ones(n, bool)
        pair = np.full(n, NO_RANK, np.int32)
        linked = np.flatnonzero(after >= 0)
        pair[linked] = self._pair_ranks(token[linked], token[after[linked]])
        queue = RankQueue(self.size)
        known = np.flatnonzero(pair != NO_RANK)
        if len(known):
            self._fill(queue, pair[known], known)
        odd = set()
        while (rank := queue.first()) >= 0:
            bucket = queue.take(rank)
            left = bucket[0] if len(bucket) == 1 else np.concatenate(bucket)
            left = left[pair[left] == rank]
            if not len(left):
                continue
            if len(left) > 1:
                left = np.sort(left)
                clash = after[left[:-1]] == left[1:]
                if clash.any():
                    # In a chain of overlapping pairs every second one merges, from the left.
                    place = np.arange(len(left))
                    head = np.concatenate([[True], ~clash])
                    left = left[(place - np.maximum.accumulate(np.where(head, place, 0))) % 2 == 0]
            right = after[left]
            following = after[right]
            token[left] = rank
            after[left] = following
            inner = following >= 0
            before[following[inner]] = left[inner]
            alive[right] = False
            pair[right] = NO_RANK
            pair[left] = NO_RANK
            previous = before[left]
            changed = np.concatenate([left[inner], previous[previous >= 0]])
            if len(left) > 1:
                changed = np.unique(changed)
            new = self._pair_ranks(token[changed], token[after[changed]])
            pair[changed] = new
            told = new != NO_RANK
            new, changed = new[told], changed[told]
            if len(new):
                lower = new < rank
                if lower.any():
                    odd.update(np.searchsorted(bounds, changed[lower], "right").tolist())
                self._fill(queue, new, changed)
        starts = np.flatnonzero(alive)
        ids, offsets = token[starts], np.searchsorted(starts, bounds)
        if odd:
            parts = [ids[offsets[i]:offsets[i + 1]] for i in range(len(pieces))]
            for i in odd:
                parts[i - 1] = np.array(self.merge(pieces[i - 1]), np.int32)
            ids = np.concatenate(parts)
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, offsets

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token, one merge at a time."""
        ranks, n = self.ranks, len(piece)
        ends = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        pair: list[int | None] = [None] * n
        queue = RankQueue(self.size)

        def pair_up(i: int) -> None:
            pair[i] = rank = ranks.get(piece[i:ends[ends[i]]]) if ends[i] < n else None
            if rank is not None:
                heapq.heappush(queue.bucket(rank), i)

        for i in range(n - 1):
            pair_up(i)
        while (rank := queue.first()) >= 0:
            bucket = queue.bucket(rank)
            i = heapq.heappop(bucket)
            if not bucket:
                queue.take(rank)
            if pair[i] != rank:
                continue
            j = ends[i]
            ends[i] = ends[j]
            pair[j] = None
            if ends[i] < n:
                before[ends[i]] = i
            pair_up(i)
            if before[i] >= 0:
                pair_up(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:ends[i]]])
            i = ends[i]
        return out

    def encode_batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of every whole text."""
        if len(self.numbers) > MEMO_ENTRIES:
            self._forget()
        known = len(self.numbers)
        picks = []
        for text in texts:
            found = self.find(text)
            picks.append(np.fromiter(map(self.numbers.__getitem__, found), np.int64, len(found)))
        pieces = [t.encode() for t in itertools.islice(self.numbers, known, None)]
        # A pre-token that is a token itself is taken whole, as the public encoder does.
        whole = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int64, len(pieces))
        rest = np.flatnonzero(whole < 0)
        ids, offsets = self.merge_all([pieces[i] for i in rest.tolist()])
        sizes = np.ones(len(pieces), np.int64)
        sizes[rest] = np.diff(offsets)
        all_offsets = np.concatenate([[0], np.cumsum(sizes)])
        all_ids = np.empty(all_offsets[-1], np.int32)
        single = np.flatnonzero(whole >= 0)
        all_ids[all_offsets[:-1][single]] = whole[single]
        mask = np.ones(len(all_ids), bool)
        mask[all_offsets[:-1][single]] = False
        all_ids[mask] = ids
        self.offsets = np.concatenate([self.offsets, all_offsets[1:] + self.offsets[-1]])
        self.ids = np.concatenate([self.ids, all_ids])
        for pick in picks:
            yield _gather(self.ids, self.offsets, pick)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids stand for."""
        return _gather(self.token_bytes, self.token_offsets, ids).tobytes()


_CODECS: dict[tuple[str, str], Codec] = {}


def _codec(ranks_file: str, pattern: str) -> Codec:
    """One codec per Python worker and table, kept between tasks."""
    key = (ranks_file, pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(load_ranks(ranks_file), pattern)
    return _CODECS[key]


def bpe_round_trip(documents: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id",
                   text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per document: n_tokens, digests of the ids and of the bytes they decode to.

    ``with_ids`` adds the ids themselves (array of int) and the decoded bytes. No shuffle. The
    rank file has to be at ``ranks_path`` on every machine, or be sent with ``addFile`` under
    its base name.
    """
    source = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = ranks_path if os.path.exists(ranks_path) else SparkFiles.get(
            os.path.basename(ranks_path))
        codec = _codec(sent, pattern)
        for batch in batches:
            n_tokens, ids_sha, decoded_sha, ids_out, decoded_out = [], [], [], [], []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for ids in codec.encode_batch(texts):
                decoded = codec.decode(ids)
                n_tokens.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded_sha.append(hashlib.sha256(decoded).hexdigest())
                if with_ids:
                    ids_out.append(ids)
                    decoded_out.append(decoded)
            columns = [batch.column("doc_id"), pa.array(n_tokens, pa.int64()),
                       pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array(ids_out, pa.list_(pa.int32())),
                            pa.array(decoded_out, pa.binary())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    more = ", ids array<int>, decoded binary" if with_ids else ""
    return source.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, "
                                  f"decoded_sha256 string{more}")
