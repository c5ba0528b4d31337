"""Alignment of two tokenizers' ids over a corpus by inverted pair bitmaps.

Each text is encoded by a byte-level BPE (A, on space + text) and a piece model (B, which adds the
space itself). Where an A token and a B token end at the same byte, their ids are linked. The
inverted index holds, for every id pair and every range of ``RANGE`` documents, bitmaps of the
documents: plane k marks the documents whose number of links of that pair has bit k set. A plane is
compressed: sorted 16-bit places while it is sparse, plain bits from ``DENSE`` documents on. Tasks
write partial postings, which are OR-merged per pair and range; the OR of the planes, popcounted,
gives the documents of a pair, and the popcounts weighted by 2**k its links. The postings then carry
the counts back to the documents.

A row of the input is a document of its own, also if its id repeats or is null. Null and empty
texts, and those whose A or B tokens do not spell space + text, have no tokens: zeros and an empty
digest. A text is encoded whole; a very long one takes memory in proportion to its length in the
one task that holds it. Ties for a B id's highest count all count as best. An empty table gives no
rows; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.storage import stored

RANGE_BITS = 13
RANGE = 1 << RANGE_BITS         # documents of one bitmap
DENSE = RANGE // 16             # from here on plain bits take no more room than places
POSTINGS = 2_000_000            # a task writes out its partial postings at this number
CHUNK_CHARS = 1 << 20           # texts that are encoded together; a longer one comes alone
LONG_RUN = re.compile(r"\S{2000}|\s{2000}")
POSTING_SCHEMA = "a int, b int, part long, planes array<binary>"


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """Encoder A. Where ids follow the order of the merges, which is checked, ranks do the work,
    being several times faster; otherwise, and for texts with a very long run without a break, the
    vocabulary's own library does."""

    def __init__(self, path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = _byte_letters()
        vocab = {piece: i for piece, i in model["vocab"].items() if set(piece) <= set(letters)}
        ranks = {bytes(letters[c] for c in piece): i for piece, i in vocab.items()}
        self.tokens = [b""] * (max(model["vocab"].values()) + 1)
        for piece, i in ranks.items():
            self.tokens[i] = piece
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        merged = [vocab.get("".join(m), -1) for m in merges]
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        single = sum(len(piece) == 1 for piece in ranks)
        special = {i for piece, i in model["vocab"].items() if piece == "<|endoftext|>"}
        ordered = single == 256 and merged == sorted(set(merged)) and len(ranks) - len(special) == 256 + len(merged)
        self.by_rank = tiktoken.Encoding("pairs", pat_str=pattern, special_tokens={}, mergeable_ranks={
            piece: i for piece, i in ranks.items() if i not in special}) if ordered else None

    def encode(self, texts: list[str]) -> list:
        if self.by_rank is None:
            return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return [self.library.encode(t, add_special_tokens=False).ids if LONG_RUN.search(t)
                else self.by_rank.encode_ordinary(t) for t in texts]


class Pieces:
    """Encoder B; the bytes of a piece have a space for U+2581, and <0xHH> is a byte."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        one = re.compile(r"<0x([0-9A-Fa-f]{2})>")
        self.tokens = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            byte = one.fullmatch(piece)
            self.tokens.append(bytes([int(byte[1], 16)]) if byte
                               else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list:
        return self.model.encode(texts, num_threads=1)


class Aligner:
    """Both encoders with the tables of their tokens."""

    def __init__(self, a_path: str, b_path: str, pattern: str):
        self.a, self.b = ByteLevel(a_path, pattern), Pieces(b_path)
        self.a_size, self.b_size = (np.array([len(t) for t in e.tokens], np.int64)
                                    for e in (self.a, self.b))
        self.n_a, self.n_b = len(self.a_size), len(self.b_size)
        names = [b"%d%s" % (i, end) for n, ends in ((self.n_a, (b",", b"|")), (self.n_b, (b",", b";")))
                 for end in ends for i in range(n)]
        self.names = np.array(names, object)

    def spelled(self, texts: list[str]) -> tuple[list[int], list, list]:
        """Numbers of the texts whose tokens on both sides spell space + text, and the ids."""
        asked = [i for i, t in enumerate(texts) if t]
        spaced = [" " + texts[i] for i in asked]
        a = self.a.encode(spaced)
        b = self.b.encode([texts[i] for i in asked]) if asked else []
        good = [j for j, whole in enumerate(map(str.encode, spaced))
                if b"".join(map(self.a.tokens.__getitem__, a[j])) == whole
                and b"".join(map(self.b.tokens.__getitem__, b[j])) == whole]
        return [asked[j] for j in good], [a[j] for j in good], [b[j] for j in good]

    def align(self, texts: list[str]) -> dict[str, np.ndarray | list]:
        """Counts, digest and distinct linked pairs of each text.

        ``doc``, ``pair`` (a * n_b + b) and ``times`` are by text, then pair.
        """
        n = len(texts)
        which, a_lists, b_lists = self.spelled(texts)
        which = np.array(which, np.int64)
        sizes = [np.array([len(x) for x in lists], np.int64) for lists in (a_lists, b_lists)]
        a, b = (np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(size.sum()))
                for lists, size in zip((a_lists, b_lists), sizes))
        of = [np.repeat(np.arange(len(which)), size) for size in sizes]
        # A gap of one after each text keeps tokens without bytes in their own text.
        a_end, b_end = np.cumsum(self.a_size[a]) + of[0], np.cumsum(self.b_size[b]) + of[1]
        low, high = np.searchsorted(b_end, a_end, "left"), np.searchsorted(b_end, a_end, "right")
        meet = high - low
        link_a = np.repeat(np.arange(len(a)), meet)
        link_b = np.arange(len(link_a)) - np.repeat(np.cumsum(meet) - meet - low, meet)
        cuts, first = np.unique(a_end[meet > 0], return_index=True)
        cut_of = of[0][meet > 0][first]
        group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)

        order = np.empty(len(a) + len(b), np.int64)
        last = [np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in group]
        order[np.arange(len(a)) + np.searchsorted(group[1], group[0], "left")] = a + self.n_a * last[0]
        order[np.arange(len(b)) + np.searchsorted(group[0], group[1], "right")] = (
            2 * self.n_a + b + self.n_b * last[1])
        written = self.names[order].tolist()
        at = np.concatenate([[0], np.cumsum(sizes[0] + sizes[1])]).tolist()
        digest = [""] * n
        for j, i in enumerate(which.tolist()):
            digest[i] = hashlib.sha256(b"".join(written[at[j]:at[j + 1]])[:-1]).hexdigest()

        pairs = self.n_a * self.n_b
        key, times = np.unique(of[0][link_a] * pairs + a[link_a] * self.n_b + b[link_b],
                               return_counts=True)

        def spread(counts):
            out = np.zeros(n, np.int64)
            out[which] = counts
            return out

        return {"n_a": spread(sizes[0]), "n_b": spread(sizes[1]),
                "n_groups": spread(np.bincount(cut_of, minlength=len(which))),
                "n_links": spread(np.bincount(of[0][link_a], minlength=len(which))),
                "groups_sha256": digest, "doc": which[key // pairs], "pair": key % pairs,
                "times": times}


def pack_planes(group: np.ndarray, place: np.ndarray, times: np.ndarray, n_groups: int) -> pa.ListArray:
    """The planes of each group from its documents' places and link counts.

    ``group`` is ascending, and places ascend inside a group.
    """
    bits = np.zeros(n_groups, np.int64)
    np.maximum.at(bits, group, np.frexp(times.astype(np.float64))[1].astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(bits)])
    which, kept = [], []
    for k in range(int(bits.max(initial=0))):
        there = (times >> k) & 1 == 1
        which.append(offsets[group[there]] + k)
        kept.append(place[there])
    plane = np.concatenate([*which, np.zeros(0, np.int64)])
    low = np.concatenate([*kept, np.zeros(0, np.int64)]).astype(np.uint16)
    turn = np.argsort(plane, kind="stable")
    plane, low = plane[turn], low[turn]
    count = np.bincount(plane, minlength=offsets[-1])
    dense = count >= DENSE
    size = np.where(dense, RANGE // 8, 2 * count)
    starts = np.concatenate([[0], np.cumsum(size)])
    first = np.concatenate([[0], np.cumsum(count)])
    data = np.zeros(starts[-1] // 2, np.uint16)
    sparse = ~dense[plane]
    at = plane[sparse]
    data[starts[at] // 2 + np.flatnonzero(sparse) - first[at]] = low[sparse]
    raw = data.view(np.uint8)
    for p in np.flatnonzero(dense).tolist():
        marks = np.zeros(RANGE, bool)
        marks[low[first[p]:first[p + 1]]] = True
        raw[starts[p]:starts[p + 1]] = np.packbits(marks, bitorder="little")
    planes = pa.Array.from_buffers(pa.binary(), len(size), [
        None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(raw)])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), planes)


def open_planes(planes: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, place and plane number of every mark."""
    flat = planes.flatten()
    lists = np.asarray(planes.value_lengths().fill_null(0)).astype(np.int64)
    row = np.repeat(np.arange(len(lists)), lists)
    k = np.arange(len(row)) - np.repeat(np.cumsum(lists) - lists, lists)
    if not len(flat):
        none = np.zeros(0, np.int64)
        return none, none, none
    offsets = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset:flat.offset + len(flat) + 1].astype(np.int64)
    data = flat.buffers()[2]
    raw = (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))[
        offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    size = np.diff(offsets)
    dense = size == RANGE // 8
    inside = np.repeat(~dense, size)
    low = raw[inside].view("<u2").astype(np.int64)
    mark = np.repeat(np.arange(len(size)), np.where(dense, 0, size // 2))
    rows, places, ks = [row[mark]], [low], [k[mark]]
    for p in np.flatnonzero(dense).tolist():
        marks = np.flatnonzero(np.unpackbits(raw[offsets[p]:offsets[p + 1]], bitorder="little"))
        rows.append(np.full(len(marks), row[p]))
        places.append(marks)
        ks.append(np.full(len(marks), k[p]))
    return tuple(np.concatenate(x) for x in (rows, places, ks))


def _sent(path: str) -> str:
    return path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))


_ALIGNERS: dict[tuple[str, str, str], Aligner] = {}


def _aligner(a_path: str, b_path: str, pattern: str) -> Aligner:
    """One aligner per Python worker, kept between tasks."""
    key = (_sent(a_path), _sent(b_path), pattern)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _table(n: int, **columns) -> dict:
    return {"n": n, **columns}


def _encode(a_path: str, b_path: str, pattern: str, doc_id: pa.DataType):
    """Texts to one row per document and to partial postings, in one pass; both in one schema."""
    fields = [("row", pa.int64()), ("doc_id", doc_id), *[(c, pa.int64()) for c in _COUNTS],
              ("groups_sha256", pa.string()), ("a", pa.int32()), ("b", pa.int32()),
              ("part", pa.int64()), ("planes", pa.list_(pa.binary()))]

    def rows(n: int, columns: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [columns[c] if c in columns else pa.nulls(n, t) for c, t in fields],
            schema=pa.schema(fields))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a_path, b_path, pattern)
        held, size = [], 0

        def postings() -> pa.RecordBatch:
            row, pair, times = (np.concatenate(x) for x in zip(*held))
            # Rows ascend already, so a stable order by range and pair keeps places ascending.
            turn = np.lexsort((pair, row >> RANGE_BITS))
            row, pair, times = row[turn], pair[turn], times[turn]
            part = row >> RANGE_BITS
            new = np.ones(len(row), bool)
            new[1:] = (pair[1:] != pair[:-1]) | (part[1:] != part[:-1])
            planes = pack_planes(np.cumsum(new) - 1, row & (RANGE - 1), times, int(new.sum()))
            return rows(len(planes), {
                "a": pa.array((pair[new] // aligner.n_b).astype(np.int32)),
                "b": pa.array((pair[new] % aligner.n_b).astype(np.int32)),
                "part": pa.array(part[new]), "planes": planes})

        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            numbers = batch.column("row").to_numpy()
            start = 0
            while start < len(texts):
                stop, chars = start, 0
                while stop < len(texts) and (stop == start or chars + len(texts[stop]) <= CHUNK_CHARS):
                    chars += len(texts[stop])
                    stop += 1
                found = aligner.align(texts[start:stop])
                yield rows(stop - start, {
                    "row": batch.column("row")[start:stop], "doc_id": batch.column("doc_id")[start:stop],
                    **{c: pa.array(found[c]) for c in _COUNTS},
                    "groups_sha256": pa.array(found["groups_sha256"], pa.string())})
                held.append((numbers[start:stop][found["doc"]], found["pair"], found["times"]))
                size += len(found["pair"])
                if size >= POSTINGS:
                    yield postings()
                    held, size = [], 0
                start = stop
        if size:
            yield postings()

    return run


def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """OR of the partial postings of each pair and range, whose rows follow each other."""
    def merged(table: pa.Table) -> pa.RecordBatch:
        a, b, part = (table.column(c).to_numpy() for c in ("a", "b", "part"))
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (part[1:] != part[:-1])
        group, n = np.cumsum(new) - 1, int(new.sum())
        row, place, k = open_planes(table.column("planes").combine_chunks())
        marks = np.unique((group[row] * 64 + k) * RANGE + place)      # the OR
        mark_place, mark_plane = marks % RANGE, marks // RANGE % 64
        doc, inverse = np.unique(marks // (RANGE * 64) * RANGE + mark_place, return_inverse=True)
        times = np.zeros(len(doc), np.int64)
        np.add.at(times, inverse, np.int64(1) << mark_plane)
        of = doc // RANGE
        links = np.zeros(n, np.int64)
        np.add.at(links, of, times)
        return pa.RecordBatch.from_arrays(
            [pa.array(a[new]), pa.array(b[new]), pa.array(part[new]),
             pack_planes(of, doc % RANGE, times, n),
             pa.array(np.bincount(of, minlength=n).astype(np.int64)), pa.array(links)],
            ["a", "b", "part", "planes", "n_docs", "n_links"])

    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        a, b, part = (table.column(c).to_numpy() for c in ("a", "b", "part"))
        same = np.flatnonzero((a != a[-1]) | (b != b[-1]) | (part != part[-1]))
        open_from = int(same[-1]) + 1 if len(same) else 0
        if open_from:
            yield merged(table.slice(0, open_from))
        rest = table.slice(open_from)
    if rest is not None:
        yield merged(rest)


def _give_back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per document of what its postings return; rows come sorted by range."""
    part, total = None, None

    def rows() -> pa.RecordBatch:
        there = np.flatnonzero(total[0])
        return pa.RecordBatch.from_arrays(
            [pa.array(part * RANGE + there), pa.array(total[1][there]), pa.array(total[0][there])],
            ["row", "n_best", "count_sum"])

    for batch in batches:
        if not batch.num_rows:
            continue
        parts = batch.column("part").to_numpy()
        row, place, k = open_planes(batch.column("planes"))
        count, best = batch.column("count").to_numpy(), batch.column("best").to_numpy(zero_copy_only=False)
        weight = np.int64(1) << k
        edges = np.flatnonzero(np.append(True, parts[1:] != parts[:-1]))
        mark_part = parts[row]
        for p in parts[edges].tolist():
            if p != part:
                if part is not None:
                    yield rows()
                part, total = p, np.zeros((2, RANGE), np.int64)
            own = mark_part == p if len(edges) > 1 else slice(None)
            np.add.at(total[0], place[own], weight[own] * count[row[own]])
            np.add.at(total[1], place[own], weight[own] * best[row[own]])
    if part is not None:
        yield rows()


def pair_postings(documents: DataFrame, a_path: str, b_path: str, pattern: str, *,
                  id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows of the documents, merged postings), both stored.

    The first has row (an own number), doc_id, n_a, n_b, n_groups, n_links, groups_sha256; the
    second a, b, part (range of rows), planes, n_docs, n_links. The tokenizer files have to be at
    their paths on every machine, or be sent with ``addFile`` under their base names.
    """
    source = documents.select(F.monotonically_increasing_id().alias("row"),
                              F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    schema = (f"row long, doc_id {kind.simpleString()}, " + ", ".join(f"{c} long" for c in _COUNTS)
              + f", groups_sha256 string, {POSTING_SCHEMA}")
    encoded = stored(source.mapInArrow(_encode(a_path, b_path, pattern, to_arrow_type(kind)), schema),
                     "encoded")
    partial = encoded.where("row is null").select("a", "b", "part", "planes")
    merged = stored(partial.repartition("a", "b", "part").sortWithinPartitions("a", "b", "part")
                    .mapInArrow(_merge, f"{POSTING_SCHEMA}, n_docs long, n_links long"), "postings")
    return encoded.where("row is not null").drop("a", "b", "part", "planes"), merged


def pair_counts(postings: DataFrame) -> DataFrame:
    """Per id pair: n_docs, n_links and whether no pair of its B id has more links."""
    pairs = postings.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"),
                                           F.sum("n_links").alias("n_links"))
    top = pairs.groupBy("b").agg(F.max("n_links").alias("top"))
    return pairs.join(top, "b").select("a", "b", "n_docs", "n_links",
                                       (F.col("n_links") == F.col("top")).alias("best"))


def align_documents(documents: DataFrame, a_path: str, b_path: str, pattern: str, *,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: tokens of both sides, groups, links, and what its links' counts are."""
    rows, postings = pair_postings(documents, a_path, b_path, pattern, id_col=id_col, text_col=text_col)
    counts = stored(pair_counts(postings), "pairs")
    scored = postings.select("a", "b", "part", "planes").join(
        counts.select("a", "b", F.col("n_links").alias("count"), "best"), ["a", "b"])
    sums = (scored.select("part", "planes", "count", "best").repartition("part")
            .sortWithinPartitions("part").mapInArrow(_give_back, "row long, n_best long, count_sum long"))
    return rows.join(sums, "row", "left").select(
        "doc_id", *_COUNTS, F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
