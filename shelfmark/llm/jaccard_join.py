"""N-gram Jaccard join by chosen paths.

Sets are the distinct five-word shingles of the texts. Rows with equal sets are one
representative with a count. A run starts with all representatives in one node; a node picks on
average 1 / 0.8 of ``HASHES`` MinHash coordinates at random and sends each set to one child per
picked coordinate, named by the value there. Small nodes (``LEAF``) are compared all against all
by sketch; large ones are split again, down to ``MAX_DEPTH``; what is still large there shares so
many values that it counts as connected. A node of up to ``NODE_SETS`` is split inside one task, from one byte of
each value, and gives one set of spanning edges; only larger ones are split by Spark, set by set. Runs are repeated
until a pair at similarity 0.8 has met with the target recall, given the depth that the data needed.

Sketch links only say which sets may be linked: their connected components are then verified by
exact set intersection. A component too large for one task is cut into blocks, and each pair of
blocks is one task; the tasks give sums of links and spanning edges, never the pairs. The number
of comparisons in a component of n sets that are all alike is n * n; equal sets are not compared.

Cases: null or empty texts have no set, no link, and are a class of their own; a text of one to
four words is one shingle; repeated rows are equal sets; a null id is a row like any other, and
a class's id is its least id that is not null; an empty table gives an empty result; other columns
are ignored (or kept, in ``keep_one``).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.components import components
from shelfmark.llm.storage import stored
from shelfmark.llm.textbatch import (
    Texts, chunks, minima, mix, permutations, shingles, window_hashes)

SHINGLE_WORDS = 5
MIN_JACCARD = 0.8
HASHES = 128
LOOSE_SHARE = 0.65         # of sketch bytes that agree before a pair is verified
LEAF = 128                 # sets that are compared all against all
NODE_SETS = 32_768         # sets whose node is split inside one task (about 5 MB of marks)
MAX_DEPTH = 4
TARGET_RECALL = 0.9999
BLOCK_SETS, BLOCK_SHINGLES = 768, 400_000

_MAPS = permutations(HASHES, 23)


def sets_of(texts: Texts) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = texts.words()
    hashes, offsets = shingles(words, SHINGLE_WORDS)
    out = [np.unique(hashes[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    for i in np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE_WORDS)):
        own = words.hashes()[words.offsets[i]:words.offsets[i + 1]]
        out[i] = window_hashes(own, len(own)) + np.uint64(len(own))
    return out


def _sketches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in chunks(batch.column("text")):
            sets = sets_of(texts)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys, sketches = [None] * texts.n, [None] * texts.n
            if full:
                starts = np.cumsum([0, *[len(sets[i]) for i in full[:-1]]])
                lows = np.ascontiguousarray(
                    minima(np.concatenate([sets[i] for i in full]), starts, _MAPS).T)
                for i, low in zip(full, lows):
                    keys[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                    sketches[i] = low.tobytes()
            rows = slice(texts.first, texts.first + texts.n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row")[rows], pa.array(keys, pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array(sketches, pa.binary())],
                ["row", "set_key", "n", "sketch"])


def _lows(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("sketch")
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), HASHES)


def _salt(coordinate: int, factor: int) -> np.uint64:
    return np.uint64((coordinate + 1) * factor % 2**64)


def _name(node: np.ndarray, coordinate: int, low: np.ndarray) -> np.ndarray:
    return mix(node ^ mix(low.astype(np.uint64) + _salt(coordinate, 0x9E3779B97F4A7C15)))


def _picked(node: np.ndarray, coordinate: int) -> np.ndarray:
    """Whether a node picks a coordinate: 1 / 0.8 of them on average."""
    draw = mix(node + _salt(coordinate, 0xD1B54A32D192ED03))
    return draw < np.uint64(int(2**64 / (MIN_JACCARD * HASHES)))


def _node_rows(nodes: list, rows: list) -> pa.RecordBatch:
    node = np.concatenate(nodes) if nodes else np.zeros(0, np.uint64)
    row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(row)], ["node", "row"])


def _first_level(runs: range):
    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows, row = _lows(batch), batch.column("row").to_numpy()
            nodes, rows = [], []
            for run in runs:
                root = mix(np.array([run + 1], np.uint64))
                for i in range(HASHES):
                    if _picked(root, i)[0]:
                        nodes.append(_name(root, i, lows[:, i]))
                        rows.append(row)
            yield _node_rows(nodes, rows)
    return split


def _next_level(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lows, row = _lows(batch), batch.column("row").to_numpy()
        node = batch.column("node").to_numpy().view(np.uint64)
        nodes, rows = [], []
        for i in range(HASHES):
            into = np.flatnonzero(_picked(node, i))
            nodes.append(_name(node[into], i, lows[into, i]))
            rows.append(row[into])
        yield _node_rows(nodes, rows)


def _runs(depth: int, target: float) -> int:
    """Runs until a pair at the threshold has met with probability ``target``.

    Two sets share one child on average, so they still meet at depth d + 1 with probability
    1 - exp(-p) when they do at depth d with probability p.
    """
    meet = 1.0
    for _ in range(depth):
        meet = 1 - math.exp(-meet)
    return math.ceil(math.log(1 - target) / math.log(1 - meet))


def _local_roots(linked: np.ndarray) -> np.ndarray:
    """Least index that each index is connected to, from a symmetric matrix of links."""
    n = len(linked)
    roots = np.arange(n)
    while True:
        new = np.minimum(roots, np.where(linked, roots, n).min(1, initial=n))
        if (new == roots).all():
            return roots
        roots = new


def _leaves(node: int, marks: np.ndarray, level: int, leaf: int) -> Iterator[tuple[np.ndarray, int]]:
    """Places and levels of the leaves below a node; ``marks``: a row of one byte per coordinate and set.

    What is large at ``MAX_DEPTH`` is a leaf too. A split gives its level even if no child has two sets.
    """
    waiting = [(node, np.arange(len(marks)), level)]
    while waiting:
        name, places, level = waiting.pop()
        if len(places) <= leaf or level == MAX_DEPTH:
            yield places, level
            continue
        yield places[:0], level + 1
        own = np.array([name], np.uint64)
        for i in range(HASHES):
            if not _picked(own, i)[0]:
                continue
            value = marks[places, i]
            order = np.argsort(value, kind="stable")
            cuts = np.flatnonzero(np.diff(value[order])) + 1
            for part in np.split(order, cuts):
                if len(part) > 1:
                    child = _name(own, i, value[part[:1]])[0]
                    waiting.append((child, places[part], level + 1))


def _node_edges(level: int, leaf: int):
    """Spanning edges of the sketch links in every node of a level, and the deepest level that was needed.

    The first row of a batch tells only that: its edge leads to itself.
    """
    need = math.ceil(LOOSE_SHARE * HASHES)

    def link(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, deepest = [], [], level
            nodes = batch.column("node").to_numpy().view(np.uint64)
            for node, members in zip(nodes, batch.column("members")):
                rows = members.values.field("row").to_numpy()
                marks = np.frombuffer(b"".join(members.values.field("marks").to_pylist()),
                                      np.uint8).reshape(len(rows), HASHES)
                order = np.argsort(rows)
                rows, marks = rows[order], marks[order]
                roots = np.arange(len(rows))
                for places, depth in _leaves(node, marks, level, leaf):
                    deepest = max(deepest, depth)
                    if len(places) < 2:
                        continue
                    if len(places) <= leaf:
                        part = marks[places]
                        linked = np.stack([(part == m).sum(1) >= need for m in part])
                        low = _local_roots(linked)
                    else:
                        low = np.zeros(len(places), int)
                    other = np.flatnonzero(low != np.arange(len(places)))
                    _unite(roots, places[other], places[low[other]])
                roots = _flat(roots)
                other = np.flatnonzero(roots != np.arange(len(rows)))
                a += [rows[other]] if a else [rows[:1], rows[other]]
                b += [rows[roots[other]]] if b else [rows[:1], rows[roots[other]]]
            if a:
                a, b = np.concatenate(a), np.concatenate(b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(b), pa.array(np.full(len(a), deepest, np.int32))], ["a", "b", "depth"])
    return link


def _unite(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of each pair; a root is never above its members."""
    for x, y in zip(a.tolist(), b.tolist()):
        while roots[x] != x:
            roots[x] = x = roots[roots[x]]
        while roots[y] != y:
            roots[y] = y = roots[roots[y]]
        roots[max(x, y)] = min(x, y)


def _flat(roots: np.ndarray) -> np.ndarray:
    while True:
        new = roots[roots]
        if (new == roots).all():
            return roots
        roots = new


def _marks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One byte of each sketch value."""
    for batch in batches:
        marks = [m.tobytes() for m in (_lows(batch) >> np.uint32(13)).astype(np.uint8)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(marks, pa.binary())], ["row", "marks"])


def loose_edges(reps: DataFrame, target: float = TARGET_RECALL) -> DataFrame:
    """Spanning edges (a, b) among representatives whose sketches are alike; reps: row, sketch."""
    marks = stored(reps.select("row", "sketch").mapInArrow(_marks, "row long, marks binary"), "marks")
    done, depth, out = 0, 1, []
    while done < _runs(depth, target):
        runs = range(done, _runs(depth, target))
        done = runs.stop
        nodes = reps.select("row", "sketch").mapInArrow(_first_level(runs), "node long, row long")
        for level in range(1, MAX_DEPTH + 1):
            sizes = nodes.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
            held = stored(nodes.join(sizes, "node"), "nodes")
            most = LEAF if level == MAX_DEPTH else NODE_SETS
            leaves = held.where(F.col("size") <= most).join(marks, "row").groupBy("node").agg(
                F.collect_list(F.struct("row", "marks")).alias("members"))
            found = stored(leaves.select("node", "members").mapInArrow(
                _node_edges(level, LEAF), "a long, b long, depth int"), "edges")
            depth = max(depth, found.agg(F.max("depth")).first()[0] or 1)
            out.append(found.where("a <> b").select("a", "b"))
            large = held.where(F.col("size") > most)
            if large.isEmpty():
                break
            depth = max(depth, min(level + 1, MAX_DEPTH))
            if level == MAX_DEPTH:
                centre = large.groupBy("node").agg(F.min("row").alias("b"))
                out.append(large.join(centre, "node").select(F.col("row").alias("a"), "b"))
            else:
                nodes = large.join(reps.select("row", "sketch"), "row").select(
                    "node", "row", "sketch").mapInArrow(_next_level, "node long, row long")
    edges = out[0]
    for more in out[1:]:
        edges = edges.unionByName(more)
    return edges


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the sizes of all pairwise intersections."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times > 1
    number = np.cumsum(common) - 1
    keep = common[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = 8192
    total = np.zeros((n, n), np.float64)
    for low in range(0, int(common.sum()), width):
        a, b = np.searchsorted(column, [low, low + width])
        block = np.zeros((n, min(width, int(common.sum()) - low)), np.float32)
        block[owner[a:b], column[a:b] - low] = 1
        total += block @ block.T
    out = np.rint(total).astype(np.int64)
    out[np.arange(n), np.arange(n)] = [len(s) for s in sets]
    return out


def grouped(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal keys of rows that come sorted by them."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
        if not table.num_rows:
            continue
        values = np.stack([table.column(k).to_numpy() for k in keys])
        cuts = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(0)) + 1
        bounds = [0, *cuts.tolist()]
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(bounds[-1])
    if rest is not None and rest.num_rows:
        yield rest


def _verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each pair of blocks: links of every row in it, and a spanning edge to a lower row."""
    rows_out, links_out, roots_out, many_out, size = [], [], [], [], 0

    def result():
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c)) for c in (rows_out, links_out, roots_out, many_out)],
            ["row", "links", "low", "many"])

    for group in grouped(batches, ["root", "p", "q"]):
        order = np.argsort(group.column("row").to_numpy())
        group = group.take(pa.array(order))
        row, copies = (group.column(c).to_numpy() for c in ("row", "copies"))
        block = group.column("block").to_numpy()
        p, q = group.column("p")[0].as_py(), group.column("q")[0].as_py()
        sets = [np.frombuffer(h, np.uint64) for h in group.column("hashes").to_pylist()]
        shared = shared_counts(sets)
        own = np.diag(shared)
        linked = 5 * shared >= 4 * (own[:, None] + own[None, :] - shared)
        np.fill_diagonal(linked, False)
        if p != q:
            linked &= block[:, None] != block[None, :]
        roots = _local_roots(linked)
        rows_out.append(row)
        links_out.append(linked @ copies)
        roots_out.append(row[roots])
        many_out.append(np.full(len(row), group.column("blocks")[0].as_py() > 1))
        size += len(row)
        if size >= 10_000:
            yield result()
            rows_out, links_out, roots_out, many_out, size = [], [], [], [], 0
    if size:
        yield result()


def _shingle_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in chunks(batch.column("text")):
            rows = batch.slice(texts.first, texts.n)
            yield pa.RecordBatch.from_arrays(
                [*[rows.column(c) for c in ("row", "root", "copies", "blocks")],
                 pa.array([s.tobytes() for s in sets_of(texts)], pa.binary())],
                ["row", "root", "copies", "blocks", "hashes"])


def link_rows(texts: DataFrame, target: float = TARGET_RECALL) -> DataFrame:
    """(row, class, n_links) of every row of ``texts`` (row: distinct long, text); class: a row.

    ``texts`` is read three times, so it should be a stored table.
    """
    sketches = stored(texts.mapInArrow(
        _sketches, "row long, set_key binary, n long, sketch binary"), "sketches")
    full = sketches.where("n > 0")
    reps = stored(full.groupBy("set_key").agg(
        F.min(F.struct("row", "n", "sketch")).alias("r"), F.count("*").alias("copies"))
        .select("set_key", "r.*", "copies"), "representatives")
    loose = stored(components(loose_edges(reps, target)), "loose")
    sizes = loose.join(reps.select(F.col("row").alias("vertex"), "n"), "vertex").groupBy("root").agg(
        F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    members = stored(
        loose.join(sizes, "root").join(reps.select(F.col("row").alias("vertex"), "copies"), "vertex")
        .select(F.col("vertex").alias("row"), "root", "copies", F.greatest(
            F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
            .cast("long").alias("blocks")), "members")
    sets = texts.join(members, "row").select("row", "text", "root", "copies", "blocks").mapInArrow(
        _shingle_rows, "row long, root long, copies long, blocks long, hashes binary")
    block = F.pmod(F.xxhash64("row", F.lit(5)), F.col("blocks"))
    dealt = (sets.withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other")))
    parts = max(8, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    links = stored(dealt.repartition(parts, "root", "p", "q").sortWithinPartitions("root", "p", "q")
                   .select("row", "root", "copies", "blocks", "block", "p", "q", "hashes")
                   .mapInArrow(_verify, "row long, links long, low long, many boolean"), "links")
    counts = links.groupBy("row").agg(F.sum("links").alias("links"))
    spread = links.where("many").select(F.col("row").alias("a"), F.col("low").alias("b"))
    roots = links.where("not many").select("row", "low")
    if not spread.isEmpty():
        roots = roots.unionByName(components(spread).select(
            F.col("vertex").alias("row"), F.col("root").alias("low")))
    told = (reps.select("row", "set_key", "copies").join(counts, "row", "left")
            .join(roots, "row", "left")
            .select("set_key", F.coalesce("low", "row").alias("class"),
                    (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    return sketches.select("row", "set_key").join(told, "set_key", "left").select(
        "row", F.coalesce("class", "row").alias("class"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def jaccard_classes(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    target: float = TARGET_RECALL) -> DataFrame:
    """One row per document: doc_id, class_id (the least doc_id of its class), n_links."""
    rows = stored(documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
                  .withColumn("row", F.monotonically_increasing_id()), "texts")
    linked = stored(link_rows(rows.select("row", "text"), target), "classes")
    named = rows.select("row", "doc_id").join(linked, "row")
    least = named.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    return named.join(least, "class").select("doc_id", "class_id", "n_links")


def keep_one(documents: DataFrame, *, text_col: str = "text",
             target: float = TARGET_RECALL) -> DataFrame:
    """The rows of ``documents``, one of each class (its first in the stored order), unchanged."""
    columns = documents.columns
    rows = stored(documents.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)],
                                   F.monotonically_increasing_id().alias("row")), "documents")
    linked = link_rows(rows.select("row", F.col(f"c{columns.index(text_col)}").alias("text")), target)
    others = stored(linked.where("class <> row").select("row"), "others")
    return rows.join(others, "row", "left_anti").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
