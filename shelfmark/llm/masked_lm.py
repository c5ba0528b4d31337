"""Language-model scoring by masked pseudo-likelihood.

Every token is predicted from the ``REACH`` words on both sides. All words are counted exactly, as a
Spark table (word, n). With V distinct words, the ``OWN`` x sqrt(V) most frequent have a class of
their own; the rest share sqrt(V) classes, each a range of frequencies. A small network (one
embedding per place and class, summed, tanh, softmax over groups of classes and then over the
classes of the group) gives the class of the middle word; the word's share of its class, counted
over the whole corpus, gives the rest. A document's score is the sum of the log-probabilities of
its tokens.

Texts are dealt to blocks of ``BLOCK_BYTES``. Spark joins the distinct words of each block with the
table of words, and each block is encoded with its own words only, so the table of words is never
sent to a task or gathered. What is gathered and sent are the classes' parameters, about
``(2 * REACH + 1) * HIDDEN * (OWN + 1) * sqrt(V)`` numbers, the words with a class of their own and
the distinct frequencies.

Training covers all documents: they are dealt to ``SLICES`` slices, and an epoch takes one slice after
the other. Each task descends in numpy over its own texts of the slice from the same start, with steps
divided by the root of the squared gradients so far (AdaGrad); Spark averages the tasks' parameters and
squares, weighted by tokens, in levels of ``FAN`` tasks. The loss is taken while training, so in the first
epoch it is that of unseen texts. Another epoch follows while the last slice has lost more than
``TOLERANCE`` less than the slice before, at most ``MAX_EPOCHS`` in all; those of the last are used
then. A slice has a task for every ``TASK_TOKENS`` tokens, or twice the numbers that a task returns if that
is more, however many partitions the input has: no task takes only a few steps, and what is averaged
stays smaller than the texts.

Cases: a null or empty text has no tokens and a score of 0 (its mean is null); repeated rows score
alike and count twice; a one-word text is predicted from empty sides; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.storage import new_folder, stored
from shelfmark.llm.textbatch import chunks, per_text
from shelfmark.session import scratch_scope

OWN = 4                    # times sqrt(V): classes of one frequent word
LEAST_CLASSES = 32         # of either sort
REACH = 2
HIDDEN = 16
SLICES = 4                 # of an epoch
TOLERANCE = 0.01           # share of the loss that the last slice has to save for another epoch
MAX_EPOCHS = 20
TASK_TOKENS = 500_000
BLOCK_BYTES = 8 << 20      # of texts encoded together
BATCH = 8192               # tokens per step
ROWS = 1024                # of them scored at a time, which stay in the processor's cache
SCORED = 1 << 16           # tokens scored together, so that few rows are many of a group of classes
LEAST_SUM = 1e-15          # of exponentials that are taken as they are
RATE = 0.3
BLOCK = 8192               # parameters per row when tasks are averaged
FAN = 64                   # rows averaged at a time


def _dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of its block for every row."""
    block, size = 0, BLOCK_BYTES
    for batch in batches:
        for texts in chunks(batch.column("text")):
            rows = batch.slice(texts.first, texts.n)
            if size + len(texts.data) > BLOCK_BYTES:
                block, size = rows.column("row")[0].as_py(), 0
            size += len(texts.data)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(texts.n, block, np.int64)),
                 rows.column("doc_id"), rows.column("text")], ["block", "doc_id", "text"])


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each block; a block that lies in two batches comes twice."""
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        for low, high in zip(cuts[:-1], cuts[1:]):
            hashes, found, counts = [], [], []
            for texts in chunks(batch.column("text").slice(low, high - low)):
                words, raw = texts.words(), texts.data.tobytes()
                own, first, n = np.unique(words.hashes(), return_index=True, return_counts=True)
                hashes.append(own)
                counts.append(n)
                found += [raw[a:b] for a, b in zip(words.starts[first].tolist(),
                                                   words.ends[first].tolist())]
            _, first, place = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
            n = np.bincount(place, np.concatenate(counts), len(first)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), block[low], np.int64)),
                 pa.array([found[i] for i in first.tolist()], pa.binary()), pa.array(n)],
                ["block", "word", "n"])


def vocabulary(words: DataFrame) -> tuple[DataFrame, int]:
    """(word, class, log_share) of every word, and the number of classes; words: word, n.

    Class 0 stands for places outside the text.
    """
    spark = words.sparkSession
    counts = stored(words.groupBy("word").agg(F.sum("n").alias("n")), "counts")
    root = math.isqrt(counts.count())
    own, ranges = max(LEAST_CLASSES, OWN * root), max(LEAST_CLASSES, root)
    often = [(r["word"], i + 1) for i, r in enumerate(
        counts.orderBy(F.desc("n"), "word").limit(own).collect())]
    frequent = spark.createDataFrame(often, "word binary, class int")
    rest = counts.join(frequent, "word", "left_anti")
    # Ranks of the others: by frequency, words of one frequency by hash.
    sizes = rest.groupBy("n").agg(F.count("*").alias("size")).orderBy(F.desc("n")).collect()
    ends = np.cumsum([r["size"] for r in sizes], dtype=np.int64).tolist()
    ranks = spark.createDataFrame([(r["n"], r["size"], e - r["size"]) for r, e in zip(sizes, ends)],
                                  "n long, size long, before long")
    rank = F.col("before") + F.pmod(F.xxhash64("word"), F.col("size"))
    told = counts.join(frequent, "word").select("word", "n", "class").unionByName(
        rest.join(F.broadcast(ranks), "n").select("word", "n", (F.lit(1 + own) + F.floor(
            rank * ranges / F.lit(ends[-1] if ends else 1))).cast("int").alias("class")))
    told = stored(told, "classes")
    mass = told.groupBy("class").agg(F.sum("n").alias("mass"))
    return told.join(mass, "class").select(
        "word", "class", F.log(F.col("n") / F.col("mass")).alias("log_share")), 1 + own + ranges


def _encoded(id_type: pa.DataType):
    """Classes and summed log shares of the texts of one block, from the words of the block."""
    def encode(texts: pa.Table, words: pa.Table) -> pa.Table:
        block = texts.column("block").to_numpy()
        part = ((block + np.arange(len(block))) % SLICES).astype(np.int32)
        hashes, column = [], pa.array(words.column("word").combine_chunks().cast(pa.string()))
        for texts_part in chunks(column):
            hashes.append(texts_part.words().hashes())
        known = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(known)
        known = known[order]
        named = words.column("class").to_numpy()[order]
        shares = words.column("log_share").to_numpy()[order]
        n, share, classes = [], [], []
        for texts_part in chunks(texts.column("text").combine_chunks()):
            found = texts_part.words()
            place = np.searchsorted(known, found.hashes())
            own, offsets = named[place].astype(np.int32), found.offsets
            n += np.diff(offsets).tolist()
            share += per_text(shares[place].astype(np.float64), offsets).tolist()
            classes += [own[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
        return pa.table([texts.column("doc_id").cast(id_type), pa.array(n, pa.int64()),
                         pa.array(share, pa.float64()), pa.array(classes, pa.binary()),
                         pa.array(part)], ["doc_id", "n", "share", "classes", "slice"])
    return encode


def encoded(source: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, n, share, classes, slice) of every document, and the number of classes."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark, kind = source.sparkSession, source.schema["doc_id"].dataType
    folder = new_folder(spark, "encoded")
    with scratch_scope(spark):   # texts and words are not needed once the texts are encoded
        texts = stored(source.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
            _dealt, f"block long, doc_id {kind.simpleString()}, text string"), "texts")
        named_at = new_folder(spark, "named")
        with scratch_scope(spark):   # nor are their counts once the words of each block have their classes
            words = stored(texts.select("block", "text").mapInArrow(
                _counted, "block long, word binary, n long"), "words")
            table, classes = vocabulary(words)
            named = stored(words.select("block", "word").join(table, "word"), "named", folder=named_at)
        out = texts.groupBy("block").cogroup(named.groupBy("block")).applyInArrow(
            _encoded(to_arrow_type(kind)),
            f"doc_id {kind.simpleString()}, n long, share double, classes binary, slice int")
        return stored(out, "encoded", by="slice", folder=folder), classes


def _tokens(batch: pa.RecordBatch, limit: int = 1 << 18) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, classes and offsets of runs of about ``limit`` tokens."""
    counts = batch.column("n").to_numpy()
    ends, at = np.cumsum(counts), 0
    while at < len(counts):
        before = ends[at] - counts[at]
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        raw = b"".join(batch.column("classes").slice(at, to - at).to_pylist())
        yield at, np.frombuffer(raw, np.int32), np.concatenate([[0], ends[at:to] - before])
        at = to


class Network:
    """Places x classes embeddings, hidden bias; weights and biases of the groups of classes and of
    the classes of each group."""

    def __init__(self, flat: np.ndarray, classes: int):
        groups, width = self.shape(classes)
        self.flat, self.width, at = flat, width, 0

        def take(*shape):
            nonlocal at
            at += math.prod(shape)
            return flat[at - math.prod(shape):at].reshape(shape)

        self.embed = take(2 * REACH, classes, HIDDEN)
        self.lean = take(HIDDEN)
        self.top, self.top_base = take(HIDDEN, groups), take(groups)
        self.low, self.low_base = take(groups, HIDDEN, width), take(groups, width)

    @staticmethod
    def shape(classes: int) -> tuple[int, int]:
        width = math.isqrt(classes - 1) + 1
        return -(-classes // width), width

    @staticmethod
    def start(classes: int) -> np.ndarray:
        groups, width = Network.shape(classes)
        size = (2 * REACH * classes * HIDDEN + HIDDEN + (HIDDEN + 1) * groups
                + (HIDDEN + 1) * groups * width)
        flat = np.random.default_rng(11).normal(0, 0.1, size).astype(np.float32)
        base = Network(flat, classes).low_base.reshape(-1)
        base[0] = base[classes:] = -1e4  # no word is of these classes
        return flat

    @staticmethod
    def _exps(scores: np.ndarray) -> np.ndarray:
        """The scores' exponentials in place, up to a factor of the row; their sums, as a column."""
        scores -= scores.max(1, keepdims=True)
        np.exp(scores, out=scores)
        return scores.sum(1, keepdims=True)

    def _shares(self, hidden: np.ndarray, weights: np.ndarray, base: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The share of the class ``own`` of every row."""
        scores = hidden @ weights
        scores += base
        with np.errstate(over="ignore"):
            np.exp(scores, out=scores)
        total = scores @ np.ones((len(base), 1), scores.dtype)
        if not (total.min() > LEAST_SUM and total.max() < 1 / LEAST_SUM):   # too far from 0 for single precision
            scores = hidden @ weights
            scores += base
            total = self._exps(scores)
        return scores[np.arange(len(own)), own] / total[:, 0]

    def _hidden(self, around: np.ndarray) -> np.ndarray:
        hidden = np.take(self.embed[0], around[:, 0], axis=0)
        for p in range(1, 2 * REACH):
            hidden += np.take(self.embed[p], around[:, p], axis=0)
        hidden += self.lean
        return np.tanh(hidden, out=hidden)

    def _parts(self, target: np.ndarray) -> Iterator[tuple]:
        """Weights, biases, place in the parameters, rows and choices: first of the groups, then of the
        classes of each group; targets come in order."""
        group, leaf = target // self.width, target % self.width
        for a in range(0, len(target), ROWS):
            yield self.top, self.top_base, -1, slice(a, a + ROWS), group[a:a + ROWS]
        cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            g = int(group[a])
            for at in range(a, b, BATCH):
                rows = slice(at, min(at + BATCH, b))
                yield self.low[g], self.low_base[g], g, rows, leaf[rows]

    def log_chance(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The logarithm of the chance of every target class between the classes around it."""
        out = np.empty(len(target))
        for low in range(0, len(target), SCORED):
            order = low + _order(target[low:low + SCORED], self.embed.shape[1])
            hidden, chance = self._hidden(np.take(around, order, axis=0)), np.zeros(len(order))
            for weights, base, _, rows, own in self._parts(target[order]):
                chance[rows] += np.log(np.maximum(self._shares(hidden[rows], weights, base, own), 1e-30))
            out[order] = chance
        return out

    def learn(self, squares: Network, around: np.ndarray, target: np.ndarray, rate: float) -> float:
        """One step over the tokens; their loss before it. ``squares``: sums of squared gradients."""
        order = _order(target, self.embed.shape[1])
        around, target = np.take(around, order, axis=0), target[order]
        hidden = self._hidden(around)
        back, lost = np.zeros_like(hidden), 0.0
        top, top_base = np.zeros_like(self.top), np.zeros_like(self.top_base)

        def step(values: np.ndarray, sums: np.ndarray, gradient: np.ndarray) -> None:
            sums += gradient * gradient
            values -= rate * gradient / np.sqrt(sums)

        for weights, base, g, rows, own in self._parts(target):
            here = hidden[rows]
            fault = here @ weights
            fault += base
            total, places = self._exps(fault), np.arange(len(own))
            lost -= float(np.log(np.maximum(fault[places, own] / total[:, 0], 1e-30)).sum())
            # Faults are chance minus truth, here times ``total``.
            fault[places, own] -= total[:, 0]
            share = 1 / total
            back[rows] += (fault @ weights.T) * share
            slope, lean = (here * share).T @ fault, share[:, 0] @ fault
            if g < 0:
                top += slope
                top_base += lean
            else:
                step(weights, squares.low[g], slope)
                step(base, squares.low_base[g], lean)
        step(self.top, squares.top, top)
        step(self.top_base, squares.top_base, top_base)
        back *= 1 - hidden * hidden
        step(self.lean, squares.lean, back.sum(0))
        columns = np.ascontiguousarray(back.T, np.float64)
        seen, number = np.zeros(self.embed.shape[1], bool), np.empty(self.embed.shape[1], np.intp)
        for p in range(2 * REACH):
            seen[:] = False
            seen[around[:, p]] = True
            rows = np.flatnonzero(seen)
            number[rows] = np.arange(len(rows))
            place = number[around[:, p]]
            slope = np.stack([np.bincount(place, column, len(rows)) for column in columns],
                             axis=1).astype(np.float32)
            sums = squares.embed[p][rows] + slope * slope
            squares.embed[p][rows] = sums
            self.embed[p][rows] -= rate * slope / np.sqrt(sums)
        return lost


def _order(values: np.ndarray, limit: int) -> np.ndarray:
    """The stable order of classes; sorted by counting where they fit 16 bits."""
    return np.argsort(values.astype(np.uint16) if limit <= 1 << 16 else values, kind="stable")


def _windows(classes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The classes around every token; 0 beyond the text."""
    n = len(classes)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    around = np.zeros((n, 2 * REACH), np.int32)
    for p, step in enumerate([*range(-REACH, 0), *range(1, REACH + 1)]):
        a, b = max(0, -step), min(n, n - step)
        if a < b:
            same = owner[a:b] == owner[a + step:b + step]
            around[a:b, p] = np.where(same, classes[a + step:b + step], 0)
    return around


def _average(rows: pa.Table) -> pa.Table:
    """The weighted mean of the rows of one block of parameters."""
    seen = rows.column("seen").to_numpy()
    values = rows.column("values").combine_chunks().values.to_numpy().reshape(len(seen), -1)
    mean = (seen @ values.astype(np.float64) / seen.sum()).astype(np.float32)
    return pa.table([rows.column("block").slice(0, 1), rows.column("part").slice(0, 1),
                     pa.array([int(seen.sum())], pa.int64()),
                     pa.array([rows.column("lost").to_numpy().sum()], pa.float64()),
                     pa.array([mean], pa.list_(pa.float32()))],
                    ["block", "part", "seen", "lost", "values"])


def _descend(given, classes: int):
    """Descent over the texts of a task from the given parameters and squares; rows to average."""
    def descend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, seen, lost = given.value.copy(), 0, 0.0
        net, squares = (Network(half, classes) for half in np.split(flat, 2))
        for batch in batches:
            for _, own, offsets in _tokens(batch):
                around = _windows(own, offsets)
                # Tokens of one text should not follow each other in the descent.
                order = np.random.default_rng(len(own)).permutation(len(own))
                for low in range(0, len(order), BATCH):
                    part = order[low:low + BATCH]
                    seen += len(part)
                    lost += net.learn(squares, np.take(around, part, axis=0), own[part], RATE)
        if seen:
            blocks = range(0, len(flat), BLOCK)
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([b // BLOCK for b in blocks], pa.int64()),
                 pa.array([task] * len(blocks), pa.int32()),
                 pa.array([seen] * len(blocks), pa.int64()),
                 pa.array([lost] * len(blocks), pa.float64()),
                 pa.array([flat[b:b + BLOCK] for b in blocks], pa.list_(pa.float32()))],
                ["block", "part", "seen", "lost", "values"])
    return descend


def train(texts: DataFrame, classes: int, epochs: int | None = None) -> np.ndarray:
    """Parameters after some epochs; texts: n, classes, slice (see ``encoded``).

    Without ``epochs``: until the loss stops falling.
    """
    context, start = texts.sparkSession.sparkContext, Network.start(classes)
    flat = np.concatenate([start, np.ones_like(start)])
    schema = "block long, part int, seen long, lost double, values array<float>"
    sizes = {r["slice"]: r["n"] for r in texts.groupBy("slice").agg(F.sum("n").alias("n")).collect()}
    losses: list[float] = []
    for _ in range(MAX_EPOCHS if epochs is None else epochs):
        for number in sorted(k for k, n in sizes.items() if n):
            # Without a shuffle; more tasks than partitions are not made.
            tasks = -(-sizes[number] // max(TASK_TOKENS, 2 * len(flat)))
            given = context.broadcast(flat)
            rows = (texts.where(F.col("slice") == number).select("n", "classes").coalesce(tasks)
                    .mapInArrow(_descend(given, classes), schema))
            while True:
                tasks = -(-tasks // FAN)
                rows = (rows.withColumn("part", F.pmod("part", F.lit(tasks)))
                        .groupBy("block", "part").applyInArrow(_average, schema))
                if tasks == 1:
                    break
            told, flat = rows.toArrow(), flat.copy()
            given.destroy()
            losses.append(told.column("lost")[0].as_py() / told.column("seen")[0].as_py())
            for block, values in zip(told.column("block").to_pylist(), told.column("values")):
                flat[block * BLOCK:(block + 1) * BLOCK] = values.values.to_numpy()
        if epochs is None and (len(losses) < 2 or losses[-1] > losses[-2] * (1 - TOLERANCE)):
            break
    return flat[:len(start)]


def score_documents(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    epochs: int | None = None) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_likelihood) of every document."""
    source, classes = encoded(documents.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    model = source.sparkSession.sparkContext.broadcast(train(source, classes, epochs))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(model.value, classes)
        for batch in batches:
            for first, own, offsets in _tokens(batch):
                n = np.diff(offsets)
                rows = batch.slice(first, len(n))
                total = (per_text(net.log_chance(_windows(own, offsets), own), offsets)
                         + rows.column("share").to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(total),
                     pa.array(total / np.maximum(n, 1), mask=n == 0)],
                    ["doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(score, f"doc_id {kind}, n_tokens long, log_likelihood double, "
                                    "mean_log_likelihood double")
