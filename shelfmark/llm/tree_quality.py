"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics (``STATISTICS``) of a text come from vectorised counts over the whole text. Trees are
grown level by level on binned statistics with the logistic loss: the gradients of a level are added
up by node, statistic and bin, and each node takes the cut with the largest gain. The fitted trees
lie flattened in five arrays; a batch walks all trees at once, one array step per level.

Cases: a null or empty text has all statistics 0 and gets the score of such texts; repeated rows
are scored alike; a null id is never held out and never a training row; without labels of both classes
the score is the share of label 1 (no labels: 0.5). Ties between cuts go to the first statistic,
then the lowest bin. A long text is counted whole, alone in its chunk; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.quality import base_counts
from shelfmark.llm.textbatch import Texts, chunks, per_text

SAMPLE_ROWS = 20_000       # most labelled documents that are read for fitting
BINS = 64
TREES, DEPTH, RATE = 150, 4, 0.1
LEAST_WEIGHT, SHRINK = 2.0, 1.0     # of a leaf: least curvature, and ridge
MIN_SCORE = 0.3

STATISTICS = (
    "bytes", "chars", "words", "lines", "word_chars", "longest_word", "short_words", "long_words",
    "distinct_words", "top_word", "symbols", "symbol_words", "ending_marks", "marks", "digits",
    "capitals", "capital_words", "shout_words", "wide_letters", "blanks", "dup_lines",
    "line_words", "repeat_words", "byte_entropy", "byte_kinds", "same_byte_steps")


def _table(picked: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in picked]] = True
    return out


_CAPITAL = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_SMALL = _table("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _table("0123456789")
_SYMBOL = _table("#*$%&|<>")
_ENDING = _table(".!?")
_MARK = _table("\"'(),-./:;=?@[\\]^_`{}~+!")
_BLANK = _table(" \t\n\r\x0b\x0c")


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _most_frequent(owner: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per owner, the number of distinct keys and how often the commonest one stands."""
    order = np.lexsort((keys, owner))
    owner, keys = owner[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])
    first = np.flatnonzero(new)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner[first], np.diff(np.append(first, len(keys))))
    return np.bincount(owner[first], minlength=n), top


def statistics(texts: Texts) -> np.ndarray:
    """One row per text, columns as in STATISTICS."""
    counts, words, hashes = base_counts(texts)
    data, n = texts.data, texts.n
    size = np.diff(texts.offsets)
    n_words = counts["n_words"]
    owner = np.repeat(np.arange(n), n_words)
    letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    word_chars = letters[words.ends] - letters[words.starts]
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, owner, word_chars)

    def bytes_of(table):
        return per_text(table[data], texts.offsets)

    def words_where(marks):
        return per_text(marks, words.offsets)

    def inside(table):
        sums = np.concatenate([[0], np.cumsum(table[data])])
        return sums[words.ends] - sums[words.starts]

    chars = per_text((data & 0xC0) != 0x80, texts.offsets)
    lines = per_text(data == 10, texts.offsets) + (size > 0)
    capitals, small = inside(_CAPITAL), inside(_SMALL)
    distinct, top = _most_frequent(owner, hashes, n)
    of_byte = np.repeat(np.arange(n), size)
    seen = np.bincount(of_byte * 256 + data, minlength=256 * n).reshape(n, 256)
    share = seen / np.maximum(size, 1)[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(1)
    steps = np.zeros(len(data), bool)
    steps[1:] = (data[1:] == data[:-1]) & (of_byte[1:] == of_byte[:-1])
    columns = (
        size, chars, n_words, lines, _share(counts["word_chars"], n_words), longest,
        _share(words_where(word_chars <= 3), n_words), _share(words_where(word_chars >= 12), n_words),
        _share(distinct, n_words), _share(top, n_words), _share(counts["n_symbols"], chars),
        _share(words_where(inside(_SYMBOL) > 0), n_words), _share(bytes_of(_ENDING), n_words),
        _share(bytes_of(_MARK), chars), _share(bytes_of(_DIGIT), chars), _share(bytes_of(_CAPITAL), chars),
        _share(words_where(_CAPITAL[data[words.starts]]), n_words),
        _share(words_where((capitals > 1) & (small == 0)), n_words),
        _share(per_text(data >= 0xC0, texts.offsets), chars), _share(bytes_of(_BLANK), chars),
        _share(counts["n_dup_lines"], lines), _share(n_words, lines),
        _share(counts["n_repeat_words"], n_words), entropy, (seen > 0).sum(1),
        _share(per_text(steps, texts.offsets), size))
    return np.stack(columns, 1).astype(np.float64)


@dataclass
class Trees:
    """All trees in flat arrays. A leaf is its own child on both sides, so a walk of ``depth`` steps
    from every root ends in leaves. ``start`` is the score before the first tree."""
    statistic: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def probability(self, rows: np.ndarray) -> np.ndarray:
        node = np.broadcast_to(self.roots, (len(rows), len(self.roots)))
        at = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            beyond = rows[at, self.statistic[node]] > self.cut[node]
            node = np.where(beyond, self.right[node], self.left[node])
        score = self.start + self.value[node].sum(1)
        return 1 / (1 + np.exp(-np.clip(score, -50, 50)))


def bin_edges(rows: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Cuts of each statistic halfway between neighbouring values, at most ``bins`` - 1 of them."""
    out = []
    for values in rows.T:
        found = np.unique(values)
        if len(found) > bins:
            found = np.unique(np.quantile(values, np.linspace(0, 1, bins), method="lower"))
        out.append((found[1:] + found[:-1]) / 2)
    return out


def fit_trees(rows: np.ndarray, target: np.ndarray, *, trees: int = TREES, depth: int = DEPTH,
              rate: float = RATE, bins: int = BINS) -> Trees:
    """Boosting with the logistic loss on the statistics ``rows`` and labels 0 / 1."""
    share = target.mean() if len(target) else 0.5
    start = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    parts = {k: [] for k in ("statistic", "cut", "left", "right", "value")}
    roots, used = [], 0
    if 0 < share < 1:
        edges = bin_edges(rows, bins)
        n, m = rows.shape
        binned = np.stack([np.searchsorted(e, rows[:, f], "left") for f, e in enumerate(edges)], 1)
        # Cell of (statistic, bin) in a node's histogram; the last bin of a statistic is no cut.
        cell = binned + np.arange(m) * bins
        no_cut = np.arange(bins) >= np.array([len(e) for e in edges])[:, None]
        score = np.full(n, start)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            tree, leaf = _grow(cell, binned, p - target, p * (1 - p), no_cut, edges, depth)
            score += rate * tree["value"][leaf]
            roots.append(used)
            for k in ("statistic", "cut"):
                parts[k].append(tree[k])
            for k in ("left", "right"):
                parts[k].append(tree[k] + used)
            parts["value"].append(rate * tree["value"])
            used += len(tree["value"])
    flat = {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in parts.items()}
    return Trees(**flat, roots=np.array(roots, np.int64), depth=depth, start=start)


def _grow(cell, binned, gradient, curvature, no_cut, edges, depth):
    """One tree as flat arrays, and the leaf of every row."""
    m, bins = no_cut.shape
    statistic, cut, left, right, value = [0], [0.0], [0], [0], [0.0]
    node = np.zeros(len(cell), np.int64)           # where each row is
    level = np.array([0])                          # nodes that may be split
    for step in range(depth + 1):
        place = np.full(len(value), -1)
        place[level] = np.arange(len(level))
        slot = place[node]
        live = slot >= 0
        slot, own = slot[live], cell[live]
        width = m * bins
        at = (slot[:, None] * width + own).ravel()
        g, h = (np.bincount(at, np.repeat(w[live], m), len(level) * width).reshape(-1, m, bins)
                for w in (gradient, curvature))
        g_all, h_all = g[:, 0].sum(1), h[:, 0].sum(1)
        for i, k in enumerate(level):
            value[k] = float(-g_all[i] / (h_all[i] + SHRINK))
        if step == depth:
            break
        gl, hl = np.cumsum(g, 2), np.cumsum(h, 2)
        gr, hr = g_all[:, None, None] - gl, h_all[:, None, None] - hl
        gain = (gl ** 2 / (hl + SHRINK) + gr ** 2 / (hr + SHRINK)
                - (g_all ** 2 / (h_all + SHRINK))[:, None, None])
        gain[(hl < LEAST_WEIGHT) | (hr < LEAST_WEIGHT) | no_cut] = 0
        best = gain.reshape(len(level), -1).argmax(1)
        split = np.take_along_axis(gain.reshape(len(level), -1), best[:, None], 1)[:, 0] > 1e-9
        following = []
        go = np.full(len(value), -1)
        for i, k in enumerate(level):
            if split[i]:
                f, b = divmod(int(best[i]), bins)
                statistic[k], cut[k] = f, float(edges[f][b])
                go[k] = b
                left[k], right[k] = len(value), len(value) + 1
                for child in (left[k], right[k]):
                    following.append(child)
                    statistic.append(0), cut.append(0.0), left.append(child), right.append(child)
                    value.append(0.0)
        if not following:
            break
        moved = go[node] >= 0
        at = node[moved]
        beyond = binned[moved, np.array(statistic)[at]] > go[at]
        node[moved] = np.where(beyond, np.array(right)[at], np.array(left)[at])
        level = np.array(following)
    return {"statistic": np.array(statistic, np.int64), "cut": np.array(cut), "left": np.array(left, np.int64),
            "right": np.array(right, np.int64), "value": np.array(value)}, node


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids whose labels are kept for measuring."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Trees from at most ``sample_rows`` labelled documents, picked by hash of the id.

    Held-out ids give no labels. An id with several labels takes the smallest; an id of several
    documents labels each. Only the statistics of the sampled documents reach the driver.
    """
    picked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
              .where(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id")))
              .groupBy("id").agg((F.min("label") > 0).cast("int").alias("label"))
              .withColumn("turn", F.xxhash64("id", F.lit(11))).orderBy("turn", "id").limit(sample_rows))
    # At most sample_rows rows of three numbers are sent to the tasks.
    sample = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(picked), "id")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column("text")):
                rows = slice(texts.first, texts.first + texts.n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("turn")[rows], batch.column("label")[rows],
                     pa.array(list(statistics(texts)), pa.list_(pa.float64()))],
                    ["turn", "label", "found"])

    found = (sample.mapInArrow(count, "turn long, label int, found array<double>")
             .orderBy("turn", "found", "label").limit(sample_rows).toArrow())
    rows = np.array(found.column("found").to_pylist(), float).reshape(-1, len(STATISTICS))
    return fit_trees(rows, found.column("label").to_numpy().astype(float))


def score_documents(documents: DataFrame, trees: Trees, *, id_col: str = "doc_id",
                    text_col: str = "text", min_score: float = MIN_SCORE,
                    with_statistics: bool = False) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted; no shuffle.

    ``with_statistics`` adds the statistics as columns of their names.
    """
    model = documents.sparkSession.sparkContext.broadcast(trees)
    source = documents.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                              F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column("text")):
                rows = slice(texts.first, texts.first + texts.n)
                found = statistics(texts)
                p = model.value.probability(found)
                columns = [batch.column("doc_id")[rows], batch.column("held_out")[rows], pa.array(p),
                           pa.array((p >= min_score).astype(np.int32))]
                names = ["doc_id", "held_out", "score", "predicted"]
                if with_statistics:
                    columns += [pa.array(c) for c in found.T]
                    names += STATISTICS
                yield pa.RecordBatch.from_arrays(columns, names)

    more = "".join(f", {c} double" for c in STATISTICS) if with_statistics else ""
    return source.mapInArrow(
        score, f"doc_id {kind}, held_out boolean, score double, predicted int{more}")
