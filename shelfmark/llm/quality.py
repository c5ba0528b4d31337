"""Quality rules: fixed rules on counts, then a hashed n-gram logistic regression.

Two heads (quality, toxic) are trained on a bounded sample of labelled rows: features are hashed
word 1-grams, word 2-grams and byte 5-grams, each count divided by the root of the text's number
of n-grams of that kind, so a score is a plain sum over occurrences. A held-out part of the sample
calibrates each head to probabilities (Platt scaling); texts are scored in Arrow batches against
fixed thresholds.

Cases: a null or empty text has no words and fails the base rule; repeated rows are judged alike;
without labels of both classes a head says the share of its positives (no labels: good, not
toxic); other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.storage import stored
from shelfmark.llm.textbatch import (
    Texts, chunks, covered, mix, per_text, window_hashes, window_starts)

BUCKETS = 1 << 18
SAMPLE_ROWS = 6_000        # most labelled rows that are read for training
HELD_OUT = 4               # every fourth sampled row calibrates instead of training
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WORDS = 10, 20, 5
MIN_QUALITY, MAX_TOXIC = 0.5, 0.5
LENGTH_POWER = 0.5
MIN_Z = 6.0                # buckets whose document shares in the two classes differ by less are left out
HEADS = ("quality", "toxic")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

BASE_SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
               "n_repeat_words long, base_failed boolean")


@dataclass
class Head:
    """Weights over the hash buckets, and the calibration p = 1 / (1 + exp(-(a * score + b)))."""
    weights: np.ndarray
    a: float
    b: float

    def probability(self, scores: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * scores + self.b, -50, 50)))


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Marks of the entries whose key occurs twice or more."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    out = np.empty(len(keys), bool)
    out[order] = same[1:] | same[:-1]
    return out


def _owned(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Keys that also tell texts apart."""
    return mix(keys ^ mix(owner.astype(np.uint64) + np.uint64(1)))


def base_counts(texts: Texts) -> dict[str, np.ndarray]:
    """The counts of the fixed rules for each text."""
    words = texts.words()
    data, inside = texts.data, words.inside
    letters = inside & ((data & 0xC0) != 0x80)
    starts, owner = window_starts(words.offsets, REPEAT_WORDS)
    hashes = words.hashes()
    keys = _owned(window_hashes(hashes, REPEAT_WORDS)[starts] if len(starts)
                  else np.zeros(0, np.uint64), owner)
    repeated = covered(starts[_repeats(keys)], REPEAT_WORDS, len(hashes))
    return {"n_words": words.counts, "word_chars": per_text(letters, texts.offsets),
            "n_symbols": per_text(_SYMBOL[data], texts.offsets),
            "n_dup_lines": _repeated_lines(texts, words),
            "n_repeat_words": per_text(repeated, words.offsets)}, words, hashes


def _repeated_lines(texts: Texts, words) -> np.ndarray:
    breaks = np.flatnonzero(texts.data == 10)
    # A line starts at every text's start and after every line break inside it.
    starts = np.concatenate([texts.offsets[:-1], breaks + 1])
    owner = np.concatenate([np.arange(texts.n), np.searchsorted(texts.offsets, breaks, "right") - 1])
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    final = np.append(owner[1:] != owner[:-1], True)
    ends[final] = texts.offsets[1:][owner[final]]
    full = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends, owner = starts[full], ends[full], owner[full]
    keys = _owned(texts.range_hash(starts, ends), owner)
    _, first = np.unique(keys, return_index=True)
    later = np.ones(len(keys), np.int64)
    later[first] = 0
    return np.bincount(owner, later, texts.n).astype(np.int64)


def _grams(texts: Texts, words, hashes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket of each n-gram occurrence of one kind, and the offsets of the texts."""
    yield (hashes >> np.uint64(46)).astype(np.int32), words.offsets
    starts, owner = window_starts(words.offsets, 2)
    pairs = window_hashes(hashes, 2)
    yield ((pairs[starts] if len(starts) else pairs) >> np.uint64(46)).astype(np.int32), \
        np.searchsorted(owner, np.arange(texts.n + 1))
    data = texts.data.astype(np.uint32)
    n = max(len(data) - 4, 0)
    code = np.zeros(n, np.uint32)
    for i in range(5):
        code = code * np.uint32(0x01000193) + data[i:i + n]
    code *= np.uint32(0x9E3779B1)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x85EBCA77)
    starts, owner = window_starts(texts.offsets, 5)
    yield (code[starts] >> np.uint32(14)).astype(np.int32), \
        np.searchsorted(owner, np.arange(texts.n + 1))


def _scores(grams, heads: list[np.ndarray]) -> np.ndarray:
    """Score of each text (rows) under each head (columns)."""
    total = 0
    for buckets, offsets in grams:
        scale = np.maximum(np.diff(offsets), 1) ** -LENGTH_POWER
        total = total + np.stack([per_text(w[buckets], offsets) * scale for w in heads], 1)
    return total


def _text_features(batches) -> Iterator[tuple]:
    """(batch, text number, distinct buckets, their scaled counts) of every sampled text."""
    for batch in batches:
        for texts in chunks(batch.column("text")):
            _, words, hashes = base_counts(texts)
            kinds = list(_grams(texts, words, hashes))
            for i in range(texts.n):
                parts = [(b[o[i]:o[i + 1]], max(o[i + 1] - o[i], 1) ** -LENGTH_POWER)
                         for b, o in kinds]
                buckets = np.concatenate([p for p, _ in parts])
                weight = np.concatenate([np.full(len(p), s) for p, s in parts])
                distinct, place = np.unique(buckets, return_inverse=True)
                yield batch, texts.first + i, distinct, np.bincount(place, weight, len(distinct))


def _class_counts(batches):
    """By bucket, the training texts of each class that hold it."""
    counts = np.zeros((4, BUCKETS), np.int64)
    for batch, i, buckets, _ in _text_features(batches):
        if not batch.column("held")[i].as_py():
            for row, name in enumerate(HEADS):
                counts[2 * row + batch.column(name)[i].as_py(), buckets] += 1
    there = np.flatnonzero(counts.any(0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(there.astype(np.int64)), *[pa.array(c[there]) for c in counts]],
        ["bucket", *_COUNTS])


_COUNTS = ("quality_0", "quality_1", "toxic_0", "toxic_1")


def _picked_features(picked):
    def emit(batches):
        for batch, i, buckets, values in _text_features(batches):
            own = np.isin(buckets, picked)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).slice(i, 1) for c in ("quality", "toxic", "held", "order")]
                + [pa.array([buckets[own].astype(np.int32).tobytes()], pa.binary()),
                   pa.array([values[own].astype(np.float32).tobytes()], pa.binary())],
                ["quality", "toxic", "held", "order", "idx", "val"])
    return emit


def _telling(without: np.ndarray, with_it: np.ndarray, minus: int, plus: int) -> np.ndarray:
    """Marks of buckets in which the classes' training texts differ clearly (two-proportion z)."""
    share = (with_it + without + 1) / (plus + minus + 2)
    spread = np.sqrt(share * (1 - share) * (1 / plus + 1 / minus))
    return np.abs(with_it / plus - without / minus) >= MIN_Z * spread


def _fit(idx, val, row_of, target, held, steps=12, rate=0.3, decay=1e-5) -> Head:
    """Logistic regression by Adagrad over mini-batches, then Platt scaling on the held-out rows."""
    n, weights, grown = len(target), np.zeros(BUCKETS, np.float32), np.full(BUCKETS, 1e-6, np.float32)
    bounds = np.searchsorted(row_of, np.arange(n + 1))
    share = target.mean()
    bias, bias_grown = float(np.log(share / (1 - share))), 1e-6
    cost = np.where(target > 0, 0.5 / share, 0.5 / (1 - share))  # both classes weigh alike
    for step in range(steps):
        for lo in range(0, n, 256):
            hi = min(lo + 256, n)
            part = slice(bounds[lo], bounds[hi])
            at, x, rows = idx[part], val[part], row_of[part] - lo
            score = np.bincount(rows, weights[at] * x, hi - lo) + bias
            fault = (1 / (1 + np.exp(-np.clip(score, -50, 50))) - target[lo:hi]) * cost[lo:hi]
            fault[held[lo:hi]] = 0
            gradient = np.bincount(at, fault[rows] * x, BUCKETS).astype(np.float32) / (hi - lo)
            gradient += decay * weights
            grown += gradient * gradient
            weights -= rate * gradient / np.sqrt(grown)
            g = fault.mean()
            bias_grown += g * g
            bias -= rate * g / bias_grown ** 0.5
    score = np.bincount(row_of, weights[idx] * val, n)[held]
    wanted = target[held]
    a, b = 1.0, bias
    # Platt: Newton steps on the two parameters, targets pulled in by one pseudo-row each.
    plus, minus = wanted.sum(), (1 - wanted).sum()
    soft = np.where(wanted > 0, (plus + 1) / (plus + 2), 1 / (minus + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * score + b, -30, 30)))
        g, h = p - soft, np.maximum(p * (1 - p), 1e-9)
        m = np.array([[(h * score * score).sum() + 1e-6, (h * score).sum()],
                      [(h * score).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(m, [(g * score).sum(), g.sum()])
        size = min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        a, b = a - size * step[0], b - size * step[1]
        if np.abs(step).max() < 1e-6:
            break
    return Head(weights, float(a), float(b))


def train(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Head]:
    """Fit both heads on at most ``sample_rows`` labelled documents, picked by hash of the id.

    Buckets are chosen from counts that Spark adds up; of the sampled rows only the chosen buckets'
    values reach the driver, and ``sample_rows`` bounds them.
    """
    picked = (labels.where("doc_id is not null and quality is not null and toxic is not null")
              .groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("quality"),
                                     (F.max("toxic") > 0).cast("int").alias("toxic"))
              .withColumn("order", F.xxhash64("doc_id", F.lit(1)))
              .orderBy("order").limit(sample_rows))
    sample = stored(documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select(
        "text", "quality", "toxic", "order", (F.pmod("order", F.lit(HELD_OUT)) == 0).alias("held")),
        "labelled")
    sizes = {(r["held"], name, r[name]): r["n"] for name in HEADS
             for r in sample.groupBy("held", name).agg(F.count("*").alias("n")).collect()}
    counts = sample.mapInArrow(_class_counts, ", ".join(f"{c} long" for c in ("bucket", *_COUNTS)))
    found = counts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in _COUNTS]).toArrow()
    bucket = found.column("bucket").to_numpy()
    chosen = {}
    for name in HEADS:
        if all(sizes.get((held, name, value)) for held in (True, False) for value in (0, 1)):
            marks = _telling(found.column(f"{name}_0").to_numpy(), found.column(f"{name}_1").to_numpy(),
                             sizes[False, name, 0], sizes[False, name, 1])
            chosen[name] = bucket[marks]
    picked = np.unique(np.concatenate([*chosen.values(), np.zeros(0, np.int64)]))
    rows = sample.mapInArrow(_picked_features(picked), "quality int, toxic int, held boolean, "
                             "order long, idx binary, val binary").toArrow()
    size = np.array([len(x) for x in rows.column("idx").to_pylist()], np.int64)
    turn = np.lexsort((size, rows.column("order").to_numpy()))
    idx = np.frombuffer(b"".join(rows.column("idx").take(pa.array(turn)).to_pylist()), np.int32)
    val = np.frombuffer(b"".join(rows.column("val").take(pa.array(turn)).to_pylist()), np.float32)
    row_of = np.repeat(np.arange(len(turn)), size[turn] // 4)
    held = rows.column("held").to_numpy()[turn].astype(bool)
    heads = []
    for name, default in zip(HEADS, (1.0, 0.0)):
        target = rows.column(name).to_numpy()[turn].astype(float)
        if name in chosen:
            own = np.isin(idx, chosen[name])
            heads.append(_fit(idx[own], val[own], row_of[own], target, held))
        else:
            share = target.mean() if len(target) else default
            heads.append(Head(np.zeros(BUCKETS, np.float32), 0.0,
                              float(np.log((share + 1e-6) / (1 - share + 1e-6)))))
    return heads


def score_quality(documents: DataFrame, heads: list[Head], *, id_col: str = "doc_id",
                  text_col: str = "text", keep: tuple[str, ...] = (),
                  min_quality: float = MIN_QUALITY, max_toxic: float = MAX_TOXIC) -> DataFrame:
    """One row per document: counts, base verdict, both probabilities, ``kept``; no shuffle.

    ``keep`` names further input columns to carry along.
    """
    model = documents.sparkSession.sparkContext.broadcast(heads)
    source = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                              *[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)])
    kept_fields = source.schema.fields[2:]

    def score(batches):
        heads = model.value
        for batch in batches:
            for texts in chunks(batch.column("text")):
                counts, words, hashes = base_counts(texts)
                failed = (counts["n_words"] < MIN_WORDS) | (
                    100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])
                scores = _scores(_grams(texts, words, hashes), [h.weights for h in heads])
                quality, toxic = (h.probability(scores[:, i]) for i, h in enumerate(heads))
                kept = ~failed & (quality >= min_quality) & (toxic <= max_toxic)
                rows = slice(texts.first, texts.first + texts.n)
                columns = [batch.column("doc_id")[rows], *counts.values(), failed, kept, quality, toxic]
                columns += [batch.column(f.name)[rows] for f in kept_fields]
                names = ["doc_id", *counts, "base_failed", "kept", "p_quality", "p_toxic",
                         *[f.name for f in kept_fields]]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    kind = source.schema["doc_id"].dataType.simpleString()
    more = "".join(f", {f.name} {f.dataType.simpleString()}" for f in kept_fields)
    out = source.mapInArrow(score, f"doc_id {kind}, {BASE_SCHEMA}, kept boolean, "
                                   f"p_quality double, p_toxic double{more}")
    return out.withColumnsRenamed({f"_keep_{i}": c for i, c in enumerate(keep)})


def filter_quality(documents: DataFrame, labels: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The rows of ``documents`` that pass the base rules and the trained verdict, unchanged."""
    heads = train(documents, labels)
    columns = documents.columns
    renamed = documents.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    text = f"c{columns.index(text_col)}"
    scored = score_quality(renamed, heads, id_col=text, text_col=text, keep=tuple(renamed.columns))
    return scored.where("kept").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
