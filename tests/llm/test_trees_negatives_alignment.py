"""Quality trees, hard negatives and tokenizer alignment against plain loops."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.llm import alignment, hard_negatives, tree_quality
from shelfmark.llm.textbatch import CHUNK_BYTES, chunks

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")


# ---- quality trees ----------------------------------------------------------------------------

def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(300)}" for _ in range(n))


def quality_tables(spark):
    rows, labels = [], []
    for i in range(900):
        good = i % 3 != 0
        text = prose(i, 80)
        if not good:
            text = (text.upper(), text.replace(" ", "### "), f"{prose(i, 5)} " * 20)[i // 3 % 3]
        rows.append((i, text, "x"))
        labels.append((i, int(good), "y"))
    return rows, labels


def test_trees_on_held_out_ids(spark):
    rows, labels = quality_tables(spark)
    odd = [(None, "no id"), (None, None), (1, None), (2, ""), (3, prose(3, 80)), (3, prose(3, 80)),
           (5000, "z" * (CHUNK_BYTES + 10))]
    docs = spark.createDataFrame(rows + [(i, t, "x") for i, t in odd],
                                 "doc_id long, text string, score string")
    wrong = [(i, 1, "y") for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0] \
        + [(None, 0, None), (7, None, None)]
    table = spark.createDataFrame(
        [r for r in labels if zlib.crc32(str(r[0]).encode()) % 5] + wrong,
        "doc_id long, quality int, text string")
    trees = tree_quality.train(docs, table)
    found = tree_quality.score_documents(docs, trees).collect()
    assert len(found) == docs.count()
    truth = {i: q for i, q, _ in labels}
    right = [r.predicted == truth[r.doc_id] for r in found
             if r.held_out and r.doc_id in truth and r.doc_id not in (1, 2, 3)]
    assert len(right) > 120 and np.mean(right) > 0.95
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    empty = {r.score for r in found if r.doc_id is None or r.doc_id == 2}
    assert len({r.score for r in found if r.doc_id == 3}) <= 2 and empty


def test_trees_without_both_classes(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in tree_quality.score_documents(docs, tree_quality.train(docs, labels)).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    scores = {r.score for r in tree_quality.score_documents(docs, tree_quality.train(docs, ones)).collect()}
    assert len(scores) == 1 and scores.pop() > 0.99
    assert tree_quality.score_documents(docs.where("false"), tree_quality.train(docs, ones)).count() == 0


def test_flat_walk_equals_nested_walk():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(400, 5)).round(1)
    target = ((rows[:, 0] > 0.2) ^ (rows[:, 3] < -0.1)).astype(float)
    trees = tree_quality.fit_trees(rows, target, trees=20, depth=3)

    def walk(row, node):
        while trees.left[node] != node:
            node = (trees.right if row[trees.statistic[node]] > trees.cut[node] else trees.left)[node]
        return trees.value[node]

    plain = [1 / (1 + math.exp(-(trees.start + sum(walk(r, k) for k in trees.roots)))) for r in rows]
    assert np.allclose(trees.probability(rows), plain)
    assert ((trees.probability(rows) > 0.5) == target).mean() > 0.97


def test_first_cut_has_the_largest_gain():
    rng = np.random.default_rng(4)
    rows = rng.integers(0, 8, (300, 3)).astype(float)
    target = (rng.random(300) < 0.2 + 0.6 * (rows[:, 1] > 4)).astype(float)
    trees = tree_quality.fit_trees(rows, target, trees=1, depth=1)
    p = target.mean()
    g, h = p - target, np.full(300, p * (1 - p))

    def gain(f, cut):
        low = rows[:, f] <= cut
        parts = [(g[m].sum(), h[m].sum()) for m in (low, ~low)]
        if min(x[1] for x in parts) < tree_quality.LEAST_WEIGHT:
            return -1
        return sum(a * a / (b + tree_quality.SHRINK) for a, b in parts)

    best = max((gain(f, c + 0.5), -f, -c) for f in range(3) for c in range(7))
    assert (trees.statistic[0], trees.cut[0]) == (-best[1], -best[2] + 0.5)


def test_statistics_against_plain_counts():
    texts = ["", "One two two THREE.\n\nOne two### 77\nOne two### 77", "é😀 ñandú  x", "y" * 900]
    found = np.concatenate([tree_quality.statistics(t) for t in chunks(pa.array(texts))])
    for text, row in zip(texts, found):
        r = dict(zip(tree_quality.STATISTICS, row))
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        assert (r["bytes"], r["chars"], r["words"]) == (len(text.encode()), len(text), len(words))
        assert r["longest_word"] == max(map(len, words), default=0)
        n = max(len(words), 1)
        assert math.isclose(r["distinct_words"], len(set(words)) / n)
        assert math.isclose(r["top_word"], max(collections.Counter(words).values(), default=0) / n)
        assert math.isclose(r["symbol_words"], sum(bool(re.search(r"[#*$%&|<>]", w)) for w in words) / n)
        share = [v / len(text.encode()) for v in collections.Counter(text.encode()).values()]
        assert math.isclose(r["byte_entropy"], -sum(s * math.log2(s) for s in share), abs_tol=1e-9)


# ---- hard negatives ---------------------------------------------------------------------------

def plain_negatives(rows, every=50):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(256 * float(np.float32(x))) for x in v])
        kept[i] = min(kept.get(i, row), row)
    out = set()
    for a, (la, va) in kept.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(va, v)) for i, (_, v) in kept.items()}
        best = sorted((i for i in kept if i != a and kept[i][0] == la), key=lambda i: (-score[i], i))[:5]
        for p in best:
            fit = sorted((i for i in kept if kept[i][0] != la
                          and 50 * score[p] <= 100 * score[i] <= 95 * score[p]),
                         key=lambda i: (-score[i], i))[:3]
            out |= {(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(fit)}
    return out


def vector_rows(seed, n, dims=20, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    return [(i, (centres[rng.integers(6)] + 0.4 * rng.normal(size=dims)).astype(np.float32).tolist(),
             int(rng.integers(labels))) for i in range(n)]


def spark_negatives(spark, rows, every=50):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn(
        "vector", F.lit("x")).withColumn("id", F.lit(9)).withColumn("block", F.lit(1))
    found = hard_negatives.hard_negatives(table, is_anchor=F.col("id") % every == 0).collect()
    assert len(found) == len(set(found))
    return {tuple(r) for r in found}


def test_negatives_in_many_cells(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 150)
    monkeypatch.setattr(hard_negatives, "CHUNK_ANCHORS", 7)
    rows = vector_rows(1, 900)
    rows += [(i, rows[0][1], i % 3) for i in range(900, 1200)]       # a third are the same vector
    expected = plain_negatives(rows)
    assert len(expected) > 100
    assert spark_negatives(spark, rows) == expected


def test_negatives_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vector_rows(2, 200, dims=7)
    rows += [(None, [1.0] * 7, 1), (300, None, 1), (301, [1.0] * 7, None), (350, [nan] * 7, 1),
             (351, [inf] + [0.0] * 6, 1), (352, [None] + [1.0] * 6, 1), (400, [], 1), (401, [2.0], 1),
             (450, [0.5] * 7, 2), (450, [0.25] * 7, 2), (450, [0.5] * 7, 1), (500, [1e4] * 7, 0),
             (501, [9e3] * 7, 0), (502, [8e3] * 7, 1), (550, [0.0] * 7, 2)]
    rows += rows[:40]
    assert spark_negatives(spark, rows) == plain_negatives(rows)
    assert spark_negatives(spark, []) == set()


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(5)
    vectors = rng.integers(-90, 90, (300, 64)) + rng.integers(-300, 300, (300, 1))
    flat = np.concatenate([x for level in hard_negatives.summaries(vectors.astype(float)) for x in level], 1)
    table = pa.table({"id": np.arange(300), "label": np.zeros(300, int), "vector": list(vectors),
                      "summary": list(flat)})
    side = hard_negatives.Side(table, 64)
    cell = hard_negatives.Cell(side, side)
    exact = vectors @ vectors.T
    everyone = np.arange(300)
    last = np.full(exact.shape, np.inf)
    for level in range(len(side.level)):
        middle, radius = cell.bounds(level, everyone, everyone, False)
        assert (np.abs(exact - middle) <= radius).all()
        assert (radius <= last * (1 + 1e-6)).all()     # a finer level is never looser
        last = radius
    assert len(side.level) == 3
    a, x, score = hard_negatives.cell_positives(side, side, 5, cell)
    assert cell.left[-1] < 0.3 * exact.size
    for i in range(0, 300, 37):
        own = sorted((j for j in range(300) if j != i), key=lambda j: (-exact[i, j], j))[:5]
        assert x[a == i].tolist() == own and score[a == i].tolist() == exact[i, own].tolist()


# ---- tokenizer alignment ----------------------------------------------------------------------

ALIGN_TEXTS = [
    "The quick brown fox, the quick brown fox.", "", None, " ", "Straße über naïve café — 東京 😀",
    "<|endoftext|> and <s> </s> <unk> <0x41>", "a▁b", "  two  blanks \n\n\tlines", "x" * 5000,
    "the quick brown fox the", "\u0000 nul", "é combining", "ﬁ ligature", "12345 67 890", "word " * 400,
    "The quick brown fox, the quick brown fox."]


def plain_alignment(texts):
    a_lib = Tokenizer.from_file(A_PATH)
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    letters = alignment._byte_letters()
    a_bytes = {i: bytes(letters[c] for c in p) for p, i in a_lib.get_vocab().items() if set(p) <= set(letters)}

    def b_bytes(i):
        piece = b_lib.id_to_piece(i)
        if re.fullmatch("<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    docs = []
    for text in texts:
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        parts = [[a_bytes[i] for i in a], [b_bytes(i) for i in b]]
        if not text or b"".join(parts[0]) != whole or b"".join(parts[1]) != whole:
            docs.append(None)
            continue
        ends = [np.cumsum([len(p) for p in side]).tolist() for side in parts]
        groups, ga, gb, links = [], [], [], []
        cuts = set(ends[0]) & set(ends[1])
        i = j = 0
        for cut in sorted(cuts):
            ga, gb = [], []
            while i < len(a) and ends[0][i] <= cut:
                ga.append(a[i])
                i += 1
            while j < len(b) and ends[1][j] <= cut:
                gb.append(b[j])
                j += 1
            groups.append((ga, gb))
            links.append((ga[-1], gb[-1]))
        docs.append((a, b, groups, links))
    count = collections.Counter(x for d in docs if d for x in d[3])
    top = collections.defaultdict(int)
    for (x, y), n in count.items():
        top[y] = max(top[y], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = d
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(count[x] == top[x[1]] for x in links),
                    sum(count[x] for x in links), hashlib.sha256(text.encode()).hexdigest()))
    return out, count, docs


def align_rows(spark, texts, ids=None, parts=3):
    docs = spark.createDataFrame(list(zip(ids or range(len(texts)), texts)), "doc_id long, text string")
    return docs.repartition(parts).withColumn("row", F.lit("r")).withColumn("a", F.lit(1.5)) \
        .withColumn("part", F.lit(2))


def test_alignment_equals_plain_loops(spark):
    expected, count, docs = plain_alignment(ALIGN_TEXTS)
    assert sum(d is not None for d in docs) > 8
    table = align_rows(spark, ALIGN_TEXTS)
    found = {r.doc_id: tuple(r)[1:] for r in alignment.align_documents(
        table, A_PATH, B_PATH, public_tokenizers.PATTERN).collect()}
    assert [found[i] for i in range(len(ALIGN_TEXTS))] == expected
    _, postings = alignment.pair_postings(table, A_PATH, B_PATH, public_tokenizers.PATTERN)
    pairs = {(r.a, r.b): r for r in alignment.pair_counts(postings).collect()}
    assert {k: r.n_links for k, r in pairs.items()} == dict(count)
    holders = collections.Counter(x for d in docs if d for x in set(d[3]))
    assert {k: r.n_docs for k, r in pairs.items()} == dict(holders)


def test_alignment_of_repeated_ids_and_flushed_postings(spark, monkeypatch):
    monkeypatch.setattr(alignment, "POSTINGS", 20)
    texts = [prose(i % 7, 30) for i in range(120)] + [None]
    expected, _, _ = plain_alignment(texts)
    table = align_rows(spark, texts, [None if i % 3 else 5 for i in range(len(texts))], 2)
    found = [tuple(r)[1:] for r in alignment.align_documents(
        table, A_PATH, B_PATH, public_tokenizers.PATTERN).collect()]
    assert sorted(found) == sorted(expected)
    assert alignment.align_documents(table.where("false"), A_PATH, B_PATH,
                                     public_tokenizers.PATTERN).count() == 0


def test_planes_keep_what_they_hold():
    rng = np.random.default_rng(0)
    size = [1, 3, alignment.DENSE - 1, alignment.DENSE, 3000, 2]
    group = np.repeat(np.arange(len(size)), size)
    place = np.concatenate([np.sort(rng.choice(alignment.RANGE, n, replace=False)) for n in size])
    times = rng.integers(1, 40, len(place))
    packed = alignment.pack_planes(group, place, times, len(size))
    for part in (packed, packed.slice(2, 3)):
        seen = collections.Counter()
        for r, p, k in zip(*alignment.open_planes(part)):
            seen[r, p] += 1 << int(k)
        first = 0 if part is packed else 2
        own = (group >= first) & (group < first + len(part))
        assert seen == {(g - first, p): t for g, p, t in zip(group[own], place[own], times[own])}


def test_partial_postings_are_merged_by_or(spark):
    def row(a, b, part, docs):
        place, times = map(np.array, zip(*docs))
        planes = alignment.pack_planes(np.zeros(len(place), int), place, times, 1)
        return pa.RecordBatch.from_arrays([pa.array([a], pa.int32()), pa.array([b], pa.int32()),
                                           pa.array([part]), planes], ["a", "b", "part", "planes"])

    rows = [row(1, 2, 0, [(3, 1), (9, 2)]), row(1, 2, 0, [(4, 5)]), row(1, 2, 0, [(3, 1)]),
            row(1, 2, 1, [(3, 7)]), row(2, 2, 1, [(0, 1)])]
    merged = pa.Table.from_batches(list(alignment._merge(rows))).to_pylist()
    assert [(r["a"], r["b"], r["part"], r["n_docs"], r["n_links"]) for r in merged] == [
        (1, 2, 0, 3, 8), (1, 2, 1, 1, 7), (2, 2, 1, 1, 1)]


@pytest.mark.parametrize("text", ["plain words", "tab\tand\n\nbreaks", "don't we'll 12ab", "日本語 и кириллица"])
def test_rank_form_equals_the_library(text):
    encoder = alignment.ByteLevel(A_PATH, public_tokenizers.PATTERN)
    assert encoder.by_rank is not None
    assert encoder.encode([text])[0] == encoder.library.encode(text, add_special_tokens=False).ids
