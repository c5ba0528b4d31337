"""Places, running sums and overlaps of many hits against plain loops."""

import random
import re

import pytest
from pyspark.sql import functions as F

from shelfmark.llm.spans import SIDE, free_flags, hits_and_gaps, placed, running


@pytest.mark.parametrize("n", [0, 1, SIDE, SIDE + 1, 3 * SIDE + 7])
def test_running_and_places(spark, n):
    draw = random.Random(n)
    text = "".join(f"é{'x' * draw.randrange(4)}{draw.randrange(10 ** draw.randrange(1, 5))}" for _ in range(n)) + "語"
    t = F.col("text")
    row = spark.createDataFrame([(text,)], "text string").select(
        placed(hits_and_gaps(t, "[0-9]+", F.lit(True)), lambda x: F.length(x) > 1).alias("spans"),
        running(F.transform(F.split(t, "é"), F.length)).alias("sums")).first()
    assert [(s["start"], s["stop"], s["match"]) for s in row["spans"]] == [
        (m.start(), m.end(), m[0]) for m in re.finditer("[0-9]+", text) if len(m[0]) > 1]
    sums, total = [], 0
    for part in text.split("é"):
        total += len(part)
        sums.append(total)
    assert row["sums"] == sums


def test_free_flags(spark):
    draw = random.Random(3)
    spans, others = ([(a, a + draw.randrange(1, 6)) for a in (draw.randrange(4000) for _ in range(n))]
                     for n in (600, 700))
    kind = "array<struct<start:int,stop:int>>"
    rows = spark.createDataFrame([(spans, others), (spans, []), ([], others), ([], [])], f"a {kind}, b {kind}").select(
        free_flags(F.col("a"), F.col("b")).alias("flags")).collect()
    want = [not any(c < b and a < d for c, d in others) for a, b in spans]
    assert [r["flags"] for r in rows] == [want, [True] * 600, [], []]
