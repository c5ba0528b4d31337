"""Global order statistics that never pull a whole column into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shelfmark.session import cut


def exact_medians(df: DataFrame, columns: Sequence[str],
                  accuracy: int = 100_000) -> dict[str, float | None]:
    """Exact (interpolating) median of the non-null values of each column.

    The first job brackets each median with approximate percentiles whose rank error is at
    most n / accuracy. While that is below half a rank (n <= accuracy / 4) the bracket is the
    answer. Otherwise a second job counts what lies below the bracket and groups the few
    values inside it, so a hot value is one row and the final window sees only the bracket.
    """
    step = 2.0 / accuracy
    first = df.agg(*[
        F.struct(
            F.count(c).alias("n"),
            F.percentile_approx(F.col(c).cast("double"), [0.5 - step, 0.5, 0.5 + step], accuracy)
            .alias("b")).alias(c)
        for c in columns]).first()
    medians: dict[str, float | None] = dict.fromkeys(columns)
    bounds = {}
    for c in columns:
        n = first[c]["n"]
        if n and n * step <= 0.5:
            low, high = first[c]["b"][1], first[c]["b"][1 if n % 2 else 2]
            medians[c] = (low + high) / 2
        elif n:
            bounds[c] = (first[c]["b"][0], first[c]["b"][2], n)
    if not bounds:
        return medians

    # One row per (column, value) inside the bracket; everything below it is the null value.
    cells = df.select(F.explode(F.array(*[
        F.struct(
            F.lit(c).alias("name"),
            F.when(F.col(c).cast("double") >= lo, F.col(c).cast("double")).alias("value"),
            (F.col(c).isNotNull() & (F.col(c).cast("double") <= hi)).alias("keep"))
        for c, (lo, hi, _) in bounds.items()])).alias("cell")).select("cell.*").where("keep")
    upto = W.partitionBy("name").orderBy(F.col("value").asc_nulls_first())
    sizes = F.create_map(*[x for c, (_, _, n) in bounds.items() for x in (F.lit(c), F.lit(n))])
    ranked = cells.groupBy("name", "value").count().withColumn(
        "last", F.sum("count").over(upto) - 1).withColumn(
        "first", F.col("last") - F.col("count") + 1).withColumn("n", sizes[F.col("name")])
    middle = [(F.col("n") - 1) / 2, F.col("n") / 2]
    hits = [(F.col("first") <= F.floor(m)) & (F.floor(m) <= F.col("last")) for m in middle]
    picked = ranked.groupBy("name").agg(
        ((F.max(F.when(hits[0], F.col("value"))) + F.max(F.when(hits[1], F.col("value")))) / 2)
        .alias("median")).collect()  # one row per column
    for row in picked:
        if row["median"] is None:
            raise ArithmeticError(f"median bracket missed for {row['name']}")
        medians[row["name"]] = row["median"]
    return medians


def with_global_rank(df: DataFrame, order: Sequence[Column], name: str = "global_rank") -> DataFrame:
    """Row number over the whole frame (from 1) without a single-partition window.

    The frame is range-partitioned and sorted, and each row stored with its partition and its
    position in it (the two halves of ``monotonically_increasing_id``). Adding the sizes of
    the earlier partitions, the only thing to reach the driver, gives the global position.
    ``order`` must be total, so that no two rows compare equal and ranges stay balanced.
    """
    placed = cut(df.repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumn("_at", F.monotonically_increasing_id()))
    part, position = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = {r["part"]: r["count"]
             for r in placed.groupBy(part.alias("part")).count().collect()}
    offsets, total = [], 0
    for number in sorted(sizes):
        offsets += [F.lit(number), F.lit(total)]
        total += sizes[number]
    offset = F.create_map(*offsets)[part] if offsets else F.lit(0)
    return placed.withColumn(name, (position + offset + 1).cast("bigint")).drop("_at")
