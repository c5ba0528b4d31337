"""Exact batched top-k of ``alpha * cosine + beta * popularity - gamma * penalty``.

Scoring every item for every query would be a cross join. Instead items are put in the order of
what they can promise and cut into groups of about equal size. A group keeps, for every angle a
query can have to a common centre, the best score any of its items can reach: an item at angle t
to the centre has at most the cosine of ``t - angle`` to such a query. Each query first visits its most
promising group, which gives it a k-th best score, and afterwards only those other groups that
could still beat it. The result equals the full comparison; the bounds only save work.

If what is left to visit is more than a few copies of items and queries, the groups come in rounds, the
most promising ones of each query first: at least ``ROUND_VISITS`` groups, or as many as ``ROUND_BYTES`` allow. A
round is stored with the best rows so far and its shuffle files are dropped before the next one.

Queries come in slices by hash, whose vectors and lists fill ``ROUND_BYTES`` or half as much as the items. A slice
meets the groups in steps that send about as many bytes each. So the disk holds the items once, the lists found
and a part of the items and queries on their way, however many queries and groups there are.

The order is that of the best score for a query at the usual angle where popularity or penalty count. Where
only the cosine counts it is the angle to the centre or, if the vectors lie close around
pivots, the nearest pivot, whose angles then bound the cosine too.

A group and a chunk of its queries meet in one cell. What is shuffled are the queries once per group
they visit and the items once per chunk, so groups and chunks grow with the root of the pairs,
up to ``MAX_SIDE`` rows; groups with more equal items than that are split by hash. Only the bounds (a few
thousand numbers a group) reach the driver.
"""

from __future__ import annotations

import math
from types import SimpleNamespace

import numpy as np
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from shelfmark.session import cut, cut_at, remove, run_folder, scratch_scope

MAX_PIVOTS = 512
ITEM_BLOCK = 4096    # least items of a group and queries of a chunk, as long as there are as many
QUERY_CHUNK = 8192
MAX_SIDE = 131_072   # most of either
MANY_CELLS = 256     # groups and chunks grow once all pairs would make so many cells
MAX_TASKS = 50_000
ROUND_VISITS = 2     # least groups that a query visits in a round
ROUND_BYTES = 1 << 28  # least bytes on their way at a time
LIST_BYTES = 48      # of a row found
MAX_WEIGHTS = 64     # different weights that have bounds of their own; with more all groups are visited
CELL_BLOCK = 1024    # items of a cell that share their bounds
CELL_ANGLES = 64     # steps of a query's angle to the items' mean, between those of the cell's queries
ANGLES = 256         # steps of a query's angle to the centre
TIGHT = 0.5          # items are ordered by pivot if this times as far from it as from the centre
DIGITS = 9           # scores are ranked as reported: rounded, ties by item id
_SLACK = 1e-6        # rounding slack of the bounds, far above float error


def _pivots(vectors: DataFrame, wanted: int) -> np.ndarray:
    """Unit vectors of ``wanted`` distinct items, chosen by hash order."""
    rows = (vectors.where(F.exists("embedding", lambda x: x != 0)).select("item_id", "embedding")
            .orderBy(F.xxhash64("item_id"), "item_id").limit(wanted).collect())
    if not rows:
        return np.zeros((0, 0))
    matrix = np.array([r["embedding"] for r in rows], dtype=float)
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.unique(unit.round(12), axis=0)


def _place(vectors: DataFrame, pivots: np.ndarray, centre: np.ndarray, key: T.DataType) -> DataFrame:
    """Angle to the centre, nearest pivot and angle to it per item; a zero vector has pivot -1, angle -1."""
    shared = vectors.sparkSession.sparkContext.broadcast((pivots, centre))  # at most MAX_PIVOTS + 1 rows

    def nearest(batches):
        import numpy as np
        import pandas as pd
        centres, middle = shared.value
        for batch in batches:
            pivot = np.full(len(batch), -1, dtype="int32")
            angle, theta = np.zeros(len(batch)), np.full(len(batch), -1.0)
            if len(batch) and len(centres):
                matrix = np.stack(batch["embedding"].to_numpy())
                length = np.linalg.norm(matrix, axis=1)
                known = length > 0
                if known.any():
                    unit = matrix[known] / length[known, None]
                    cos = unit @ centres.T
                    best = cos.argmax(axis=1)
                    pivot[known] = best
                    angle[known] = np.arccos(np.clip(cos[np.arange(len(best)), best], -1, 1))
                    theta[known] = np.arccos(np.clip(unit @ middle, -1, 1))
            yield batch.assign(pivot=pivot, angle=angle, theta=theta)

    schema = T.StructType([
        T.StructField("item_id", key), T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("pop", T.DoubleType()), T.StructField("pen", T.DoubleType()),
        T.StructField("pivot", T.IntegerType()), T.StructField("angle", T.DoubleType()),
        T.StructField("theta", T.DoubleType())])
    return vectors.select("item_id", "embedding", "pop", "pen").mapInPandas(nearest, schema)


def _usual_angle(queries: DataFrame, centre: np.ndarray) -> float:
    """Mean angle to the centre of up to 1,000 queries; only the order of the items depends on it."""
    rows = [r["vec"] for r in queries.select("vec").limit(1_000).collect()]
    matrix = np.array(rows, dtype=float).reshape(len(rows), -1)
    length = np.linalg.norm(matrix, axis=1) if len(rows) else np.zeros(0)
    if not (length > 0).any():
        return 0.0
    matrix, length = matrix[length > 0], length[length > 0]
    return float(np.arccos(np.clip(matrix @ centre / length, -1, 1)).mean())


def _grouped(placed: DataFrame, queries: DataFrame, weights: np.ndarray, centre: np.ndarray,
             n_items: int, side: int) -> tuple[DataFrame, bool]:
    """Items with the number of their group, and whether the groups follow the pivots."""
    by_pivot = False
    if len(weights) and (weights[:, 1:] > 0).any():
        alpha, beta, gamma = (F.lit(float(w)) for w in weights.mean(axis=0))
        away = F.greatest(F.col("theta") - F.lit(_usual_angle(queries, centre)), F.lit(0.0))
        cosine = F.when(F.col("theta") < 0, F.lit(0.0)).otherwise(F.cos(away))
        order = -(alpha * cosine + beta * F.col("pop") - gamma * F.col("pen"))
    else:
        far = placed.where("theta >= 0").agg(F.avg("angle").alias("a"), F.avg("theta").alias("t")).first()
        by_pivot = far["a"] is not None and far["a"] < TIGHT * far["t"]
        order = F.col("pivot") + F.col("angle") / F.lit(4.0) if by_pivot else F.col("theta")
    n = max(1, math.ceil(n_items / side))
    edges = placed.agg(F.percentile_approx(order, [i / n for i in range(1, n)], 100_000)).first()[0] if n > 1 else []
    edges = sorted(set(edges or []))
    number = F.size(F.filter(F.lit(edges), lambda x: x < order)) if edges else F.lit(0)
    return placed.withColumn("grp", number.cast("int")), by_pivot


def _reach(blocks: DataFrame, weights: np.ndarray) -> dict:
    """Per group the best score of an item for each of the weights (rows) and each step of the query's angle
    (columns; the last one is for zero queries)."""
    steps = ANGLES

    def highest(batches):
        import numpy as np
        import pandas as pd
        low = np.arange(steps) * np.pi / steps - 1e-7
        high = low + np.pi / steps + 2e-7
        best = {}
        for batch in batches:
            for start in range(0, len(batch), 4096):
                part = batch.iloc[start:start + 4096]
                grp = part["grp"].to_numpy()
                order = np.argsort(grp, kind="stable")
                grp, theta, pop, pen = grp[order], *(part[c].to_numpy(dtype=float)[order] for c in ("theta", "pop", "pen"))
                near = np.maximum(np.maximum(theta[:, None] - high, low - theta[:, None]), 0.0)
                cos = np.where(theta[:, None] >= 0, np.cos(near), 0.0)
                cos = np.concatenate([cos, np.zeros((len(theta), 1))], axis=1)
                first = np.flatnonzero(np.append(True, grp[1:] != grp[:-1]))
                for w, (alpha, beta, gamma) in enumerate(weights):
                    score = alpha * cos + (beta * pop - gamma * pen)[:, None]
                    top = np.maximum.reduceat(np.where(np.isnan(score), -np.inf, score), first)
                    for g, row in zip(grp[first].tolist(), top):
                        best[g, w] = np.maximum(best[g, w], row) if (g, w) in best else row
        if best:
            yield pd.DataFrame({"grp": [g for g, _ in best], "w": [w for _, w in best], "reach": list(best.values())})

    rows = blocks.select("grp", "theta", "pop", "pen").mapInPandas(
        highest, "grp int, w int, reach array<double>").select("grp", "w", F.posexplode("reach").alias("at", "x"))
    table = {}
    for r in rows.groupBy("grp", "w", "at").agg(F.max("x").alias("x")).collect():
        table.setdefault(r["grp"], np.full((len(weights), steps + 1), -np.inf))[r["w"], r["at"]] = r["x"]
    return table


def _plan(blocks: DataFrame, weights: np.ndarray, pivots: np.ndarray, centre: np.ndarray,
          by_pivot: bool, side: int) -> SimpleNamespace:
    """Driver-side bounds of the item groups: a few thousand numbers a group.

    A plain namespace of arrays, so that workers need nothing of this package.
    """
    sizes = {r["grp"]: r["count"] for r in blocks.groupBy("grp").count().collect()}
    group = sorted(sizes)
    known = len(weights) <= MAX_WEIGHTS
    table = _reach(blocks, weights) if known else {}
    parts = sorted(blocks.groupBy("grp", "pivot").agg(
        F.max("angle").alias("angle"), F.max("pop").alias("pop"), F.min("pen").alias("pen")).collect(),
        key=lambda r: (r["grp"], r["pivot"])) if by_pivot else []
    return SimpleNamespace(
        group=np.array(group, dtype=int), size=np.array([sizes[g] for g in group], dtype=float),
        salts=np.array([max(1, math.ceil(sizes[g] / side)) for g in group], dtype=int),
        weights=weights, reach=np.array([table[g] for g in group]) if known and group else None,
        pivots=pivots, centre=centre,
        start=np.flatnonzero([i == 0 or parts[i - 1]["grp"] != r["grp"] for i, r in enumerate(parts)]),
        pivot=np.array([r["pivot"] for r in parts], dtype=int),
        **{c: np.array([r[c] for r in parts], dtype=float) for c in ("angle", "pop", "pen")})


def _visits(queries: DataFrame, plan: SimpleNamespace, k: int, turn: int | None, key: T.DataType) -> DataFrame:
    """Queries with the array ``grps`` of groups to visit, the most promising first: without ``turn`` as many as
    hold 2 x k items; otherwise those that come from this turn on after them and can still reach
    ``floor``, the k-th best score so far (null if there is none)."""
    shared = queries.sparkSession.sparkContext.broadcast(plan)

    def choose(batches):
        import numpy as np
        p = shared.value
        for batch in batches:
            if not len(batch):
                continue
            matrix = np.stack(batch["vec"].to_numpy())
            length = np.linalg.norm(matrix, axis=1)
            unit = matrix / np.where(length > 0, length, 1.0)[:, None]
            own = batch[["alpha", "beta", "gamma"]].to_numpy(dtype=float)
            bound = np.full((len(batch), len(p.group)), np.inf)
            if p.reach is not None:
                step = np.minimum(np.arccos(np.clip(unit @ p.centre, -1, 1)) / np.pi * (p.reach.shape[2] - 1),
                                  p.reach.shape[2] - 2).astype(int)
                step = np.where(length > 0, step, p.reach.shape[2] - 1)
                for w, weights in enumerate(p.weights):
                    same = np.flatnonzero((own == weights).all(axis=1))
                    bound[same] = p.reach[:, w, step[same]].T
            if len(p.pivot):
                alpha, beta, gamma = (own[:, i, None] for i in range(3))
                cos = np.zeros((len(batch), len(p.pivot)))
                real = p.pivot >= 0
                away = np.arccos(np.clip(unit @ p.pivots.T, -1, 1))[:, p.pivot[real]]
                near = np.maximum(away - p.angle[real] - 1e-7, 0.0)
                cos[:, real] = np.where(length[:, None] > 0, np.cos(near), 0.0)
                best = alpha * cos + beta * p.pop - gamma * p.pen
                bound = np.minimum(bound, np.maximum.reduceat(best, p.start, axis=1))
            bound = bound + 1e-6
            order = np.argsort(-bound, axis=1, kind="stable")
            before = np.cumsum(p.size[order], axis=1) - p.size[order]
            take = before < 2 * k
            if turn is not None:
                floor = batch["floor"].to_numpy(dtype=float)
                late = np.arange(bound.shape[1]) - take.sum(axis=1)[:, None] >= turn
                take = late & (np.take_along_axis(bound, order, axis=1)
                               >= np.where(np.isnan(floor), -np.inf, floor)[:, None])
            yield batch.assign(grps=[p.group[o[t]].astype("int32") for o, t in zip(order, take)])

    owner = [queries.schema["owner"]] if "owner" in queries.columns else []
    schema = T.StructType([
        T.StructField("query_id", key), *owner, T.StructField("vec", T.ArrayType(T.DoubleType()))] + [
        T.StructField(c, T.DoubleType()) for c in ("alpha", "beta", "gamma", "floor")] + [
        T.StructField("grps", T.ArrayType(T.IntegerType()))])
    return queries.select(*schema.names[:-1]).mapInPandas(choose, schema).where(F.size("grps") > 0)


def _load(visits: DataFrame) -> dict[int, int]:
    """How many queries visit each group: a few hundred rows."""
    return {r["grp"]: r["count"] for r in visits.select(F.explode("grps").alias("grp")).groupBy("grp").count().collect()}


def _score(visits: DataFrame, blocks: DataFrame, salts: dict[int, int],
           seen: DataFrame | None, k: int, chunk: int, load: dict[int, int] | None = None) -> DataFrame:
    """Best k unseen items of each visited block for each query, as far as they reach its ``floor``.

    ``seen`` holds, per query (or ``owner``, if the queries have one) and block, the array of items not to return;
    ``load`` the queries of each group.
    """
    load = _load(visits) if load is None else load
    visits = visits.withColumn("grp", F.explode("grps")).drop("grps")
    load = {g: math.ceil(n / chunk) for g, n in load.items()}
    chunks = F.create_map(*[x for g, n in load.items() for x in (F.lit(g), F.lit(n))]) \
        if load else None
    # A cell (block x chunk) is a bounded piece of computing, however few bytes it has, so
    # the number of tasks follows the cells.
    tasks = max(1, min(MAX_TASKS, sum(n * salts[g] for g, n in load.items())))

    def n_chunks(grp):
        return F.lit(1) if chunks is None else F.coalesce(chunks[grp], F.lit(0))

    def chunk_of():
        return F.pmod(F.xxhash64("query_id"), n_chunks(F.col("grp"))).cast("int")

    salt_of = F.create_map(*[F.lit(x) for pair in salts.items() for x in pair])
    left = visits.drop(*([] if seen is not None else ["owner"])).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), salt_of[F.col("grp")] - 1))).withColumn(
        "chunk", chunk_of()).withColumn("seen", F.lit(None).cast(T.ArrayType(blocks.schema["item_id"].dataType)))
    if seen is not None:
        # What a query must not get meets it in the cell, as a row without a vector: joined to the visits before,
        # it would send their vectors through one more shuffle.
        barred = seen.join(visits.select("query_id", "grp"), ["query_id", "grp"], "left_semi") \
            if "owner" not in visits.columns else seen.join(
                visits.select("query_id", "owner", "grp"), ["owner", "grp"]).drop("owner")
        left = left.drop("owner")
        left = left.unionByName(barred.withColumn("chunk", chunk_of()), allowMissingColumns=True)
    right = blocks.withColumn("copies", n_chunks(F.col("grp"))).where("copies > 0").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))

    digits, block, steps, most_weights = DIGITS, CELL_BLOCK, CELL_ANGLES, MAX_WEIGHTS

    def best(left_rows, right_rows):
        import numpy as np
        import pandas as pd
        extra = left_rows["vec"].isna().to_numpy()
        left_rows, bans = left_rows[~extra], left_rows[extra]
        if not len(left_rows) or not len(right_rows):
            # Typed like the input, so that an empty string column stays a string column.
            none = {c: np.zeros(0) for c in (
                "content_score", "popularity_score", "penalty", "final_score")}
            return pd.DataFrame({"query_id": left_rows["query_id"].iloc[:0].to_numpy(),
                                 "item_id": right_rows["item_id"].iloc[:0].to_numpy(), **none})
        right_rows = right_rows.sort_values("item_id", kind="stable")
        ids = right_rows["item_id"].to_numpy()

        def units(column):
            matrix = np.stack(column.to_numpy())
            length = np.linalg.norm(matrix, axis=1)
            return matrix / np.where(length > 0, length, 1.0)[:, None]

        matrix, vec = units(right_rows["embedding"]), units(left_rows["vec"])
        pop, pen = right_rows["pop"].to_numpy(), right_rows["pen"].to_numpy()
        a, b, g = (left_rows[c].to_numpy() for c in ("alpha", "beta", "gamma"))
        floor = left_rows["floor"].to_numpy(dtype=float)
        floor = np.where(np.isnan(floor), -np.inf, floor)

        # Angles to the items' mean, -1 for zero vectors.
        middle = matrix.mean(axis=0)
        middle = middle / (np.linalg.norm(middle) or 1.0)

        def to_middle(rows):
            return np.where(rows.any(axis=1), np.arccos(np.clip(rows @ middle, -1, 1)), -1.0)

        theta, angle = to_middle(matrix), to_middle(vec)
        # The items in the order of what they promise to a usual query, in blocks; ``turn`` is their place by id.
        promise = b.mean() * pop - g.mean() * pen + a.mean() * np.where(theta >= 0, np.cos(np.maximum(
            theta - (angle[angle >= 0].mean() if (angle >= 0).any() else 0.0), 0.0)), 0.0)
        turn = np.argsort(-promise, kind="stable")
        matrix, pop, pen, theta = matrix[turn], pop[turn], pen[turn], theta[turn]

        # What a block can reach for each of the weights, step of the query's angle, and zero queries (the last).
        edges = np.linspace(angle.min() - 1e-7, angle.max() + 1e-7, steps + 1)
        step = np.clip(np.searchsorted(edges, angle, "right") - 1, 0, steps - 1)
        step = np.where(angle >= 0, step, steps)
        weights, which = np.unique(np.column_stack([a, b, g]), axis=0, return_inverse=True)
        which, starts = which.ravel(), range(0, len(ids), block)
        bound = np.full((len(weights), len(starts), steps + 1), np.inf)
        for i, at in enumerate(starts if len(weights) <= most_weights else ()):
            own = theta[at:at + block, None]
            cos = np.where(own >= 0, np.cos(np.maximum(np.maximum(own - edges[1:], edges[:-1] - own) - 1e-7, 0.0)), 0.0)
            cos = np.concatenate([cos, np.zeros((len(cos), 1))], axis=1)
            for w, (alpha, beta, gamma) in enumerate(weights):
                best_of = alpha * cos + (beta * pop[at:at + block] - gamma * pen[at:at + block])[:, None]
                bound[w, i] = np.where(np.isnan(best_of), -np.inf, best_of).max(axis=0) + 1e-6

        # Scores in single precision leave out what is surely below the floor; the rest is scored in double.
        coarse = np.column_stack([vec * a[:, None], b, -g]).astype("float32")
        against = np.column_stack([matrix, pop, pen]).astype("float32")
        size = [np.abs(x[np.isfinite(x)]).max(initial=0.0) for x in (pop, pen)]
        error = (a + b * size[0] + g * size[1]) * (matrix.shape[1] + 4) * 2e-7 + 1e-8
        place = {item: i for i, item in enumerate(ids)}
        barred = dict(zip(bans["query_id"], bans["seen"]))
        banned = [[place[item] for item in barred.get(q, ())] for q in left_rows["query_id"]]
        by_query = np.repeat(np.arange(len(banned)), [len(x) for x in banned])
        banned = np.argsort(turn)[np.array([i for x in banned for i in x], dtype=int)]

        def merged(parts):
            query, hit, cos, final = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((turn[hit], -final, query))  # ties: smallest item ids first
            query, hit, cos, final = (x[order] for x in (query, hit, cos, final))
            nth = np.arange(len(query)) - np.searchsorted(query, query, "left")
            kth = nth == k - 1
            floor[query[kth]] = np.maximum(floor[query[kth]], final[kth])
            return [x[nth < k] for x in (query, hit, cos, final)]

        chosen = []
        for start in range(0, len(left_rows), 512):
            stop = min(start + 512, len(left_rows))
            mine = slice(*np.searchsorted(by_query, [start, stop]))
            reach = bound[which[start:stop], :, step[start:stop]]
            parts, waiting = [], 0
            for i, at in enumerate(starts):
                live = start + np.flatnonzero(reach[:, i] >= floor[start:stop])
                if not len(live):
                    continue
                score = coarse[live] @ against[at:at + block].T
                here = np.flatnonzero((banned[mine] >= at) & (banned[mine] < at + block))
                if len(here):
                    row = np.searchsorted(live, by_query[mine][here])
                    real = row < len(live)
                    real[real] = live[row[real]] == by_query[mine][here][real]
                    score[row[real], banned[mine][here][real] - at] = -np.inf
                least = floor[live] - error[live]
                open_ = np.flatnonzero(np.isneginf(least))
                if len(open_) and score.shape[1] > k:
                    known = score[open_]
                    known[np.isnan(known)] = -np.inf
                    kth = known.max(axis=1) if k == 1 else np.partition(known, -k, axis=1)[:, -k]
                    least[open_] = kth - 2 * error[live][open_]
                lowest = np.maximum(least, -3e38).astype("float32")   # above a banned item's
                hit = np.flatnonzero(score >= lowest[:, None])
                query, hit = live[hit // score.shape[1]], at + hit % score.shape[1]
                cos = np.einsum("nd,nd->n", vec[query], matrix[hit])
                final = np.round(a[query] * cos + b[query] * pop[hit] - g[query] * pen[hit], digits)
                good = np.isfinite(final)
                waiting += int(good.sum())
                first = not parts
                parts.append([x[good] for x in (query, hit, cos, final)])
                if first or waiting > k * (stop - start):
                    parts, waiting = [merged(parts)], 0
            if parts:
                chosen.append(merged(parts))
        query, hit, cos, final = (np.concatenate(x) for x in zip(*chosen)) if chosen else (
            np.zeros(0, int), np.zeros(0, int), np.zeros(0), np.zeros(0))
        penalty = pen[hit] * g[query]
        return pd.DataFrame({
            "query_id": left_rows["query_id"].to_numpy()[query], "item_id": ids[turn[hit]],
            "content_score": cos, "popularity_score": pop[hit], "penalty": penalty,
            "final_score": final})

    schema = T.StructType([
        T.StructField("query_id", visits.schema["query_id"].dataType),
        T.StructField("item_id", blocks.schema["item_id"].dataType)] + [
        T.StructField(c, T.DoubleType())
        for c in ("content_score", "popularity_score", "penalty", "final_score")])
    keys = ["grp", "salt", "chunk"]
    return (left.repartition(tasks, *keys).groupBy(*keys)
            .cogroup(right.repartition(tasks, *keys).groupBy(*keys))
            .applyInPandas(best, schema))


def _seen_by_block(seen: DataFrame | None, blocks: DataFrame) -> DataFrame | None:
    """What a query or an owner of queries must not get back, per block, so that no array is longer than a block.

    Stored, because both phases use it.
    """
    if seen is None:
        return None
    by = "owner" if "owner" in seen.columns else "query_id"
    return cut(seen.join(blocks.select("item_id", "grp", "salt"), "item_id").groupBy(
        by, "grp", "salt").agg(F.collect_set("item_id").alias("seen")))


def rank_within(scored: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Keep the k best rows per key by rounded score, ties by item id, with ``rank`` from 1.

    The rank filter is applied inside each task first, so at most k rows per key and task
    are shuffled.
    """
    order = W.partitionBy(*keys).orderBy(F.round("final_score", DIGITS).desc(), F.asc("item_id"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _this_round(load: dict[int, int], index: SimpleNamespace, n_queries: int) -> int:
    """How many of the next groups of each query fit a round: all, if they are few copies of the rows.

    A visit sends the query once, a visited group its items once per chunk.
    """
    size, row_bytes = index.size, index.row_bytes
    sent = sum(n + size[g] * math.ceil(n / index.chunk) for g, n in load.items())
    if sent * row_bytes <= max(ROUND_BYTES, 2 * row_bytes * (index.n_items + n_queries)):
        return len(size)
    turn = n_queries * (row_bytes + LIST_BYTES * index.k) + row_bytes * (
        index.n_items / len(size) * math.ceil(n_queries / index.chunk))
    return max(ROUND_VISITS, int(index.limit // turn))


def _steps(load: dict[int, int], index: SimpleNamespace) -> list[dict[int, int]]:
    """The visited groups, a few at a time, so that no step sends many more bytes than the limit."""
    steps, room = [], 0
    for g, n in sorted(load.items()):
        sent = index.row_bytes * (n + index.size[g] * math.ceil(n / index.chunk))
        if not steps or sent > room:
            steps.append({})
            room = index.limit
        steps[-1][g] = n
        room -= sent
    return steps


def _found(visits: DataFrame, load: dict[int, int], index: SimpleNamespace, seen: DataFrame | None,
           folder: str) -> DataFrame:
    """What the visits find, stored step by step if there are several."""
    steps = _steps(load, index)
    found = None
    for step in steps:
        here, barred = visits, seen
        if len(steps) > 1:
            groups = F.lit(list(step))
            here = visits.withColumn("grps", F.filter("grps", lambda g: F.array_contains(groups, g))).where(
                F.size("grps") > 0)
            barred = None if seen is None else seen.where(F.col("grp").isin(list(step)))
        found = _score(here, index.blocks, index.salts, barred, index.k, index.chunk, step)
        if len(steps) > 1:
            found = cut_at(found, folder)
    return found


def _search(queries: DataFrame, index: SimpleNamespace, seen: DataFrame | None, n_queries: int) -> DataFrame:
    """The k best items of the queries, stored."""
    spark, k, plan = queries.sparkSession, index.k, index.plan
    key = queries.schema["query_id"].dataType
    folder, at, hits = (run_folder(spark, name) for name in ("best", "visits", "found"))
    if plan is None:
        first = queries.withColumn("grps", F.array(F.lit(0)))
    else:
        first = cut_at(_visits(queries, plan, k, None, key), at)
    load = _load(first)
    if not load:
        return cut_at(rank_within(_score(first, index.blocks, index.salts, seen, k, index.chunk, load),
                                  ["query_id"], k), folder)
    best = cut_at(rank_within(_found(first, load, index, seen, hits), ["query_id"], k), folder)
    for path in (at, hits):
        remove(spark, path)
    turn = 0
    while plan is not None and turn < len(plan.group):
        floors = best.where(F.col("rank") == k).select(
            "query_id", (F.col("final_score") - F.lit(_SLACK)).alias("floor"))
        old = [folder, run_folder(spark, "visits"), run_folder(spark, "found")]
        folder = run_folder(spark, "best")
        rest = cut_at(_visits(queries.drop("floor").join(floors, "query_id", "left"), plan, k, turn, key), old[1])
        load = _load(rest)
        if not load:
            remove(spark, old[1])
            break
        step = _this_round(load, index, n_queries)
        now = rest
        if step < len(plan.group):
            now = rest.withColumn("grps", F.slice("grps", 1, step))
            load = _load(now)
        found = _found(now, load, index, seen, old[2])
        best = cut_at(rank_within(best.drop("rank").unionByName(found), ["query_id"], k), folder)
        for path in old:
            remove(spark, path)
        turn += step
    return best


def _index(queries: DataFrame, items: DataFrame, k: int, n_queries: int, group_size: int) -> SimpleNamespace:
    """The items in groups (``blocks``) with their bounds (``plan``), stored once more; a small catalog is one group
    without bounds, as it is."""
    n_items = items.count()
    side = min(MAX_SIDE, math.isqrt(n_items * n_queries // MANY_CELLS))
    side, chunk = max(ITEM_BLOCK, side), max(QUERY_CHUNK, side)
    width = (items.select(F.size("embedding").alias("n")).first() or {"n": 0})["n"]
    row_bytes = 8 * max(width, 0) + 32
    index = SimpleNamespace(k=k, chunk=chunk, n_items=n_items, row_bytes=row_bytes,
                            limit=max(ROUND_BYTES, n_items * row_bytes // 2))
    wanted = min(MAX_PIVOTS, n_items // group_size)
    if wanted <= 1:  # a small catalog is one group: nothing to prune
        index.plan, index.size, index.salts = None, {0: n_items}, {0: max(1, math.ceil(n_items / side))}
        index.blocks = items.withColumns({
            "grp": F.lit(0), "salt": F.pmod(F.xxhash64("item_id"), F.lit(index.salts[0])).cast("int")})
        return index

    pivots = _pivots(items, wanted)
    centre = pivots.sum(axis=0)
    centre = centre / (np.linalg.norm(centre) or 1.0)
    weights = np.array(sorted(tuple(r) for r in queries.select("alpha", "beta", "gamma").distinct()
                              .limit(MAX_WEIGHTS + 1).collect()), dtype=float).reshape(-1, 3)
    placed = cut(_place(items, pivots, centre, items.schema["item_id"].dataType))
    grouped, by_pivot = _grouped(placed, queries, weights, centre, n_items, side)
    plan = _plan(grouped, weights, pivots, centre, by_pivot, side)
    index.plan, index.size = plan, dict(zip(plan.group.tolist(), plan.size.tolist()))
    index.salts = dict(zip(plan.group.tolist(), plan.salts.tolist()))
    salt_of = F.create_map(*[F.lit(x) for pair in index.salts.items() for x in pair])
    index.blocks = grouped.withColumn("salt", F.pmod(
        F.xxhash64("item_id"), salt_of[F.col("grp")]).cast("int")).drop("pivot", "angle", "theta")
    return index


def weighted_topk(queries: DataFrame, items: DataFrame, k: int, seen: DataFrame | None = None,
                  group_size: int = 2048, stored: bool = False, folder: str | None = None) -> DataFrame:
    """The k best items per query, exactly.

    ``queries``: query_id, vec, alpha, beta, gamma (weights not negative).
    ``items``: item_id, embedding, pop, pen. ``seen``: query_id, item_id pairs left out; a pair may come twice. If
    several queries leave out the same items, they have an ``owner`` (then no query_id may come twice), and ``seen`` is owner, item_id.
    ``stored`` says that ``queries`` come from a stored table as they are, or are as cheap to read again.
    Returns query_id, item_id, content_score, popularity_score, penalty, final_score, rank.
    Runs the search, slice by slice, and returns the stored result, in ``folder`` if given; nothing else stays.
    """
    spark = items.sparkSession
    folder = folder or run_folder(spark, "lists")
    with scratch_scope(spark):
        by = "owner" if "owner" in queries.columns else "query_id"
        queries = queries.select(*dict.fromkeys(("query_id", by)), "vec", "alpha", "beta", "gamma")
        queries = queries if stored else cut(queries)
        at = run_folder(spark, "items")
        items = cut_at(items.select("item_id", "embedding", "pop", "pen"), at)
        n_queries = queries.count()
        index = _index(queries, items, k, n_queries, group_size)
        if index.plan is not None:
            remove(spark, at)
        queries = queries.withColumn("floor", F.lit(None).cast("double"))
        seen = _seen_by_block(seen, index.blocks)
        slices = max(1, math.ceil(n_queries * (index.row_bytes + LIST_BYTES * k) / index.limit))
        # Not the hash that deals a group's queries to chunks.
        part = F.pmod(F.xxhash64(F.lit(slices), F.col(by)), F.lit(slices))
        for number in range(slices):
            own, barred = queries, seen
            if slices > 1:
                own = queries.where(part == number)
                barred = None if seen is None else seen.where(part == number)
            with scratch_scope(spark):
                lists = cut_at(_search(own, index, barred, math.ceil(n_queries / slices)), folder)
    return lists
