"""Pattern matches with their places, and span lists, as DataFrame expressions.

Places are code points, end exclusive. A pattern's hits and the gaps between them come from two
built-in functions; the running length of both gives the places. Running sums are made in blocks of ``SIDE``
numbers and then over the blocks, and spans are compared with blocks of spans first, so that a text with very
many hits costs little more than its hits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

CONTEXT_CHARS = 60
SIDE = 256
_SPAN = "struct<start:int,stop:int,match:string,before:string,after:string>"


def hits_and_gaps(text: Column, pattern: str, gate: Column) -> Column:
    """struct(hits, gaps); both empty where ``gate`` says that nothing can match."""
    return F.when(gate, F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
        F.split(text, pattern, -1).alias("gaps"))).otherwise(F.struct(
            F.array().cast("array<string>").alias("hits"),
            F.array().cast("array<string>").alias("gaps")))


def named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often and deep inside it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def blocks(values: Column) -> Column:
    """The array cut into arrays of ``SIDE`` elements; none for an empty one."""
    return F.when(F.size(values) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / SIDE).cast("int")),
        lambda b: F.slice(values, b * SIDE + 1, SIDE))).otherwise(F.slice(F.array(values), 1, 0))


def running(numbers: Column) -> Column:
    """The sums of the first one, two, three ... of an array of integers."""
    def sums(values: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(values, start, lambda s, x: F.struct(
            (s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"] + x)).alias("out")),
            lambda s: s["out"])

    def added(parts: Column) -> Column:
        ends = sums(F.transform(parts, lambda part: F.element_at(part, -1)))
        return F.flatten(F.zip_with(
            parts, F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size(parts) - 1)),
            lambda part, before: F.transform(part, lambda x: x + before)))

    return named(numbers, lambda given: F.when(F.size(given) > 0, named(
        F.transform(blocks(given), sums), added)).otherwise(F.array().cast("array<int>")))


def placed(found: Column, good: Callable[[Column], Column]) -> Column:
    """The hits that pass ``good`` as array<start, stop, match, before, after>, from hits_and_gaps.

    ``before`` and ``after`` are the nearest characters of the gaps on both sides.
    """
    def spans(given: Column) -> Column:
        hits, gaps = given["hits"], given["gaps"]
        rows = F.arrays_zip(
            hits.alias("hit"), F.slice(gaps, 1, F.size(hits)).alias("gap"),
            F.slice(gaps, 2, F.size(hits)).alias("next"),
            running(F.zip_with(F.slice(gaps, 1, F.size(hits)), hits,
                               lambda gap, hit: F.length(gap) + F.length(hit))).alias("stop"))
        return F.transform(F.filter(rows, lambda r: good(r["hit"])), lambda r: F.struct(
            (r["stop"] - F.length(r["hit"])).alias("start"), r["stop"].alias("stop"),
            r["hit"].alias("match"),
            F.substring(r["gap"], -CONTEXT_CHARS, CONTEXT_CHARS).alias("before"),
            F.substring(r["next"], 1, CONTEXT_CHARS).alias("after")))

    return F.when(F.size(found["hits"]) > 0, named(found, spans)).otherwise(
        F.array().cast(f"array<{_SPAN}>"))


def tagged(spans: Column, kind: str, order: int) -> Column:
    """Spans as struct(start, kind_order, stop, kind), which sorts as the reports want it."""
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("kind_order"), s["stop"].alias("stop"),
        F.lit(kind).alias("kind")))


def span_text(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def free_flags(spans: Column, others: Column) -> Column:
    """For every span whether it overlaps none of the other spans."""
    def meets(span: Column, other: Column) -> Column:
        return (other["start"] < span["stop"]) & (span["start"] < other["stop"])

    def flags(parts: Column) -> Column:
        return F.transform(spans, lambda span: ~F.exists(parts, lambda part: F.when(
            meets(span, part), F.exists(part["spans"], lambda other: meets(span, other)))
            .otherwise(False)))

    bounds = F.transform(blocks(others), lambda part: F.struct(
        F.array_min(part["start"]).alias("start"), F.array_max(part["stop"]).alias("stop"),
        part.alias("spans")))
    return F.when(F.size(others) > 0, named(bounds, flags)).otherwise(
        F.transform(spans, lambda span: F.lit(True)))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, overlaps joined, replaced by its first kind in brackets."""
    def step(state: Column, s: Column) -> Column:
        return F.when(s["start"] >= state["at"], F.struct(
            F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]),
                     F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out"),
            s["stop"].alias("at"))).otherwise(F.struct(
                state["out"].alias("out"), F.greatest(state["at"], s["stop"]).alias("at")))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    whole = F.aggregate(F.array_sort(spans), start, step, lambda s: F.concat(
        s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
