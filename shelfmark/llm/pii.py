"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

Base spans are matches of the fixed patterns (email, ip, card, phone). They are the seeds of a
bootstrap: the words around each identifier-like string form lexical patterns (two words before;
one before and one after). On the graph of patterns and instances a pattern's score is the
weighted share of its instances' scores (pulled down by ``PRIOR`` when it has few), and an unseen
instance's score is that of its best pattern; ``ROUNDS`` rounds run as joins and aggregations.
Patterns of at least ``MIN_INSTANCES`` instances and a score of ``MIN_SCORE`` add the unseen
identifiers that they hold as kind ``context``.

The graph has one row per distinct pattern and instance, reduced per task before the shuffle, so a
pattern or value that a third of all rows hold costs no more than any other.

Cases: a null text counts as empty and has no span; repeated rows are reported each; an empty table
gives an empty result; other columns are ignored (or kept, in ``redact``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.spans import (
    free_flags, hits_and_gaps, placed, redacted, span_text, tagged)
from shelfmark.llm.storage import stored

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
PRIOR = 2.0                # pseudo-instances without a score in every pattern
MIN_INSTANCES = 5
MIN_SCORE = 0.8
MIN_DIGITS = 5             # of an identifier-like string

# A match can begin only where its leading run begins or where the last match ended; saying so
# keeps long runs linear and changes no match.
EMAIL = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IDENTIFIER = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_PARTS = rf"^{_PART}(?:\.{_PART}){{3}}$"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    values = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""),
                         lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
                             (c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0


def _good_card(hit: Column) -> Column:
    digits = _digits(hit)
    return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)


def _words_of(span: Column) -> Column:
    """The patterns of a span: (two words before), (one word before, one after)."""
    before = F.lower(span["before"])
    last = F.regexp_extract(before, r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$", 1)
    two = F.regexp_extract(
        before, r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]+[^\x20\x09-\x0D]+[\x20\x09-\x0D]*$", 1)
    after = F.regexp_extract(F.lower(span["after"]), r"^[\x20\x09-\x0D]*([^\x20\x09-\x0D]+)", 1)
    return F.filter(F.array(
        F.when((two != "") & (last != ""), F.concat(F.lit("2:"), two, F.lit(" "), last)),
        F.when((last != "") & (after != ""), F.concat(F.lit("1:"), last, F.lit(" _ "), after))),
        lambda p: p.isNotNull())


def _scanned(documents: DataFrame, text: Column) -> DataFrame:
    """The input rows with base spans and the places of identifier-like strings; one pass."""
    t = F.col("text")
    rows = documents.withColumn("text", F.coalesce(text, F.lit("")))
    digit = t.rlike("[0-9]")
    found = rows.withColumns({
        "e": hits_and_gaps(t, EMAIL, t.contains("@")),
        "i": hits_and_gaps(t, IP, digit & t.rlike(r"[0-9]\.[0-9]")),
        "c": hits_and_gaps(t, CARD, t.rlike(CARD)),
        "p": hits_and_gaps(t, PHONE, t.contains("+")),
        "n": hits_and_gaps(t, IDENTIFIER, digit)})
    spans = found.withColumns({
        "e": placed(F.col("e"), lambda x: F.lit(True)),
        "i": placed(F.col("i"), lambda x: x.rlike(_PARTS)),
        "c": placed(F.col("c"), _good_card),
        "p": placed(F.col("p"), lambda x: F.length(_digits(x)).between(9, 15)),
        "n": placed(F.col("n"), lambda x: F.length(_digits(x)) >= MIN_DIGITS)})
    base = F.array_sort(F.concat(*[tagged(F.col(c), kind, i)
                                   for i, (c, kind) in enumerate(zip("eicp", KINDS))]))
    marked = spans.withColumn("base", base)

    def place(span: Column, seed: bool) -> Column:
        return F.struct(F.sha2(F.lower(span["match"]), 256).alias("instance"),
                        span["start"].alias("start"), span["stop"].alias("stop"),
                        F.lit(seed).alias("seed"), _words_of(span).alias("patterns"))

    return marked.withColumn("places", F.concat(
        F.transform(F.concat("e", "i", "c", "p"), lambda s: place(s, True)),
        F.filter(F.zip_with("n", free_flags(F.col("n"), F.col("base")), lambda s, free: F.when(
            free, place(s, False))), lambda p: p.isNotNull()))).withColumns(
        {f"n_{kind}": F.size(c).cast("long") for c, kind in zip("eicp", KINDS)}).drop(*"eicpn")


def score_patterns(edges: DataFrame, rounds: int = ROUNDS, prior: float = PRIOR) -> DataFrame:
    """(pattern, score, n_instances) after some rounds; edges: (pattern, instance, seed, weight)."""
    instances = edges.groupBy("instance").agg(F.max("seed").cast("double").alias("value"))
    patterns = None
    for _ in range(rounds):
        patterns = edges.join(instances, "instance").groupBy("pattern").agg(
            (F.sum(F.col("weight") * F.col("value")) / (F.sum("weight") + prior)).alias("score"),
            F.count("*").alias("n_instances"))
        instances = stored(edges.join(patterns, "pattern").groupBy("instance").agg(
            F.greatest(F.max(F.col("seed").cast("double")), F.max("score")).alias("value")),
            "pii-instances")
    return patterns


def find_personal(documents: DataFrame, *, id_col: str | None = "doc_id", text_col: str = "text",
                  keep_text: bool = False, rounds: int = ROUNDS, min_score: float = MIN_SCORE,
                  min_instances: int = MIN_INSTANCES) -> DataFrame:
    """One row per document: counts, ``base`` and ``added`` span arrays.

    ``keep_text`` keeps the text too, and all columns of the input under names c0, c1, ...
    """
    if keep_text:
        source = documents.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(documents.columns)],
                                  F.col(text_col).alias("text"))
        names = [f"c{i}" for i in range(len(documents.columns))] + ["text"]
    else:
        source = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        names = ["doc_id"]
    counts = [f"n_{k}" for k in KINDS]
    rows = stored(_scanned(source, F.col("text")).select(*names, *counts, "base", "places")
                  .withColumn("row", F.monotonically_increasing_id()), "pii")
    places = rows.where(F.size("places") > 0).select("row", F.explode("places").alias("p")).select(
        "row", "p.*")
    edges = stored(places.select(F.explode(F.array_distinct("patterns")).alias("pattern"),
                                 "instance", "seed").groupBy("pattern", "instance").agg(
        F.max("seed").alias("seed"), F.log1p(F.count("*")).alias("weight")), "pii-edges")
    trusted = score_patterns(edges, rounds).where(
        (F.col("score") >= min_score) & (F.col("n_instances") >= min_instances))
    unseen = places.where(~F.col("seed")).select(
        "row", "start", "stop", F.explode("patterns").alias("pattern"))
    span = F.struct("start", F.lit(len(KINDS)).alias("kind_order"), "stop",
                    F.lit("context").alias("kind"))
    # The trusted patterns of a corpus are few; as a stored table Spark sees whether it can send them.
    added = stored(unseen.join(stored(trusted.select("pattern"), "pii-patterns"), "pattern", "leftsemi")
                   .groupBy("row").agg(F.array_sort(F.collect_set(span)).alias("added")), "pii-added")
    empty = F.array().cast("array<struct<start:int,kind_order:int,stop:int,kind:string>>")
    return rows.drop("places").join(added, "row", "left").select(
        *names, *counts, "base", F.coalesce("added", empty).alias("added"))


def personal_report(documents: DataFrame, **options) -> DataFrame:
    """The contract's row per document."""
    return find_personal(documents, **options).select(
        "doc_id", *[f"n_{k}" for k in KINDS],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.concat("base", "added")).alias("spans"))


def redact(documents: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The input rows with every span of the text replaced by its kind in brackets; null stays."""
    columns = documents.columns
    found = find_personal(documents, text_col=text_col, keep_text=True, **options)
    new = redacted(F.col("text"), F.concat("base", "added"))
    return found.select(*[
        F.when(F.col(f"c{i}").isNotNull(), new).alias(c) if c == text_col
        else F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
