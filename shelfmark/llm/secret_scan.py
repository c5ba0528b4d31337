"""Secret scans: fixed patterns, and candidates judged by how many owners share them.

The base spans are matches of the fixed patterns. Beside them, candidate strings (known key
prefixes, long mixed strings) are hashed, and their hashes are counted over the whole corpus by
distinct repository and owner. A value that several owners hold is a widely copied example; one
that only a single owner holds, in at most ``MAX_REPOS`` repositories, looks live and is added
to the spans as kind ``owned``. All of it is DataFrame expressions.

A value that a third of all rows hold is reduced per task before each shuffle; only owner-specific
values go on to be joined with their places.

Cases: a null text counts as empty and has no span; a null owner or repository counts as one of
its own; repeated rows are reported each, and count once; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.spans import free_flags, hits_and_gaps, placed, span_text, tagged
from shelfmark.llm.storage import stored

MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 8, 16, 32
MAX_OWNERS, MAX_REPOS = 1, 2
KINDS = ("assign", "access", "hex")

ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
# A run shorter than wanted fails from every start in it, so the least length may stand here.
ACCESS = rf"AKIA[A-Z0-9]{{{MIN_ACCESS - 4},}}"
HEX = rf"[0-9a-f]{{{MIN_HEX},}}"
# Candidates beyond the base: whole runs of key characters, long or with a known prefix.
CANDIDATE = (r"(?<![A-Za-z0-9+/_=-])(?:gh[pousr]_[A-Za-z0-9]{20,}|sk_(?:live|test)_[A-Za-z0-9]{16,}"
             r"|xox[abprs]-[A-Za-z0-9-]{10,}|glpat-[A-Za-z0-9_-]{16,}|[A-Za-z0-9+/_=-]{24,})"
             r"(?![A-Za-z0-9+/_=-])")


def _mixed(hit: Column) -> Column:
    """Known prefix, or lower and upper letters and at least three digits, not all alike."""
    return hit.rlike("^(?:gh[pousr]_|sk_|xox|glpat-)") | (
        hit.rlike("[a-z]") & hit.rlike("[A-Z]") & hit.rlike("[0-9].*[0-9].*[0-9]")
        & (F.size(F.array_distinct(F.split(hit, ""))) >= 12))


def _scanned(documents: DataFrame, id_col, text_col, owner: Column, repo: Column) -> DataFrame:
    """One row per document with its base spans and its candidates; one pass over the texts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = documents.select(F.col(id_col).alias("doc_id"), text.alias("text"),
                            owner.cast("string").alias("owner"), repo.cast("string").alias("repo"))
    t = F.col("text")
    found = rows.select(
        "doc_id", "owner", "repo",
        hits_and_gaps(t, ASSIGN, (t.contains("=") | t.contains(":"))
                      & t.rlike("(?i:pass|secret|token|key)")).alias("a"),
        hits_and_gaps(t, ACCESS, t.contains("AKIA")).alias("k"),
        hits_and_gaps(t, HEX, t.rlike(HEX)).alias("h"),
        hits_and_gaps(t, CANDIDATE, t.rlike(CANDIDATE)).alias("c"))
    spans = found.select(
        "doc_id", "owner", "repo",
        placed(F.col("a"), lambda x: F.length(F.regexp_extract(x, ASSIGN, 1)) >= MIN_ASSIGNED)
        .alias("a"),
        placed(F.col("k"), lambda x: F.lit(True)).alias("k"),
        placed(F.col("h"), lambda x: F.lit(True)).alias("h"),
        placed(F.col("c"), _mixed).alias("c"))
    base = F.array_sort(F.concat(*[tagged(F.col(c), kind, i)
                                   for i, (c, kind) in enumerate(zip("akh", KINDS))]))
    return spans.select(
        "doc_id", "owner", "repo", F.size("a").cast("long").alias("n_assign"),
        F.size("k").cast("long").alias("n_access"), F.size("h").cast("long").alias("n_hex"),
        base.alias("base"),
        # Values of base spans are counted as well; only what overlaps none can become a new span.
        F.concat(
            F.transform("a", lambda s: F.struct(
                F.sha2(F.regexp_extract(s["match"], ASSIGN, 1), 256).alias("value"),
                s["start"].alias("start"), s["stop"].alias("stop"), F.lit(False).alias("new"))),
            F.transform(F.concat("k", "h"), lambda s: F.struct(
                F.sha2(s["match"], 256).alias("value"), s["start"].alias("start"),
                s["stop"].alias("stop"), F.lit(False).alias("new"))),
            F.zip_with("c", free_flags(F.col("c"), base), lambda s, free: F.struct(
                F.sha2(s["match"], 256).alias("value"), s["start"].alias("start"),
                s["stop"].alias("stop"), free.alias("new")))).alias("candidates"))


def value_owners(candidates: DataFrame) -> DataFrame:
    """(value, n_owners, n_repos) of every candidate value, over the whole corpus."""
    absent = F.lit("\u0000")
    held = candidates.select("value", F.coalesce("owner", absent).alias("owner"),
                             F.coalesce("repo", absent).alias("repo")).distinct()
    by_owner = held.groupBy("value", "owner").agg(F.count("*").alias("repos"))
    return by_owner.groupBy("value").agg(F.count("*").alias("n_owners"),
                                         F.sum("repos").alias("n_repos"))


def scan_secrets(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 owner: Column | None = None, repo: Column | None = None,
                 max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """One row per document: counts, ``base`` and ``added`` span arrays, and of all candidate values
    how many look live (``n_live``) and how many are widely copied (``n_copied``).

    A repository is counted within its owner. Default owner: ``source``, repository: its ``lang``.
    """
    owner = F.col("source") if owner is None else owner
    repo = F.col("lang") if repo is None else repo
    rows = stored(_scanned(documents, id_col, text_col, owner, repo)
                  .withColumn("row", F.monotonically_increasing_id()), "secrets")
    places = rows.where(F.size("candidates") > 0).select(
        "row", "owner", "repo", F.explode("candidates").alias("c")).select(
        "row", "owner", "repo", "c.*")
    counts = value_owners(places)
    judged = places.join(counts, "value").withColumn(
        "live", (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos))
    free = F.col("new") & F.col("live")
    span = F.struct("start", F.lit(len(KINDS)).alias("kind_order"), "stop",
                    F.lit("owned").alias("kind"))
    added = stored(judged.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(free, span))).alias("added"),
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_copied")),
        "secrets-added")
    empty = F.array().cast("array<struct<start:int,kind_order:int,stop:int,kind:string>>")
    return rows.drop("candidates", "owner", "repo").join(added, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base", F.coalesce("added", empty).alias("added"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).alias("n_copied"))


def secret_report(documents: DataFrame, **options) -> DataFrame:
    """The contract's row per document."""
    return scan_secrets(documents, **options).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(span_text(F.col("base")), 256)
        .alias("base_sha256"), span_text(F.concat("base", "added")).alias("spans"),
        "n_live", "n_copied")
