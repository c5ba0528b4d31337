"""Title search over a posting table of short character sequences (grams).

``build`` stores two tables in a folder that all executors reach:

- ``postings`` (gram, block, places): the items of a block of ``BLOCK`` neighbouring ids whose
  lower-case title holds the gram, as an ascending array of places in the block. Grams have one, two or
  three characters. Rows are sorted by gram, so a search reads the row groups of its own grams only;
  a gram of every title is many rows of at most ``BLOCK`` places, over many tasks.
- ``titles`` (item_id, title, wide): one row per item, a partition folder per ``WIDE`` ids.

A text of three characters and more is found through its trigrams: the posting arrays of a block that
holds all of them are intersected, and the title of each item left is compared as a whole. A shorter text is
a gram itself. An empty text is in every title.

Cases: a null title is never found, a null text finds nothing; repeated item rows come once per row; an
empty table gives an empty index; other columns are not kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

BLOCK = 1 << 14
WIDE = 1 << 22
GRAM = 3


@dataclass(frozen=True)
class TitleIndex:
    postings: DataFrame
    titles: DataFrame


def _pieces(text: Column, n: int) -> Column:
    """All runs of ``n`` characters."""
    return F.when(F.length(text) >= n, F.transform(
        F.sequence(F.lit(1), F.length(text) - (n - 1)),
        lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def grams(title: Column) -> Column:
    """The distinct grams of one to three characters."""
    return F.array_distinct(F.concat(*[_pieces(title, n) for n in range(1, GRAM + 1)]))


def needed(text: Column) -> Column:
    """The grams that every title with ``text`` in it holds."""
    return F.when(F.length(text) >= GRAM, F.array_distinct(_pieces(text, GRAM))).otherwise(F.array(text))


def build(items: DataFrame, folder: str) -> TitleIndex:
    """Store the index of ``items`` (item_id, title) below ``folder`` and open it."""
    block = F.floor(F.col("item_id") / BLOCK).cast("bigint")
    rows = items.where(F.col("title").isNotNull() & F.col("item_id").isNotNull()).select(
        block.alias("block"), "item_id", "title", F.floor(F.col("item_id") / WIDE).cast("bigint").alias("wide"))
    rows.repartition("wide", "block").select("item_id", "title", "wide").write.partitionBy("wide").parquet(f"{folder}/titles")
    held = rows.select("block", (F.col("item_id") - F.col("block") * BLOCK).cast("int").alias("place"),
                       F.explode(F.concat(grams(F.lower("title")), F.array(F.lit("")))).alias("gram"))
    # A block's ids are at most BLOCK, and so is the set.
    held.groupBy("gram", "block").agg(F.array_sort(F.collect_set("place")).alias("places")) \
        .repartitionByRange("gram", "block").sortWithinPartitions("gram", "block") \
        .write.parquet(f"{folder}/postings")
    return open_index(items.sparkSession, folder)


def open_index(spark, folder: str) -> TitleIndex:
    return TitleIndex(
        spark.read.schema("gram string, block bigint, places array<int>").parquet(f"{folder}/postings"),
        spark.read.schema("item_id bigint, title string, wide bigint")
        .parquet(f"{folder}/titles"))


def _in_all(met: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, item_id, wide) of the items that all ``n`` grams of a text hold.

    met: keys, block, places, n; one row per block and gram, so at most the text's grams are gathered.
    """
    lists = met.groupBy(*keys, "block").agg(
        F.collect_list("places").alias("lists"), F.first("n").alias("n")).where(F.size("lists") == F.col("n"))
    both = F.reduce(F.slice("lists", 2, F.size("lists")), F.get("lists", F.lit(0)), F.array_intersect)
    return lists.select(*keys, "block", F.explode(both).alias("place")).select(
        *keys, (F.col("block") * BLOCK + F.col("place")).alias("item_id"),
        F.floor((F.col("block") * BLOCK) / WIDE).cast("bigint").alias("wide"))


def search(index: TitleIndex, text: str | None) -> DataFrame:
    """(item_id, title) of all items whose title contains the text, ignoring case."""
    small = F.lower(F.lit(text).cast("string"))
    # The grams of the text, as literals, reach the scan of the postings.
    own = index.postings.sparkSession.range(1).select(needed(small)).first()[0] or []
    own = [g for g in own if g is not None]
    met = index.postings.where(F.col("gram").isin(own)).withColumn("n", F.lit(len(own)))
    return _in_all(met, []).join(index.titles, ["wide", "item_id"]).where(
        F.contains(F.lower("title"), small)).select("item_id", "title")


def search_all(index: TitleIndex, texts: DataFrame, scored: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most popular items of every text; texts: query, text.

    Returns (query, rank, item_id, popularity_score). Ranked as reported: nine digits, ties by item id.
    """
    texts = texts.where(F.col("text").isNotNull()).select("query", F.lower("text").alias("text"))
    met = texts.select("query", needed(F.col("text")).alias("grams")).select(
        "query", F.size("grams").alias("n"), F.explode("grams").alias("gram")).join(index.postings, "gram")
    found = _in_all(met, ["query"]).join(index.titles, ["wide", "item_id"]).join(texts, "query").where(
        F.contains(F.lower("title"), F.col("text"))).select("query", "item_id")
    score = F.round("popularity_score", 9)
    best = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "item_id"))
    return found.join(scored.select("item_id", score.alias("score")), "item_id").select(
        "query", best.alias("rank"), "item_id", F.col("score").alias("popularity_score")) \
        .where(F.col("rank") <= n)
