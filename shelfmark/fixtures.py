"""The catalog derived from the TPC-H-like test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.sources.catalog import Catalog

# Declared, so that opening a table starts no job.
BASE_SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, "
                "l_returnflag string, l_linestatus string",
    "events": "event_id bigint, user_id bigint, event_type string, value double",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def derive_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    def base(name: str) -> DataFrame:
        return spark.read.schema(BASE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")

    def items() -> DataFrame:
        key = F.col("p_partkey")
        return base("part").select(
            key.alias("item_id"),
            F.col("p_name").alias("title"),
            F.when(key % 23 != 0, (1990 + (key * 7) % 31).cast("int")).alias("release_year"),
            F.when(key % 5 == 3, F.col("p_type"))
            .when(key % 5 == 4, F.lit("UNKNOWN_CAT")).alias("category_id"),
            F.when(key % 4 == 0, F.lit(""))
            .when(key % 4 != 1, F.concat(F.lit("img/"), key.cast("string")))
            .alias("cover_url"),
            F.when(key % 3 == 0, "catalog").when(key % 3 == 1, "universe")
            .otherwise("finder").alias("source_type"),
            F.when(key % 11 == 0, "upcoming").otherwise("released").alias("release_state"))

    def item_tags() -> DataFrame:
        # Three tags per part row, so the union's DISTINCT is a per-row array_distinct.
        name = F.col("p_name")
        return base("part").where("p_partkey % 13 <> 0").select(
            F.col("p_partkey").alias("item_id"),
            F.explode(F.array_distinct(F.array(
                F.split_part(name, F.lit(" "), F.lit(1)),
                F.split_part(name, F.lit(" "), F.lit(2)),
                F.lower("p_type")))).alias("tag_id"))

    def tags() -> DataFrame:
        return item_tags().select("tag_id").where("tag_id <> 'rod'").distinct()

    def item_platforms() -> DataFrame:
        nations = base("supplier").join(
            base("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        ).select("s_suppkey", "n_name")
        return (base("lineitem")
                .join(nations, F.col("l_suppkey") == F.col("s_suppkey"))
                .select(F.col("l_partkey").alias("item_id"), F.col("n_name").alias("platform_id"))
                .distinct())

    def platforms() -> DataFrame:
        return base("nation").select(
            F.col("n_name").alias("platform_id"),
            F.concat(F.lit("platform "), F.lower("n_name")).alias("name"))

    def categories() -> DataFrame:
        return base("part").select("p_type").distinct().select(
            F.col("p_type").alias("category_id"),
            F.concat(F.lit("cat "), F.lower("p_type")).alias("name"))

    def signals() -> DataFrame:
        key = F.col("l_partkey")
        # Money and percentages are summed as integers: the sums are then exact.
        cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
        percent = F.round(F.col("l_discount") * 100).cast("bigint")

        def share(flag):
            return F.round(F.avg(F.when(flag, 1.0).otherwise(0.0)), 6)

        per_order = base("lineitem").where("l_partkey % 10 <> 7").groupBy(
            "l_partkey", "l_orderkey").agg(
            F.count("*").alias("n"), F.max("l_quantity").alias("max_quantity"),
            F.sum(percent).alias("discount"),
            F.count_if(F.col("l_returnflag") == "N").alias("n_open"),
            F.count_if(F.col("l_linestatus") == "F").alias("n_final"),
            F.max(cents).alias("max_cents"), F.sum(cents).alias("sum_cents"))
        # One row per (part, order) first: the distinct order count becomes a plain count and
        # a part that holds a large share of the rows is spread over its orders.
        rows = F.sum("n")
        return per_order.groupBy("l_partkey").agg(
            rows.alias("rows"), F.count("*").alias("orders"),
            F.max("max_quantity").alias("max_quantity"), F.sum("discount").alias("discount"),
            F.sum("n_open").alias("n_open"), F.sum("n_final").alias("n_final"),
            F.max("max_cents").alias("max_cents"), F.sum("sum_cents").alias("sum_cents"),
        ).select(
            key.alias("item_id"),
            F.when(key % 4 != 0, F.round(F.col("max_quantity") / 50, 6)).alias("best_critic_score"),
            F.when(key % 3 != 0, F.round(F.col("discount") / F.col("rows") / 10, 6))
            .alias("best_user_score"),
            F.col("rows").alias("critic_review_count"),
            F.when(key % 6 != 0, F.col("orders")).alias("user_review_count"),
            F.when(key % 7 != 0, F.round(F.col("n_open") / F.col("rows"), 6))
            .alias("critic_positive_ratio"),
            F.when(key % 8 != 0, F.round(F.col("n_final") / F.col("rows"), 6))
            .alias("user_positive_ratio"),
            (F.col("max_cents") / F.lit(100000000.0)).alias("max_sales_millions"),
            F.when(key % 9 != 0, F.col("sum_cents") / F.lit(100000000.0))
            .alias("total_sales_millions"),
            ((key * 37) % 101).cast("int").alias("data_confidence_score"),
            (key % 2 == 0).alias("has_external_id"), (key % 3 == 0).alias("has_company"),
            (key % 5 == 0).alias("has_age_rating"), (key % 7 < 4).alias("has_summary"),
            (key % 9 != 0).alias("has_sales"), (key % 11 < 2).alias("has_review_sentiment"))

    def dup_candidates() -> DataFrame:
        part = base("part").select("p_name", "p_brand", "p_partkey")
        repeated = part.groupBy("p_name", "p_brand").count().where("count > 1").drop("count")
        return part.join(repeated, ["p_name", "p_brand"], "left_semi").select(
            F.concat("p_name", F.lit("|"), "p_brand").alias("group_key"),
            F.col("p_partkey").alias("item_id"))

    def dup_groups() -> DataFrame:
        years = items().select("item_id", "release_year")
        # (group, year) first, so that the distinct years need no second pass over the rows.
        by_year = dup_candidates().join(years, "item_id").groupBy(
            "group_key", "release_year").agg(F.count("*").alias("n"))
        return by_year.groupBy("group_key").agg(
            F.sum("n").alias("candidate_count"),
            F.count("release_year").alias("known_year_count"),
        ).select(
            "group_key",
            F.when(F.col("known_year_count") > 1, "check_years").otherwise("merge")
            .alias("suggested_review"),
            F.when(F.col("candidate_count") % 3 == 0, "resolved").otherwise("needs_review")
            .alias("status"),
            "candidate_count", "known_year_count")

    def external_matches() -> DataFrame:
        value = F.col("value")
        return base("events").select(
            F.col("event_id").alias("match_id"),
            (F.col("event_id") % 2000).alias("item_id"),
            F.when(F.col("event_type").isin("view", "click"), "source_a")
            .otherwise("source_b").alias("source"),
            F.concat(F.lit("title "), F.col("event_id").cast("string")).alias("source_title"),
            F.least(F.lit(100), F.floor(value)).cast("int").alias("confidence_score"),
            F.when(value >= 70, "auto_approved").when(value >= 20, "needs_review")
            .otherwise("rejected").alias("status"),
            F.col("event_type").alias("matched_by"))

    def lines_of_users(flag: str) -> DataFrame:
        lines = base("lineitem").where(F.col("l_returnflag") == flag).select("l_orderkey", "l_partkey")
        return base("orders").select("o_orderkey", "o_custkey").join(
            lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
            F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")).distinct()

    def user_likes() -> DataFrame:
        # Every line says something: kept on order (liked), sent back (excluded), or neither.
        return lines_of_users("N")

    def users() -> DataFrame:
        return base("customer").select(F.col("c_custkey").alias("user_id"))

    def user_exclusions() -> DataFrame:
        # What a user sent back is not recommended to them again.
        return lines_of_users("R")

    def ab_units() -> DataFrame:
        # One unit per event user: mean value of two event types.
        return base("events").where("event_type in ('view', 'click')").groupBy("user_id").agg(
            F.avg(F.when(F.col("event_type") == "view", F.col("value"))).alias("metric_a"),
            F.avg(F.when(F.col("event_type") == "click", F.col("value"))).alias("metric_b"),
        ).where("metric_a is not null and metric_b is not null").withColumnRenamed(
            "user_id", "unit_id")

    def vectors() -> DataFrame:
        return base("embeddings").select(
            F.col("vec_id").alias("item_id"),
            F.col("embedding").cast("array<double>").alias("embedding"), "label")

    return Catalog({
        "items": items, "item_tags": item_tags, "tags": tags, "item_platforms": item_platforms,
        "platforms": platforms, "categories": categories, "signals": signals,
        "dup_candidates": dup_candidates, "dup_groups": dup_groups,
        "external_matches": external_matches, "user_likes": user_likes, "users": users,
        "user_exclusions": user_exclusions, "ab_units": ab_units, "vectors": vectors})
