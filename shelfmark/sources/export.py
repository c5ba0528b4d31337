"""Export of tables to Parquet with a manifest, and the processed feature matrix."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

_MANIFEST = ("table_name string, row_count bigint, column_count int, "
             "column_names array<string>, file string")


def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, partitions: int = 1) -> DataFrame:
    """A database table. With a partition column the scan is split into ranges of it."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if partition_column is not None:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
            numPartitions=str(partitions))
    return reader.load()


def export_table(name: str, df: DataFrame, root: str) -> dict:
    """Write one table and describe it. The row count is read from the Parquet footers."""
    path = f"{root}/{name}.parquet"
    df.write.mode("overwrite").parquet(path)
    rows = df.sparkSession.read.parquet(path).count()
    return {"table_name": name, "row_count": rows, "column_count": len(df.columns),
            "column_names": df.columns, "file": path}


def export_all(tables: Mapping[str, DataFrame], root: str) -> DataFrame:
    """Export every table and write the manifest as JSON next to them."""
    entries = [export_table(name, df, root) for name, df in tables.items()]
    spark = next(iter(tables.values())).sparkSession
    manifest = spark.createDataFrame([tuple(e.values()) for e in entries], _MANIFEST)
    manifest.coalesce(1).write.mode("overwrite").json(f"{root}/_manifest_json")
    return read_manifest(spark, root)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).json(f"{root}/_manifest_json")


def write_matrix(matrix: DataFrame, path: str) -> DataFrame:
    """Store the scored feature matrix and return it as read back."""
    matrix.write.mode("overwrite").parquet(path)
    return matrix.sparkSession.read.schema(matrix.schema).parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str = "item_id", buckets: int = 64) -> DataFrame:
    """Save as a table of the session catalog, bucketed and sorted by ``key``, and open it.

    Tables with the same key and number of buckets are joined and grouped by the key without a shuffle.
    Rows are brought together first, so a bucket is one file and not one file per task; a file holds
    1 / ``buckets`` of the table, so the number has to follow its size.
    """
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key) \
        .saveAsTable(table)
    return df.sparkSession.table(table)


def precomputed_items(vectors: DataFrame, scored: DataFrame) -> DataFrame:
    """Precomputed embeddings with scores and the literal defaults of a reduced item table."""
    return vectors.select("item_id", "embedding").join(
        scored.select("item_id", "title", "popularity_score", "data_confidence_score"),
        "item_id").withColumns({
            "richness_score": F.lit(1.0), "release_year": F.lit(0),
            "tags": F.array().cast("array<string>"), "platforms": F.array().cast("array<string>"),
            "category_id": F.lit(""), "cover_url": F.lit("")})
