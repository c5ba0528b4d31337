"""Diagnostics tables on disk and timestamped CSV snapshots of them."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfmark.operators import diagnostics as dg
from shelfmark.schemas import DIAGNOSTIC_DEFAULTS, DIAGNOSTIC_KEYS, DIAGNOSTICS

_SUMMARY = ("table_name string, row_count bigint, column_names array<string>, path string, "
            "error string")

# Quotes are doubled, as other CSV readers expect. An empty string is written as a quoted empty
# field and a null as nothing; reading keeps them apart by a null marker that is never written.
_CSV = {"header": True, "escape": '"'}
_CSV_READ = {**_CSV, "multiLine": True, "nullValue": "\0"}


def ensure_schema(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the target database of ``save_table`` writes if it is missing."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{database}`{place}")


def save_table(name: str, df: DataFrame, database: str) -> None:
    """Overwrite a diagnostics table of the session catalog."""
    conform(name, df).write.mode("overwrite").saveAsTable(f"`{database}`.`{name}`")


def drop_schema(spark: SparkSession, database: str) -> None:
    """Remove a database with its tables."""
    spark.sql(f"DROP SCHEMA IF EXISTS `{database}` CASCADE")


def conform(name: str, df: DataFrame) -> DataFrame:
    """Rows of a diagnostics table with its declared types; defaults replace nulls."""
    defaults = DIAGNOSTIC_DEFAULTS.get(name, {})
    columns = []
    for field in DIAGNOSTICS[name].fields:
        value = F.col(field.name).cast(field.dataType)
        if field.name in defaults:
            value = F.coalesce(value, F.lit(defaults[field.name]).cast(field.dataType))
        elif isinstance(field.dataType, T.ArrayType):
            value = F.coalesce(value, F.array().cast(field.dataType))
        columns.append(value.alias(field.name))
    return df.select(*columns)


def write_diagnostics(name: str, df: DataFrame, root: str) -> DataFrame:
    """Replace one diagnostics table; a repeated or missing key is an error."""
    spark, path = df.sparkSession, f"{root}/{name}"
    conform(name, df).write.mode("overwrite").parquet(path)
    stored = spark.read.schema(DIAGNOSTICS[name]).parquet(path)
    key = DIAGNOSTIC_KEYS.get(name)
    if key is not None:
        bad = stored.groupBy(key).agg(F.count("*").alias("n")).where(
            (F.col("n") > 1) | F.col(key).isNull()).limit(1).collect()
        if bad:
            raise ValueError(f"{name}: key {key}={bad[0][key]!r} is missing or repeated")
    return stored


def flatten(df: DataFrame) -> DataFrame:
    """Array columns as comma-separated text, as a CSV file needs."""
    return df.select(*[
        F.array_join(f.name, ",").alias(f.name) if isinstance(f.dataType, T.ArrayType)
        else F.col(f.name) for f in df.schema.fields])


def _csv_schema(name: str) -> T.StructType:
    return T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.ArrayType)
                      else f.dataType) for f in DIAGNOSTICS[name].fields])


def take_snapshot(spark: SparkSession, diagnostics_root: str, snapshot_root: str,
                  snapshot_id: str | None = None) -> DataFrame:
    """Copy the diagnostics tables to CSV below ``<table>/snapshot_id=<id>``.

    Returns (and stores as JSON) a summary row per table. A table that cannot be read gives
    zero rows and the error, and does not stop the others.
    """
    snapshot_id = snapshot_id or datetime.now().strftime("%Y-%m-%d_%H-%M-%S")
    summary = []
    for name in DIAGNOSTICS:
        path = f"{snapshot_root}/{name}/snapshot_id={snapshot_id}"
        try:
            table = spark.read.parquet(f"{diagnostics_root}/{name}")
            flatten(table).write.mode("overwrite").options(**_CSV).csv(path)
            summary.append((name, table.count(), table.columns, path, None))
        except AnalysisException as error:
            summary.append((name, 0, None, None, error.getCondition() or str(error)))
    rows = spark.createDataFrame(summary, _SUMMARY)
    rows.coalesce(1).write.mode("overwrite").json(
        f"{snapshot_root}/summary/snapshot_id={snapshot_id}")
    return spark.read.schema(_SUMMARY).json(f"{snapshot_root}/summary/snapshot_id={snapshot_id}")


def read_snapshot(spark: SparkSession, snapshot_root: str, name: str,
                  snapshot_id: str) -> DataFrame | None:
    """One table of a snapshot, or None when the snapshot does not hold it."""
    path = f"{snapshot_root}/{name}/snapshot_id={snapshot_id}"
    try:
        return spark.read.schema(_csv_schema(name)).options(**_CSV_READ).csv(path)
    except AnalysisException:
        return None


def snapshot_ids(spark: SparkSession, snapshot_root: str) -> list[str]:
    """All snapshot ids in name order, from the partition folders of the summary."""
    found = spark.read.schema(_SUMMARY + ", snapshot_id string").json(f"{snapshot_root}/summary")
    return sorted(r["snapshot_id"] for r in found.select("snapshot_id").distinct().collect())


def diff_latest(spark: SparkSession, snapshot_root: str) -> DataFrame:
    """Compare the last two snapshots by name order."""
    ids = snapshot_ids(spark, snapshot_root)
    if len(ids) < 2:
        raise ValueError("two snapshots are needed")
    prev, curr = ids[-2:]

    def table(name: str, snapshot_id: str) -> DataFrame | None:
        return read_snapshot(spark, snapshot_root, name, snapshot_id)

    return dg.snapshot_diff(
        table("quality_gaps", prev), table("quality_gaps", curr),
        table("low_confidence_priorities", prev), table("low_confidence_priorities", curr))


def table_summary(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a database with their exact row counts."""
    rows = [(t.name, spark.table(f"`{database}`.`{t.name}`").count())
            for t in spark.catalog.listTables(database) if not t.isTemporary]
    return spark.createDataFrame(rows, "table_name string, row_count bigint")
