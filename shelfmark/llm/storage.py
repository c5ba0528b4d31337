"""Intermediate tables and files in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.session import run_folder, shuffles_dropped


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused folder below ``spark.checkpoint.dir``, or below that of the current scratch scope."""
    return run_folder(spark, name)


def stored(df: DataFrame, name: str, by: str | None = None, folder: str | None = None) -> DataFrame:
    """``df`` written as a table and read again: what follows starts from files, not from lineage.

    ``by``: the last column, of few values; each value gets a folder, so that a filter on it reads only that.
    ``folder``: an unused one, to keep the table longer than the current scratch scope.
    """
    folder = folder or new_folder(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    with shuffles_dropped(df.sparkSession):
        (writer.partitionBy(by) if by else writer).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
