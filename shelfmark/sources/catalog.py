"""The set of input tables, each a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.schemas import TABLES


class Catalog:
    """Named tables, opened on first use: ``catalog.items``, ``catalog["item_tags"]``."""

    def __init__(self, openers: dict[str, Callable[[], DataFrame]]):
        self._openers = openers
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._openers[name]()
        return self._open[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._openers:
            raise AttributeError(name)
        return self[name]

    @property
    def names(self) -> list[str]:
        return list(self._openers)

    def register_views(self, names: list[str] | None = None) -> None:
        """Temporary views for ad-hoc SQL."""
        for name in names or self.names:
            self[name].createOrReplaceTempView(name)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One exported table, with its declared schema when it has one."""
    reader = spark.read
    if name in TABLES:
        reader = reader.schema(TABLES[name])
    return reader.parquet(f"{root}/{name}.parquet")


def load_catalog(spark: SparkSession, root: str, names: list[str] | None = None) -> Catalog:
    """The catalog stored as one Parquet folder per table below ``root``."""
    return Catalog({
        name: (lambda n=name: read_table(spark, root, n)) for name in names or list(TABLES)})


def query(spark: SparkSession, sql: str) -> DataFrame:
    """Ad-hoc SQL over the registered views (or over ``parquet.`path` ``)."""
    return spark.sql(sql)
