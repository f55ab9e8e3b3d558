"""Warehouse scans (S3): column-pruned reads of published tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def table_path(root: str, name: str) -> str:
    return f"{str(root).rstrip('/')}/{name}"


def is_missing(exc: AnalysisException) -> bool:
    """Whether a read failed because nothing is at the path."""
    return exc.getCondition() == "PATH_NOT_FOUND"


def read_table(spark: SparkSession, root: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Parquet table under ``root``; selecting columns prunes the scan."""
    df = spark.read.parquet(table_path(root, name))
    return df.select(*columns) if columns else df


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              columns: list[str] | None = None, partition: tuple[str, int, int, int] | None = None) -> DataFrame:
    """Same scan against an external database through the JDBC source.

    ``partition`` is (numeric column, lowest, highest value, number of parts):
    that many tasks then read ranges of the column side by side.  Without it
    one task reads the whole table.
    """
    split = {}
    if partition:
        column, low, high, parts = partition
        split = {"column": column, "lowerBound": low, "upperBound": high, "numPartitions": parts}
    df = spark.read.jdbc(url, table, properties=properties or {}, **split)
    return df.select(*columns) if columns else df
