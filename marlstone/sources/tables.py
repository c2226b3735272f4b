"""Reading lake tables by name or by path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table_or_path(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The catalog table, or the Parquet at ``path`` if it is missing or empty."""
    if spark.catalog.tableExists(table):
        df = spark.table(table)
        if not df.isEmpty():
            return df
    return spark.read.parquet(path)
