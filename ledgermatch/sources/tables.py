"""Reading the given Parquet tables. Column pruning and filter pushdown are
left to Catalyst: callers select and filter on the returned DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
