"""Access to the parquet tables of a data folder, with column pruning left to Catalyst."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """One parquet table of ``data_dir`` (``<data_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")
