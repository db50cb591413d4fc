"""Readers for the provided Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table. Column pruning and filter pushdown reach the Parquet
    reader because callers only ever select/filter on top of this scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
