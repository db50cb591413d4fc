"""Top-k rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, groups: list[str], order: list[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group by ``order`` (make the order total
    for a deterministic result). ``row_number() <= k`` lets Spark insert a
    partial WindowGroupLimit before the shuffle: each task keeps only its
    own top ``k`` per group, so a group holding most of the rows still
    ships at most ``k`` rows per task."""
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
