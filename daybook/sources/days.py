"""Day tables: any set of days, however scattered, as a small table that prunes the
partitions of a large one while it runs (``dynamicpruning`` on its scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WANTED = "wanted"


def write_days(spark: SparkSession, path: str, days: list[str], status: str = WANTED) -> DataFrame:
    """The requested days as a stored table (day, status), a row a day."""
    rows = spark.createDataFrame([(d, status) for d in sorted(set(days))], "day string, status string")
    rows.select(F.col("day").cast("date").alias("day"), "status").coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema("day date, status string").parquet(path)


def of_days(rows: DataFrame, days: DataFrame, day_col: str = "date", status: str = WANTED) -> DataFrame:
    """Rows of the wanted days. A day table has a row a day, a few hundred KB for all days of
    a millennium, so it is broadcast; folders of other days are not opened."""
    wanted = days.where(F.col("status") == status).select(F.col("day").alias(day_col)).distinct()
    return rows.join(F.broadcast(wanted), day_col, "left_semi")
