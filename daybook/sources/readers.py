"""Readers that tolerate type drift between landed files."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daybook.sources.contracts import conform, empty


def read_landed(spark: SparkSession, paths: list[str], contract: T.StructType) -> DataFrame:
    """Read each landed folder with the schema its files carry, conform it
    to ``contract`` (try_cast, missing -> NULL) and append all of them.

    One scan per landed run: Parquet files whose column types differ cannot
    be read as one dataset, and forcing one schema on the reader fails on
    double vs long. Runs are few (one per day), the rows many."""
    frames = [conform(spark.read.parquet(p), contract) for p in paths]
    return reduce(lambda a, b: a.unionByName(b), frames)


def read_landed_days(spark: SparkSession, root: str, days: list[str], contract: T.StructType,
                     partition_col: str = "date") -> DataFrame:
    """The given ``<partition_col>=<day>`` folders of a landing folder, one
    scan for all days whose files have the same schema. Only the folders of
    these days are listed; their schemas are read at the same time. No day
    gives an empty table."""
    if not days:
        return empty(spark, contract)
    folders = [f"{root}/{partition_col}={d}" for d in days]
    with ThreadPoolExecutor(8) as pool:
        schemas = list(pool.map(lambda p: spark.read.parquet(p).schema, folders))
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, path in zip(schemas, folders):
        groups.setdefault(schema.simpleString(), (schema, []))[1].append(path)
    frames = []
    for schema, paths in groups.values():
        whole = T.StructType([f for f in schema.fields if f.name != partition_col]).add(partition_col, "string")
        frames.append(conform(spark.read.schema(whole).option("basePath", root).parquet(*paths), contract))
    return reduce(lambda a, b: a.unionByName(b), frames)
