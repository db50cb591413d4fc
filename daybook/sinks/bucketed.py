"""Bucketed catalog tables from the contracts: ``PARTITIONED BY`` a day, ``CLUSTERED BY``
the key ``INTO n BUCKETS``, sorted by it, with NOT NULL enforced as rows are written.

A join or an aggregate on the key of two tables of as many buckets deals nothing, a key
look-up reads one bucket, and a day's rows are one folder. The declarations below are
the warehouse's: which columns are never NULL, the key, the day that partitions."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.sources import contracts as K
from daybook.sources.contracts import conform


@dataclass(frozen=True)
class TableSpec:
    contract: T.StructType
    key: str
    not_null: tuple[str, ...]
    partition: str | None = None


DIM_PRODUCTS = TableSpec(K.DIM_PRODUCTS, "product_id", ("product_id", "product_name", "effective_date", "is_active"))
DIM_COMMENTS = TableSpec(K.DIM_COMMENTS, "comment_id",
                         ("comment_id", "product_id", "comment_content", "comment_rating", "effective_date", "is_active"))
FACT_PRODUCTS = TableSpec(K.FACT_PRODUCTS, "product_id", ("product_id", "snapshot_date"), "snapshot_date")
#: Reviews lie by their product, so that they meet the product dimension without a shuffle.
FACT_COMMENTS = TableSpec(K.FACT_COMMENTS, "product_id", ("comment_id", "product_id", "snapshot_date"), "snapshot_date")

#: Bytes of a bucket that a task reads well.
BUCKET_BYTES = 256 << 20


def buckets_for(total_bytes: int, least: int = 1) -> int:
    """How many buckets hold about ``BUCKET_BYTES`` each, as a power of two: tables of
    different sizes then have buckets that are multiples of each other."""
    return 2 ** max(0, math.ceil(math.log2(max(total_bytes / BUCKET_BYTES, least, 1))))


def _name(text: str) -> str:
    if not re.fullmatch(r"\w+(\.\w+)*", text):
        raise ValueError(f"{text!r} is no table name")
    return ".".join(f"`{part}`" for part in text.split("."))


def ddl(name: str, spec: TableSpec, buckets: int, location: str | None = None) -> str:
    """The ``CREATE TABLE`` of a contract. Data source tables cannot declare NOT NULL
    on a Parquet file in a way that a write obeys: ``required`` does it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.contract.fields)
    parts = f" PARTITIONED BY (`{spec.partition}`)" if spec.partition else ""
    at = f" LOCATION '{location}'" if location else ""
    return (f"CREATE TABLE {_name(name)} ({columns}) USING parquet{parts} "
            f"CLUSTERED BY (`{spec.key}`) SORTED BY (`{spec.key}`) INTO {buckets} BUCKETS{at}")


def required(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df`` under the contract; evaluating a NULL of a NOT NULL column is an error that
    names the column, so a write of it fails and commits nothing."""

    def kept(f: T.StructField) -> Column:
        if f.name not in spec.not_null:
            return F.col(f.name)
        return (F.when(F.col(f.name).isNull(), F.raise_error(F.lit(f"NULL in NOT NULL column {f.name}")).cast(f.dataType))
                .otherwise(F.col(f.name)).alias(f.name))

    return conform(df, spec.contract).select(*(kept(f) for f in spec.contract.fields))


def create(spark: SparkSession, name: str, spec: TableSpec, buckets: int, location: str | None = None) -> None:
    spark.sql(ddl(name, spec, buckets, location))


def append(df: DataFrame, name: str, spec: TableSpec, buckets: int) -> None:
    """Append rows. They are dealt by the key as the buckets are, so each task writes one
    file a bucket (and day) and the table has no more files than that. A bucket that
    a hot key makes large is still one file: that is what buckets are."""
    rows = required(df, spec).repartition(buckets, spec.key)
    order = [c for c in (spec.partition, spec.key) if c]
    # Partition columns go last in an INSERT.
    columns = [f.name for f in spec.contract.fields if f.name != spec.partition] + ([spec.partition] if spec.partition else [])
    rows.sortWithinPartitions(*order).select(*columns).write.insertInto(name)
