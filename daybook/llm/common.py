"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import scratch_path

#: White space and words of the contracts: ASCII blanks only.
BLANKS = "[ \\t\\n\\x0B\\f\\r]+"
#: Rows and bytes of an Arrow batch.
ARROW_ROWS, ARROW_BYTES = 2000, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` evaluated once a row. Inside a lambda an outer
    expression is evaluated again for every element; a lambda variable is not."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with those of ``df`` (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


_scope: ContextVar[list[str] | None] = ContextVar("scratch tables", default=None)


@contextmanager
def scratch() -> Iterator[list[str]]:
    """The folders of the tables that are ``stored`` within."""
    outer, paths = _scope.get(), []
    token = _scope.set(paths)
    try:
        yield paths
    finally:
        _scope.reset(token)
        if outer is not None:
            outer += paths


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete these folders: nothing that is still to run reads them."""
    for path in paths:
        given = spark._jvm.org.apache.hadoop.fs.Path(path)
        given.getFileSystem(spark._jsc.hadoopConfiguration()).delete(given, True)
    paths.clear()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again: its
    lineage is cut, and a lost executor costs nothing that was finished. The folder
    stays until the cluster clears it, or ``remove`` does (see ``scratch``)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if (paths := _scope.get()) is not None:
        paths.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of bounded size: a batch is held in the JVM and again in the
    worker, and texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def in_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with batches of bounded size; ``function`` reads columns by place."""
    bounded_batches(df.sparkSession)
    if any("." in c for c in df.columns):  # mapInArrow takes such a name for a field
        df = df.toDF(*(f"column{i}" for i in range(len(df.columns))))
    return df.mapInArrow(function, schema)


def by_bytes(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """Slices of about ``most`` bytes of text, or of one longer text."""
    part = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    return (texts.slice(i, j - i) for i, j in zip(cuts, cuts[1:]) if j > i)


def partitions_for(rows: int, each: int, least: int) -> int:
    """Partitions that hold about ``each`` rows or bytes, ``least`` of them at least."""
    return max(least, math.ceil(rows / each))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start .. start + size - 1 of each pair, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
