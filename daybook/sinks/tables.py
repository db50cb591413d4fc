"""Writers: landing files, appends per run, partitioned appends and
overwrites, clustered layout, and the store of a dimension.

Overwriting a Parquet path that the same plan reads fails and can leave the
path empty. So each run of a dimension writes its changes into a folder of
its own, committed by a marker file created last: a failed or retried job
leaves the table as it was, and readers never see half a run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators import merge as M
from daybook.operators import reduce as R
from daybook.operators.scd2 import AS_WRITTEN, Scd2Spec
from daybook.session import small_tasks
from daybook.sources.contracts import conform, empty


def write_landing(df: DataFrame, root: str, entity: str, stamp: str) -> str:
    """One Parquet folder per run and entity, named by the run stamp;
    re-running the same stamp replaces it."""
    path = f"{root.rstrip('/')}/{entity}/run_ts={stamp}"
    df.write.mode("overwrite").parquet(path)
    return path


def land_ingested(ingested: DataFrame, path: str) -> DataFrame:
    """Write ingested documents (``sources.documents``) in one pass, rows and rejects in
    folders of their own, ``is_rejected=<bool>``; the written table."""
    out = ingested.withColumn("is_rejected", F.col("rejected").isNotNull())
    (out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("is_rejected").parquet(path))
    return ingested.sparkSession.read.schema(out.schema).parquet(path)


def rejects(landed: DataFrame) -> DataFrame:
    """What could not be read; the rows' folder is not scanned."""
    return landed.where(F.col("is_rejected")).select(*(c for c in landed.columns if c.startswith("rejected")))


def rows(landed: DataFrame) -> DataFrame:
    return landed.where(~F.col("is_rejected")).select(
        *(c for c in landed.columns if not c.startswith(("rejected", "is_rejected"))))


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV; text is quoted (RFC 4180 doubled quotes) and written
    as-is, so embedded newlines and edge whitespace survive a round trip.
    An empty string and NULL both read back as NULL (as with pandas)."""
    (df.write.mode("overwrite").option("header", True).option("quote", '"')
       .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False).csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV whose quoted fields may hold newlines (multiLine)."""
    return (spark.read.option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').schema(schema).csv(path))


def append_partitioned(df: DataFrame, path: str, partition_col: str = "date") -> None:
    """Append one run's rows under ``partition_col=<day>`` folders; a later
    reader filtering on the day prunes to that folder."""
    df.write.mode("append").partitionBy(partition_col).parquet(path)


def append_run(df: DataFrame, path: str, run: str, partition_col: str = "date") -> None:
    """Append one run's rows under ``run_ts=<run>/<partition_col>=<day>``. A
    re-run of the same ``run`` replaces what it wrote and nothing else: other
    runs' rows of the same day, or without a day, stay. ``run`` is part of a
    path, so it must not hold ``/``, ``:`` or glob characters."""
    if not re.fullmatch(r"[\w.+-]+", run):
        raise ValueError(f"run name {run!r} cannot be a folder name")
    (df.write.mode("overwrite").option("partitionOverwriteMode", "static")
       .partitionBy(partition_col).parquet(f"{path}/run_ts={run}"))


def overwrite_partitions(df: DataFrame, path: str, partition_col: str) -> None:
    """Replace only the partitions present in ``df`` (dynamic overwrite);
    every other partition under ``path`` is kept."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col).parquet(path))


def clustered(df: DataFrame, partition_col: str, cluster_col: str,
              tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """Partition + cluster layout for a write partitioned by ``partition_col``.

    ``REBALANCE`` on the partition column lets AQE size the write tasks from
    the shuffle statistics: a large day is split over several tasks (a hot
    product inside it too, since splits follow size, not key), small days are
    coalesced, and unlike range partitioning no extra sampling pass over
    the input is needed. Within each file rows are sorted by (day, cluster
    key, tie-break) for tight Parquet min/max statistics on the key."""
    cols = [partition_col, cluster_col, *[c for c in tiebreak if c not in (partition_col, cluster_col)]]
    return df.hint("rebalance", partition_col).sortWithinPartitions(*cols)


def write_clustered(df: DataFrame, path: str, partition_col: str, cluster_col: str,
                    mode: str = "overwrite", tiebreak: tuple[str, ...] = ()) -> None:
    (clustered(df, partition_col, cluster_col, tiebreak).write.mode(mode)
       .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path))


# ------------------------------------------------------------ dimension store

def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


class Scd2Store:
    """Storage for a type-2 dimension whose runs write only what they change.

    Each run writes one folder ``v=<n>`` in one job: ``state=open`` and ``state=ended``
    hold the versions it inserted, in full and with a digest of each tracked column;
    ``state=closing`` the key, date and end of each older version it ended.
    ``v=<n>/_COMMITTED`` is created last and never overwritten, so a crashed run
    is invisible, its retry overwrites its folder, and a writer that comes late fails;
    nothing else is ever rewritten, moved or deleted. One pipeline writes a table: two
    that write at the very same time are not kept apart. The marker holds the dimension's greatest
    effective date, which the gate of the next run needs.

    ``log`` is what a merge reads: key, date and digests; of it a merge deals only the
    rows whose key the batch may hold. ``read`` gives the table: inserted versions with the
    end that a later run gave them (a join on key and date)."""

    MARKER = "_COMMITTED"

    def __init__(self, spark: SparkSession, root: str, contract: T.StructType, spec: Scd2Spec,
                 cluster_col: str | None = None):
        self.spark, self.root, self.contract, self.spec, self.key = spark, root.rstrip("/"), contract, spec, spec.key
        self.sort_cols = list(dict.fromkeys([cluster_col or self.key, self.key]))
        self._schema = T.StructType(contract.fields + [
            T.StructField(M.DIGESTS, M.DIGESTS_TYPE),
            T.StructField("v", T.IntegerType()), T.StructField("state", T.StringType())])

    def _versions(self) -> list[int]:
        fs, p = _fs(self.spark, self.root)
        if not fs.exists(p):
            return []
        out = [int(m.group(1)) for st in fs.listStatus(p)
               if st.isDirectory() and (m := re.fullmatch(r"v=(\d+)", st.getPath().getName()))]
        return sorted(out)

    def _path(self, v: int) -> str:
        return f"{self.root}/v={v}"

    def _committed(self, v: int) -> bool:
        fs, p = _fs(self.spark, f"{self._path(v)}/{self.MARKER}")
        return bool(fs.exists(p))

    def current_version(self) -> int | None:
        for v in reversed(self._versions()):
            if self._committed(v):
                return v
        return None

    def high_water(self) -> str | None:
        """The greatest effective date, as text, from the newest marker."""
        v = self.current_version()
        if v is None:
            return None
        fs, p = _fs(self.spark, f"{self._path(v)}/{self.MARKER}")
        stream = fs.open(p)
        try:
            return stream.readLine() or None
        finally:
            stream.close()

    def _states(self, *states: str, version: int | None = None) -> DataFrame:
        v = self.current_version() if version is None else version
        if not v:
            return empty(self.spark, self._schema)
        df = self.spark.read.schema(self._schema).parquet(self.root)
        return df.where((F.col("v") <= v) & F.col("state").isin(*states))

    def log(self) -> DataFrame:
        """(key, effective_date, digests, kind): the open versions and the closings."""
        return self._states(M.OPEN, M.CLOSING).select(self.key, "effective_date", M.DIGESTS, F.col("state").alias("kind"))

    def _closings(self) -> DataFrame:
        return self._states(M.CLOSING).select(self.key, "effective_date", F.col("end_date").alias("closed_on"))

    def inserted(self, version: int | None = None) -> DataFrame:
        """Every version as it was inserted, without the ends that came later: as many rows
        as ``read``, and no join. ``version``: as of that run (0: before any), the newest if None."""
        return conform(self._states(M.OPEN, M.ENDED, version=version), self.contract)

    def read_open(self, partners: DataFrame | None = None) -> DataFrame:
        """The active versions; with ``partners``, at least those whose key is in its column
        of the same name (others are left out before the join where that is sure)."""
        opened, closings = conform(self._states(M.OPEN), self.contract), self._closings()
        if partners is not None:
            words = R.key_words(partners, self.key)
            opened, closings = R.may_match(opened, self.key, words), R.may_match(closings, self.key, words)
        return (opened.join(closings, [self.key, "effective_date"], "left_anti").select(*self.contract.fieldNames()))

    def active(self, partners: DataFrame, version: int | None = None) -> DataFrame:
        """Key, effective_date, end_date and is_active of the active versions (``version``: see
        ``inserted``), at least of those whose key is in the column of the same name of
        ``partners``: the log is read once and others are left out before it is dealt."""
        log = self._states(M.OPEN, M.CLOSING, version=version).select(self.key, "effective_date", "state")
        # An aggregate, not an anti join: Spark moves that below the bitmap, and the whole log would be dealt.
        # Dealt by key, as the semi join that follows needs it.
        state = (R.may_match(log, self.key, R.key_words(partners, self.key)).repartition(self.key)
                 .groupBy(self.key, "effective_date").agg(F.bool_or(F.col("state") == M.CLOSING).alias("_closed")))
        return state.where(~F.col("_closed")).select(
            self.key, "effective_date", F.lit(None).cast("date").alias("end_date"), F.lit(True).alias("is_active"))

    def read(self) -> DataFrame:
        once_open = conform(self._states(M.OPEN), self.contract).join(self._closings(), [self.key, "effective_date"], "left")
        end = F.coalesce("closed_on", "end_date")
        return (once_open.withColumns({"end_date": end, "is_active": end.isNull()}).select(*self.contract.fieldNames())
                .unionByName(conform(self._states(M.ENDED), self.contract)))

    def merge(self, batch: DataFrame, mode: str = AS_WRITTEN, keys: DataFrame | None = None) -> int:
        """Merge staged rows of one load date or several, see ``merge_changes``. ``keys``
        holds every key of the batch (others too), if that is cheaper to read than the batch."""
        mark, log = self.high_water(), self.log()
        if mark:
            # Versions of other keys neither end nor hide a row of the batch.
            taken = keys if keys is not None else batch.where(F.col("load_date") >= F.lit(mark).cast("date"))
            log = R.may_match(log, self.key, R.key_words(taken, self.key))
        return self._write(M.merge_changes(log, batch, self.spec, mode,
                                           high_water=F.lit(mark).cast("date") if mark else None), mark)

    def _write(self, changes: DataFrame, mark: str | None) -> int:
        v = (self.current_version() or 0) + 1
        active = F.when(F.col("kind") != M.CLOSING, F.col("kind") == M.OPEN)
        rows = conform(changes.withColumn("is_active", active), T.StructType(
            self.contract.fields + [T.StructField(M.DIGESTS, M.DIGESTS_TYPE), T.StructField("kind", T.StringType())]))
        rows = rows.withColumn(M.DIGESTS, F.when(F.col("kind") == M.OPEN, F.col(M.DIGESTS))).withColumnRenamed("kind", "state")
        out = (rows.hint("rebalance", "state")
                   .sortWithinPartitions("state", "effective_date", *self.sort_cols))
        if self._committed(v):
            raise FileExistsError(f"{self._path(v)} is committed: another writer was faster")
        # Static overwrite: a retry clears everything a crashed attempt left.
        with small_tasks(out.sparkSession):
            (out.write.mode("overwrite").option("partitionOverwriteMode", "static")
                .partitionBy("state").parquet(self._path(v)))
        inserted = self.spark.read.schema(self._schema).parquet(self._path(v)).where(F.col("state") != M.CLOSING)
        newest = inserted.agg(F.max("effective_date").cast("string")).first()[0]
        fs, p = _fs(self.spark, f"{self._path(v)}/{self.MARKER}")
        stream = fs.create(p, False)
        stream.writeBytes(max(filter(None, [mark, newest]), default=""))
        stream.close()
        return v
