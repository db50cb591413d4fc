"""Session construction and shared-folder helpers.

Everything time-related in the library assumes the session zone is UTC:
epoch seconds become timestamps and day boundaries are cut in that zone.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Options every session of the library needs, whatever the cluster size.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dimension and fact writes replace only the partitions they touch.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}

# The most that a task reads (scan split, shuffle partition) in a job that sorts or
# aggregates whole tasks; a session's smaller figures stay, see ``small_tasks``.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": 16 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
}
_lock = threading.Lock()
_inside: dict[int, tuple[int, dict[str, str]]] = {}  # session: jobs inside, options before


def build_session(master: str | None = None, app: str = "daybook",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's required options.

    On a cluster leave ``master`` unset so spark-submit decides, and size
    ``shuffle_partitions`` to the data (about 128-256 MB per partition);
    AQE coalesces what is left over.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Pin the runtime options a session handed to us must have."""
    for k in ("spark.sql.session.timeZone",
              "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(k, BASE_CONF[k])


def _bytes(size: str) -> int:
    n, unit = re.fullmatch(r"(\d+)([kmgtp]?)(?:i?b)?", size.strip().lower()).groups()
    return int(n) << 10 * " kmgtp".index(unit or " ")


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside have tasks of at most ``TASK_BYTES``, so that what a task sorts in
    memory does not grow with the input: more tasks do. Session options hold for
    all threads; the last job to leave puts them back."""
    with _lock:
        jobs, before = _inside.get(id(spark), (0, {}))
        if not jobs:
            before = {k: now for k, most in TASK_BYTES.items() if _bytes(now := spark.conf.get(k)) > most}
            for k in before:
                spark.conf.set(k, str(TASK_BYTES[k]))
        _inside[id(spark)] = jobs + 1, before
    try:
        yield
    finally:
        with _lock:
            jobs, before = _inside.pop(id(spark))
            if jobs > 1:
                _inside[id(spark)] = jobs - 1, before
            else:
                for k, v in before.items():
                    spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it; only when it is unset (local runs, tests) do we pick
    a folder of our own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = jdir.get() if jdir.isDefined() else None
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="daybook-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # core conf locked at runtime: the context dir below suffices
            pass
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for written intermediate tables, placed in the
    shared checkpoint folder so every executor (and a retried task) sees it."""
    return f"{checkpoint_dir(spark)}/daybook-scratch/{name}-{uuid.uuid4().hex[:12]}"
