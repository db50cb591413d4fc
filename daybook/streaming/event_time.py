"""Event-time streams into the dimensions.

A day's documents may fall into several micro-batches. Which row of a (key, day)
survives must not depend on that, so survivors are chosen by a stateful aggregate over
day windows and leave it, in append mode, once the watermark says that the day
is over: when a document of a later day (less ``lateness``) has been seen. The state
holds a row for each key of the days that are still open. A ``heartbeat``, a document
without an id, closes the days before it when nothing later has landed yet; staging
drops it.

Files whose column types drift cannot be one file stream. Each landed run leaves a
manifest (its folder); ``conform_landing`` streams the manifests, reads each folder with
the schema its own files carry and writes the rows under the contract, which is what the
event-time stream reads."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators import clean as C
from daybook.operators import scd2 as S
from daybook.operators import staging as ST
from daybook.sinks.tables import Scd2Store
from daybook.sources import contracts as K
from daybook.sources.readers import read_landed


@dataclass(frozen=True)
class Entity:
    raw: T.StructType
    clean: Callable[[DataFrame], DataFrame]
    stage: Callable[[DataFrame], DataFrame]
    #: Survivor of a (key, day): the greatest by these, in the order that the batch
    #: jobs compare; the remaining columns follow.
    order: Callable[[], list[Column]]
    #: Values of a heartbeat that cleaning does not drop.
    heartbeat: dict


PRODUCTS = Entity(K.RAW_PRODUCTS, C.product_rows, ST.stage_products, list, {"name": "heartbeat"})
COMMENTS = Entity(
    K.RAW_COMMENTS, lambda raw: C.clean_comments(raw, None), ST.stage_comments,
    lambda: [F.col("created_at"), F.col("product_id").cast("string"), F.col("sentiment"), F.col("content"), F.col("rating"),
             F.col("purchased_at"), F.col("days_to_review"), F.col("rating_valid")],
    {"product_id": 0, "rating": 0})


def survivors(rows: DataFrame, order: list[Column], lateness: str, key: str = "id", day: str = "date") -> DataFrame:
    """One row for each (key, day), the greatest by ``order`` and then by its other
    columns; of a stream, emitted when the day is over."""
    rest = [c for c in rows.columns if c not in (key, day)]
    timed = (rows.where(F.col(day).isNotNull()).withColumn("_at", F.col(day).cast("timestamp"))
             .withWatermark("_at", lateness))
    best = F.max(F.struct(*(c.alias(f"_o{i}") for i, c in enumerate(order)), *rest)).alias("_row")
    found = timed.groupBy(key, F.window("_at", "1 day")).agg(best)
    return found.select(key, *(F.col(f"_row.{c}").alias(c) for c in rest),
                        F.col("window.start").cast("date").alias(day)).select(*rows.columns)


def _drain(stream, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    q = (stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _reader(spark: SparkSession, schema, max_files: int | None):
    reader = spark.readStream.schema(schema)
    return reader.option("maxFilesPerTrigger", max_files) if max_files else reader


def stream_into_dimension(spark: SparkSession, landing: str, dim: Scd2Store, checkpoint: str, entity: Entity,
                          mode: str = S.AS_WRITTEN, max_files: int | None = None, lateness: str = "0 days") -> None:
    """Merge the days that are over into ``dim``, then stop (one scheduled run). The same
    dimension comes out however many files a micro-batch takes. A replayed
    micro-batch changes nothing: its days are loaded."""

    def merge(batch: DataFrame, epoch_id: int) -> None:
        staged = entity.stage(batch).persist()  # a merge reads its keys, then its rows
        try:
            if not staged.isEmpty():
                dim.merge(staged, mode)
        finally:
            staged.unpersist()

    rows = entity.clean(_reader(spark, entity.raw, max_files).parquet(landing))
    _drain(survivors(rows, entity.order(), lateness), checkpoint, merge)


def heartbeat(spark: SparkSession, entity: Entity, day: str) -> DataFrame:
    """A document of ``day`` without an id: landed as any other, it closes the days
    before."""
    return spark.range(1).select(*(F.lit(day if f.name == "date" else entity.heartbeat.get(f.name)).cast(f.dataType).alias(f.name)
                                   for f in entity.raw.fields)).coalesce(1)


def land_run(df: DataFrame, root: str, run: str) -> None:
    """Land a run's documents with whatever types they have, and its manifest."""
    folder = f"{root}/runs/run_ts={run}"
    df.write.mode("overwrite").parquet(folder)
    manifest = df.sparkSession.createDataFrame([(folder, run)], "folder string, run string")
    manifest.coalesce(1).write.mode("append").json(f"{root}/manifests")


def conform_landing(spark: SparkSession, root: str, conformed: str, checkpoint: str, entity: Entity,
                    max_runs: int | None = None) -> None:
    """Rewrite the runs that have landed since under the contract. A micro-batch that is
    delivered again replaces its own folder."""

    def rewrite(batch: DataFrame, epoch_id: int) -> None:
        folders = [r["folder"] for r in batch.orderBy("run").collect()]  # one small row a run
        if folders:
            (read_landed(spark, folders, entity.raw).write.mode("overwrite")
             .option("partitionOverwriteMode", "static").parquet(f"{conformed}/epoch={epoch_id}"))

    _drain(_reader(spark, "folder string, run string", max_runs).json(f"{root}/manifests"), checkpoint, rewrite)
