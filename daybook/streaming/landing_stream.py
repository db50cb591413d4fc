"""The landing folder as a stream: each run's new raw files are picked up
once (``Trigger.AvailableNow``) and merged into the dimension by
``foreachBatch``.

A micro-batch may hold several load days or part of one; ``scd2_merge``
handles both in one job. Replaying a micro-batch after a failure is a
no-op: the gate and the (key, date) anti join skip what the target already
holds, and the target only changes by committing a fully written run. Files must land in date order (the daily schedule does), since a
day older than the dimension's newest load is ignored by the gate, as in
the batch model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import clean as C
from daybook.operators import scd2 as S
from daybook.operators import staging as ST
from daybook.sinks.tables import Scd2Store
from daybook.sources import contracts as K


def products_micro_batch(dim: Scd2Store, mode: str):
    def run(batch: DataFrame, epoch_id: int) -> None:
        # One run's documents: clean per (id, day), stage, merge.
        clean = C.clean_products(batch, dedupe_keys=["id", "date"])
        stg = ST.stage_products(clean)
        dim.merge(stg, mode, keys=batch.select(F.col("id").cast("string").alias(dim.key)))
    return run


def stream_products_into_dimension(spark: SparkSession, landing: str, dim: Scd2Store,
                                   checkpoint: str, mode: str = S.AS_WRITTEN,
                                   max_files: int | None = None) -> None:
    """Process everything landed so far, then stop (one scheduled run)."""
    reader = spark.readStream.schema(K.RAW_PRODUCTS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    q = (reader.parquet(landing).writeStream
         .foreachBatch(products_micro_batch(dim, mode))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def land_days_in_order(raw: DataFrame, landing: str, files: int | None = None) -> list[str]:
    """Land raw documents one day at a time, oldest first, the way the daily
    crawl drops them (a ``date=<day>`` folder per run; ``files``: in so many files, else
    in as many as their size asks for). ``raw`` is read once for each day: give a stored table."""
    days = sorted(r[0] for r in raw.select("date").distinct().collect())
    for d in days:
        rows = raw.where(F.col("date") == d).drop("date")
        (rows.repartition(files) if files else rows.hint("rebalance")).write.mode("overwrite").parquet(f"{landing}/date={d}")
    return days
