"""The event-time stream: the same dimension however files fall into micro-batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daybook.operators import clean as C
from daybook.operators import scd2 as S
from daybook.operators import staging as ST
from daybook.session import scratch_path
from daybook.sinks.tables import Scd2Store
from daybook.sources import contracts as K
from daybook.streaming import event_time as EV

DAYS = ["2024-01-01", "2024-01-02", "2024-01-04"]


def reviews(seed):
    r = random.Random(seed)
    out = []
    for day in DAYS:
        noon = int(dt.datetime.fromisoformat(day).replace(tzinfo=dt.timezone.utc).timestamp()) + 43200
        for i in range(60):
            out.append((r.randint(1, 8), r.choice([1, 2, 10, None]), "Hài lòng", r.choice(["a", "b", "", None]), r.choice([1, 5, None]),
                        noon + r.randint(0, 2), noon, day))
    return out + out[:7]


def land(spark, rows, landing, cut):
    """Files that split days: ``cut`` rows each, in order."""
    for k in range(0, len(rows), cut):
        spark.createDataFrame(rows[k:k + cut], K.RAW_COMMENTS).coalesce(1).write.mode("append").parquet(landing)


@pytest.mark.parametrize("max_files", [1, 2, None])
def test_survivors_do_not_depend_on_micro_batches(spark, max_files):
    root = scratch_path(spark, "event-time")
    rows = sorted(reviews(4), key=lambda r: r[-1])
    landing, dim = f"{root}/landing", Scd2Store(spark, f"{root}/dim", K.DIM_COMMENTS, S.COMMENTS)
    land(spark, rows, landing, 37)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        EV.stream_into_dimension(spark, landing, dim, f"{root}/ckpt", EV.COMMENTS, max_files=max_files)
        open_day = [r for r in dim.read().collect() if str(r["effective_date"]) == DAYS[-1]]
        assert not open_day  # the last day may still get documents
        EV.heartbeat(spark, EV.COMMENTS, "2024-02-01").write.mode("append").parquet(landing)
        EV.stream_into_dimension(spark, landing, dim, f"{root}/ckpt", EV.COMMENTS, max_files=max_files)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    staged = ST.stage_comments(C.clean_comments(spark.createDataFrame(rows, K.RAW_COMMENTS), None))
    want = S.scd2_history(staged, S.COMMENTS)
    assert sorted(map(str, dim.read().collect())) == sorted(map(str, want.select(dim.read().columns).collect()))


def test_drifting_runs_are_conformed_once(spark):
    root = scratch_path(spark, "drift-test")
    base = spark.range(3).selectExpr("id", "concat('n', id) name", "1 all_time_quantity_sold", "'2024-01-01' date")
    EV.land_run(base, root, "a")
    EV.land_run(base.withColumn("all_time_quantity_sold", F.lit(2.5)).withColumn("date", F.lit("2024-01-02")), root, "b")
    for _ in range(2):  # nothing new the second time
        EV.conform_landing(spark, root, f"{root}/conformed", f"{root}/ckpt", EV.PRODUCTS)
    got = spark.read.schema(K.RAW_PRODUCTS).parquet(f"{root}/conformed")
    assert sorted((r["id"], r["all_time_quantity_sold"], r["date"]) for r in got.collect()) == \
        sorted([(i, 1, "2024-01-01") for i in range(3)] + [(i, 2, "2024-01-02") for i in range(3)])
