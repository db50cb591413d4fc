"""The one-exchange merge against the brute-force loop of test_scd2, its stored
change log, and the plan it runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook import session as SE
from daybook.operators import merge as M
from daybook.operators import scd2 as S
from daybook.plans.model import Warehouse
from daybook.session import scratch_path
from daybook.sinks.tables import Scd2Store
from daybook.sources import contracts as K
from test_scd2 import DIM, SPEC, STG, model_loop, random_batches, rows_of, to_stg

D = [dt.date(2024, 1, d) for d in range(1, 10)]


def store(spark, contract=DIM, spec=SPEC):
    return Scd2Store(spark, scratch_path(spark, "merge-test"), contract, spec)


@pytest.mark.parametrize("mode", [S.AS_WRITTEN, S.STRICT])
def test_merges_equal_the_loop_however_days_are_cut(spark, mode):
    batches = random_batches(3, keys=30, days=6)
    want, stg = model_loop(batches, mode), to_stg(spark, batches)
    for cuts in ([6], [1, 3, 6], [2, 4, 6], [1, 2, 3, 4, 5, 6]):
        st, at = store(spark), 0
        for cut in cuts:
            st.merge(stg.where(F.col("load_date").isin([d for d, _ in batches[at:cut]])), mode)
            at = cut
        assert rows_of(st.read()) == want, cuts
        assert rows_of(st.read_open()) == {r for r in want if r[5]}
        st.merge(stg, mode)  # all days again
        assert rows_of(st.read()) == want, cuts


def test_survivor_copies_and_loaded_days(spark):
    spec = S.Scd2Spec(key="k", tracked=["a", "b"], prefer=["b"])
    rows = [("X", "a", 1, D[0]), ("X", "z", None, D[0]), ("X", "a", 2, D[0]), ("X", "a", 2, D[0]), ("Y", "b", None, D[0]),
            (None, "n", 1, D[0])]
    st = store(spark, DIM, spec)
    st.merge(spark.createDataFrame(rows, STG))
    assert rows_of(st.read()) == {("X", D[0], "a", 2, None, True), ("Y", D[0], "b", None, None, True),
                                  (None, D[0], "n", 1, None, True)}
    # (X, day 1) is loaded, whatever its values are now; Z is new on that day.
    st.merge(spark.createDataFrame([("X", "q", 9, D[0]), ("Z", "c", 1, D[0])], STG))
    assert {r[0]: r[2] for r in rows_of(st.read())} == {"X": "a", "Y": "b", None: "n", "Z": "c"}
    # A day before the newest one is ignored.
    st.merge(spark.createDataFrame([("X", "r", 9, D[3])], STG))
    st.merge(spark.createDataFrame([("X", "s", 9, D[2]), ("V", "s", 9, D[2])], STG))
    assert sorted((r[2], r[1], r[4]) for r in rows_of(st.read()) if r[0] == "X") == [("a", D[0], D[3]), ("r", D[3], None)]
    assert not [r for r in rows_of(st.read()) if r[0] == "V"] and st.high_water() == str(D[3])


def test_empty_batch_and_empty_store(spark):
    st, none = store(spark), spark.createDataFrame([], STG)
    assert st.read().count() == 0 and st.high_water() is None
    st.merge(none)
    assert st.read().count() == 0 and st.high_water() is None
    st.merge(spark.createDataFrame([("X", "a", 1, D[0])], STG))
    st.merge(none)
    assert st.read().count() == 1 and st.high_water() == str(D[0])


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="mode"):
        store(spark).merge(spark.createDataFrame([], STG), "both")


@pytest.mark.parametrize("mode", [S.AS_WRITTEN, S.STRICT])
def test_executed_plan_deals_once_and_reads_no_texts(spark, mode):
    st = store(spark, K.DIM_COMMENTS, S.COMMENTS)
    stg = K.conform(spark.range(500).selectExpr(
        "string(id) comment_id", "string(id % 7) product_id", "'long text' comment_content", "id % 5 comment_rating",
        "date_add(date'2024-01-01', int(id % 3)) load_date"), K.STG_COMMENTS)
    path = scratch_path(spark, "staged")
    stg.write.parquet(path)
    stg = spark.read.parquet(path)
    st.merge(stg, mode)
    later = stg.withColumn("load_date", F.date_add("load_date", 9))
    changes = M.merge_changes(st.log(), later, S.COMMENTS, mode, high_water=F.lit(st.high_water()).cast("date"))
    rows = changes.collect()
    assert len(rows) >= 500 if mode == S.AS_WRITTEN else True
    plan = changes._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning(comment_id") == 1 and final.count("Exchange ") == 1
    scans = [line for line in final.split("\n") if "FileScan" in line]
    of_log = [line for line in scans if "digests" in line.split("ReadSchema:")[1]]
    assert len(scans) == 2 and len(of_log) == 1
    for wide in ("comment_content", "sentiment", "comment_rating"):
        assert wide not in of_log[0].split("ReadSchema:")[1]
    assert "Join" not in final and "Subquery" not in final


def test_tasks_of_a_merge_and_of_a_stored_table_stay_small(spark, monkeypatch):
    least = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    stg = spark.range(4_000).selectExpr("md5(string(id)) k", "sha2(string(id), 256) a", "id b", "date'2024-01-01' load_date")

    def files():
        st = store(spark)
        st.merge(stg)
        kept = Warehouse(spark, "", stored=True).staged(stg.hint("rebalance", "k"))
        assert st.read().count() == kept.count() == 4_000
        return len(st.inserted().inputFiles()), len(kept.inputFiles())

    assert files() == (1, 1)  # a task writes a file
    before = {k: spark.conf.get(k) for k in SE.TASK_BYTES}
    monkeypatch.setattr(SE, "TASK_BYTES", dict.fromkeys(before, 32 << 10))
    now = spark.conf.get(least)
    spark.conf.set(least, "1k")  # 1 MB, more than these rows
    try:
        assert min(files()) >= 3
    finally:
        spark.conf.set(least, now)
    assert {k: spark.conf.get(k) for k in before} == before


def test_small_tasks_keep_smaller_options_and_nest(spark):
    scan, deal = SE.TASK_BYTES
    before = {k: spark.conf.get(k) for k in SE.TASK_BYTES}
    spark.conf.set(deal, "16k")
    try:
        with SE.small_tasks(spark):
            with SE.small_tasks(spark):
                pass
            assert spark.conf.get(deal) == "16k" and spark.conf.get(scan) == str(SE.TASK_BYTES[scan])
        assert spark.conf.get(scan) == before[scan] and spark.conf.get(deal) == "16k"
    finally:
        spark.conf.set(deal, before[deal])
