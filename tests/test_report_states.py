"""Mergeable report states and scattered days."""

import datetime as dt

from pyspark.sql import functions as F

from daybook.operators import report_states as RS
from daybook.plans.catalog import QUERIES
from daybook.plans.daily import DailyWarehouse
from daybook.session import scratch_path
from daybook.sources import contracts as K

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 3)


def products(spark, n=300):
    return K.conform(spark.range(n).selectExpr(
        "id % 120 id", "'n' name", "if(id % 7 = 0, null, double(id) / 3) price", "id * 10 all_time_quantity_sold",
        "if(id % 5 = 0, null, concat('s', id % 3)) inventory_status",
        "date_add(date'2024-01-01', int(id % 4)) date"), K.CLEAN_PRODUCTS)


def told(df):
    return {(r["metric"], r["key"]): r["value"] for r in df.collect()}


def test_merge_is_associative_and_equals_one_pass(spark):
    df, spec = products(spark), RS.products_spec()
    whole = told(RS.report(RS.states(df, spec)))
    parts = [RS.states(df.where(F.col("id") % 3 == k), spec) for k in range(3)]
    left = RS.merged(parts[0].unionByName(parts[1]), keep_day=True).unionByName(parts[2])
    right = parts[0].unionByName(RS.merged(parts[1].unionByName(parts[2])))
    for got in (told(RS.report(left)), told(RS.report(right))):
        assert got.keys() == whole.keys()
        for k, v in whole.items():
            assert abs((got[k] or 0) - (v or 0)) <= 1e-6 * max(1, abs(v or 0)), k
    one = df.agg(F.round(F.avg("price"), 4), F.round(F.stddev_samp("price"), 4), F.count_if(F.col("inventory_status").isNull())).first()
    assert (whole["avg_price", None], whole["stddev_price", None], whole["null_count", "inventory_status"]) == tuple(one)
    assert abs(whole["distinct_ids_estimate", None] - 120) <= 6 and whole["inventory_status", None] == 60


def test_span_and_empty(spark):
    df, spec = products(spark), RS.products_spec()
    span = told(RS.report(RS.over(RS.states(df, spec), "2024-01-02", "2024-01-03")))
    assert span["total_records", None] == df.where("date BETWEEN '2024-01-02' AND '2024-01-03'").count()
    assert RS.report(RS.states(df.limit(0), spec)).count() == 0
    one = told(RS.report(RS.states(df.limit(1), spec)))
    assert one["stddev_price", None] is None and one["total_records", None] == 1


def test_history_report_reads_states_only(spark):
    wh = DailyWarehouse(spark, scratch_path(spark, "states-run"))
    raw = lambda day: spark.createDataFrame(
        [(i, f"n{i}", float(i), 3, str(day)) for i in range(4)], "id long, name string, price double, all_time_quantity_sold long, date string")
    for day in (D1, D2):
        wh.run_batch(str(day), raw(day), None)
    report = wh.history_report()
    assert told(report)["total_records", None] == 8 and told(wh.history_report(str(D2)))["total_records", None] == 4
    files = report.inputFiles()
    assert len(files) == 2 and all("/reports/states/run_ts=" in f for f in files)


def test_scattered_days_prune_while_they_run(spark):
    df = QUERIES["backfill_scattered_days"](spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_run_days_loads_the_days_only(spark):
    wh = DailyWarehouse(spark, scratch_path(spark, "run-days"))
    days = [D1, dt.date(2024, 1, 2), D2]
    raw = spark.createDataFrame([(i, f"n{i}", float(d.day), 3, str(d)) for i in range(3) for d in days],
                                "id long, name string, price double, all_time_quantity_sold long, date string")
    wh.run_days([str(D1), str(D2)], raw, None, "catch-up")
    assert wh.raw_products().count() == 9
    assert {r[0] for r in wh.fact_products().select("snapshot_date").distinct().collect()} == {D1, D2}
    assert {r[0] for r in wh.dim_products.read().select("effective_date").distinct().collect()} == {D1, D2}
