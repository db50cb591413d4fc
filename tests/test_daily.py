import datetime as dt

from pyspark.sql import functions as F

from daybook.plans import daily as PL
from daybook.session import scratch_path

PRODUCT_COLS = ("id bigint, name string, short_description string, price double, list_price bigint, "
                "discount bigint, discount_rate bigint, all_time_quantity_sold bigint, inventory_status string, "
                "stock_item_qty bigint, stock_item_max_sale_qty bigint, date string")
COMMENT_COLS = ("id bigint, product_id bigint, title string, content string, rating bigint, "
                "created_at bigint, purchased_at bigint, date string")


def _p(i, name, status, day):
    return (i, name, None, 10.0, 11, 1, 5, 3, status, 1, 2, day)


def _state(pl):
    dims = {(r.product_id, r.effective_date, r.end_date, r.is_active) for r in pl.dim_products.read().collect()}
    counts = {r.table_name: r.rows for r in pl.row_counts().collect()}
    return dims, counts


def test_daily_runs_rerun_is_noop_and_facts_gate(spark):
    products = spark.createDataFrame([
        _p(1, "a", "x", "2024-01-01"), _p(2, "b", "x", "2024-01-01"),
        _p(1, "a", "y", "2024-01-02"), _p(2, "b", "x", "2024-01-02"), _p(3, "c", "x", "2024-01-02"),
    ], PRODUCT_COLS)
    comments = spark.createDataFrame([
        (10, 1, "Hài lòng", "ok", 5, 1704153600, None, "2024-01-02"),
        (11, 9, "x", "", 2, 1704153600, 1704067200, "2024-01-02"),
    ], COMMENT_COLS)
    pl = PL.DailyWarehouse(spark, scratch_path(spark, "pl"))
    for day in ["2024-01-01", "2024-01-02"]:
        report = pl.run_batch(day, products.where(F.col("date") == day),
                              comments.where(F.col("date") == day))
    dims, counts = _state(pl)
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    # as_written: product 1 changed (closed), product 2 unchanged (two active).
    assert dims == {("1", d1, d2, False), ("1", d2, None, True), ("2", d1, None, True),
                    ("2", d2, None, True), ("3", d2, None, True)}
    assert counts == {"raw_products": 5, "raw_comments": 2, "dim_products": 5, "dim_comments": 2,
                      "fact_products": 5, "fact_comments": 1}
    failures = {(r.test, r.table_name, r.column_name): r.failures for r in report.collect()}
    # Review 11 points at product 9, which no product row has.
    assert failures[("relationships", "stg_comments", "product_id")] == 1
    assert sum(failures.values()) == 2  # the same orphan in dim_comments
    assert failures[("rule", "stg_products", "product_price")] == 0

    # Re-running a day changes nothing anywhere.
    pl.run_batch("2024-01-02", products.where(F.col("date") == "2024-01-02"),
                 comments.where(F.col("date") == "2024-01-02"))
    assert _state(pl) == (dims, counts)
    assert pl.metrics[-1]["rows"] == 2 and pl.metrics[-2]["rows"] == 3
    # Every run's tests and quality report are stored.
    assert {r.run_ts for r in pl.reports("tests").select("run_ts").distinct().collect()} == {"2024-01-01", "2024-01-02"}
    totals = pl.reports("quality").where("metric = 'total_records' AND run_ts = '2024-01-02'")
    assert {(r.table_name, r.value) for r in totals.collect()} == {("products", 3.0), ("comments", 2.0)}


def _tables(pl):
    return {
        "dim_products": {tuple(r) for r in pl.dim_products.read().collect()},
        "dim_comments": {tuple(r) for r in pl.dim_comments.read().collect()},
        "fact_products": {tuple(r) for r in pl.fact_products().collect()},
        "fact_comments": {tuple(r) for r in pl.fact_comments().collect()},
        "raw_products": {tuple(r) for r in pl.raw_products().collect()},
        "raw_comments": {tuple(r)[:-1] for r in pl.raw_comments().collect()},  # minus processing date
    }


def test_backfill_equals_day_by_day(spark):
    days = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    products = spark.createDataFrame([
        _p(1, "a", "x", days[0]), _p(1, "a", "y", days[1]), _p(2, "b", "x", days[2]),
        _p(1, "a", "x", days[3]), _p(2, "b", "x", days[3]),
    ], PRODUCT_COLS)
    t = 1704067200
    comments = spark.createDataFrame([
        (10, 1, "Hài lòng", "ok", 5, t, None, days[0]),
        (11, 2, "x", "", 2, t + 86400, t, days[1]),      # product 2 is not loaded until day 3
        (12, 2, None, "null", 4, t + 2 * 86400, t, days[2]),
        (13, 1, "Bình thường", "x", 3, t + 86400, None, days[1]),
        (14, 3, "x", "x", 1, t + 3 * 86400, None, days[3]),  # product 3 never exists
    ], COMMENT_COLS)
    daily = PL.DailyWarehouse(spark, scratch_path(spark, "daily"))
    for d in days:
        daily.run_batch(d, products.where(F.col("date") == d), comments.where(F.col("date") == d))
    back = PL.DailyWarehouse(spark, scratch_path(spark, "backfill"))
    back.run_range(days[0], days[-1], products, comments)
    a, b = _tables(daily), _tables(back)
    for name in a:
        assert a[name] == b[name], name
    assert {r[0] for r in a["fact_comments"]} == {"10", "12", "13"}


def test_second_batch_late_and_undated_documents_remove_nothing(spark):
    def docs(*rows):
        return spark.createDataFrame(list(rows), PRODUCT_COLS)

    pl = PL.DailyWarehouse(spark, scratch_path(spark, "append"))
    pl.run_batch("2024-01-01", docs(_p(1, "a", "x", "2024-01-01"), _p(2, "b", "x", "no day")), None)
    pl.run_batch("2024-01-01", docs(_p(3, "c", "x", "2024-01-01")), None, run_ts="2024-01-01.2")
    late = docs(_p(4, "d", "x", "2024-01-02"), _p(5, "e", "x", "2024-01-01"), _p(6, "f", "x", None))
    for _ in range(2):
        pl.run_batch("2024-01-02", late, None)
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    assert {(r.id, r.date) for r in pl.raw_products().collect()} == {(1, d1), (2, None), (3, d1), (4, d2), (5, d1), (6, None)}
    assert pl.raw_products().count() == 6
    assert {r.product_id for r in pl.dim_products.read().collect()} == {"1", "3", "4"}


def test_landed_days_with_drifting_types(spark):
    path = f"{scratch_path(spark, 'landing')}/products"
    first = spark.createDataFrame([_p(1, "a", "x", "2024-01-01")], PRODUCT_COLS).drop("date")
    first.write.parquet(f"{path}/date=2024-01-01")
    first.withColumn("all_time_quantity_sold", F.lit(7.0)).write.parquet(f"{path}/date=2024-01-02")
    days = PL.landed_days(spark, path)
    got = PL.RD.read_landed_days(spark, path, days, PL.K.RAW_PRODUCTS).collect()
    assert {(r.date, r.all_time_quantity_sold) for r in got} == {("2024-01-01", 3), ("2024-01-02", 7)}
    one = PL.landed_day(spark, path, "2024-01-02", PL.K.RAW_PRODUCTS).collect()
    assert [(r.date, r.all_time_quantity_sold) for r in one] == [("2024-01-02", 7)]
    assert PL.landed_day(spark, path, "2024-01-03", PL.K.RAW_PRODUCTS).count() == 0


def test_undated_and_misspelled_documents_are_kept(spark):
    days, t = ["2024-01-01", "2024-01-02"], 1704067200
    products = spark.createDataFrame(
        [_p(1, "a", "x", days[0]), _p(2, "b", "x", days[1]), _p(3, "c", "x", None), _p(4, "d", "x", "2024-1-5"),
         _p(5, "e", "x", "bad"), _p(6, "f", "x", "2024-02-30"), _p(7, "g", "x", "2024/01/02 10:00")], PRODUCT_COLS)
    comments = spark.createDataFrame(
        [(10, 1, "x", "ok", 5, t, None, days[0]), (11, 1, "x", "ok", 4, t, None, None), (12, 2, "x", "ok", 3, t, None, "bad")],
        COMMENT_COLS)
    daily = PL.run_days(spark, scratch_path(spark, "daily"), products, comments)
    back = PL.backfill(spark, scratch_path(spark, "backfill"), products, comments)
    a, b = _tables(daily), _tables(back)
    assert a == b
    day = {1: dt.date(2024, 1, 1), 2: dt.date(2024, 1, 2), 10: dt.date(2024, 1, 1)}
    for pl in (daily, back):
        assert {(r.id, r.date) for r in pl.raw_products().collect()} == {(i, day.get(i)) for i in range(1, 8)}
        assert {(r.id, r.date) for r in pl.raw_comments().collect()} == {(i, day.get(i)) for i in (10, 11, 12)}
        assert {r.product_id for r in pl.dim_products.read().collect()} == {"1", "2"}
        assert {r.comment_id for r in pl.fact_comments().collect()} == {"10"}
    totals = daily.reports("quality").where("metric = 'total_records' AND run_ts = 'undated'").collect()
    assert {(r.table_name, r.value) for r in totals} == {("products", 5.0), ("comments", 2.0)}


def test_landings_without_a_day(spark):
    none = PL.backfill(spark, scratch_path(spark, "none"), spark.createDataFrame([], PRODUCT_COLS),
                       spark.createDataFrame([], COMMENT_COLS))
    assert {r["rows"] for r in none.row_counts().collect()} == {0}
    products = spark.createDataFrame([_p(3, "c", "x", None)], PRODUCT_COLS)
    only = PL.backfill(spark, scratch_path(spark, "only"), products, spark.createDataFrame([], COMMENT_COLS))
    assert [(r.id, r.date) for r in only.raw_products().collect()] == [(3, None)]
    assert only.dim_products.read().count() == 0
