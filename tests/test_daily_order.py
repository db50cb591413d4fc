import threading

import pytest
from pyspark.sql import functions as F

from daybook.operators import checks as CH
from daybook.plans import daily as PL
from daybook.session import scratch_path
from test_daily import COMMENT_COLS, PRODUCT_COLS, _p

DAYS = [f"2024-03-{d:02d}" for d in range(1, 7)]


def _inputs(spark):
    """Products 1 and 2 first, product 3 in the third run; a review of each product every day."""
    products = [_p(i, f"n{i}", status, DAYS[d]) for d, i, status in
                [(0, 1, "x"), (0, 2, "x"), (2, 1, "y"), (2, 3, "x"), (4, 2, "z")]]
    comments = [(100 * i + (d if i == 1 else 0), i, "t", f"c{d}", 3 + d % 2, 1704153600, None, DAYS[d])
                for d in range(6) for i in (1, 2, 3)]
    return spark.createDataFrame(products, PRODUCT_COLS), spark.createDataFrame(comments, COMMENT_COLS)


def _tables(pl):
    tests = {tuple(r) for r in pl.reports("tests").collect()}
    quality = {tuple(r) for r in pl.reports("quality").collect()}
    tables = [sorted(map(tuple, t.collect()), key=repr) for t in
              (pl.dim_products.read(), pl.dim_comments.read(), pl.fact_products(), pl.fact_comments(),
               pl.raw_products(), pl.raw_comments())]
    return tables, tests, quality, [sorted(m.items(), key=repr) for m in pl.metrics]


def _batch(products, comments, day):
    p, c = products.where(F.col("date") == day), comments.where(F.col("date") == day)
    return day, p if day in (DAYS[0], DAYS[2], DAYS[4]) else None, c


def test_runs_that_overlap_leave_what_runs_in_turn_leave(spark):
    products, comments = _inputs(spark)
    turns, over = (PL.DailyWarehouse(spark, scratch_path(spark, name)) for name in ("turns", "overlap"))
    for day in DAYS:
        turns.run_batch(*_batch(products, comments, day))
    over.run_batches([lambda day=day: _batch(products, comments, day) for day in DAYS])
    assert _tables(over) == _tables(turns)
    # Product 3 has no review fact before its first version, and each report is of its own run.
    assert over.fact_comments().where("product_id = '3'").count() == 4
    assert {r.run_ts for r in over.reports("tests").collect()} == set(DAYS)


def test_a_run_is_cleaned_while_another_loads(spark, monkeypatch):
    products, comments = _inputs(spark)
    pl, second = PL.DailyWarehouse(spark, scratch_path(spark, "beside")), threading.Event()
    merge, prepare = pl.dim_comments.merge, pl._prepare

    def slow(*args):
        assert second.wait(120), "the second run waits for the first one's load"
        return merge(*args)

    def noted(day, *args):
        staged = prepare(day, *args)
        if day == DAYS[1]:
            second.set()
        return staged

    monkeypatch.setattr(pl.dim_comments, "merge", slow)
    monkeypatch.setattr(pl, "_prepare", noted)
    pl.run_batches([lambda day=day: _batch(products, comments, day) for day in DAYS[:2]])
    assert pl.dim_comments.current_version() == 2


def test_no_run_loads_a_table_that_a_run_before_did_not(spark, monkeypatch):
    products, comments = _inputs(spark)
    pl = PL.DailyWarehouse(spark, scratch_path(spark, "fails"))
    write = pl._write_review_facts

    def broken(rows):
        if pl.fact_comments().count():
            raise RuntimeError("no second day")
        write(rows)

    monkeypatch.setattr(pl, "_write_review_facts", broken)
    batches = [lambda day=day: _batch(products, comments, day) for day in DAYS]
    with pytest.raises(RuntimeError, match="no second day"):
        pl.run_batches(batches)
    # The third run has products: their versions wait for the second run's review facts.
    assert {str(r.snapshot_date) for r in pl.fact_comments().collect()} == {DAYS[0]}
    assert pl.dim_products.current_version() == 1
    again, whole = (PL.DailyWarehouse(spark, r) for r in (pl.layout.root, scratch_path(spark, "whole")))
    again.run_batches(batches)
    whole.run_batches(batches)
    assert _tables(again)[0] == _tables(whole)[0]


def test_tests_of_several_tables_in_one_aggregate(spark):
    a = spark.createDataFrame([(1, None), (None, None), (3, "x")], "k int, t string")
    empty, rules = a.where("k > 5"), {"low": F.col("k") < 2}
    got = CH.check_tables([(a, "a", ["k", "t"], rules), (empty, "none", ["k"], {})])
    want = CH.union_all([CH.check_table(a, "a", ["k", "t"], rules), CH.check_table(empty, "none", ["k"])])
    assert got.schema.names == want.schema.names and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_active_versions_deal_few_rows_of_the_log(spark):
    products, comments = _inputs(spark)
    pl = PL.DailyWarehouse(spark, scratch_path(spark, "active"))
    pl.run_batches([lambda day=day: _batch(products, comments, day) for day in DAYS])
    keys = spark.createDataFrame([("1",), ("3",), (None,)], "product_id string")
    for version in (1, 2, 3, None):
        got = pl.dim_products.active(keys, version)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Aggregate") < plan.index("Join Inner") and "LeftAnti" not in plan
        rows = {tuple(r) for r in got.collect() if r.product_id in ("1", "3")}
        assert len({r[0] for r in rows}) == (1 if version == 1 else 2)
        assert all(r[2] is None and r[3] for r in rows)
    now = {(r.product_id, r.effective_date) for r in pl.dim_products.read_open().collect()} & {(r[0], r[1]) for r in rows}
    assert now == {(r[0], r[1]) for r in rows}
    assert pl.dim_products.active(keys, 0).count() == 0
