import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.operators import checks as CH
from daybook.operators import facts as FA
from daybook.session import scratch_path
from daybook.sinks import tables as SK
from daybook.sources import contracts as K

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def _stg_products(spark, rows):
    return K.conform(spark.createDataFrame(rows, "product_id string, product_price double, load_date date"),
                     K.STG_PRODUCTS)


def test_fact_gate_is_strict_and_dim_gate_inclusive(spark):
    fact = FA.fact_products(_stg_products(spark, [("1", 1.0, D1)]), K.empty(spark, K.FACT_PRODUCTS))
    fact = spark.createDataFrame(fact.collect(), K.FACT_PRODUCTS)
    # Second batch on the same day adds nothing to the fact.
    again = FA.fact_products(_stg_products(spark, [("2", 1.0, D1)]), fact)
    assert {r.product_id for r in again.collect()} == {"1"}
    later = FA.fact_products(_stg_products(spark, [("2", 1.0, D2)]), fact)
    assert {(r.product_id, r.snapshot_date) for r in later.collect()} == {("1", D1), ("2", D2)}


def test_fact_comments_semi_join_has_no_fanout(spark):
    dim = spark.createDataFrame([("p", D1, None, True), ("p", D2, None, True), ("q", D1, D2, False)],
                                "product_id string, effective_date date, end_date date, is_active boolean")
    stg = K.conform(spark.createDataFrame(
        [("c1", "p", dt.datetime(2024, 1, 3, 5), D2), ("c2", "q", dt.datetime(2024, 1, 3), D2)],
        "comment_id string, product_id string, created_at timestamp, load_date date"), K.STG_COMMENTS)
    out = FA.fact_comments(stg, dim, K.empty(spark, K.FACT_COMMENTS)).collect()
    assert [(r.comment_id, r.comment_date, r.snapshot_date) for r in out] == [("c1", dt.date(2024, 1, 3), D2)]


def test_asof_join_half_open(spark):
    dim = spark.createDataFrame([(1, D1, D2, "a"), (1, D2, None, "b")],
                                "pk bigint, effective_date date, end_date date, s string")
    facts = spark.createDataFrame([(1, D1), (1, D2), (1, dt.date(2023, 12, 31))], "k bigint, d date")
    got = sorted((r.d, r.s) for r in FA.asof_join(facts, dim, "k", "pk", "d").select("f.d", "d.s").collect())
    assert got == [(D1, "a"), (D2, "b")]


def test_dynamic_overwrite_keeps_other_partitions(spark):
    path = scratch_path(spark, "parts")
    df = spark.createDataFrame([(1, D1), (2, D2)], "v int, d date")
    SK.overwrite_partitions(df, path, "d")
    SK.overwrite_partitions(spark.createDataFrame([(3, D2)], "v int, d date"), path, "d")
    got = sorted((r.v, r.d) for r in spark.read.parquet(path).collect())
    assert got == [(1, D1), (3, D2)]


def test_csv_roundtrip_with_newlines_quotes_and_spaces(spark):
    rows = [(1, ' lead and trail ', 'a "quoted"\nsecond line'), (2, '', None), (3, 'x,y', 'null')]
    df = spark.createDataFrame(rows, "id bigint, a string, b string")
    path = scratch_path(spark, "csv")
    SK.write_csv(df, path)
    back = sorted(tuple(r) for r in SK.read_csv(spark, path, df.schema).collect())
    # Text, quotes, newlines, separators and edge spaces survive; an empty
    # string reads back as NULL (as in a pandas CSV hop).
    assert back == sorted([(1, ' lead and trail ', 'a "quoted"\nsecond line'), (2, None, None), (3, 'x,y', 'null')])


def test_checks_report_shape(spark):
    parent = spark.createDataFrame([("a",)], "k string")
    child = spark.createDataFrame([("a",), ("b",), (None,), ("b",)], "k string")
    rep = CH.union_all([CH.check_not_null(child, "c", ["k"]),
                        CH.check_relationship(child, parent, "c", "k", "k"),
                        CH.check_unique(child, "c", ["k"])])
    assert rep.columns == CH.REPORT
    got = {(r.test, r.failures) for r in rep.collect()}
    assert got == {("not_null", 1), ("relationships", 2), ("unique", 1)}


def _store(spark):
    from daybook.operators import scd2 as S
    cols = "product_id string, product_name string, product_description string, product_inventory_status string, load_date date"
    days = [D1, D2, dt.date(2024, 1, 3)]
    stg = K.conform(spark.createDataFrame(
        [("1", "a", "d", s, d) for s, d in zip("xyz", days)], cols), K.STG_PRODUCTS)
    return S, SK.Scd2Store(spark, scratch_path(spark, "store"), K.DIM_PRODUCTS, S.PRODUCTS), stg, days


def test_scd2_store_ignores_a_crashed_run_and_retries_it(spark):
    S, st, stg, days = _store(spark)
    for d in days[:2]:
        st.merge(stg.where(F.col("load_date") == d))
    before = sorted(tuple(r) for r in st.read().collect())
    assert len(before) == 2 and len(st.read_open().collect()) == 1 and st.high_water() == "2024-01-02"
    # A crashed third run: its folder is written but never committed.
    st.read().withColumn("state", F.lit("closing")).write.mode("overwrite").partitionBy("state").parquet(f"{st.root}/v=3")
    assert sorted(tuple(r) for r in st.read().collect()) == before
    # The retry takes its number and commits; the history stays whole.
    assert st.merge(stg.where(F.col("load_date") == days[2])) == 3
    assert sorted(tuple(r) for r in st.read().collect()) == \
        sorted(tuple(r) for r in S.scd2_history(stg, S.PRODUCTS).collect())


def test_scd2_store_of_two_writers_one_fails(spark, monkeypatch):
    _, st, stg, days = _store(spark)
    st.merge(stg.where(F.col("load_date") == days[0]))
    monkeypatch.setattr(st, "current_version", lambda: None)  # as a writer that started before
    with pytest.raises(Exception, match="committed"):
        st.merge(stg.where(F.col("load_date") == days[0]))


def test_scd2_store_run_writes_its_changes_only(spark):
    S, st, stg, days = _store(spark)
    many = K.conform(spark.range(200).selectExpr("string(id + 10) product_id", "'n' product_name",
                                                 "date'2024-01-01' load_date"), K.STG_PRODUCTS)
    st.merge(many.unionByName(stg.where(F.col("load_date") == D1)))
    v = st.merge(stg.where(F.col("load_date") == D2))
    # One version ended, one inserted; the 200 others are not written again.
    assert spark.read.parquet(f"{st.root}/v={v}").count() == 2 and st.read().count() == 202
    closing = spark.read.parquet(f"{st.root}/v={v}/state=closing").first()
    assert closing["product_id"] == "1" and closing["product_name"] is None and str(closing["end_date"]) == str(D2)
    assert st.merge(stg.where(F.col("load_date") == D2)) == v + 1 and st.read().count() == 202  # nothing to do
