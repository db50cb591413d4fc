"""All tests of a table in one scan, against the tests one by one."""

from pyspark.sql import functions as F

from daybook.operators import checks as CH


def test_check_table_equals_single_queries(spark):
    rows = [("a", 1, 5), ("a", 1, None), ("b", None, 7), ("b", None, 8), (None, 2, -1), (None, 2, -1), ("c", 3, 0)]
    df = spark.createDataFrame(rows, "k string, d int, v int")
    sets = [["k", "d"], ["k"], ["d", "v"], ["v"], ["k", "d", "v"]]
    got = {(r["test"], r["column_name"]): r["failures"] for r in CH.check_table(
        df, "t", ["k", "d", "v"], {"v": F.col("v") < 0, "odd": F.col("v") % 2 == 1}, sets).collect()}
    want = {("not_null", c): df.where(F.col(c).isNull()).count() for c in "kdv"}
    want |= {("rule", "v"): df.where("v < 0").count(), ("rule", "odd"): df.where("v % 2 = 1").count()}
    want |= {("unique", ",".join(s)): df.groupBy(*s).count().where("count > 1").count() for s in sets}
    assert got == want


def test_empty_table_reports_zeros(spark):
    df = spark.createDataFrame([], "k string, d int")
    rows = CH.check_table(df, "t", ["k"], {"d": F.col("d") < 0}, [["k", "d"]]).collect()
    assert [tuple(r) for r in rows] == [("not_null", "t", "k", 0), ("rule", "t", "d", 0), ("unique", "t", "k,d", 0)]
    assert [tuple(r) for r in CH.check_rules(df, "t", {"d": F.col("d") < 0}).collect()] == [("rule", "t", "d", 0)]


def test_one_scan(spark, tmp_path):
    spark.range(100).selectExpr("id % 7 k", "id d", "id v", "id other").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = CH.check_table(df, "t", ["k", "v"], {"v": F.col("v") < 0}, [["k", "d"], ["d"]])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "other" not in plan and "Join" not in plan
