"""Bucketed tables: layout in the plans, NOT NULL at the write."""

import pytest
from pyspark.sql import functions as F

from daybook.plans.catalog import QUERIES
from daybook.session import scratch_path
from daybook.sinks import bucketed as B
from daybook.sources import contracts as K

SF_DIR = "/root/testdata/sf0.001"


def table(spark, spec, rows, buckets=4):
    path = scratch_path(spark, "bucketed")
    name = "t_" + path.rsplit("-", 1)[-1]
    B.create(spark, name, spec, buckets, path)
    B.append(rows, name, spec, buckets)
    return name


def facts(spark, n=1000):
    return K.conform(spark.range(n).selectExpr("string(id % 50) product_id", "date_add(date'2024-01-01', int(id % 3)) snapshot_date",
                                               "double(id) product_price"), K.FACT_PRODUCTS)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_join_and_aggregate_deal_nothing(spark):
    for name in ("bucketed_dim_join", "bucketed_reviews_per_product"):
        plan = executed(QUERIES[name](spark, SF_DIR))
        assert "Exchange" not in plan and "Bucketed: true" in plan, plan
    assert "SortMergeJoin" in executed(QUERIES["bucketed_dim_join"](spark, SF_DIR))


def test_key_lookup_reads_one_bucket_and_day_one_folder(spark):
    name = table(spark, B.FACT_PRODUCTS, facts(spark))
    df = spark.table(name).where("product_id = '7' AND snapshot_date = date'2024-01-02'")
    # Files of other buckets are skipped either way; only a bucketed scan shows it.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        plan = executed(df.select("*"))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 4" in plan and "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert {r["product_id"] for r in df.collect()} == {"7"}


def test_null_in_a_required_column_fails_the_write(spark):
    name = table(spark, B.FACT_PRODUCTS, facts(spark))
    bad = facts(spark, 10).withColumn("product_id", F.when(F.col("product_price") != 3, F.col("product_id")))
    with pytest.raises(Exception, match="NULL in NOT NULL column product_id"):
        B.append(bad, name, B.FACT_PRODUCTS, 4)
    assert spark.table(name).count() == 1000  # nothing was committed
    B.append(facts(spark, 10).withColumn("product_price", F.lit(None).cast("double")), name, B.FACT_PRODUCTS, 4)
    assert spark.table(name).where("product_price IS NULL").count() == 10


def test_appends_keep_one_file_a_bucket_and_day(spark):
    name = table(spark, B.FACT_PRODUCTS, facts(spark))
    assert spark.table(name).select(F.input_file_name()).distinct().count() <= 4 * 3
    assert spark.table(name).count() == 1000 and spark.table(name).columns[-1] == "snapshot_date"


def test_dimension_tables_of_every_contract(spark):
    for spec, contract in ((B.DIM_PRODUCTS, K.DIM_PRODUCTS), (B.DIM_COMMENTS, K.DIM_COMMENTS), (B.FACT_COMMENTS, K.FACT_COMMENTS)):
        name = table(spark, spec, K.empty(spark, contract))
        assert sorted(spark.table(name).columns) == sorted(contract.fieldNames()) and spark.table(name).count() == 0
        with pytest.raises(Exception, match="NOT NULL"):
            B.append(spark.range(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in contract.fields)), name, spec, 4)


def test_bucket_counts_and_names():
    assert [B.buckets_for(n) for n in (0, 1, 256 << 20, (256 << 20) + 1, 100 << 40)] == [1, 1, 1, 2, 2 ** 19]
    with pytest.raises(ValueError):
        B.ddl("a; DROP TABLE b", B.DIM_PRODUCTS, 4)
