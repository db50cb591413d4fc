"""One-pass data-quality reports.

The source jobs ran a dozen separate actions over an uncached plan; here all
scalar metrics of a table come from a single aggregate, and each
distribution is one grouped aggregate over a few distinct values (partial
aggregation before the shuffle, so nothing large moves)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.expressions import UNKNOWN


def _r4(c):
    return F.round(c, 4)


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of NULLs in every column, named as the column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in df.columns])


def price_stats(df: DataFrame, col: str = "price") -> DataFrame:
    c = F.col(col)
    return df.agg(_r4(F.avg(c)).alias("avg_price"), F.min(c).alias("min_price"),
                  F.max(c).alias("max_price"), _r4(F.stddev_samp(c)).alias("stddev_price"))


def sales_stats(df: DataFrame, col: str = "all_time_quantity_sold") -> DataFrame:
    c = F.col(col)
    return df.agg(F.sum(c).cast("bigint").alias("total_sold"), _r4(F.avg(c)).alias("avg_sold"),
                  F.max(c).alias("max_sold"))


def distribution(df: DataFrame, col: str, by_count: bool = True) -> DataFrame:
    """Row count per value; most frequent first (ties by value) or by value.
    Only the aggregated rows are sorted."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    if by_count:
        return out.orderBy(F.desc("count"), F.asc_nulls_first(col))
    return out.orderBy(F.asc_nulls_first(col))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys present more than once, with their row count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("count"))
              .where(F.col("count") > 1))


def rule_violations(df: DataFrame, price: str = "price",
                    qty: str = "all_time_quantity_sold") -> DataFrame:
    """Counts of rows breaking price >= 0 and quantity >= 0 (logged, not removed)."""
    p, q = F.col(price), F.col(qty)
    return df.agg(F.count_if((p < 0) | (q < 0)).cast("bigint").alias("invalid_records"),
                  F.count_if(p < 0).cast("bigint").alias("negative_price"),
                  F.count_if(q < 0).cast("bigint").alias("negative_quantity"))


def comments_summary(df: DataFrame) -> DataFrame:
    """Total, valid ratings, their share and unknown content in one pass.
    The share is NULL (not an error) on an empty batch."""
    total = F.count(F.lit(1))
    valid = F.count_if(F.col("rating_valid"))
    return df.agg(total.cast("bigint").alias("total_records"),
                  valid.cast("bigint").alias("valid_ratings"),
                  _r4(F.try_divide(valid, total)).alias("valid_share"),
                  F.count_if(F.col("content") == UNKNOWN).cast("bigint").alias("unknown_content"))


def product_report(df: DataFrame) -> DataFrame:
    """The whole product report as one long table (metric, key, value):
    one scalar aggregate plus the status distribution and duplicate count."""
    scal = df.agg(
        F.count(F.lit(1)).cast("double").alias("total_records"),
        _r4(F.avg("price")).alias("avg_price"), F.min("price").cast("double").alias("min_price"),
        F.max("price").cast("double").alias("max_price"),
        _r4(F.stddev_samp("price")).alias("stddev_price"),
        F.sum("all_time_quantity_sold").cast("double").alias("total_sold"),
        _r4(F.avg("all_time_quantity_sold")).alias("avg_sold"),
        F.max("all_time_quantity_sold").cast("double").alias("max_sold"),
        F.count_if(F.col("price") < 0).cast("double").alias("negative_price"),
        F.count_if(F.col("all_time_quantity_sold") < 0).cast("double").alias("negative_quantity"),
        *[F.count_if(F.col(c).isNull()).cast("double").alias(f"null:{c}") for c in df.columns],
    )
    names = scal.columns
    stack = "stack({n}, {args}) AS (metric, value)".format(
        n=len(names), args=", ".join(f"'{m}', `{m}`" for m in names))
    scalars = scal.selectExpr(stack).select(
        F.when(F.col("metric").startswith("null:"), F.lit("null_count")).otherwise(F.col("metric")).alias("metric"),
        F.when(F.col("metric").startswith("null:"), F.expr("substring(metric, 6)")).alias("key"),
        F.col("value"))
    status = (df.groupBy("inventory_status").agg(F.count(F.lit(1)).cast("double").alias("value"))
                .select(F.lit("inventory_status").alias("metric"),
                        F.col("inventory_status").alias("key"), "value"))
    dups = (duplicate_keys(df, ["id"]).agg(F.count(F.lit(1)).cast("double").alias("value"))
              .select(F.lit("duplicate_ids").alias("metric"), F.lit(None).cast("string").alias("key"), "value"))
    return scalars.unionByName(status).unionByName(dups)


def comments_report(df: DataFrame) -> DataFrame:
    """The whole review report as one long table (metric, key, value)."""
    s = comments_summary(df)
    stack = ("stack(4, 'total_records', double(total_records), 'valid_ratings', double(valid_ratings), "
             "'valid_share', double(valid_share), 'unknown_content', double(unknown_content)) AS (metric, value)")
    scalars = s.selectExpr(stack).select("metric", F.lit(None).cast("string").alias("key"), "value")
    rating = (df.groupBy("rating").agg(F.count(F.lit(1)).cast("double").alias("value"))
                .select(F.lit("rating").alias("metric"), F.col("rating").cast("string").alias("key"), "value"))
    sent = (df.groupBy("sentiment").agg(F.count(F.lit(1)).cast("double").alias("value"))
              .select(F.lit("sentiment").alias("metric"), F.col("sentiment").alias("key"), "value"))
    return scalars.unionByName(rating).unionByName(sent)


def observed_metrics(df: DataFrame, observation) -> DataFrame:
    """Attach the scalar review/product counters to a write with ``observe``:
    they are computed by the write itself, with no extra pass over the data."""
    cols = [F.count(F.lit(1)).alias("rows")]
    if "rating_valid" in df.columns:
        cols += [F.count_if(F.col("rating_valid")).alias("valid_ratings"),
                 F.count_if(F.col("content") == UNKNOWN).alias("unknown_content")]
    if "price" in df.columns:
        cols += [F.count_if(F.col("price") < 0).alias("negative_price")]
    if "all_time_quantity_sold" in df.columns:
        cols += [F.count_if(F.col("all_time_quantity_sold") < 0).alias("negative_quantity")]
    return df.observe(observation, *cols)
