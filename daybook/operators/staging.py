"""Staging: rename, retype, default, key filter, day filter, whole-row DISTINCT.

``run_date`` given -> one daily batch (``date = run_date``, pushed to the
scan and pruned to one partition on a date-partitioned layout).
``run_date`` None -> every day at once; each row's load date is its own day,
which is what the daily runs would have produced one by one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.expressions import date_lit


def _day_filter(df: DataFrame, run_date: str | None) -> DataFrame:
    return df if run_date is None else df.where(F.col("date") == date_lit(run_date))


def stage_products(clean: DataFrame, run_date: str | None = None) -> DataFrame:
    return product_rows(clean, run_date).distinct()


def stage_comments(clean: DataFrame, run_date: str | None = None) -> DataFrame:
    return comment_rows(clean, run_date).distinct()


def product_rows(clean: DataFrame, run_date: str | None = None) -> DataFrame:
    df = _day_filter(clean, run_date).where(F.col("id").isNotNull())
    return df.select(
        F.col("id").cast("string").alias("product_id"),
        F.col("name").alias("product_name"),
        F.coalesce("short_description", F.lit("")).alias("product_description"),
        F.coalesce(F.col("price").cast("double"), F.lit(0.0)).alias("product_price"),
        F.coalesce("list_price", F.lit(0)).cast("bigint").alias("product_list_price"),
        F.coalesce("discount", F.lit(0)).cast("bigint").alias("product_discount"),
        F.coalesce("discount_rate", F.lit(0)).cast("bigint").alias("product_discount_rate"),
        F.coalesce("all_time_quantity_sold", F.lit(0)).cast("bigint").alias("product_all_time_quantity_sold"),
        F.coalesce("inventory_status", F.lit("unknown")).alias("product_inventory_status"),
        F.coalesce("stock_item_qty", F.lit(0)).cast("bigint").alias("product_stock_item_qty"),
        F.coalesce("stock_item_max_sale_qty", F.lit(0)).cast("bigint").alias("product_stock_item_max_sale_qty"),
        F.col("date").alias("load_date"),
    )


def comment_rows(clean: DataFrame, run_date: str | None = None) -> DataFrame:
    df = (_day_filter(clean, run_date)
          .where(F.col("id").isNotNull() & F.col("product_id").isNotNull()))
    return df.select(
        F.col("id").cast("string").alias("comment_id"),
        F.col("product_id").cast("string").alias("product_id"),
        F.col("sentiment"),
        F.col("content").alias("comment_content"),
        F.coalesce("rating", F.lit(0)).cast("bigint").alias("comment_rating"),
        F.col("created_at"),
        F.col("purchased_at"),
        F.col("days_to_review").cast("bigint").alias("days_to_review"),
        F.col("rating_valid"),
        F.col("date").alias("load_date"),
    )
