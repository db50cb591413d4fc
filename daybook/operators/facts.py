"""Snapshot facts and the as-of dimension join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.upsert import gate, keyed_upsert
from daybook.sources.contracts import FACT_COMMENTS, FACT_PRODUCTS


def fact_products_delta(stg: DataFrame, target: DataFrame) -> DataFrame:
    """Rows newer than the fact's latest snapshot, one snapshot per load date."""
    b = gate(stg, target, "load_date", "snapshot_date", inclusive=False)
    return b.select(
        "product_id", F.col("load_date").alias("snapshot_date"),
        "product_all_time_quantity_sold", "product_stock_item_qty",
        "product_stock_item_max_sale_qty",
        *[F.col(c).cast("double").alias(c) for c in
          ("product_price", "product_list_price", "product_discount", "product_discount_rate")],
    ).distinct().select(*FACT_PRODUCTS.fieldNames())


def fact_products(stg: DataFrame, target: DataFrame) -> DataFrame:
    return keyed_upsert(target.select(*FACT_PRODUCTS.fieldNames()),
                        fact_products_delta(stg, target), ["product_id", "snapshot_date"])


def fact_comments_delta(stg: DataFrame, dim_products: DataFrame, target: DataFrame) -> DataFrame:
    """Reviews of products that have an active version, newer than the fact.

    The warehouse writes an inner join and hides its fan-out (several active
    versions per product) with DISTINCT; no dimension column is projected,
    so a semi join gives the same rows without the fan-out. Spark chooses
    broadcast or sort-merge from runtime sizes (AQE), and AQE splits a skewed
    product on the review side."""
    # Distinct keys: several active versions of one product (as-written mode)
    # collapse map-side, and the distinct's shuffle on product_id is the one
    # the join needs.
    active = (dim_products.where(F.col("is_active") & F.col("end_date").isNull())
                          .select("product_id").distinct())
    b = gate(stg, target, "load_date", "snapshot_date", inclusive=False)
    c = b.join(active, "product_id", "left_semi")
    return c.select(
        "comment_id", "product_id", "comment_rating", "days_to_review",
        F.to_date("created_at").alias("comment_date"),
        F.col("load_date").alias("snapshot_date"),
    ).distinct().select(*FACT_COMMENTS.fieldNames())


def fact_comments_delta_asof(stg: DataFrame, dim_products: DataFrame, target: DataFrame) -> DataFrame:
    """``fact_comments_delta`` for a batch spanning several load days, against
    the dimension as it stands after the last of them: a review of day d
    needs a product version that was active after run d, i.e.
    ``effective_date <= d`` and not closed by then (``end_date`` NULL or
    after d). Equi join on the product plus that range test, as a semi join."""
    b = gate(stg, target, "load_date", "snapshot_date", inclusive=False).alias("c")
    d = dim_products.select("product_id", "effective_date", "end_date").alias("d")
    cond = ((F.col("c.product_id") == F.col("d.product_id"))
            & (F.col("d.effective_date") <= F.col("c.load_date"))
            & (F.col("d.end_date").isNull() | (F.col("d.end_date") > F.col("c.load_date"))))
    c = b.join(d, cond, "left_semi")
    return c.select(
        "comment_id", "product_id", "comment_rating", "days_to_review",
        F.to_date("created_at").alias("comment_date"),
        F.col("load_date").alias("snapshot_date"),
    ).distinct().select(*FACT_COMMENTS.fieldNames())


def fact_comments(stg: DataFrame, dim_products: DataFrame, target: DataFrame) -> DataFrame:
    return keyed_upsert(target.select(*FACT_COMMENTS.fieldNames()),
                        fact_comments_delta(stg, dim_products, target),
                        ["comment_id", "snapshot_date"])


def asof_join(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
              fact_date: str, how: str = "inner") -> DataFrame:
    """Attach to each fact row the dimension version valid on ``fact_date``:
    equi join on the key, then the half-open validity test
    ``effective_date <= d < coalesce(end_date, +inf)``. Use a dimension
    with one version per key and date (``strict`` mode), otherwise a
    boundary day can match two versions. The equi key carries the join, so
    it is a regular shuffle (or broadcast) join, never a nested loop; each
    fact row meets at most the versions of its own key."""
    f, d = facts.alias("f"), dim.alias("d")
    cond = ((F.col(f"f.{fact_key}") == F.col(f"d.{dim_key}"))
            & (F.col(f"f.{fact_date}") >= F.col("d.effective_date"))
            & (F.col("d.end_date").isNull() | (F.col(f"f.{fact_date}") < F.col("d.end_date"))))
    return f.join(d, cond, how)
