"""Cleaning steps of the two daily jobs. Both are single lazy plans of narrow
operators except the key dedupe, which is an aggregate (map-side combined)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import expressions as X
from daybook.sources.contracts import RAW_COMMENTS, RAW_PRODUCTS, conform


def dedupe_by_key(df: DataFrame, keys: list[str], order: list[str],
                  descending: bool = True) -> DataFrame:
    """Keep one row per ``keys``: the greatest (or least) by ``order``, ties
    broken by every other column, so the survivor is the same on every run.

    Written as an aggregate over a struct instead of a window: the partial
    aggregate runs before the shuffle, so a key holding a large share of the
    rows is reduced per task instead of landing whole in one task."""
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_row")
    agg = F.max(packed) if descending else F.min(packed)
    out = df.groupBy(*keys).agg(agg.alias("_row"))
    return out.select(*[F.col(k) for k in keys],
                      *[F.col(f"_row.{c}").alias(c) for c in order + rest]).select(*df.columns)


def product_rows(raw: DataFrame) -> DataFrame:
    """The product job row by row: drop unnamed rows, price to double, quantity to
    long, date text to DATE."""
    df = conform(raw, RAW_PRODUCTS)
    return (df.dropna(subset=["name"])
              .withColumn("price", F.col("price").cast("double"))
              .withColumn("all_time_quantity_sold", F.col("all_time_quantity_sold").cast("bigint"))
              .withColumn("date", X.parse_day("date")))


def clean_products(raw: DataFrame, dedupe_keys: list[str] | None = None) -> DataFrame:
    """Product job: ``product_rows``, then one row per id (latest load date wins).

    Default fill is deliberately *not* applied here (the source job computes
    it and discards it); staging fills instead. Use ``fill_defaults`` to get
    the filled frame."""
    return dedupe_by_key(product_rows(raw), dedupe_keys or ["id"], ["date"])


def fill_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Per-column default fill (floats given for long columns become longs)."""
    d = {k: v for k, v in (defaults or X.PRODUCT_DEFAULTS).items() if k in df.columns}
    return df.fillna(d)


def clean_comments(raw: DataFrame, run_date: str | None,
                   sentiment_map: list[tuple[str, str]] | None = None) -> DataFrame:
    """Review job: unknown title/content, drop rows without product or rating,
    epoch seconds to TIMESTAMP, sentiment, review delay, rating flag and the
    processing date (``run_date``; None in a backfill = each row's own day,
    the date its daily run would have stamped). No dedupe."""
    stamp = F.lit(run_date) if run_date is not None else X.day_stamp("date")
    df = conform(raw, RAW_COMMENTS)
    return (df.withColumn("title", X.title_or_unknown("title"))
              .withColumn("content", X.content_or_unknown("content"))
              .dropna(subset=["product_id", "rating"])
              .withColumn("created_at", X.epoch_to_ts("created_at"))
              .withColumn("purchased_at", X.epoch_to_ts("purchased_at"))
              .withColumn("date", X.parse_day("date"))
              .withColumn("sentiment", X.sentiment("title", sentiment_map))
              .withColumn("days_to_review", X.days_between("created_at", "purchased_at"))
              .withColumn("rating_valid", X.rating_valid("rating"))
              .withColumn("processing_date", stamp))
