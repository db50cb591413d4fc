"""Raw product and review inputs derived, with Spark, from the provided tables.

Every fixture is a lazy DataFrame over the whole source tables, so its work
grows with them. The derivations are plain expressions and one aggregate;
the DuckDB spellings of the same derivations live in ``daybook.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.expressions import TITLE_SENTIMENT
from daybook.sources.tables import table

# Event type -> review title (fixture rule: the five titles in order).
EVENT_TITLES = list(zip(["purchase", "signup", "view", "click", "error"],
                        [t for t, _ in TITLE_SENTIMENT]))
# Event type -> star rating used by the review-history fixture.
EVENT_RATINGS = {"purchase": 5, "signup": 4, "view": 3, "click": 2, "error": 1}


def _title(event_type) -> F.Column:
    e = None
    for et, title in EVENT_TITLES:
        e = F.when(event_type == et, title) if e is None else e.when(event_type == et, title)
    return e


def raw_comments(spark: SparkSession, sf_dir: str, with_score: bool = False) -> DataFrame:
    """One raw review per event (contract RAW_COMMENTS; 30 load days)."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    created = F.unix_timestamp(F.col("ts"))
    cols = [
        eid.alias("id"),
        F.when(eid % 50 == 0, F.lit(None)).otherwise(F.col("user_id")).cast("bigint").alias("product_id"),
        F.when(eid % 17 == 0, F.lit(None)).otherwise(_title(F.col("event_type"))).alias("title"),
        F.when(eid % 19 == 0, F.lit(None).cast("string"))
         .when(eid % 23 == 0, F.lit(""))
         .when(eid % 29 == 0, F.lit("null"))
         .otherwise(F.col("props")).alias("content"),
        F.when(eid % 11 == 0, F.lit(None)).otherwise(eid % 7).cast("bigint").alias("rating"),
        created.alias("created_at"),
        F.when(eid % 13 == 0, F.lit(None))
         .otherwise(created - (eid % 40) * 86400).cast("bigint").alias("purchased_at"),
        F.date_format(F.col("ts"), "yyyy-MM-dd").alias("date"),
    ]
    if with_score:
        cols.append(F.col("value").alias("score"))
    return ev.select(*cols)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw product document per part and ship year, loaded on 31 Dec of
    that year (contract RAW_PRODUCTS; 7 load batches)."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    # Aggregate lineitem first: the partial aggregate combines map-side, so
    # a hot part key is one row per task before the shuffle.
    sales = (li.groupBy(F.col("l_partkey"), F.year("l_shipdate").alias("yr"))
               .agg(F.sum("l_quantity").alias("qty_sum"),
                    F.max("l_discount").alias("disc_max"),
                    F.max("l_returnflag").alias("flag_max"),
                    F.min("l_quantity").alias("qty_min"),
                    F.max("l_quantity").alias("qty_max")))
    p = part.select("p_partkey", "p_name", "p_type", "p_retailprice")
    j = sales.join(p, sales.l_partkey == p.p_partkey)
    key = F.col("p_partkey")
    list_price = F.ceil("p_retailprice").cast("bigint")
    return j.select(
        key.alias("id"),
        F.when(key % 97 == 0, F.lit(None)).otherwise(F.col("p_name")).alias("name"),
        F.when(key % 10 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("short_description"),
        F.col("p_retailprice").alias("price"),
        list_price.alias("list_price"),
        (list_price - F.floor("p_retailprice").cast("bigint")).alias("discount"),
        F.round(F.col("disc_max") * 100).cast("bigint").alias("discount_rate"),
        F.col("qty_sum").cast("bigint").alias("all_time_quantity_sold"),
        F.col("flag_max").alias("inventory_status"),
        F.col("qty_min").cast("bigint").alias("stock_item_qty"),
        F.col("qty_max").cast("bigint").alias("stock_item_max_sale_qty"),
        F.concat(F.col("yr").cast("string"), F.lit("-12-31")).alias("date"),
    )


def raw_products_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with price and quantity negated for every 31st id (rule checks)."""
    df = raw_products(spark, sf_dir)
    neg = F.col("id") % 31 == 0
    return (df.withColumn("price", F.when(neg, -F.col("price")).otherwise(F.col("price")))
              .withColumn("all_time_quantity_sold",
                          F.when(neg, -F.col("all_time_quantity_sold"))
                           .otherwise(F.col("all_time_quantity_sold"))))


def comment_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged-review history (contract STG_COMMENTS): the last event of each
    (user, day) by (ts, event_id); key = user; the event type is the content.
    days_to_review is NULL on every 13th event so that changes to and from
    NULL occur."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type")
    day = F.to_date("ts")
    # Last event of the (user, day) group: max over a struct ordered by
    # (ts, event_id); an aggregate, so a hot user combines map-side.
    last = (ev.groupBy(F.col("user_id"), day.alias("load_date"))
              .agg(F.max(F.struct("ts", "event_id", "event_type")).alias("e")))
    etype = F.col("e.event_type")
    rating = None
    for et, r in EVENT_RATINGS.items():
        rating = F.when(etype == et, r) if rating is None else rating.when(etype == et, r)
    created = F.timestamp_seconds(F.unix_timestamp(F.col("e.ts")))
    sent = None
    for et, title in EVENT_TITLES:
        label = dict(TITLE_SENTIMENT)[title]
        sent = F.when(etype == et, label) if sent is None else sent.when(etype == et, label)
    return last.select(
        F.col("user_id").cast("string").alias("comment_id"),
        F.col("user_id").cast("string").alias("product_id"),
        sent.otherwise("unknown").alias("sentiment"),
        etype.alias("comment_content"),
        rating.cast("bigint").alias("comment_rating"),
        created.alias("created_at"),
        created.alias("purchased_at"),
        F.when(F.col("e.event_id") % 13 == 0, F.lit(None)).otherwise(F.lit(0)).cast("bigint").alias("days_to_review"),
        F.lit(True).alias("rating_valid"),
        F.col("load_date"),
    )


def raw_comments_same_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews sent again: the review id is the user's, so a review arrives several times
    a day with other contents, and every third document twice as it is."""
    rows = raw_comments(spark, sf_dir)
    ev = table(spark, sf_dir, "events").select("event_id", "user_id")
    rows = rows.join(ev, rows["id"] == ev["event_id"]).withColumn("id", F.col("user_id"))
    copies = F.when(F.col("event_id") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_copy", F.explode(copies)).select(*(c for c in rows.columns if c not in ("event_id", "user_id")))
