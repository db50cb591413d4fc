"""Table contracts and ``conform``: read a file with its own schema, then
bring it to the contract with ``try_cast`` so that type drift between
loads (a quantity written as double one day and as long the next, a
column missing from an older file) never fails the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


L, D, S = T.LongType(), T.DoubleType(), T.StringType()
DATE, TS, B, I = T.DateType(), T.TimestampType(), T.BooleanType(), T.IntegerType()

# Raw product document as landed by one run (date kept as text, parsed on clean).
RAW_PRODUCTS = _schema(
    ("id", L), ("name", S), ("short_description", S), ("price", D),
    ("list_price", L), ("discount", L), ("discount_rate", L),
    ("all_time_quantity_sold", L), ("inventory_status", S),
    ("stock_item_qty", L), ("stock_item_max_sale_qty", L), ("date", S),
)

# The ad-hoc copy job declares quantity as double and has no date column.
RAW_PRODUCTS_QTY_DOUBLE = _schema(
    ("id", L), ("name", S), ("short_description", S), ("price", D),
    ("list_price", L), ("discount", L), ("discount_rate", L),
    ("all_time_quantity_sold", D), ("inventory_status", S),
    ("stock_item_qty", L), ("stock_item_max_sale_qty", L),
)

# Raw review document; both instants are epoch seconds.
RAW_COMMENTS = _schema(
    ("id", L), ("product_id", L), ("title", S), ("content", S), ("rating", L),
    ("created_at", L), ("purchased_at", L), ("date", S),
)

# Cleaned product rows as stored in the raw table (date parsed).
CLEAN_PRODUCTS = _schema(
    ("id", L), ("name", S), ("short_description", S), ("price", D),
    ("list_price", L), ("discount", L), ("discount_rate", L),
    ("all_time_quantity_sold", L), ("inventory_status", S),
    ("stock_item_qty", L), ("stock_item_max_sale_qty", L), ("date", DATE),
)

CLEAN_COMMENTS = _schema(
    ("id", L), ("product_id", L), ("title", S), ("content", S), ("rating", L),
    ("created_at", TS), ("purchased_at", TS), ("date", DATE), ("sentiment", S),
    ("days_to_review", I), ("rating_valid", B), ("processing_date", S),
)

STG_PRODUCTS = _schema(
    ("product_id", S), ("product_name", S), ("product_description", S),
    ("product_price", D), ("product_list_price", L), ("product_discount", L),
    ("product_discount_rate", L), ("product_all_time_quantity_sold", L),
    ("product_inventory_status", S), ("product_stock_item_qty", L),
    ("product_stock_item_max_sale_qty", L), ("load_date", DATE),
)

STG_COMMENTS = _schema(
    ("comment_id", S), ("product_id", S), ("sentiment", S),
    ("comment_content", S), ("comment_rating", L), ("created_at", TS),
    ("purchased_at", TS), ("days_to_review", L), ("rating_valid", B),
    ("load_date", DATE),
)

DIM_PRODUCTS = _schema(
    ("product_id", S), ("product_name", S), ("product_description", S),
    ("product_inventory_status", S), ("effective_date", DATE),
    ("end_date", DATE), ("is_active", B),
)

DIM_COMMENTS = _schema(
    ("comment_id", S), ("product_id", S), ("sentiment", S),
    ("comment_content", S), ("comment_rating", L), ("created_at", TS),
    ("purchased_at", TS), ("days_to_review", L), ("rating_valid", B),
    ("effective_date", DATE), ("end_date", DATE), ("is_active", B),
)

# The four money columns are DOUBLE in the warehouse tables.
FACT_PRODUCTS = _schema(
    ("product_id", S), ("snapshot_date", DATE),
    ("product_all_time_quantity_sold", L), ("product_stock_item_qty", L),
    ("product_stock_item_max_sale_qty", L), ("product_price", D),
    ("product_list_price", D), ("product_discount", D),
    ("product_discount_rate", D),
)

FACT_COMMENTS = _schema(
    ("comment_id", S), ("product_id", S), ("comment_rating", L),
    ("days_to_review", L), ("comment_date", DATE), ("snapshot_date", DATE),
)


def _convert(c: Column, src: T.DataType, dst: T.DataType) -> Column:
    if src == dst:
        return c
    if isinstance(dst, T.DateType) and isinstance(src, T.StringType):
        return F.try_to_date(c, "yyyy-MM-dd")
    if isinstance(dst, T.TimestampType) and isinstance(src, (T.LongType, T.IntegerType)):
        return F.timestamp_seconds(c)
    return c.try_cast(dst)


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Project ``df`` onto ``contract``: same names and order, each column
    converted with a cast that yields NULL instead of failing; a column the
    input lacks becomes a typed NULL, extra input columns are pruned (and so
    never read from Parquet)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in contract.fields:
        if f.name in have:
            cols.append(_convert(F.col(f.name), have[f.name], f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def empty(spark, contract: T.StructType) -> DataFrame:
    """Typed empty table: the 'target does not exist yet' state, so a first
    run takes the same code path as every later one. Built as a filtered-out
    row so Catalyst sees an empty relation and prunes every branch that
    reads it (anti joins against it, unions with it)."""
    row = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in contract.fields])
    return row.where(F.lit(False))
