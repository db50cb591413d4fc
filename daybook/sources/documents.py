"""JSON documents -> rows: product pages, review pages, category listings
and the menu. A product or review document is parsed once, as a VARIANT, and its
fields are read as text and cast one by one, so a field of another JSON type ("12.5",
3.0, []) never costs its document: it keeps its value where that can be read
as the declared type, and is NULL otherwise. Absent keys and a NULL parent
give NULL fields. The same pass flags what it cannot read: ``ingest_products`` and
``ingest_reviews`` give the rows and the rejected documents, pages and reviews side
by side. Flattening is plain struct field
access and ``explode``. Document builders for the fixtures are here too; every
document they build holds a bounded number of entries (at most
``PAGE_SIZE``), however large a product, brand or site becomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.expressions import last_segment

L, D, S = T.LongType(), T.DoubleType(), T.StringType()

# Declared types of the flattened fields; documents are read as text.
PRODUCT_FIELDS = [("id", L), ("name", S), ("short_description", S), ("price", D), ("list_price", L), ("discount", L),
                  ("discount_rate", L), ("all_time_quantity_sold", L), ("inventory_status", S), ("date", S)]
STOCK_FIELDS = [("qty", L), ("max_sale_qty", L)]
REVIEW_FIELDS = [("id", L), ("product_id", L), ("title", S), ("content", S), ("rating", L), ("created_at", L), ("date", S)]
BUYER_FIELDS = [("purchased_at", L)]


def _as_text(fields: list[tuple[str, T.DataType]], *more: T.StructField) -> str:
    return T.StructType([*(T.StructField(n, S) for n, _ in fields), *more]).simpleString()


# Types as which the documents are read.
PRODUCT_DOC = _as_text(PRODUCT_FIELDS, T.StructField("stock_item", T.StructType([T.StructField(n, S) for n, _ in STOCK_FIELDS])))
REVIEW = _as_text(REVIEW_FIELDS, T.StructField("created_by", T.StructType([T.StructField(n, S) for n, _ in BUYER_FIELDS])))

#: The column of what could not be read.
REJECTED = "rejected"

LISTING = T.StructType([T.StructField("data", T.ArrayType(T.StructType([T.StructField("id", L)])))])

MENU = T.StructType([T.StructField("menu_block", T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([T.StructField("link", S)])))]))])

# Entries per built page document.
PAGE_SIZE = 1000


# ------------------------------------------------------------------ parsing

def _typed(text: Column, kind: T.DataType) -> Column:
    """The declared type of a field read as text; a whole-number field written
    as a decimal is cut to its whole part, as a cast of the number would."""
    if kind == S:
        return text
    if kind == L:
        return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))
    return text.try_cast(kind)


def _fields(parent: str, fields: list[tuple[str, T.DataType]]) -> dict[str, Column]:
    return {n: _typed(F.col(f"{parent}.{n}"), t).alias(n) for n, t in fields}


def ingest_products(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """A row per product document: its columns, and ``rejected``: the text of a
    document that is no JSON object (its other columns are NULL), else NULL."""
    parsed = docs.select(F.col(doc_col).alias("doc"), F.try_variant_get(F.try_parse_json(doc_col), "$", PRODUCT_DOC).alias("p"))
    out = _fields("p", PRODUCT_FIELDS)
    date = out.pop("date")
    return parsed.select(*out.values(), *(c.alias(f"stock_item_{n}") for n, c in _fields("p.stock_item", STOCK_FIELDS).items()),
                         date, F.when(F.col("p").isNull(), F.coalesce("doc", F.lit(""))).alias(REJECTED))


def ingest_reviews(pages: DataFrame, doc_col: str = "doc") -> DataFrame:
    """A row per review of the pages ``{data: [review, ...]}``, and one per rejected
    page (no readable ``data`` array) or review (no object): ``rejected`` holds its text and
    ``rejected_kind`` page or review, both NULL for the others."""
    data = F.try_variant_get(F.try_parse_json(doc_col), "$.data", "array<variant>")
    entries = (pages.select(F.col(doc_col).alias("doc"), data.alias("data"))
               .select("doc", F.col("data").isNull().alias("bad"), F.explode_outer("data").alias("e")).where("bad OR e IS NOT NULL"))
    r = entries.select("doc", "bad", "e", F.try_variant_get("e", "$", REVIEW).alias("r"))
    out = _fields("r", REVIEW_FIELDS)
    date = out.pop("date")
    kind = F.when(F.col("bad"), "page").when(F.col("r").isNull(), "review")
    text = F.when(F.col("bad"), F.coalesce("doc", F.lit(""))).when(F.col("r").isNull(), F.to_json("e"))
    return r.select(*out.values(), *_fields("r.created_by", BUYER_FIELDS).values(), date,
                    text.alias(REJECTED), kind.alias("rejected_kind"))


def accepted(ingested: DataFrame) -> DataFrame:
    return ingested.where(F.col(REJECTED).isNull()).drop(REJECTED, "rejected_kind")


def flatten_products(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """One row per product document that is a JSON object, whatever its fields' types."""
    return accepted(ingest_products(docs, doc_col))


def rejected_products(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """The product documents that ``flatten_products`` cannot read."""
    return ingest_products(docs, doc_col).where(F.col(REJECTED).isNotNull()).select(F.col(REJECTED).alias("doc"))


def flatten_reviews(pages: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Review pages ``{data: [review, ...]}`` -> one row per review, all
    pages appended."""
    return accepted(ingest_reviews(pages, doc_col))


def rejected_pages(pages: DataFrame, doc_col: str = "doc") -> DataFrame:
    """The review pages without a readable ``data`` array."""
    return ingest_reviews(pages, doc_col).where(F.col("rejected_kind") == "page").select(F.col(REJECTED).alias("doc"))


def explode_listing(listings: DataFrame, doc_col: str = "doc",
                    keep: list[str] | None = None) -> DataFrame:
    """Listing ``{data: [{id}, ...]}`` -> one product id per entry, entries
    without an id skipped, no dedupe (a product listed twice stays twice).
    ``position`` is the entry's place in its document."""
    keep = keep or []
    e = listings.select(*keep, F.posexplode(F.from_json(doc_col, LISTING).getField("data")).alias("position", "e"))
    return e.where(F.col("e.id").isNotNull()).select(*keep, "position", F.col("e.id").alias("product_id"))


def menu_categories(menus: DataFrame, doc_col: str = "doc", sep: str = "/c") -> DataFrame:
    """Menu ``{menu_block: {items: [{link}]}}`` -> category id = text after
    the last ``sep`` of each link."""
    items = menus.select(F.explode(F.from_json(doc_col, MENU).getField("menu_block").getField("items")).alias("i"))
    return items.select(F.col("i.link").alias("link"), last_segment(F.col("i.link"), sep).alias("category_id"))


# ------------------------------------------------------ fixture documents

def product_docs(raw: DataFrame) -> DataFrame:
    """One JSON document per raw product row; the nested stock object is
    NULL for every 37th id (absent parent)."""
    stock = F.when(F.col("id") % 37 == 0, F.lit(None)).otherwise(
        F.struct(F.col("stock_item_qty").alias("qty"), F.col("stock_item_max_sale_qty").alias("max_sale_qty")))
    return raw.select(F.to_json(F.struct(
        "id", "name", "short_description", "price", "list_price", "discount", "discount_rate",
        "all_time_quantity_sold", "inventory_status", stock.alias("stock_item"), "date")).alias("doc"))


def product_docs_drift(raw: DataFrame) -> DataFrame:
    """``product_docs`` of mixed types, by id: prices as text, quantities as decimals,
    an array for a quantity and text for the stock object; every 41st document is cut
    short and every 43rd wrapped in an array."""
    fields = ["id", "name", "short_description", "price", "list_price", "discount", "discount_rate",
              "all_time_quantity_sold", "inventory_status"]
    stock = F.struct(F.col("stock_item_qty").alias("qty"), F.col("stock_item_max_sale_qty").alias("max_sale_qty"))

    def doc(stock_item: Column = stock, **other: Column) -> Column:
        return F.to_json(F.struct(*(other.get(c, F.col(c)).alias(c) for c in fields), stock_item.alias("stock_item"), "date"))

    kind = F.col("id") % 5
    whole = (F.when(kind == 1, doc(price=F.col("price").cast("string")))
             .when(kind == 2, doc(all_time_quantity_sold=F.col("all_time_quantity_sold").cast("double")))
             .when(kind == 3, doc(F.lit("none"), all_time_quantity_sold=F.array().cast("array<int>"))).otherwise(doc()))
    return raw.select("id", whole.alias("doc")).select(
        F.when(F.col("id") % 41 == 0, F.expr("substring(doc, 1, length(doc) - 7)"))
        .when(F.col("id") % 43 == 0, F.concat(F.lit("["), "doc", F.lit("]"))).otherwise(F.col("doc")).alias("doc"))


def review_pages_drift(raw_comments: DataFrame) -> DataFrame:
    """``review_pages`` of mixed types, by id: ratings as text, epochs as decimals; every
    47th review is a bare number, and the pages of every 17th product are cut short."""
    created_by = F.when(F.col("purchased_at").isNotNull(), F.struct("purchased_at"))

    def review(**other: Column) -> Column:
        fields = ["id", "product_id", "title", "content", "rating", "created_at"]
        return F.to_json(F.struct(*(other.get(c, F.col(c)).alias(c) for c in fields), created_by.alias("created_by"), "date"))

    kind = F.col("id") % 5
    entry = (F.when(F.col("id") % 47 == 0, F.col("id").cast("string"))
             .when(kind == 1, review(rating=F.col("rating").cast("string")))
             .when(kind == 2, review(created_at=F.col("created_at").cast("double"))).otherwise(review()))
    pages = (raw_comments.groupBy("product_id", F.floor(F.col("id") / PAGE_SIZE).alias("page"))
             .agg(F.array_sort(F.collect_list(F.struct(F.col("id").alias("k"), entry.alias("e")))).alias("entries")))
    doc = F.concat(F.lit('{"data":['), F.array_join(F.transform("entries", lambda x: x["e"]), ","), F.lit("]}"))
    cut = F.when(F.col("product_id") % 17 == 0, F.expr("substring(doc, 1, length(doc) - 2)")).otherwise(F.col("doc"))
    return pages.select("product_id", "page", doc.alias("doc")).withColumn("doc", cut)


def _page_doc(df: DataFrame, group: list[Column], element: Column, sort_key: Column, wrap) -> DataFrame:
    """Group rows into page documents of bounded size: the page number is
    part of the grouping key, so no page exceeds PAGE_SIZE entries."""
    g = df.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct(sort_key.alias("k"), element.alias("e"))))
                               .alias("entries"))
    return g.select(*[c for c in g.columns if c != "entries"],
                    F.to_json(wrap(F.transform("entries", lambda x: x["e"]))).alias("doc"))


def review_pages(raw_comments: DataFrame) -> DataFrame:
    """Review pages per (product, id block); ``created_by`` is absent when
    the purchase time is unknown."""
    created_by = F.when(F.col("purchased_at").isNull(), F.lit(None)).otherwise(
        F.struct(F.col("purchased_at").alias("purchased_at")))
    review = F.struct("id", "product_id", "title", "content", "rating", "created_at",
                      created_by.alias("created_by"), "date")
    return _page_doc(raw_comments, [F.col("product_id"), F.floor(F.col("id") / PAGE_SIZE).alias("page")],
                     review, F.col("id"), lambda arr: F.struct(arr.alias("data")))


def listing_docs(part: DataFrame) -> DataFrame:
    """Category listings: one per (brand, key block) with entries in key
    order; parts of size above 45 are listed without an id."""
    entry = F.struct(F.when(F.col("p_size") > 45, F.lit(None)).otherwise(F.col("p_partkey")).alias("id"))
    return _page_doc(part, [F.col("p_brand").alias("category"),
                            F.floor(F.col("p_partkey") / PAGE_SIZE).alias("page")],
                     entry, F.col("p_partkey"), lambda arr: F.struct(arr.alias("data")))


def menu_docs(pages: DataFrame) -> DataFrame:
    """Menus: links ``<url>/c<page_id>`` in blocks of page ids."""
    link = F.struct(F.concat(F.col("url"), F.lit("/c"), F.col("page_id").cast("string")).alias("link"))
    return _page_doc(pages, [F.floor(F.col("page_id") / PAGE_SIZE).alias("block")], link,
                     F.col("page_id"),
                     lambda arr: F.struct(F.struct(arr.alias("items")).alias("menu_block")))
