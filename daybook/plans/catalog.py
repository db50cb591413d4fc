"""Catalog of named queries: each is a Spark plan over the provided tables
plus (where SQL can say it) the DuckDB oracle that must give the same rows.

Every query reads the whole tables; a LIMIT appears only where a prefix is
the feature (``first_n_ids``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import quality as Q
from daybook.operators import report_states as RS
from daybook.operators import asof as AS
from daybook.operators import scd2 as S
from daybook.operators import checks as CH
from daybook.operators import clean as C
from daybook.operators import facts as FA
from daybook.operators.upsert import gate, not_yet_loaded
from daybook.functions import expressions as X
from daybook.operators import staging as ST
from daybook.operators import topk as TK
from daybook.plans import oracle as O
from daybook.plans import daily as PL
from daybook.session import scratch_path
from daybook.sinks import bucketed as BK
from daybook.sinks import tables as SK
from daybook.sources import contracts as K
from daybook.sources import csv_infer as CI
from daybook.sources import days as DAYS
from daybook.sources import documents as DOC
from daybook.sources import readers as RD
from daybook.streaming import event_time as EV
from daybook.streaming import landing_stream as STR
from daybook.plans.model import Warehouse
from daybook.sources import fixtures as FX
from daybook.sources.tables import table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, stored: bool = False):
    """Register a query. ``stored``: the staged inputs are read several
    times, so they are materialized once like the stored tables they are."""
    def reg(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(Warehouse(spark, sf_dir, stored=stored))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return reg


# ---------------------------------------------------------------- reviews job

@query("clean_comments", O.CLEAN_COMMENTS)
def q_clean_comments(w: Warehouse) -> DataFrame:
    return w.clean_comments


@query("sentiment_distribution",
       f"SELECT sentiment, CAST(count(*) AS BIGINT) AS count FROM ({O.CLEAN_COMMENTS}) c GROUP BY sentiment")
def q_sentiment_distribution(w: Warehouse) -> DataFrame:
    return Q.distribution(w.clean_comments, "sentiment")


@query("rating_distribution",
       f"SELECT rating, CAST(count(*) AS BIGINT) AS count FROM ({O.CLEAN_COMMENTS}) c GROUP BY rating ORDER BY rating")
def q_rating_distribution(w: Warehouse) -> DataFrame:
    return Q.distribution(w.clean_comments, "rating", by_count=False)


@query("comments_quality_summary", f"""
SELECT CAST(count(*) AS BIGINT) AS total_records,
  CAST(count(*) FILTER (WHERE rating_valid) AS BIGINT) AS valid_ratings,
  round(count(*) FILTER (WHERE rating_valid) / count(*), 4) AS valid_share,
  CAST(count(*) FILTER (WHERE content = 'unknown') AS BIGINT) AS unknown_content
FROM ({O.CLEAN_COMMENTS}) c""")
def q_comments_quality_summary(w: Warehouse) -> DataFrame:
    return Q.comments_summary(w.clean_comments)


# --------------------------------------------------------------- product job

@query("clean_products", O.CLEAN_PRODUCTS_ONE_RUN)
def q_clean_products(w: Warehouse) -> DataFrame:
    # All documents as one run: the same id arrives up to 7 times.
    return C.clean_products(w.raw_products)


@query("fill_defaults", f"""
SELECT id, name, coalesce(short_description, '') AS short_description,
  coalesce(price, 0.0) AS price, coalesce(list_price, 0) AS list_price,
  coalesce(discount, 0) AS discount, coalesce(discount_rate, 0) AS discount_rate,
  coalesce(all_time_quantity_sold, 0) AS all_time_quantity_sold,
  coalesce(inventory_status, 'unknown') AS inventory_status,
  coalesce(stock_item_qty, 0) AS stock_item_qty,
  coalesce(stock_item_max_sale_qty, 0) AS stock_item_max_sale_qty, date
FROM ({O.CLEAN_PRODUCTS_ONE_RUN}) c""")
def q_fill_defaults(w: Warehouse) -> DataFrame:
    return C.fill_defaults(C.clean_products(w.raw_products))


_NULLS = ", ".join(f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS {c}" for c in
                   ["id", "name", "short_description", "price", "list_price", "discount",
                    "discount_rate", "all_time_quantity_sold", "inventory_status",
                    "stock_item_qty", "stock_item_max_sale_qty", "date"])


@query("null_counts", f"SELECT {_NULLS} FROM ({O.CLEAN_PRODUCTS_ONE_RUN}) c")
def q_null_counts(w: Warehouse) -> DataFrame:
    return Q.null_counts(C.clean_products(w.raw_products))


@query("price_stats", f"""
SELECT round(avg(price), 4) AS avg_price, min(price) AS min_price, max(price) AS max_price,
  round(stddev_samp(price), 4) AS stddev_price FROM ({O.CLEAN_PRODUCTS_ONE_RUN}) c""")
def q_price_stats(w: Warehouse) -> DataFrame:
    return Q.price_stats(C.clean_products(w.raw_products))


@query("sales_stats", f"""
SELECT CAST(sum(all_time_quantity_sold) AS BIGINT) AS total_sold,
  round(avg(all_time_quantity_sold), 4) AS avg_sold,
  max(all_time_quantity_sold) AS max_sold FROM ({O.CLEAN_PRODUCTS_ONE_RUN}) c""")
def q_sales_stats(w: Warehouse) -> DataFrame:
    return Q.sales_stats(C.clean_products(w.raw_products))


@query("inventory_distribution", f"""
SELECT inventory_status, CAST(count(*) AS BIGINT) AS count FROM ({O.CLEAN_PRODUCTS_ONE_RUN}) c
GROUP BY inventory_status ORDER BY count DESC, inventory_status NULLS FIRST""")
def q_inventory_distribution(w: Warehouse) -> DataFrame:
    return Q.distribution(C.clean_products(w.raw_products), "inventory_status")


@query("duplicate_ids", f"""
SELECT id, CAST(count(*) AS BIGINT) AS count FROM ({O.FX_PRODUCTS}) f
GROUP BY id HAVING count(*) > 1""")
def q_duplicate_ids(w: Warehouse) -> DataFrame:
    # Before the dedupe: ids sent in more than one document of the run.
    return Q.duplicate_keys(w.raw_products, ["id"])


@query("rule_violations", f"""
SELECT CAST(count(*) FILTER (WHERE price < 0 OR all_time_quantity_sold < 0) AS BIGINT) AS invalid_records,
  CAST(count(*) FILTER (WHERE price < 0) AS BIGINT) AS negative_price,
  CAST(count(*) FILTER (WHERE all_time_quantity_sold < 0) AS BIGINT) AS negative_quantity
FROM (SELECT * EXCLUDE (price, all_time_quantity_sold),
        CASE WHEN id % 31 = 0 THEN -price ELSE price END AS price,
        CASE WHEN id % 31 = 0 THEN -all_time_quantity_sold ELSE all_time_quantity_sold END AS all_time_quantity_sold
      FROM ({O.CLEAN_PRODUCTS_ONE_RUN}) c) n""")
def q_rule_violations(w: Warehouse) -> DataFrame:
    return Q.rule_violations(C.clean_products(FX.raw_products_negative(w.spark, w.sf_dir)))


# ------------------------------------------------------------------- staging

@query("stage_products", O.STG_PRODUCTS)
def q_stage_products(w: Warehouse) -> DataFrame:
    return w.stg_products


@query("stage_comments", O.STG_COMMENTS)
def q_stage_comments(w: Warehouse) -> DataFrame:
    return w.stg_comments


# ---------------------------------------------------------------------- SCD2

@query("scd2_products_as_written", O.DIM_PRODUCTS)
def q_scd2_products_as_written(w: Warehouse) -> DataFrame:
    return w.dim_products(S.AS_WRITTEN)


@query("scd2_products_strict", O.DIM_PRODUCTS_STRICT)
def q_scd2_products_strict(w: Warehouse) -> DataFrame:
    return w.dim_products(S.STRICT)


@query("scd2_comments_as_written", O.DIM_COMMENTS)
def q_scd2_comments_as_written(w: Warehouse) -> DataFrame:
    return w.dim_comments(S.AS_WRITTEN)


@query("scd2_comments_strict", O.DIM_COMMENTS_STRICT)
def q_scd2_comments_strict(w: Warehouse) -> DataFrame:
    return w.dim_comments(S.STRICT)


@query("scd2_active_rows", f"""
SELECT product_id, CAST(count(*) AS BIGINT) AS active_versions
FROM ({O.DIM_PRODUCTS}) d WHERE is_active AND end_date IS NULL GROUP BY product_id""")
def q_scd2_active_rows(w: Warehouse) -> DataFrame:
    d = w.dim_products(S.AS_WRITTEN)
    return (d.where(F.col("is_active") & F.col("end_date").isNull())
             .groupBy("product_id").agg(F.count(F.lit(1)).cast("bigint").alias("active_versions")))


# --------------------------------------------------------------------- facts

@query("fact_products", O.FACT_PRODUCTS)
def q_fact_products(w: Warehouse) -> DataFrame:
    return w.fact_products


@query("fact_comments", O.FACT_COMMENTS)
def q_fact_comments(w: Warehouse) -> DataFrame:
    return w.fact_comments


# --------------------------------------------------- incremental (one batch)

def _prior_and_last(w: Warehouse):
    return w.before_last_batch(w.stg_products)


@query("incremental_gate", O.INCREMENTAL_GATE, stored=True)
def q_incremental_gate(w: Warehouse) -> DataFrame:
    prior, _ = _prior_and_last(w)
    target = S.scd2_history(prior, S.PRODUCTS)
    return gate(w.stg_products, target, "load_date", "effective_date", inclusive=True)


@query("new_rows_anti_join", O.NEW_ROWS_ANTI_JOIN, stored=True)
def q_new_rows_anti_join(w: Warehouse) -> DataFrame:
    prior, _ = _prior_and_last(w)
    target = S.scd2_history(prior, S.PRODUCTS)
    b = gate(w.stg_products, target, "load_date", "effective_date", inclusive=True)
    return not_yet_loaded(b, target, "product_id", "load_date", "effective_date")


@query("keyed_upsert", O.DIM_PRODUCTS, stored=True)
def q_keyed_upsert(w: Warehouse) -> DataFrame:
    """History of all batches but the newest, then the newest merged in as a
    daily increment: must equal the one-job history of all batches."""
    prior, last = _prior_and_last(w)
    return S.scd2_apply(S.scd2_history(prior, S.PRODUCTS), last, S.PRODUCTS, S.AS_WRITTEN)


@query("scd2_apply_strict", O.DIM_PRODUCTS_STRICT, stored=True)
def q_scd2_apply_strict(w: Warehouse) -> DataFrame:
    prior, last = _prior_and_last(w)
    return S.scd2_apply(S.scd2_history(prior, S.PRODUCTS, S.STRICT), last, S.PRODUCTS, S.STRICT)


# -------------------------------------------------------------------- as-of

@query("asof_dim_join", O.ASOF_DIM_JOIN)
def q_asof_dim_join(w: Warehouse) -> DataFrame:
    """Each line item with the product version valid on its ship date."""
    li = table(w.spark, w.sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("ship_date"))
    dim = w.dim_products(S.STRICT).select(
        F.col("product_id").cast("bigint").alias("pk"), "effective_date", "end_date",
        "product_inventory_status")
    j = FA.asof_join(li, dim, "l_partkey", "pk", "ship_date")
    return j.select("f.l_orderkey", "f.l_linenumber", "f.l_partkey", "f.ship_date",
                    "d.effective_date", "d.end_date", "d.product_inventory_status")


@query("asof_carry_join", O.ASOF_DIM_JOIN)
def q_asof_carry_join(w: Warehouse) -> DataFrame:
    """The same rows without pairs of facts and versions: versions and facts in one
    sorted sequence of each key and block of days."""
    li = table(w.spark, w.sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("ship_date"))
    dim = w.dim_products(S.STRICT).select("product_id", "effective_date", "end_date", "product_inventory_status")
    j = AS.asof_carry(li, dim, "l_partkey", "product_id", "ship_date")
    return j.select(*li.columns, "version.effective_date", "version.end_date", "version.product_inventory_status")


# --------------------------------------------------------------- data tests

@query("check_not_null", O.CHECK_NOT_NULL, stored=True)
def q_check_not_null(w: Warehouse) -> DataFrame:
    return CH.union_all([
        CH.check_not_null(w.stg_products, "stg_products", ["product_id", "product_name", "load_date"]),
        CH.check_not_null(w.stg_comments, "stg_comments", ["comment_id", "product_id", "load_date"]),
        CH.check_not_null(w.dim_products(), "dim_products",
                          ["product_id", "effective_date", "is_active", "product_name"]),
        CH.check_not_null(w.dim_comments(history=False), "dim_comments",
                          ["comment_id", "product_id", "comment_content", "comment_rating"]),
        CH.check_not_null(w.fact_comments, "fact_comments", ["comment_id"]),
    ])


@query("check_relationships", O.CHECK_RELATIONSHIPS, stored=True)
def q_check_relationships(w: Warehouse) -> DataFrame:
    return CH.union_all([
        CH.check_relationship(w.stg_comments, w.stg_products, "stg_comments", "product_id", "product_id"),
        CH.check_relationship(w.dim_comments(history=False), w.dim_products(), "dim_comments",
                              "product_id", "product_id"),
    ])


@query("check_unique", O.CHECK_UNIQUE, stored=True)
def q_check_unique(w: Warehouse) -> DataFrame:
    return CH.union_all([
        CH.check_unique(w.stg_products, "stg_products", ["product_id", "load_date"]),
        CH.check_unique(w.stg_comments, "stg_comments", ["comment_id", "load_date"]),
        CH.check_unique(w.dim_products(), "dim_products", ["product_id", "effective_date"]),
        CH.check_unique(w.dim_comments(history=False), "dim_comments", ["comment_id", "effective_date"]),
        CH.check_unique(w.fact_products, "fact_products", ["product_id", "snapshot_date"]),
        CH.check_unique(w.fact_comments, "fact_comments", ["comment_id", "snapshot_date"]),
    ])


@query("check_tables_one_scan", f"{O.CHECK_NOT_NULL} UNION ALL {O.CHECK_UNIQUE}", stored=True)
def q_check_tables_one_scan(w: Warehouse) -> DataFrame:
    """Not-null and uniqueness tests of every table, each table scanned once."""
    def test(df: DataFrame, name: str, not_null: list[str], key: str, day: str) -> DataFrame:
        return CH.check_table(df, name, not_null=not_null, unique=[[key, day]])

    return CH.union_all([
        test(w.stg_products, "stg_products", ["product_id", "product_name", "load_date"], "product_id", "load_date"),
        test(w.stg_comments, "stg_comments", ["comment_id", "product_id", "load_date"], "comment_id", "load_date"),
        test(w.dim_products(), "dim_products", ["product_id", "effective_date", "is_active", "product_name"],
             "product_id", "effective_date"),
        test(w.dim_comments(history=False), "dim_comments",
             ["comment_id", "product_id", "comment_content", "comment_rating"], "comment_id", "effective_date"),
        test(w.fact_products, "fact_products", [], "product_id", "snapshot_date"),
        test(w.fact_comments, "fact_comments", ["comment_id"], "comment_id", "snapshot_date"),
    ])


@query("check_unique_key_sets", O.CHECK_UNIQUE_KEY_SETS, stored=True)
def q_check_unique_key_sets(w: Warehouse) -> DataFrame:
    """Several key sets of one table at once: with the day, the day's products alone,
    the name on a day, the key alone."""
    return CH.check_unique(w.stg_products, "stg_products", ["product_id", "load_date"], ["product_id"],
                           ["product_name", "load_date"], ["load_date"])


@query("check_scd2_invariants", O.CHECK_SCD2_INVARIANTS, stored=True)
def q_check_scd2_invariants(w: Warehouse) -> DataFrame:
    return CH.union_all([
        CH.check_one_active(w.dim_products(), "dim_products", "product_id"),
        CH.check_one_active(w.dim_products(S.STRICT), "dim_products_strict", "product_id"),
        CH.check_one_active(w.dim_comments(S.STRICT), "dim_comments_strict", "comment_id"),
        CH.check_validity(w.dim_products(), "dim_products"),
        CH.check_validity(w.dim_products(S.STRICT), "dim_products_strict"),
        CH.check_validity(w.dim_comments(), "dim_comments"),
        CH.check_accepted(w.stg_comments, "stg_comments", "sentiment", X.SENTIMENTS),
    ])


# ------------------------------------------------------------------- ingest

@query("json_flatten_products", O.JSON_FLATTEN_PRODUCTS)
def q_json_flatten_products(w: Warehouse) -> DataFrame:
    return DOC.flatten_products(DOC.product_docs(w.raw_products))


@query("json_flatten_comments", O.JSON_FLATTEN_COMMENTS)
def q_json_flatten_comments(w: Warehouse) -> DataFrame:
    return DOC.flatten_reviews(DOC.review_pages(w.raw_comments))


@query("json_flatten_products_drift", O.JSON_FLATTEN_PRODUCTS_DRIFT)
def q_json_flatten_products_drift(w: Warehouse) -> DataFrame:
    return DOC.flatten_products(DOC.product_docs_drift(w.raw_products))


@query("json_flatten_comments_drift", O.JSON_FLATTEN_COMMENTS_DRIFT)
def q_json_flatten_comments_drift(w: Warehouse) -> DataFrame:
    return DOC.flatten_reviews(DOC.review_pages_drift(w.raw_comments))


@query("json_rejects", O.JSON_REJECTS)
def q_json_rejects(w: Warehouse) -> DataFrame:
    """Documents landed in one pass each, the rejected ones counted where they lie."""
    root = scratch_path(w.spark, "ingest")
    products = SK.land_ingested(DOC.ingest_products(DOC.product_docs_drift(w.raw_products)), f"{root}/products")
    reviews = SK.land_ingested(DOC.ingest_reviews(DOC.review_pages_drift(w.raw_comments)), f"{root}/comments")
    kinds = SK.rejects(products).select(F.lit("product").alias("kind")).unionByName(
        SK.rejects(reviews).select(F.col("rejected_kind").alias("kind")))
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).cast("bigint").alias("rejected"))


def _listing(w: Warehouse) -> DataFrame:
    docs = DOC.listing_docs(table(w.spark, w.sf_dir, "part"))
    return DOC.explode_listing(docs, keep=["category", "page"])


@query("json_explode_listing", O.JSON_EXPLODE_LISTING)
def q_json_explode_listing(w: Warehouse) -> DataFrame:
    return _listing(w).select("category", "position", "product_id")


@query("first_n_ids", O.FIRST_N_IDS)
def q_first_n_ids(w: Warehouse) -> DataFrame:
    """The first 100 listed ids in listing order (the prefix is the feature:
    a crawl budget). Runs as a per-task top-N merged once."""
    return (_listing(w).orderBy("category", "page", "position").limit(100)
                       .select("category", "position", "product_id"))


@query("link_last_segment", O.LINK_LAST_SEGMENT)
def q_link_last_segment(w: Warehouse) -> DataFrame:
    p = table(w.spark, w.sf_dir, "pages")
    return p.select("page_id", "url", X.last_segment("url", "/").alias("segment"))


@query("menu_category_ids", O.MENU_CATEGORY_IDS)
def q_menu_category_ids(w: Warehouse) -> DataFrame:
    return DOC.menu_categories(DOC.menu_docs(table(w.spark, w.sf_dir, "pages").select("page_id", "url")))


@query("csv_to_parquet_landing", O.CSV_TO_PARQUET_LANDING)
def q_csv_to_parquet_landing(w: Warehouse) -> DataFrame:
    """Conversation text (with newlines, quotes, edge spaces) -> CSV ->
    multiLine CSV read -> Parquet landing folder named by run stamp -> read."""
    conv = table(w.spark, w.sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    root = scratch_path(w.spark, "landing")
    SK.write_csv(conv, f"{root}/csv/conversations")
    back = SK.read_csv(w.spark, f"{root}/csv/conversations", conv.schema)
    path = SK.write_landing(back, root, "conversations", "20240130_000000")
    return w.spark.read.parquet(path)


def _orders(w: Warehouse) -> DataFrame:
    return table(w.spark, w.sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                     F.to_date("o_orderdate").alias("o_orderdate"))


@query("csv_infer_roundtrip", O.CSV_INFER_ROUNDTRIP)
def q_csv_infer_roundtrip(w: Warehouse) -> DataFrame:
    """Orders to CSV; types inferred from a fifth of the rows, stored as a contract, and
    every row read under it."""
    root = scratch_path(w.spark, "csv-infer")
    SK.write_csv(_orders(w), f"{root}/csv")
    CI.save_contract(w.spark, CI.infer(CI.read_text(w.spark, f"{root}/csv"), sample=0.2), f"{root}/contract")
    typed = CI.read_typed(w.spark, f"{root}/csv", CI.load_contract(w.spark, f"{root}/contract"))
    return SK.rows(SK.land_ingested(typed, f"{root}/landed"))


@query("csv_rejects", O.CSV_REJECTS)
def q_csv_rejects(w: Warehouse) -> DataFrame:
    """Every 97th price is no number and every 89th date no day: under the contract of
    the clean file these rows are kept apart and counted."""
    root = scratch_path(w.spark, "csv-rejects")
    orders = _orders(w)
    dirty = orders.withColumns({
        "o_totalprice": F.when(F.col("o_orderkey") % 97 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")),
        "o_orderdate": F.when(F.col("o_orderkey") % 89 == 0, F.lit("soon")).otherwise(F.col("o_orderdate").cast("string"))})
    SK.write_csv(dirty, f"{root}/csv")
    landed = SK.land_ingested(CI.read_typed(w.spark, f"{root}/csv", orders.schema), f"{root}/landed")
    key = F.when(~F.col("is_rejected"), F.col("o_orderkey"))
    return landed.agg(F.count(F.lit(1)).cast("bigint").alias("total_rows"),
                      F.count_if("is_rejected").cast("bigint").alias("rejected"), F.sum(key).alias("accepted_keys"))


@query("backfill_scattered_days", O.BACKFILL_SCATTERED_DAYS)
def q_backfill_scattered_days(w: Warehouse) -> DataFrame:
    """The even years' days out of a raw table of two runs: a day table prunes its folders
    while the query runs."""
    root = scratch_path(w.spark, "scattered")
    clean = w.clean_products_by_day
    for k in range(2):
        SK.append_run(clean.where(F.col("id") % 2 == k), f"{root}/raw", f"run{k}")
    raw = w.spark.read.schema(K.CLEAN_PRODUCTS).parquet(f"{root}/raw")
    days = [f"{y}-12-31" for y in range(1970, 2100, 2)]
    rows = DAYS.of_days(raw, DAYS.write_days(w.spark, f"{root}/days", days))
    return rows.select(F.col("id").cast("string").alias("product_id"), "price", F.col("date").alias("day"))


@query("topk_comments_per_product", O.TOPK_COMMENTS_PER_PRODUCT)
def q_topk_comments_per_product(w: Warehouse) -> DataFrame:
    raw = FX.raw_comments(w.spark, w.sf_dir, with_score=True).where(F.col("product_id").isNotNull())
    return TK.top_k_per_group(raw, ["product_id"], [F.desc("score"), F.desc("id")], 5, "rank") \
             .select("product_id", "id", "score", "rank")


@query("type_drift_read", O.TYPE_DRIFT_READ)
def q_type_drift_read(w: Warehouse) -> DataFrame:
    """Two landed runs whose quantity column differs in type (long, then
    double) read each with its own schema and conformed to one contract."""
    raw = w.raw_products
    root = scratch_path(w.spark, "drift")
    early = SK.write_landing(raw.where(F.col("date") < "1999"), root, "products", "a")
    late = SK.write_landing(raw.where(F.col("date") >= "1999").withColumn(
        "all_time_quantity_sold", F.col("all_time_quantity_sold").cast("double")), root, "products", "b")
    return RD.read_landed(w.spark, [early, late], K.RAW_PRODUCTS)


# ----------------------------------------------------- layout and pipeline

@query("partitioned_overwrite_roundtrip", O.FACT_PRODUCTS)
def q_partitioned_overwrite_roundtrip(w: Warehouse) -> DataFrame:
    """Write the fact partitioned by snapshot date and clustered by product,
    append a stale copy of the newest partition, then re-run only that
    partition with dynamic overwrite: it is replaced and every other
    partition survives untouched."""
    root = scratch_path(w.spark, "fact")
    fact = w.fact_products
    last = fact.agg(F.max("snapshot_date")).scalar()
    SK.write_clustered(fact.where(F.col("snapshot_date") < last), root, "snapshot_date", "product_id")
    stale = fact.where(F.col("snapshot_date") == last).withColumn(
        "product_all_time_quantity_sold", F.lit(0).cast("bigint"))
    SK.append_partitioned(stale, root, "snapshot_date")
    SK.overwrite_partitions(fact.where(F.col("snapshot_date") == last), root, "snapshot_date")
    return K.conform(w.spark.read.schema(K.FACT_PRODUCTS).parquet(root), K.FACT_PRODUCTS)


@query("raw_append_two_batches", O.CLEAN_PRODUCTS_BY_DAY)
def q_raw_append_two_batches(w: Warehouse) -> DataFrame:
    """Two batches of the same days appended to the raw table, the second one
    run twice: every row of both is there once."""
    root = scratch_path(w.spark, "raw")
    clean, even = w.clean_products_by_day, F.col("id") % 2 == 0
    SK.append_run(clean.where(even), root, "a")
    for _ in range(2):
        SK.append_run(clean.where(~even), root, "b")
    return K.conform(w.spark.read.schema(K.CLEAN_PRODUCTS).parquet(root), K.CLEAN_PRODUCTS)


BUCKETS = 8


def _bucketed(w: Warehouse, name: str, spec: BK.TableSpec, rows: DataFrame) -> DataFrame:
    """``rows`` in a bucketed table of this session, stored in the shared folder."""
    path = scratch_path(w.spark, name)
    table_name = f"{name}_{path.rsplit('-', 1)[-1]}"
    BK.create(w.spark, table_name, spec, BUCKETS, path)
    BK.append(rows, table_name, spec, BUCKETS)
    return w.spark.table(table_name)


@query("bucketed_dim_join", O.BUCKETED_DIM_JOIN, stored=True)
def q_bucketed_dim_join(w: Warehouse) -> DataFrame:
    """Product snapshots with the version in force on their day, from two tables in
    equal buckets of the product: no row is dealt for the join."""
    dim = _bucketed(w, "dim_products", BK.DIM_PRODUCTS, w.dim_products(S.STRICT))
    fact = _bucketed(w, "fact_products", BK.FACT_PRODUCTS, w.fact_products)
    # Merged, not broadcast: a broadcast would ship the dimension.
    joined = FA.asof_join(fact.hint("merge"), dim, "product_id", "product_id", "snapshot_date")
    return joined.select("f.product_id", "f.snapshot_date", "f.product_price", "d.effective_date", "d.product_inventory_status")


@query("bucketed_reviews_per_product", O.BUCKETED_REVIEWS_PER_PRODUCT, stored=True)
def q_bucketed_reviews_per_product(w: Warehouse) -> DataFrame:
    """Reviews counted by product in place: the buckets are the groups' partitions."""
    fact = _bucketed(w, "fact_comments", BK.FACT_COMMENTS, w.fact_comments)
    return fact.groupBy("product_id").agg(F.count(F.lit(1)).cast("bigint").alias("reviews"), F.max("snapshot_date").alias("last_day"))


def _backfill(w: Warehouse) -> PL.DailyWarehouse:
    return PL.backfill(w.spark, scratch_path(w.spark, "backfill"), w.raw_products, w.raw_comments)


@query("backfill_dim_products", O.DIM_PRODUCTS)
def q_backfill_dim_products(w: Warehouse) -> DataFrame:
    """The stored product dimension after a catch-up run over all days."""
    return _backfill(w).dim_products.read()


@query("backfill_dim_comments", O.DIM_COMMENTS_STG)
def q_backfill_dim_comments(w: Warehouse) -> DataFrame:
    return _backfill(w).dim_comments.read()


@query("backfill_fact_comments", O.FACT_COMMENTS)
def q_backfill_fact_comments(w: Warehouse) -> DataFrame:
    return _backfill(w).fact_comments()


@query("backfill_row_counts", O.DAILY_ROW_COUNTS)
def q_backfill_row_counts(w: Warehouse) -> DataFrame:
    """All load days caught up in one backfill run: the stored tables must
    hold the same rows as after the day-by-day runs."""
    return _backfill(w).row_counts()


#: Roots of the warehouses that were run day by day, by application and inputs: the
#: queries below read one stored warehouse.
_DAILY: dict[tuple[str, str], str] = {}


def _daily(w: Warehouse) -> PL.DailyWarehouse:
    """Every load day run through the daily pipeline in date order (land,
    clean, append, stage, SCD2 merge, facts, tests)."""
    key = (w.spark.sparkContext.applicationId, w.sf_dir)
    if key not in _DAILY:
        root = scratch_path(w.spark, "warehouse")
        PL.run_days(w.spark, root, w.raw_products, w.raw_comments)
        _DAILY[key] = root
    return PL.DailyWarehouse(w.spark, _DAILY[key])


@query("daily_runs_row_counts", O.DAILY_ROW_COUNTS)
def q_daily_runs_row_counts(w: Warehouse) -> DataFrame:
    """Rows per stored table after all days."""
    return _daily(w).row_counts()


@query("daily_dim_products", O.DIM_PRODUCTS)
def q_daily_dim_products(w: Warehouse) -> DataFrame:
    """The whole product dimension after all days."""
    return _daily(w).dim_products.read()


@query("daily_dim_comments", O.DIM_COMMENTS_STG)
def q_daily_dim_comments(w: Warehouse) -> DataFrame:
    return _daily(w).dim_comments.read()


@query("daily_fact_comments", O.FACT_COMMENTS)
def q_daily_fact_comments(w: Warehouse) -> DataFrame:
    return _daily(w).fact_comments()


@query("daily_test_report", O.DAILY_TEST_REPORT)
def q_daily_test_report(w: Warehouse) -> DataFrame:
    """The stored tables' tests in the report of the last run."""
    tests = _daily(w).reports("tests")
    last = tests.agg(F.max("run_ts")).scalar()
    return (tests.where((F.col("run_ts") == last) & ~F.col("table_name").startswith("stg_"))
            .select("test", "table_name", "column_name", "failures"))


@query("landing_by_run_stamp", O.LANDING_BY_RUN_STAMP)
def q_landing_by_run_stamp(w: Warehouse) -> DataFrame:
    """Product runs landed under their run stamps (an hour past midnight of the load
    day); the stamps, which sort as text, choose the runs that are read."""
    root = scratch_path(w.spark, "landing")
    at = F.to_timestamp(F.concat("date", F.lit(" 01:00:00")))
    (w.raw_products.withColumn("run_ts", X.run_stamp(at)).write.partitionBy("run_ts").parquet(f"{root}/products"))
    whole = w.raw_products.schema.add("run_ts", "string")
    runs = w.spark.read.schema(whole).parquet(f"{root}/products").where(F.col("run_ts") >= "19950101_000000")
    return runs.groupBy("run_ts").agg(F.count(F.lit(1)).cast("bigint").alias("documents"), F.min("id").alias("first_id"))


def _first_days(w: Warehouse, n: int):
    """(rows of the first ``n`` load days, rows of the later days)."""
    days = w.stg_products.select("load_date").distinct()
    cut = days.where(F.col("load_date") <= days.orderBy("load_date").limit(n).agg(F.max("load_date")).scalar())
    early = w.stg_products.join(cut, "load_date", "left_semi")
    late = w.stg_products.join(cut, "load_date", "left_anti")
    return early, late


@query("scd2_merge_many_days", O.DIM_PRODUCTS, stored=True)
def q_scd2_merge_many_days(w: Warehouse) -> DataFrame:
    """History of the first three load days, then the other four merged as
    one multi-day batch in one job: must equal the full history."""
    early, late = _first_days(w, 3)
    return S.scd2_merge(S.scd2_history(early, S.PRODUCTS), late, S.PRODUCTS, S.AS_WRITTEN)


@query("scd2_merge_many_days_strict", O.DIM_PRODUCTS_STRICT, stored=True)
def q_scd2_merge_many_days_strict(w: Warehouse) -> DataFrame:
    early, late = _first_days(w, 3)
    return S.scd2_merge(S.scd2_history(early, S.PRODUCTS, S.STRICT), late, S.PRODUCTS, S.STRICT)


@query("scd2_merge_comments_many_days", O.DIM_COMMENTS, stored=True)
def q_scd2_merge_comments_many_days(w: Warehouse) -> DataFrame:
    """Same invariant on the review history, whose tracked columns include a
    nullable one (a change to or from NULL is not seen as a change)."""
    h = w.comment_history
    days = h.select("load_date").distinct()
    cut = days.orderBy("load_date").limit(10)
    early = h.join(cut, "load_date", "left_semi")
    late = h.join(cut, "load_date", "left_anti")
    return S.scd2_merge(S.scd2_history(early, S.COMMENTS), late, S.COMMENTS, S.AS_WRITTEN)


def _merged(w: Warehouse, contract, spec: S.Scd2Spec, parts: list[DataFrame], mode: str) -> DataFrame:
    """A stored dimension after merging ``parts`` one after another."""
    dim = SK.Scd2Store(w.spark, scratch_path(w.spark, "merged"), contract, spec)
    for part in parts:
        dim.merge(part, mode)
    return dim.read()


@query("scd2_merge_one_shuffle", O.DIM_PRODUCTS, stored=True)
def q_scd2_merge_one_shuffle(w: Warehouse) -> DataFrame:
    """The first three load days merged into an empty dimension, then the others as
    one batch, then all of them again: each merge deals the change log and the batch
    once by key. Must equal the full history."""
    return _merged(w, K.DIM_PRODUCTS, S.PRODUCTS, [*_first_days(w, 3), w.stg_products], S.AS_WRITTEN)


@query("scd2_merge_one_shuffle_strict", O.DIM_PRODUCTS_STRICT, stored=True)
def q_scd2_merge_one_shuffle_strict(w: Warehouse) -> DataFrame:
    return _merged(w, K.DIM_PRODUCTS, S.PRODUCTS, [*_first_days(w, 3)], S.STRICT)


def _history_parts(w: Warehouse, n: int) -> list[DataFrame]:
    """The review history in ``n`` parts of consecutive load days."""
    h = w.comment_history
    days = [r[0] for r in h.select("load_date").distinct().orderBy("load_date").collect()]
    cuts = [days[len(days) * k // n] for k in range(1, n)]
    edges = [None, *cuts, None]
    return [h.where((F.lit(True) if lo is None else F.col("load_date") >= F.lit(lo))
                    & (F.lit(True) if hi is None else F.col("load_date") < F.lit(hi)))
            for lo, hi in zip(edges, edges[1:])]


@query("scd2_merge_one_shuffle_comments", O.DIM_COMMENTS, stored=True)
def q_scd2_merge_one_shuffle_comments(w: Warehouse) -> DataFrame:
    """The review history in four merges: changes to and from NULL go unseen."""
    return _merged(w, K.DIM_COMMENTS, S.COMMENTS, _history_parts(w, 4), S.AS_WRITTEN)


@query("scd2_merge_one_shuffle_comments_strict", O.DIM_COMMENTS_STRICT, stored=True)
def q_scd2_merge_one_shuffle_comments_strict(w: Warehouse) -> DataFrame:
    return _merged(w, K.DIM_COMMENTS, S.COMMENTS, _history_parts(w, 4), S.STRICT)


# ---------------------------------------------------------------- streaming

@query("stream_scd2_available_now", O.DIM_PRODUCTS)
def q_stream_scd2_available_now(w: Warehouse) -> DataFrame:
    """Product documents landed day by day, consumed as a file stream with
    an AvailableNow trigger (two files per micro-batch) and merged into a
    stored dimension by foreachBatch: equals the one-job history."""
    root = scratch_path(w.spark, "stream")
    STR.land_days_in_order(w.staged(w.raw_products, always=True), f"{root}/landing")
    dim = SK.Scd2Store(w.spark, f"{root}/dim_products", K.DIM_PRODUCTS, S.PRODUCTS)
    STR.stream_products_into_dimension(w.spark, f"{root}/landing", dim, f"{root}/_checkpoint",
                                       max_files=2)
    return dim.read()


def _same_day(w: Warehouse) -> DataFrame:
    """Staged reviews of which a day holds several rows of a review, and copies."""
    return ST.stage_comments(C.clean_comments(FX.raw_comments_same_day(w.spark, w.sf_dir), None))


@query("distinct_copies", O.STG_COMMENTS_SAME_DAY)
def q_distinct_copies(w: Warehouse) -> DataFrame:
    return _same_day(w)


@query("dedupe_same_day", O.SURVIVORS_SAME_DAY)
def q_dedupe_same_day(w: Warehouse) -> DataFrame:
    """The survivor of each review and day: the latest created, then the greatest."""
    spec = S.COMMENTS
    rows = _same_day(w).select(*spec.value_columns, F.col("load_date").alias("effective_date"))
    return C.dedupe_by_key(rows, [spec.key, "effective_date"], spec.prefer)


@query("scd2_comments_same_day", O.DIM_COMMENTS_SAME_DAY, stored=True)
def q_scd2_comments_same_day(w: Warehouse) -> DataFrame:
    """The same reviews merged in three parts: losers never become versions."""
    staged = w.staged(_same_day(w))
    cuts = [F.col("load_date") < "2024-01-08", F.col("load_date").between("2024-01-08", "2024-01-20"),
            F.col("load_date") > "2024-01-20"]
    return _merged(w, K.DIM_COMMENTS, S.COMMENTS, [staged.where(c) for c in cuts], S.AS_WRITTEN)


@query("merge_delta_duplicates", O.DELTA_DUPLICATES, stored=True)
def q_merge_delta_duplicates(w: Warehouse) -> DataFrame:
    """The guard that keeps one row of each (key, date) of a delta, as a count: over all
    rows that merges of same-day duplicates wrote there is none to drop."""
    staged = w.staged(_same_day(w))
    dim = SK.Scd2Store(w.spark, scratch_path(w.spark, "guard"), K.DIM_COMMENTS, S.COMMENTS)
    for part in (staged.where(F.col("load_date") < "2024-01-15"), staged):
        dim.merge(part)
    twice = (w.spark.read.option("basePath", dim.root).parquet(f"{dim.root}/v=*").groupBy("v", "comment_id", "effective_date")
             .agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    return twice.agg(F.lit("dim_comments").alias("table_name"), F.count(F.lit(1)).cast("bigint").alias("duplicates"))


LAST_DAY = "2100-01-01"


@query("stream_scd2_comments", O.DIM_COMMENTS_SAME_DAY)
def q_stream_scd2_comments(w: Warehouse) -> DataFrame:
    """Reviews landed day by day in two files each, 13 files a micro-batch, so that
    days are split: survivors wait in the state until their day is over."""
    root = scratch_path(w.spark, "stream")
    raw = FX.raw_comments_same_day(w.spark, w.sf_dir)
    STR.land_days_in_order(w.staged(raw, always=True), f"{root}/landing", files=2)
    STR.land_days_in_order(EV.heartbeat(w.spark, EV.COMMENTS, LAST_DAY), f"{root}/landing")
    dim = SK.Scd2Store(w.spark, f"{root}/dim", K.DIM_COMMENTS, S.COMMENTS, cluster_col="product_id")
    EV.stream_into_dimension(w.spark, f"{root}/landing", dim, f"{root}/_checkpoint", EV.COMMENTS, max_files=13)
    return dim.read()


@query("stream_type_drift", O.DIM_PRODUCTS)
def q_stream_type_drift(w: Warehouse) -> DataFrame:
    """Product runs of which every other one has its quantities as doubles, taken up
    by their manifests, conformed and streamed into the dimension."""
    root = scratch_path(w.spark, "drift-stream")
    raw = w.staged(w.raw_products, always=True)
    days = sorted(r[0] for r in raw.select("date").distinct().collect())
    for k, day in enumerate(days):
        run = raw.where(F.col("date") == day)
        EV.land_run(run.withColumn("all_time_quantity_sold", F.col("all_time_quantity_sold").cast("double")) if k % 2 else run,
                    f"{root}/landing", day)
    EV.land_run(EV.heartbeat(w.spark, EV.PRODUCTS, LAST_DAY), f"{root}/landing", LAST_DAY)
    EV.conform_landing(w.spark, f"{root}/landing", f"{root}/conformed", f"{root}/_conforming", EV.PRODUCTS, max_runs=2)
    dim = SK.Scd2Store(w.spark, f"{root}/dim", K.DIM_PRODUCTS, S.PRODUCTS)
    EV.stream_into_dimension(w.spark, f"{root}/conformed", dim, f"{root}/_checkpoint", EV.PRODUCTS)
    return dim.read()


@query("product_quality_report", O.PRODUCT_QUALITY_REPORT)
def q_product_quality_report(w: Warehouse) -> DataFrame:
    """The product job's whole report in one long table (metric, key,
    value): one scalar aggregate plus two small grouped aggregates."""
    return Q.product_report(C.clean_products(w.raw_products))


@query("comments_quality_report", O.COMMENTS_QUALITY_REPORT)
def q_comments_quality_report(w: Warehouse) -> DataFrame:
    return Q.comments_report(w.clean_comments)


def _report_states(w: Warehouse) -> DataFrame:
    """States of all raw rows as runs leave them, in three runs by id."""
    root = scratch_path(w.spark, "states")
    clean = w.clean_comments
    for k in range(3):
        part = F.col("id") % 3 == k
        CH.union_all([RS.states(w.clean_products_by_day.where(part), RS.products_spec()),
                      RS.states(clean.where(part), RS.comments_spec())]).write.parquet(f"{root}/run_ts={k}")
    return w.spark.read.schema(RS.SCHEMA).parquet(f"{root}/run_ts=*")


def _history_report(states: DataFrame) -> DataFrame:
    # The estimated number of ids has no counterpart in SQL; a unit test bounds its error.
    return RS.report(states).where("metric != 'distinct_ids_estimate'")


@query("history_report", O.HISTORY_REPORT)
def q_history_report(w: Warehouse) -> DataFrame:
    """The whole quality report over all runs, from their states alone."""
    return _history_report(_report_states(w))


@query("history_report_span", O.HISTORY_REPORT_SPAN)
def q_history_report_span(w: Warehouse) -> DataFrame:
    """A span of days out of the middle, from states that were merged by day before."""
    return _history_report(RS.over(RS.merged(_report_states(w), keep_day=True), "1993-06-01", "2024-01-12"))


@query("adhoc_copy_qty_double", O.ADHOC_COPY_QTY_DOUBLE)
def q_adhoc_copy_qty_double(w: Warehouse) -> DataFrame:
    """Landed product files read under the copy job's contract: quantity
    as double, the date column left out (and so never read)."""
    root = scratch_path(w.spark, "copy")
    path = SK.write_landing(w.raw_products, root, "products", "a")
    return RD.read_landed(w.spark, [path], K.RAW_PRODUCTS_QTY_DOUBLE)
