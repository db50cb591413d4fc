"""Independent DuckDB SQL for every catalog query (the correctness oracle).

Written from the semantics, not generated from the Spark plans: fixtures,
cleaning, staging and SCD2 are spelled out again in plain SQL. SCD2 end
dates use the pairwise definition (first later version that differs),
which the Spark side computes with window passes instead."""

from __future__ import annotations

from daybook.functions.expressions import SENTIMENTS, TITLE_SENTIMENT
from daybook.plans.model import CATALOG_RUN_DATE
from daybook.sources.fixtures import EVENT_RATINGS, EVENT_TITLES


def _case(col: str, pairs, default="NULL") -> str:
    arms = " ".join(f"WHEN {col} = '{a}' THEN '{b}'" if isinstance(b, str) else
                    f"WHEN {col} = '{a}' THEN {b}" for a, b in pairs)
    return f"CASE {arms} ELSE {default} END"


EPOCH = "CAST(floor(epoch(ts)) AS BIGINT)"

FX_COMMENTS = f"""
SELECT event_id AS id,
  CASE WHEN event_id % 50 = 0 THEN NULL ELSE user_id END AS product_id,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE {_case('event_type', EVENT_TITLES)} END AS title,
  CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 23 = 0 THEN ''
       WHEN event_id % 29 = 0 THEN 'null' ELSE props END AS content,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 7 END AS rating,
  {EPOCH} AS created_at,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE {EPOCH} - (event_id % 40) * 86400 END AS purchased_at,
  strftime(ts, '%Y-%m-%d') AS date,
  value AS score
FROM events"""

SENTIMENT = _case("title", TITLE_SENTIMENT, "'unknown'")

CLEAN_COMMENTS = f"""
SELECT id, product_id, title, content, rating, created_at, purchased_at, date,
  {SENTIMENT} AS sentiment,
  CAST(abs(date_diff('day', CAST(purchased_at AS DATE), CAST(created_at AS DATE))) AS INTEGER) AS days_to_review,
  (rating >= 1 AND rating <= 5) AS rating_valid,
  '{CATALOG_RUN_DATE}' AS processing_date
FROM (
  SELECT id, product_id, coalesce(title, 'unknown') AS title,
    CASE WHEN content IS NULL OR content IN ('', 'null') THEN 'unknown' ELSE content END AS content,
    rating, make_timestamp(created_at * 1000000) AS created_at,
    make_timestamp(purchased_at * 1000000) AS purchased_at,
    CAST(strptime(date, '%Y-%m-%d') AS DATE) AS date
  FROM ({FX_COMMENTS}) r
  WHERE product_id IS NOT NULL AND rating IS NOT NULL
) c"""

FX_PRODUCTS = """
SELECT p.p_partkey AS id,
  CASE WHEN p.p_partkey % 97 = 0 THEN NULL ELSE p.p_name END AS name,
  CASE WHEN p.p_partkey % 10 = 0 THEN NULL ELSE p.p_type END AS short_description,
  p.p_retailprice AS price,
  CAST(ceil(p.p_retailprice) AS BIGINT) AS list_price,
  CAST(ceil(p.p_retailprice) AS BIGINT) - CAST(floor(p.p_retailprice) AS BIGINT) AS discount,
  CAST(round(s.disc_max * 100) AS BIGINT) AS discount_rate,
  CAST(s.qty_sum AS BIGINT) AS all_time_quantity_sold,
  s.flag_max AS inventory_status,
  CAST(s.qty_min AS BIGINT) AS stock_item_qty,
  CAST(s.qty_max AS BIGINT) AS stock_item_max_sale_qty,
  CAST(s.yr AS VARCHAR) || '-12-31' AS date
FROM (SELECT l_partkey, year(l_shipdate) AS yr, sum(l_quantity) AS qty_sum,
             max(l_discount) AS disc_max, max(l_returnflag) AS flag_max,
             min(l_quantity) AS qty_min, max(l_quantity) AS qty_max
      FROM lineitem GROUP BY l_partkey, year(l_shipdate)) s
JOIN part p ON s.l_partkey = p.p_partkey"""

# Product job on each load day: named rows, one per (id, day).
CLEAN_PRODUCTS_BY_DAY = f"""
SELECT id, name, short_description, price, list_price, discount, discount_rate,
  all_time_quantity_sold, inventory_status, stock_item_qty, stock_item_max_sale_qty,
  CAST(strptime(date, '%Y-%m-%d') AS DATE) AS date
FROM ({FX_PRODUCTS}) f WHERE name IS NOT NULL"""

# Product job on all documents as one run: one row per id, latest date wins.
CLEAN_PRODUCTS_ONE_RUN = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY date DESC) AS rn
  FROM ({CLEAN_PRODUCTS_BY_DAY}) c) WHERE rn = 1"""

STG_PRODUCTS = f"""
SELECT DISTINCT CAST(id AS VARCHAR) AS product_id, name AS product_name,
  coalesce(short_description, '') AS product_description,
  coalesce(price, 0) AS product_price,
  coalesce(list_price, 0) AS product_list_price,
  coalesce(discount, 0) AS product_discount,
  coalesce(discount_rate, 0) AS product_discount_rate,
  coalesce(all_time_quantity_sold, 0) AS product_all_time_quantity_sold,
  coalesce(inventory_status, 'unknown') AS product_inventory_status,
  coalesce(stock_item_qty, 0) AS product_stock_item_qty,
  coalesce(stock_item_max_sale_qty, 0) AS product_stock_item_max_sale_qty,
  date AS load_date
FROM ({CLEAN_PRODUCTS_BY_DAY}) c WHERE id IS NOT NULL"""

STG_COMMENTS = f"""
SELECT DISTINCT CAST(id AS VARCHAR) AS comment_id, CAST(product_id AS VARCHAR) AS product_id,
  sentiment, content AS comment_content, coalesce(rating, 0) AS comment_rating,
  created_at, purchased_at, CAST(days_to_review AS BIGINT) AS days_to_review,
  rating_valid, date AS load_date
FROM ({CLEAN_COMMENTS}) c WHERE id IS NOT NULL AND product_id IS NOT NULL"""

COMMENT_HISTORY = f"""
SELECT CAST(user_id AS VARCHAR) AS comment_id, CAST(user_id AS VARCHAR) AS product_id,
  {_case('event_type', [(et, dict(TITLE_SENTIMENT)[t]) for et, t in EVENT_TITLES], "'unknown'")} AS sentiment,
  event_type AS comment_content,
  CAST({_case('event_type', list(EVENT_RATINGS.items()))} AS BIGINT) AS comment_rating,
  make_timestamp({EPOCH} * 1000000) AS created_at,
  make_timestamp({EPOCH} * 1000000) AS purchased_at,
  CAST(CASE WHEN event_id % 13 = 0 THEN NULL ELSE 0 END AS BIGINT) AS days_to_review,
  TRUE AS rating_valid,
  load_date
FROM (SELECT *, CAST(ts AS DATE) AS load_date,
        row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) e
WHERE rn = 1"""


def versions(stg: str, key: str, cols: list[str], prefer: list[str]) -> str:
    """One candidate version per (key, load date), greatest by ``prefer``
    then by every remaining column (NULL lowest)."""
    order = ", ".join(f"{c} DESC NULLS LAST" for c in prefer + [c for c in cols if c != key and c not in prefer])
    return f"""
SELECT {', '.join(cols)}, load_date AS effective_date FROM (
  SELECT *, row_number() OVER (PARTITION BY {key}, load_date ORDER BY {order}) AS rn
  FROM ({stg}) s) WHERE rn = 1"""


def scd2_as_written(stg: str, key: str, cols: list[str], tracked: list[str],
                    prefer: list[str]) -> str:
    """End date = first later version of the key whose tracked values differ
    under plain != (a NULL comparison never counts)."""
    diff = " OR ".join(f"u.{c} != t.{c}" for c in tracked)
    sel = ", ".join(f"t.{c}" for c in cols)
    return f"""
WITH v AS ({versions(stg, key, cols, prefer)}),
ends AS (
  SELECT t.{key}, t.effective_date, min(u.effective_date) AS end_date
  FROM v t JOIN v u ON u.{key} = t.{key} AND u.effective_date > t.effective_date AND ({diff})
  GROUP BY t.{key}, t.effective_date)
SELECT {sel}, t.effective_date, e.end_date, e.end_date IS NULL AS is_active
FROM v t LEFT JOIN ends e ON e.{key} = t.{key} AND e.effective_date = t.effective_date"""


def scd2_strict(stg: str, key: str, cols: list[str], tracked: list[str],
                prefer: list[str]) -> str:
    same = " AND ".join(f"(prev_{c} IS NOT DISTINCT FROM {c})" for c in tracked)
    lags = ", ".join(f"lag({c}) OVER w AS prev_{c}" for c in tracked)
    return f"""
WITH v AS ({versions(stg, key, cols, prefer)}),
l AS (SELECT *, {lags}, row_number() OVER w AS pos FROM v WINDOW w AS (PARTITION BY {key} ORDER BY effective_date)),
k AS (SELECT {', '.join(cols)}, effective_date FROM l WHERE pos = 1 OR NOT ({same}))
SELECT {', '.join(cols)}, effective_date,
  lead(effective_date) OVER (PARTITION BY {key} ORDER BY effective_date) AS end_date,
  lead(effective_date) OVER (PARTITION BY {key} ORDER BY effective_date) IS NULL AS is_active
FROM k"""


P_KEY = "product_id"
P_TRACKED = ["product_name", "product_description", "product_inventory_status"]
P_COLS = [P_KEY] + P_TRACKED
C_KEY = "comment_id"
C_TRACKED = ["comment_content", "comment_rating", "days_to_review", "rating_valid"]
C_COLS = ["comment_id", "product_id", "sentiment", "comment_content", "comment_rating",
          "created_at", "purchased_at", "days_to_review", "rating_valid"]

DIM_PRODUCTS = scd2_as_written(STG_PRODUCTS, P_KEY, P_COLS, P_TRACKED, [])
DIM_PRODUCTS_STRICT = scd2_strict(STG_PRODUCTS, P_KEY, P_COLS, P_TRACKED, [])
DIM_COMMENTS = scd2_as_written(COMMENT_HISTORY, C_KEY, C_COLS, C_TRACKED, ["created_at"])
DIM_COMMENTS_STRICT = scd2_strict(COMMENT_HISTORY, C_KEY, C_COLS, C_TRACKED, ["created_at"])

FACT_PRODUCTS = f"""
SELECT DISTINCT product_id, load_date AS snapshot_date, product_all_time_quantity_sold,
  product_stock_item_qty, product_stock_item_max_sale_qty,
  CAST(product_price AS DOUBLE) AS product_price, CAST(product_list_price AS DOUBLE) AS product_list_price,
  CAST(product_discount AS DOUBLE) AS product_discount,
  CAST(product_discount_rate AS DOUBLE) AS product_discount_rate
FROM ({STG_PRODUCTS}) s"""

FACT_COMMENTS = f"""
SELECT DISTINCT c.comment_id, c.product_id, c.comment_rating, c.days_to_review,
  CAST(c.created_at AS DATE) AS comment_date, c.load_date AS snapshot_date
FROM ({STG_COMMENTS}) c
JOIN ({DIM_PRODUCTS}) p ON c.product_id = p.product_id AND p.is_active AND p.end_date IS NULL"""


def _split_last(stg: str) -> tuple[str, str]:
    last = f"(SELECT max(load_date) FROM ({stg}) m)"
    return (f"SELECT * FROM ({stg}) a WHERE load_date < {last}",
            f"SELECT * FROM ({stg}) b WHERE load_date = {last}")


STG_PRODUCTS_PRIOR, STG_PRODUCTS_LAST = _split_last(STG_PRODUCTS)

INCREMENTAL_GATE = f"""
SELECT * FROM ({STG_PRODUCTS}) s
WHERE load_date >= (SELECT coalesce(max(load_date), DATE '1900-01-01') FROM ({STG_PRODUCTS_PRIOR}) t)"""

NEW_ROWS_ANTI_JOIN = f"""
SELECT * FROM ({INCREMENTAL_GATE}) s
WHERE NOT EXISTS (SELECT 1 FROM ({STG_PRODUCTS_PRIOR}) t
                  WHERE t.product_id = s.product_id AND t.load_date = s.load_date)"""

ASOF_DIM_JOIN = f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, CAST(l.l_shipdate AS DATE) AS ship_date,
  d.effective_date, d.end_date, d.product_inventory_status
FROM lineitem l
JOIN ({DIM_PRODUCTS_STRICT}) d
  ON CAST(d.product_id AS BIGINT) = l.l_partkey
 AND CAST(l.l_shipdate AS DATE) >= d.effective_date
 AND (d.end_date IS NULL OR CAST(l.l_shipdate AS DATE) < d.end_date)"""

BUCKETED_DIM_JOIN = f"""
SELECT f.product_id, f.snapshot_date, f.product_price, d.effective_date, d.product_inventory_status
FROM ({FACT_PRODUCTS}) f JOIN ({DIM_PRODUCTS_STRICT}) d
  ON d.product_id = f.product_id AND f.snapshot_date >= d.effective_date
 AND (d.end_date IS NULL OR f.snapshot_date < d.end_date)"""

BUCKETED_REVIEWS_PER_PRODUCT = f"""
SELECT product_id, CAST(count(*) AS BIGINT) AS reviews, max(snapshot_date) AS last_day
FROM ({FACT_COMMENTS}) f GROUP BY product_id"""

# Comment dimension of the daily pipeline (from staged reviews, not history).
DIM_COMMENTS_STG = scd2_as_written(STG_COMMENTS, C_KEY, C_COLS, C_TRACKED, ["created_at"])


# Reviews sent several times a day, every third document twice (id = the user's).
FX_COMMENTS_SAME_DAY = f"""
SELECT f.* REPLACE (e.user_id AS id) FROM ({FX_COMMENTS}) f JOIN events e ON f.id = e.event_id
UNION ALL
SELECT f.* REPLACE (e.user_id AS id) FROM ({FX_COMMENTS}) f JOIN events e ON f.id = e.event_id WHERE f.id % 3 = 0"""
STG_COMMENTS_SAME_DAY = STG_COMMENTS.replace(FX_COMMENTS, FX_COMMENTS_SAME_DAY).replace(
    f"'{CATALOG_RUN_DATE}' AS processing_date", "CAST(date AS VARCHAR) AS processing_date")
SURVIVORS_SAME_DAY = versions(STG_COMMENTS_SAME_DAY, C_KEY, C_COLS, ["created_at"])
DIM_COMMENTS_SAME_DAY = scd2_as_written(STG_COMMENTS_SAME_DAY, C_KEY, C_COLS, C_TRACKED, ["created_at"])
# The final guard of the merge finds no (key, date) twice.
DELTA_DUPLICATES = "SELECT 'dim_comments' AS table_name, CAST(0 AS BIGINT) AS duplicates"


def _nn(table: str, src: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT 'not_null' AS test, '{table}' AS table_name, '{c}' AS column_name, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM ({src}) x"
        for c in cols)


CHECK_NOT_NULL = " UNION ALL ".join([
    _nn("stg_products", STG_PRODUCTS, ["product_id", "product_name", "load_date"]),
    _nn("stg_comments", STG_COMMENTS, ["comment_id", "product_id", "load_date"]),
    _nn("dim_products", DIM_PRODUCTS, ["product_id", "effective_date", "is_active", "product_name"]),
    _nn("dim_comments", DIM_COMMENTS_STG, ["comment_id", "product_id", "comment_content", "comment_rating"]),
    _nn("fact_comments", FACT_COMMENTS, ["comment_id"]),
])


def _rel(table: str, child: str, parent: str, key: str) -> str:
    return (f"SELECT 'relationships' AS test, '{table}' AS table_name, '{key}' AS column_name, "
            f"CAST(count(*) AS BIGINT) AS failures FROM ({child}) c WHERE c.{key} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM ({parent}) p WHERE p.{key} = c.{key})")


CHECK_RELATIONSHIPS = (_rel("stg_comments", STG_COMMENTS, STG_PRODUCTS, "product_id") + " UNION ALL " +
                       _rel("dim_comments", DIM_COMMENTS_STG, DIM_PRODUCTS, "product_id"))


def _uniq(table: str, src: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return (f"SELECT 'unique' AS test, '{table}' AS table_name, '{','.join(keys)}' AS column_name, "
            f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {k} FROM ({src}) s GROUP BY {k} HAVING count(*) > 1) d")


CHECK_UNIQUE = " UNION ALL ".join([
    _uniq("stg_products", STG_PRODUCTS, ["product_id", "load_date"]),
    _uniq("stg_comments", STG_COMMENTS, ["comment_id", "load_date"]),
    _uniq("dim_products", DIM_PRODUCTS, ["product_id", "effective_date"]),
    _uniq("dim_comments", DIM_COMMENTS_STG, ["comment_id", "effective_date"]),
    _uniq("fact_products", FACT_PRODUCTS, ["product_id", "snapshot_date"]),
    _uniq("fact_comments", FACT_COMMENTS, ["comment_id", "snapshot_date"]),
])


CHECK_UNIQUE_KEY_SETS = " UNION ALL ".join(
    _uniq("stg_products", STG_PRODUCTS, keys) for keys in
    (["product_id", "load_date"], ["product_id"], ["product_name", "load_date"], ["load_date"]))


def _one_active(table: str, src: str, key: str) -> str:
    return (f"SELECT 'one_active' AS test, '{table}' AS table_name, '{key}' AS column_name, "
            f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {key} FROM ({src}) s WHERE is_active "
            f"GROUP BY {key} HAVING count(*) > 1) d")


def _validity(table: str, src: str) -> str:
    return (f"SELECT 'validity' AS test, '{table}' AS table_name, 'end_date' AS column_name, "
            f"CAST(count(*) FILTER (WHERE (end_date IS NOT NULL AND end_date <= effective_date) "
            f"OR (is_active != (end_date IS NULL))) AS BIGINT) AS failures FROM ({src}) s")


CHECK_SCD2_INVARIANTS = " UNION ALL ".join([
    _one_active("dim_products", DIM_PRODUCTS, "product_id"),
    _one_active("dim_products_strict", DIM_PRODUCTS_STRICT, "product_id"),
    _one_active("dim_comments_strict", DIM_COMMENTS_STRICT, "comment_id"),
    _validity("dim_products", DIM_PRODUCTS),
    _validity("dim_products_strict", DIM_PRODUCTS_STRICT),
    _validity("dim_comments", DIM_COMMENTS),
    "SELECT 'accepted_values' AS test, 'stg_comments' AS table_name, 'sentiment' AS column_name, "
    "CAST(count(*) FILTER (WHERE sentiment IS NOT NULL AND sentiment NOT IN ("
    + ", ".join(f"'{v}'" for v in SENTIMENTS) + ")) AS BIGINT) AS failures FROM (" + STG_COMMENTS + ") s",
])

# ------------------------------------------------------------------ ingest

JSON_FLATTEN_PRODUCTS = f"""
SELECT id, name, short_description, price, list_price, discount, discount_rate,
  all_time_quantity_sold, inventory_status,
  CASE WHEN id % 37 = 0 THEN NULL ELSE stock_item_qty END AS stock_item_qty,
  CASE WHEN id % 37 = 0 THEN NULL ELSE stock_item_max_sale_qty END AS stock_item_max_sale_qty,
  date
FROM ({FX_PRODUCTS}) f"""

RAW_COMMENT_COLUMNS = "id, product_id, title, content, rating, created_at, purchased_at, date"

JSON_FLATTEN_COMMENTS = f"SELECT {RAW_COMMENT_COLUMNS} FROM ({FX_COMMENTS}) f"

# Mixed field types: what cannot be read as declared is NULL, broken documents go.
JSON_FLATTEN_PRODUCTS_DRIFT = f"""
SELECT id, name, short_description, price, list_price, discount, discount_rate,
  CASE WHEN id % 5 = 3 THEN NULL ELSE all_time_quantity_sold END AS all_time_quantity_sold, inventory_status,
  CASE WHEN id % 5 = 3 THEN NULL ELSE stock_item_qty END AS stock_item_qty,
  CASE WHEN id % 5 = 3 THEN NULL ELSE stock_item_max_sale_qty END AS stock_item_max_sale_qty,
  date
FROM ({FX_PRODUCTS}) f WHERE id % 41 != 0 AND id % 43 != 0"""

JSON_FLATTEN_COMMENTS_DRIFT = f"""
SELECT {RAW_COMMENT_COLUMNS} FROM ({FX_COMMENTS}) f
WHERE id % 47 != 0 AND coalesce(product_id % 17 != 0, TRUE)"""

JSON_REJECTS = f"""
SELECT 'product' AS kind, CAST(count(*) AS BIGINT) AS rejected FROM ({FX_PRODUCTS}) f WHERE id % 41 = 0 OR id % 43 = 0
UNION ALL
SELECT 'page', CAST(count(*) AS BIGINT) FROM (
  SELECT DISTINCT product_id, floor(id / 1000) AS page FROM ({FX_COMMENTS}) f WHERE product_id % 17 = 0) p
UNION ALL
SELECT 'review', CAST(count(*) AS BIGINT) FROM ({FX_COMMENTS}) f
WHERE id % 47 = 0 AND coalesce(product_id % 17 != 0, TRUE)"""

LISTING_ENTRIES = """
SELECT p_brand AS category, CAST(floor(p_partkey / 1000) AS BIGINT) AS page,
  CAST(row_number() OVER (PARTITION BY p_brand, floor(p_partkey / 1000) ORDER BY p_partkey) - 1 AS INTEGER) AS position,
  CASE WHEN p_size > 45 THEN NULL ELSE p_partkey END AS product_id
FROM part"""

JSON_EXPLODE_LISTING = f"""
SELECT category, position, product_id FROM ({LISTING_ENTRIES}) e WHERE product_id IS NOT NULL"""

FIRST_N_IDS = f"""
SELECT category, position, product_id FROM ({LISTING_ENTRIES}) e WHERE product_id IS NOT NULL
ORDER BY category, page, position LIMIT 100"""

LINK_LAST_SEGMENT = "SELECT page_id, url, string_split(url, '/')[-1] AS segment FROM pages"

MENU_CATEGORY_IDS = """
SELECT link, string_split(link, '/c')[-1] AS category_id
FROM (SELECT url || '/c' || CAST(page_id AS VARCHAR) AS link FROM pages) m"""

# Runs of the hour after midnight of each load day; those from 1995 on.
LANDING_BY_RUN_STAMP = f"""
SELECT strftime(CAST(date AS DATE), '%Y%m%d') || '_010000' AS run_ts, CAST(count(*) AS BIGINT) AS documents,
  min(id) AS first_id FROM ({FX_PRODUCTS}) f WHERE date >= '1995' GROUP BY date"""

DAILY_TEST_REPORT = " UNION ALL ".join([
    _nn("dim_products", DIM_PRODUCTS, ["product_id", "effective_date", "is_active", "product_name"]),
    _nn("dim_comments", DIM_COMMENTS_STG, ["comment_id", "product_id", "comment_content", "comment_rating"]),
    _nn("fact_comments", FACT_COMMENTS, ["comment_id"]),
    _rel("dim_comments", DIM_COMMENTS_STG, DIM_PRODUCTS, "product_id")])

BACKFILL_SCATTERED_DAYS = f"""
SELECT CAST(id AS VARCHAR) AS product_id, price, date AS day FROM ({CLEAN_PRODUCTS_BY_DAY}) p WHERE year(date) % 2 = 0"""

CSV_INFER_ROUNDTRIP = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders"""

CSV_REJECTS = """
SELECT CAST(count(*) AS BIGINT) AS total_rows,
  CAST(count(*) FILTER (WHERE o_orderkey % 97 = 0 OR o_orderkey % 89 = 0) AS BIGINT) AS rejected,
  CAST(sum(o_orderkey) FILTER (WHERE o_orderkey % 97 != 0 AND o_orderkey % 89 != 0) AS BIGINT) AS accepted_keys
FROM orders"""

CSV_TO_PARQUET_LANDING = "SELECT conv_id, turn, role, text FROM conversations"

TOPK_COMMENTS_PER_PRODUCT = f"""
SELECT product_id, id, score, rank FROM (
  SELECT product_id, id, score,
    CAST(row_number() OVER (PARTITION BY product_id ORDER BY score DESC, id DESC) AS INTEGER) AS rank
  FROM ({FX_COMMENTS}) f WHERE product_id IS NOT NULL) r
WHERE rank <= 5"""

TYPE_DRIFT_READ = f"""
SELECT id, name, short_description, price, list_price, discount, discount_rate,
  all_time_quantity_sold, inventory_status, stock_item_qty, stock_item_max_sale_qty, date
FROM ({FX_PRODUCTS}) f"""

# ------------------------------------------------------- layout and pipeline

DAILY_ROW_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM ({sql}) x"
    for name, sql in [("raw_products", CLEAN_PRODUCTS_BY_DAY), ("raw_comments", CLEAN_COMMENTS),
                      ("dim_products", DIM_PRODUCTS), ("dim_comments", DIM_COMMENTS_STG),
                      ("fact_products", FACT_PRODUCTS), ("fact_comments", FACT_COMMENTS)])

# ------------------------------------------------------ one-pass reports

_P_COLS = ["id", "name", "short_description", "price", "list_price", "discount", "discount_rate",
           "all_time_quantity_sold", "inventory_status", "stock_item_qty", "stock_item_max_sale_qty", "date"]


def _metric(name: str, expr: str, src: str = "c", key: str = "CAST(NULL AS VARCHAR)") -> str:
    return f"SELECT '{name}' AS metric, {key} AS key, CAST({expr} AS DOUBLE) AS value FROM {src}"


PRODUCT_QUALITY_REPORT = f"WITH c AS ({CLEAN_PRODUCTS_ONE_RUN})\n" + "\nUNION ALL ".join(
    [_metric("total_records", "count(*)"),
     _metric("avg_price", "round(avg(price), 4)"),
     _metric("min_price", "min(price)"), _metric("max_price", "max(price)"),
     _metric("stddev_price", "round(stddev_samp(price), 4)"),
     _metric("total_sold", "sum(all_time_quantity_sold)"),
     _metric("avg_sold", "round(avg(all_time_quantity_sold), 4)"),
     _metric("max_sold", "max(all_time_quantity_sold)"),
     _metric("negative_price", "count(*) FILTER (WHERE price < 0)"),
     _metric("negative_quantity", "count(*) FILTER (WHERE all_time_quantity_sold < 0)")]
    + [_metric("null_count", f"count(*) FILTER (WHERE {c} IS NULL)", key=f"'{c}'") for c in _P_COLS]
    + ["SELECT 'inventory_status' AS metric, inventory_status AS key, CAST(count(*) AS DOUBLE) AS value "
       "FROM c GROUP BY inventory_status",
       _metric("duplicate_ids", "count(*)", src="(SELECT id FROM c GROUP BY id HAVING count(*) > 1) d")])

COMMENTS_QUALITY_REPORT = f"WITH c AS ({CLEAN_COMMENTS})\n" + "\nUNION ALL ".join(
    [_metric("total_records", "count(*)"),
     _metric("valid_ratings", "count(*) FILTER (WHERE rating_valid)"),
     _metric("valid_share", "round(count(*) FILTER (WHERE rating_valid) / count(*), 4)"),
     _metric("unknown_content", "count(*) FILTER (WHERE content = 'unknown')"),
     "SELECT 'rating' AS metric, CAST(rating AS VARCHAR) AS key, CAST(count(*) AS DOUBLE) AS value FROM c GROUP BY rating",
     "SELECT 'sentiment' AS metric, sentiment AS key, CAST(count(*) AS DOUBLE) AS value FROM c GROUP BY sentiment"])

_MEASURES = [("price", "price"), ("all_time_quantity_sold", "all_time_quantity_sold")]
_HISTORY_PRODUCTS = f"WITH c AS ({CLEAN_PRODUCTS_BY_DAY})\n" + "\nUNION ALL ".join(
    [_metric("total_records", "count(*)"),
     _metric("negative_price", "count(*) FILTER (WHERE price < 0)"),
     _metric("negative_quantity", "count(*) FILTER (WHERE all_time_quantity_sold < 0)")]
    + [_metric(f"{name}_{m}", e.format(c=c)) for m, c in _MEASURES for name, e in [
        ("avg", "round(avg({c}), 4)"), ("min", "min({c})"), ("max", "max({c})"), ("sum", "sum({c})"),
        ("stddev", "round(stddev_samp({c}), 4)")]]
    + [_metric("null_count", f"count(*) FILTER (WHERE {c} IS NULL)", key=f"'{c}'") for c in _P_COLS]
    + ["SELECT 'inventory_status' AS metric, inventory_status AS key, CAST(count(*) AS DOUBLE) AS value "
       "FROM c GROUP BY inventory_status"])
_HISTORY_COMMENTS = f"WITH c AS ({CLEAN_COMMENTS})\n" + "\nUNION ALL ".join(
    [_metric("total_records", "count(*)"),
     _metric("valid_ratings", "count(*) FILTER (WHERE rating_valid)"),
     _metric("unknown_content", "count(*) FILTER (WHERE content = 'unknown')"),
     "SELECT 'rating' AS metric, CAST(rating AS VARCHAR) AS key, CAST(count(*) AS DOUBLE) AS value FROM c GROUP BY rating",
     "SELECT 'sentiment' AS metric, sentiment AS key, CAST(count(*) AS DOUBLE) AS value FROM c GROUP BY sentiment"])
HISTORY_REPORT = (f"SELECT 'products' AS table_name, p.* FROM ({_HISTORY_PRODUCTS}) p UNION ALL "
                  f"SELECT 'comments' AS table_name, p.* FROM ({_HISTORY_COMMENTS}) p")
HISTORY_REPORT_SPAN = HISTORY_REPORT.replace(f"WITH c AS ({CLEAN_PRODUCTS_BY_DAY})",
    f"WITH c AS (SELECT * FROM ({CLEAN_PRODUCTS_BY_DAY}) WHERE date BETWEEN DATE '1993-06-01' AND DATE '2024-01-12')").replace(
    f"WITH c AS ({CLEAN_COMMENTS})",
    f"WITH c AS (SELECT * FROM ({CLEAN_COMMENTS}) WHERE date BETWEEN DATE '1993-06-01' AND DATE '2024-01-12')")

ADHOC_COPY_QTY_DOUBLE = f"""
SELECT id, name, short_description, price, list_price, discount, discount_rate,
  CAST(all_time_quantity_sold AS DOUBLE) AS all_time_quantity_sold, inventory_status,
  stock_item_qty, stock_item_max_sale_qty
FROM ({FX_PRODUCTS}) f"""
