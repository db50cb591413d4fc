import datetime as dt


from daybook.operators import clean as C
from daybook.operators import quality as Q
from daybook.operators import staging as ST
from daybook.sources import contracts as K


PRODUCT_COLS = ("id bigint, name string, short_description string, price double, list_price bigint, "
                "discount bigint, discount_rate bigint, all_time_quantity_sold double, inventory_status string, "
                "stock_item_qty bigint, stock_item_max_sale_qty bigint, date string")


def test_clean_products_drops_unnamed_keeps_nulls_dedupes(spark):
    rows = [
        (1, "a", None, None, None, None, None, 12.7, None, None, None, "2024-01-01"),
        (1, "a2", "d", 5.0, 6, 1, 10, 3.0, "ok", 1, 2, "2024-01-02"),
        (2, None, "d", 5.0, 6, 1, 10, 3.0, "ok", 1, 2, "2024-01-02"),
        (None, "n1", None, 1.0, None, None, None, None, None, None, None, "2024-01-01"),
        (None, "n2", None, 2.0, None, None, None, None, None, None, None, "2024-01-01"),
    ]
    out = C.clean_products(spark.createDataFrame(rows, PRODUCT_COLS))
    got = sorted(out.collect(), key=lambda r: (r.id is not None, r.id or 0))
    # Null ids collapse into one row; id 2 has no name; id 1 keeps its latest day.
    assert [r.id for r in got] == [None, 1]
    assert got[1].name == "a2" and got[1].date == dt.date(2024, 1, 2)
    # Quantity drifted to double is conformed to long by truncation.
    assert dict(out.dtypes)["all_time_quantity_sold"] == "bigint"
    # Default fill is not part of cleaning: a null price survives.
    one = C.clean_products(spark.createDataFrame(rows[:1], PRODUCT_COLS)).first()
    assert one.price is None and one.all_time_quantity_sold == 12


def test_dedupe_is_deterministic_on_ties(spark):
    df = spark.createDataFrame([(1, "2024-01-01", "b"), (1, "2024-01-01", "a"), (1, "2024-01-01", "c")],
                               "id int, d string, v string")
    for _ in range(3):
        assert C.dedupe_by_key(df.repartition(3), ["id"], ["d"]).first().v == "c"


def test_fill_defaults_casts_float_defaults_on_long_columns(spark):
    rows = [(1, "a", None, None, None, None, None, None, None, None, None, "2024-01-01")]
    out = C.fill_defaults(C.clean_products(spark.createDataFrame(rows, PRODUCT_COLS))).first()
    assert out.price == 0.0 and out.list_price == 0 and out.short_description == "" \
        and out.inventory_status == "unknown"


COMMENT_COLS = ("id bigint, product_id bigint, title string, content string, rating bigint, "
                "created_at bigint, purchased_at bigint, date string")


def test_clean_comments_traps(spark):
    day = 86400
    rows = [
        (1, 10, None, "null", 5, 10 * day, None, "1970-01-11"),     # no title, 'null' text, no purchase
        (2, 10, "Hài lòng", "", 6, 10 * day, 8 * day, "1970-01-11"),  # empty text, invalid rating
        (3, None, "x", "ok", 3, 0, 0, "1970-01-01"),                  # no product -> dropped
        (4, 11, "x", "ok", None, 0, 0, "1970-01-01"),                 # no rating -> dropped
        (5, 12, "", "ok", 0, 0, 5 * day, "1970-01-01"),              # empty title kept
    ]
    out = {r.id: r for r in C.clean_comments(spark.createDataFrame(rows, COMMENT_COLS), "2024-02-01").collect()}
    assert sorted(out) == [1, 2, 5]
    assert (out[1].title, out[1].content, out[1].days_to_review, out[1].sentiment) == ("unknown", "unknown", None, "unknown")
    assert (out[2].content, out[2].rating_valid, out[2].days_to_review, out[2].sentiment) == ("unknown", False, 2, "positive")
    assert (out[5].title, out[5].days_to_review, out[5].rating_valid) == ("", 5, False)
    assert out[1].processing_date == "2024-02-01" and out[1].date == dt.date(1970, 1, 11)


def test_conform_missing_and_drifted_columns(spark):
    df = spark.createDataFrame([(1, 2.9, "x")], "id int, all_time_quantity_sold double, extra string")
    out = K.conform(df, K.RAW_PRODUCTS)
    assert out.columns == K.RAW_PRODUCTS.fieldNames()
    r = out.first()
    assert r.id == 1 and r.all_time_quantity_sold == 2 and r.name is None


def test_reports_one_pass_and_empty_batch(spark):
    empty = K.empty(spark, K.CLEAN_COMMENTS)
    s = Q.comments_summary(empty).first()
    assert s.total_records == 0 and s.valid_share is None
    df = spark.createDataFrame([(1, "unknown", True), (2, "x", False)], "rating bigint, content string, rating_valid boolean")
    s = Q.comments_summary(df).first()
    assert (s.total_records, s.valid_ratings, s.valid_share, s.unknown_content) == (2, 1, 0.5, 1)


def test_staging_filters_day_and_keys_and_distinct(spark):
    rows = [(1, "a", None, None, None, None, None, None, None, None, None, "2024-01-01")] * 2 + \
           [(None, "a", None, None, None, None, None, None, None, None, None, "2024-01-01"),
            (2, "b", None, None, None, None, None, None, None, None, None, "2024-01-02")]
    clean = C.clean_products(spark.createDataFrame(rows, PRODUCT_COLS), dedupe_keys=["id", "date"])
    stg = ST.stage_products(clean, "2024-01-01").collect()
    assert len(stg) == 1 and stg[0].product_id == "1" and stg[0].product_price == 0.0 \
        and stg[0].product_inventory_status == "unknown" and stg[0].load_date == dt.date(2024, 1, 1)
