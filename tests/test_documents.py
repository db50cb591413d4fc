import datetime as dt
import json

from pyspark.sql import functions as F

from daybook.functions import expressions as X
from daybook.sources import documents as DOC


def test_product_doc_absent_null_and_malformed(spark):
    docs = spark.createDataFrame([
        ('{"id": 1, "name": "a", "stock_item": {"qty": 3, "max_sale_qty": 9}, "date": "2024-01-01"}',),
        ('{"id": 2, "name": "b", "stock_item": null}',),
        ('{"id": 3}',),
        ('not json',),
    ], "doc string")
    got = {r.id: r for r in DOC.flatten_products(docs).collect()}
    assert sorted(got) == [1, 2, 3]  # the malformed document is dropped
    assert (got[1].stock_item_qty, got[1].stock_item_max_sale_qty) == (3, 9)
    assert got[2].stock_item_qty is None and got[3].name is None and got[3].date is None


def test_review_pages_and_listing(spark):
    pages = spark.createDataFrame([
        ('{"data": [{"id": 1, "product_id": 7, "created_by": {"purchased_at": 5}}, {"id": 2}]}',),
        ('{"data": []}',),
    ], "doc string")
    got = sorted((r.id, r.product_id, r.purchased_at) for r in DOC.flatten_reviews(pages).collect())
    assert got == [(1, 7, 5), (2, None, None)]
    listing = spark.createDataFrame([('{"data": [{"id": 5}, {"id": null}, {"other": 1}, {"id": 5}]}',)], "doc string")
    got = [(r.position, r.product_id) for r in DOC.explode_listing(listing).orderBy("position").collect()]
    assert got == [(0, 5), (3, 5)]  # no dedupe, entries without an id skipped


def test_menu_categories(spark):
    menu = spark.createDataFrame([('{"menu_block": {"items": [{"link": "https://x/a/c123"}, {"link": "plain"}]}}',)],
                                 "doc string")
    assert [r.category_id for r in DOC.menu_categories(menu).collect()] == ["123", "plain"]


def test_page_builders_are_bounded(spark):
    part = spark.range(0, 2500).select(F.col("id").alias("p_partkey"), F.lit("B").alias("p_brand"),
                                       F.lit(1).alias("p_size"))
    docs = DOC.listing_docs(part)
    sizes = [r.n for r in docs.select(F.size(F.from_json("doc", DOC.LISTING)["data"]).alias("n")).collect()]
    assert sorted(sizes) == [500, 1000, 1000]


def test_stamps(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 30, 7, 41, 12),)], "ts timestamp")
    r = df.select(X.run_stamp("ts").alias("a"), X.day_stamp("ts").alias("b")).first()
    assert (r.a, r.b) == ("20240130_074112", "2024-01-30")


def test_drifting_field_types_keep_the_document(spark):
    docs = [{"id": 1, "price": "12.5", "all_time_quantity_sold": 3.0}, {"id": "2", "discount": 1.5, "stock_item": []},
            {"id": 3, "stock_item": {"qty": "7", "max_sale_qty": 8.0}, "name": 5}]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs] + [("{broken",), (None,)], "doc string")
    got = {r["id"]: r for r in DOC.flatten_products(df).collect()}
    assert set(got) == {1, 2, 3}
    assert (got[1]["price"], got[1]["all_time_quantity_sold"], got[2]["discount"]) == (12.5, 3, 1)
    assert (got[3]["stock_item_qty"], got[3]["stock_item_max_sale_qty"], got[3]["name"]) == (7, 8, "5")
    assert got[2]["stock_item_qty"] is None
    assert DOC.rejected_products(df).count() == 2
    page = {"data": [{"id": 1, "rating": "5", "created_by": {"purchased_at": "9"}}, {"id": 2, "rating": 4.5, "created_by": []}]}
    pages = spark.createDataFrame([(json.dumps(page),), ("{broken",)], "doc string")
    got = {r["id"]: (r["rating"], r["purchased_at"]) for r in DOC.flatten_reviews(pages).collect()}
    assert got == {1: (5, 9), 2: (4, None)} and DOC.rejected_pages(pages).count() == 1


def test_gate_ignores_partitions_of_empty_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1,)], "id int").write.parquet(f"{path}/d=2024-01-01")
    spark.createDataFrame([], "id int").write.parquet(f"{path}/d=2024-05-01")
    assert str(spark.read.parquet(path).agg({"d": "max"}).first()[0]) == "2024-01-01"


def test_ingest_flags_in_the_same_pass(spark):
    docs = spark.createDataFrame([('{"id": 1}',), ("[1]",), ('"x"',), ("",), (None,), ("{",), ('{"id": 2, "id": 3}',)], "doc string")
    got = DOC.ingest_products(docs).collect()
    assert [r["id"] for r in got] == [1] + [None] * 6
    assert [r["rejected"] for r in got] == [None, "[1]", '"x"', "", "", "{", '{"id": 2, "id": 3}']
    pages = spark.createDataFrame([('{"data": [{"id": 1}, 5, null, "t"]}',), ('{"data": []}',), ('{"data": {}}',), ("{}",), (None,)],
                                  "doc string")
    got = sorted(((r["id"], r["rejected_kind"], r["rejected"]) for r in DOC.ingest_reviews(pages).collect()), key=str)
    assert got == sorted([(1, None, None), (None, "review", "5"), (None, "review", "null"), (None, "review", '"t"'),
                          (None, "page", '{"data": {}}'), (None, "page", "{}"), (None, "page", "")], key=str)
    plan = DOC.ingest_reviews(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") == 1, plan


def test_rejects_are_kept_and_reported(spark):
    from daybook.plans.daily import DailyWarehouse
    from daybook.session import scratch_path

    wh = DailyWarehouse(spark, scratch_path(spark, "ingest"))
    docs = [{"id": 1, "name": "a", "date": "2024-01-01"}, {"id": 2, "name": "b", "price": "3.5", "date": "2024-01-01"}]
    review = {"id": 9, "product_id": 1, "rating": "4", "created_at": 5.0, "date": "2024-01-01"}
    p = spark.createDataFrame([(json.dumps(d),) for d in docs] + [("{broken",), (None,)], "doc string")
    c = spark.createDataFrame([(json.dumps({"data": [review, 7]}),), ("{broken",)], "doc string")
    for _ in range(2):  # ingested again, the run counts the same
        products, comments = wh.ingest("2024-01-01", p, c)
        wh.run_batch("2024-01-01", products, comments)
    got = {(r["table_name"], r["metric"]): r["value"] for r in wh.reports("quality").where("key IS NULL").collect()}
    assert got["products", "rejected_documents"] == 2 and got["comments", "rejected_documents"] == 2
    assert got["products", "total_records"] == 2 and got["comments", "total_records"] == 1
    assert wh.ingest("other", None, c)[0] is None
