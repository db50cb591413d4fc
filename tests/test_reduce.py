"""Semi-join reduction: no partner is lost, most others go, and the daily run's plans
deal only what a batch may meet."""

import datetime as dt

from pyspark.sql import functions as F

from daybook.operators import asof as AS
from daybook.operators import checks as CH
from daybook.operators import reduce as R
from daybook.operators import scd2 as S
from daybook.plans import catalog as CAT
from daybook.session import scratch_path
from daybook.sinks.tables import Scd2Store
from daybook.sources import contracts as K


def test_partners_stay_and_most_others_go(spark):
    rows = spark.range(100000).select(F.when(F.col("id") % 1000 != 0, F.col("id").cast("string")).alias("k"), "id")
    some = spark.range(0, 100000, 100).select(F.when(F.col("id") % 1000 != 0, F.col("id").cast("string")).alias("k"))
    got = R.may_match(rows, "k", R.key_words(some, "k"))
    assert got.columns == rows.columns
    ids = [r.id for r in got.select("id").collect()]
    assert set(range(0, 100000, 100)) <= set(ids)  # NULL is a key: the rows of every thousandth id
    assert len(ids) == len(set(ids)) < 1100
    assert R.may_match(rows, "k", R.key_words(some.where("k = 'none'"), "k")).count() == 0


def test_every_bit_of_a_word(spark):
    many = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    words = R.key_words(many, "k")
    assert {r[0] for r in many.select((R._slot("k") % 64)).distinct().collect()} == set(range(64))
    assert R.may_match(many, "k", words).count() == 5000


def _dealt(df, column: str) -> int:
    """Rows written by the exchanges on ``column`` of the plan that ran."""
    df.collect()
    node, total = df._jdf.queryExecution().executedPlan().finalPhysicalPlan(), 0
    todo = [node]
    while todo:
        n = todo.pop()
        name = n.getClass().getSimpleName()
        if name == "ShuffleQueryStageExec":
            n = n.shuffle()
            name = n.getClass().getSimpleName()
        elif name in ("BroadcastQueryStageExec", "ReusedExchangeExec"):
            continue
        if name == "ShuffleExchangeExec" and f"hashpartitioning({column}" in n.simpleString(200):
            total += n.metrics().apply("shuffleRecordsWritten").value()
        kids = n.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return total


def _store(spark):
    rows = K.conform(spark.range(4000).selectExpr(
        "string(id) product_id", "string(id) product_name", "date'2024-01-01' load_date"), K.STG_PRODUCTS)
    st = Scd2Store(spark, scratch_path(spark, "reduce"), K.DIM_PRODUCTS, S.PRODUCTS)
    st.merge(rows)
    return st, rows


def test_a_small_batch_deals_little_of_the_log(spark, monkeypatch):
    st, rows = _store(spark)
    batch = rows.where("product_id < 40").withColumn("product_name", F.lit("new")).withColumn(
        "load_date", F.lit("2024-01-02").cast("date"))
    written = []
    monkeypatch.setattr(st, "_write", lambda changes, mark: written.append(changes))
    st.merge(batch)
    assert 80 <= _dealt(written[0], "product_id") < 200  # 4,040 if the whole log is dealt
    monkeypatch.undo()
    st.merge(batch)
    day = dt.date(2024, 1, 2)
    ended = st.read().where(F.col("end_date").isNotNull()).collect()
    assert len(ended) == 40 and {r.end_date for r in ended} == {day} and st.read().count() == 4040
    assert st.inserted().count() == 4040
    few = spark.createDataFrame([("5",), ("77",), (None,)], "product_id string")
    got = st.read_open(few)
    assert {(r.product_id, r.effective_date) for r in got.collect()} >= {("5", day), ("77", dt.date(2024, 1, 1))}
    assert got.count() < 100 and st.read_open().count() == 4000


def test_relationship_deals_few_parents_and_counts_children(spark):
    parent = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    child = spark.createDataFrame([("1",), ("1",), ("x",), ("x",), ("y",), (None,)], "c string")
    report = CH.check_relationship(child, parent, "t", "c", "k")
    assert [(r.column_name, r.failures) for r in report.collect()] == [("c", 3)]
    assert _dealt(report, "c") < 200
    assert CH.check_relationship(child.where("c = '1'"), parent, "t", "c", "k").first().failures == 0
    assert CH.check_relationship(child.where("false"), parent, "t", "c", "k").first().failures == 0
    assert CH.check_relationship(child, parent.where("false"), "t", "c", "k").first().failures == 5

def test_asof_versions_meet_facts_in_their_parts_only(spark):
    days = [dt.date(2024, 1, d) for d in (1, 20)]
    dim = spark.createDataFrame([(k, days[0], days[1], "a") for k in range(50)] + [(k, days[1], None, "b") for k in range(50)],
                                "k int, effective_date date, end_date date, v string")
    facts = spark.createDataFrame([(k, dt.date(2024, 3, 1) if k % 2 else days[0]) for k in range(60)], "fk int, day date")
    got = AS.asof_carry(facts, dim, "fk", "k", "day").select("fk", "version.v")
    assert {(r.fk, r.v) for r in got.collect()} == {(k, "b" if k % 2 else "a") for k in range(50)}
    # 110 rows that prepare the blocks, 110 blocks at most; then 60 facts, each with its one or two
    # versions. Versions that go to every part would be 400 or more.
    assert _dealt(got, "_key") <= 460


def test_the_stream_lands_days_of_a_table_computed_once(spark, monkeypatch, tmp_path):
    spark.range(20).selectExpr("id l_partkey", "timestamp'1995-03-01' l_shipdate", "double(id) l_quantity", "0.1d l_discount",
                               "'N' l_returnflag").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(20).selectExpr("id p_partkey", "'n' p_name", "'t' p_type", "2.5d p_retailprice").write.parquet(
        f"{tmp_path}/part.parquet")
    landed = []
    whole = CAT.STR.land_days_in_order
    monkeypatch.setattr(CAT.STR, "land_days_in_order", lambda raw, *args, **kw: (landed.append(raw), whole(raw, *args, **kw))[1])
    assert CAT.QUERIES["stream_scd2_available_now"](spark, str(tmp_path)).count() == 19  # id 0 has no name
    assert landed[0].count() == 20 and not [f for f in landed[0].inputFiles() if "lineitem" in f]
