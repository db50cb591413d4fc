import datetime as dt

from pyspark.sql import functions as F

from daybook.functions import expressions as X


def test_sentiment_exact_and_case_sensitive(spark):
    titles = [t for t, _ in X.TITLE_SENTIMENT] + ["hài lòng", "Hài lòng ", "", None, "%"]
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    got = [r[0] for r in df.select(X.sentiment("title")).collect()]
    assert got == ["positive", "positive", "neutral", "negative", "negative",
                   "unknown", "unknown", "unknown", "unknown", "unknown"]


def test_content_and_title_unknown(spark):
    df = spark.createDataFrame([(None, None), ("", ""), ("null", "null"), ("x", "NULL")], "t string, c string")
    got = df.select(X.title_or_unknown("t"), X.content_or_unknown("c")).collect()
    # Empty title is kept; empty or 'null' content becomes unknown.
    assert [tuple(r) for r in got] == [("unknown", "unknown"), ("", "unknown"), ("null", "unknown"), ("x", "NULL")]


def test_epoch_days_between_and_rating(spark):
    df = spark.createDataFrame([(86400 * 3 + 5, 0, 5), (100, None, 0), (None, 100, 6)],
                               "a bigint, b bigint, r bigint")
    got = df.select(X.epoch_to_ts("a").alias("ts"),
                    X.days_between(X.epoch_to_ts("b"), X.epoch_to_ts("a")).alias("d"),
                    X.rating_valid("r").alias("v")).collect()
    assert got[0].ts == dt.datetime(1970, 1, 4, 0, 0, 5)
    assert [r.d for r in got] == [3, None, None]
    assert [r.v for r in got] == [True, False, False]


def test_parse_day_bad_text_is_null(spark):
    df = spark.createDataFrame([("2024-01-05",), ("bad",), (None,)], "d string")
    assert [r[0] for r in df.select(X.parse_day("d")).collect()] == [dt.date(2024, 1, 5), None, None]


def test_last_segment(spark):
    df = spark.createDataFrame([("https://a/b/c1",), ("https://x/c/c22",), ("plain",), ("end/",)], "s string")
    got = df.select(X.last_segment("s", "/c").alias("a"), X.last_segment("s", "/").alias("b")).collect()
    assert [r.a for r in got] == ["1", "22", "plain", "end/"]
    assert [r.b for r in got] == ["c1", "c22", "plain", ""]


def test_changed_null_unsafe_vs_safe(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", None), (None, None)], "x string, y string")
    sides = df.select(F.struct(F.col("x").alias("c")).alias("l"), F.struct(F.col("y").alias("c")).alias("r"))
    got = sides.select(X.changed("l", "r", ["c"]).alias("u"),
                       X.changed("l", "r", ["c"], True).alias("s")).collect()
    assert [r.u for r in got] == [False, True, None, None]
    assert [r.s for r in got] == [False, True, True, False]


def test_sentiment_custom_mapping(spark):
    df = spark.createDataFrame([("great",), ("meh",), ("Hài lòng",)], "title string")
    got = [r[0] for r in df.select(X.sentiment("title", [("great", "positive"), ("meh", "neutral")])).collect()]
    assert got == ["positive", "neutral", "unknown"]
