"""SCD2 against a brute-force model of the warehouse's per-batch loop.

The model below replays the incremental SQL model literally, one batch at a
time, in plain Python; the Spark forms (one-job history, per-day apply,
multi-day merge) must all give its rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators import scd2 as S

SPEC = S.Scd2Spec(key="k", tracked=["a", "b"])
STG = T.StructType([T.StructField("k", T.StringType()), T.StructField("a", T.StringType()),
                    T.StructField("b", T.LongType()), T.StructField("load_date", T.DateType())])
DIM = T.StructType([T.StructField("k", T.StringType()), T.StructField("a", T.StringType()),
                    T.StructField("b", T.LongType()), T.StructField("effective_date", T.DateType()),
                    T.StructField("end_date", T.DateType()), T.StructField("is_active", T.BooleanType())])
FLOOR = dt.date(1900, 1, 1)


def _differs(x, y, null_safe):
    if null_safe:
        return x != y
    return x is not None and y is not None and x != y


def model_loop(batches, mode):
    """batches: [(date, {key: (a, b)})] in date order."""
    t = {}
    for d, rows in batches:
        hwm = max((e for (_, e) in t), default=FLOOR)
        if d < hwm:
            continue
        inc = {k: v for k, v in rows.items() if (k, d) not in t}
        strict = mode == S.STRICT
        unchanged = set()
        for (k, e), rec in list(t.items()):
            if rec[3] and k in inc:
                if any(_differs(x, y, strict) for x, y in zip(rec[:2], inc[k])):
                    t[(k, e)] = (rec[0], rec[1], d, False)
                elif strict:
                    unchanged.add(k)
        for k, v in inc.items():
            if k not in unchanged:
                t[(k, d)] = (v[0], v[1], None, True)
    return {(k, e) + v for (k, e), v in t.items()}


def rows_of(df):
    return {(r.k, r.effective_date, r.a, r.b, r.end_date, r.is_active) for r in df.collect()}


def random_batches(seed, keys=40, days=8):
    rnd = random.Random(seed)
    start = dt.date(2024, 1, 1)
    batches = []
    for i in range(days):
        d = start + dt.timedelta(days=i * 3)
        rows = {}
        for k in range(keys):
            if rnd.random() < 0.7:
                rows[f"k{k}"] = (rnd.choice(["x", "y"]), rnd.choice([0, 1, None]))
        batches.append((d, rows))
    return batches


def to_stg(spark, batches):
    return spark.createDataFrame([(k, a, b, d) for d, rows in batches for k, (a, b) in rows.items()], STG)


def materialize(spark, df):
    # Test-only: re-create the small result so the next step's plan is short.
    return spark.createDataFrame(df.collect(), DIM)


@pytest.mark.parametrize("mode", [S.AS_WRITTEN, S.STRICT])
@pytest.mark.parametrize("seed", [1, 2])
def test_history_apply_and_merge_equal_loop(spark, mode, seed):
    batches = random_batches(seed)
    want = model_loop(batches, mode)
    want = {(k, e, a, b, end, act) for (k, e, a, b, end, act) in want}
    stg = to_stg(spark, batches)
    assert rows_of(S.scd2_history(stg, SPEC, mode)) == want

    target = spark.createDataFrame([], DIM)
    for d, _ in batches:
        day = stg.where(F.col("load_date") == F.lit(d))
        target = materialize(spark, S.scd2_apply(target, day, SPEC, mode))
    assert rows_of(target) == want

    cut = batches[3][0]
    early = S.scd2_history(stg.where(F.col("load_date") <= F.lit(cut)), SPEC, mode)
    merged = S.scd2_merge(materialize(spark, early), stg.where(F.col("load_date") > F.lit(cut)), SPEC, mode)
    assert rows_of(merged) == want


def test_worked_example_a_a_b(spark):
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    stg = spark.createDataFrame([("X", "a", 1, d1), ("X", "a", 1, d2), ("X", "b", 1, d3)], STG)
    aw = sorted((r.effective_date, r.end_date, r.is_active) for r in S.scd2_history(stg, SPEC).collect())
    assert aw == [(d1, d3, False), (d2, d3, False), (d3, None, True)]
    st = sorted((r.effective_date, r.end_date, r.is_active) for r in S.scd2_history(stg, SPEC, S.STRICT).collect())
    assert st == [(d1, d3, False), (d3, None, True)]


def test_null_change_unseen_as_written_seen_strict(spark):
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    # a, NULL, b in the nullable column: != is not transitive here.
    stg = spark.createDataFrame([("X", "a", 1, d1), ("X", "a", None, d2), ("X", "a", 2, d3)], STG)
    aw = sorted((r.effective_date, r.end_date) for r in S.scd2_history(stg, SPEC).collect())
    assert aw == [(d1, d3), (d2, None), (d3, None)]
    st = sorted((r.effective_date, r.end_date) for r in S.scd2_history(stg, SPEC, S.STRICT).collect())
    assert st == [(d1, d2), (d2, d3), (d3, None)]


def test_rerun_and_empty_batch_are_noops(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    stg = spark.createDataFrame([("X", "a", 1, d1), ("Y", "b", 1, d1), ("X", "c", 1, d2)], STG)
    dim = materialize(spark, S.scd2_history(stg, SPEC))
    again = S.scd2_apply(dim, stg.where(F.col("load_date") == F.lit(d2)), SPEC)
    assert rows_of(again) == rows_of(dim)
    empty = spark.createDataFrame([], STG)
    assert rows_of(S.scd2_apply(dim, empty, SPEC)) == rows_of(dim)
    assert rows_of(S.scd2_merge(dim, empty, SPEC)) == rows_of(dim)


def test_late_batch_is_ignored_by_gate(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 5)
    dim = materialize(spark, S.scd2_history(spark.createDataFrame([("X", "a", 1, d2)], STG), SPEC))
    late = spark.createDataFrame([("X", "z", 1, d1), ("Z", "z", 1, d1)], STG)
    assert rows_of(S.scd2_apply(dim, late, SPEC)) == rows_of(dim)


@pytest.mark.parametrize("mode", [S.AS_WRITTEN, S.STRICT])
def test_merge_from_every_split_point(spark, mode):
    batches = random_batches(7, keys=25, days=6)
    want = model_loop(batches, mode)
    want = {(k, e, a, b, end, act) for (k, e, a, b, end, act) in want}
    stg = to_stg(spark, batches)
    for i in range(len(batches)):
        cut = batches[i][0]
        early = materialize(spark, S.scd2_history(stg.where(F.col("load_date") <= F.lit(cut)), SPEC, mode))
        merged = S.scd2_merge(early, stg.where(F.col("load_date") > F.lit(cut)), SPEC, mode)
        assert rows_of(merged) == want, i
