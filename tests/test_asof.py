"""The as-of join by union and carry against a loop and the pairwise join."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daybook.operators.asof import asof_carry
from daybook.operators.facts import asof_join

START = dt.date(2020, 1, 1)
DIM = "k string, note string, effective_date date, end_date date"
FACT = "id long, key string, day date, k string, _fact int"


def day(n):
    return START + dt.timedelta(days=n)


def made(seed, keys=6):
    r = random.Random(seed)
    dim, facts = [], []
    for k in range(keys):
        starts = sorted(r.sample(range(400), r.randint(0, 12)))
        for i, a in enumerate(starts):
            end = starts[i + 1] if i + 1 < len(starts) else None
            if end is not None and r.random() < 0.3:
                end = r.randint(a + 1, end)  # a gap before the next version
            elif end is None and r.random() < 0.5:
                end = a + 5
            dim.append((f"k{k}", f"v{i}", day(a), None if end is None else day(end)))
    for i in range(300):
        facts.append((i, r.choice([None, "none", *(f"k{k}" for k in range(keys))]),
                      None if r.random() < 0.05 else day(r.randint(-10, 420)), "mine", i % 3))
    return dim, facts + facts[:5]


def want(dim, facts, how):
    out = []
    for f in facts:
        hit = [d for d in dim if f[1] == d[0] and f[2] and d[2] <= f[2] and (d[3] is None or f[2] < d[3])]
        assert len(hit) <= 1
        if hit or how == "left":
            out.append((*f, hit[0] if hit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("block,spread", [(64, 4), (1, 1), (7, 2), (10000, 3)])
def test_equals_the_loop(spark, how, block, spread):
    dim, facts = made(block + spread)
    got = asof_carry(spark.createDataFrame(facts, FACT), spark.createDataFrame(dim, DIM), "key", "k", "day", how, block, spread)
    assert got.columns == ["id", "key", "day", "k", "_fact", "version"]
    rows = sorted(((*r[:5], tuple(r[5]) if r[5] else None) for r in map(tuple, got.collect())), key=repr)
    assert rows == want(dim, facts, how)


def test_empty_sides(spark):
    dim, facts = made(1)
    f, d = spark.createDataFrame(facts, FACT), spark.createDataFrame(dim, DIM)
    assert asof_carry(f, d.limit(0), "key", "k", "day").count() == 0
    assert asof_carry(f, d.limit(0), "key", "k", "day", "left").count() == len(facts)
    assert asof_carry(f.limit(0), d, "key", "k", "day").count() == 0
    with pytest.raises(ValueError):
        asof_carry(f, d, "key", "k", "day", "outer")


def test_hot_key_stays_linear(spark):
    """100,000 facts and 1,000 versions of one key: the pairwise join would form
    10^8 pairs; here no operator makes more rows than it is given, but for the copies
    of versions, and no join is planned."""
    dim = spark.range(1000).selectExpr("'hot' k", "string(id) note", "date_add(date'2020-01-01', int(id)) effective_date",
                                       "date_add(date'2020-01-01', int(id) + 1) end_date")
    facts = spark.range(100_000).selectExpr("id", "'hot' key", "date_add(date'2020-01-01', int(id % 1000)) day")
    got = asof_carry(facts, dim, "key", "k", "day")
    right = got.where(F.col("version.effective_date") == F.col("day"))
    assert got.count() == 100_000 and right.count() == 100_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    small = facts.where("id % 500 < 3")
    pairs = asof_join(small, dim, "key", "k", "day").selectExpr("f.id", "d.note")
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, asof_carry(small, dim, "key", "k", "day").select("id", "version.note").collect()))
