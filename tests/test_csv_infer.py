"""CSV type inference and rejects."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.session import scratch_path
from daybook.sinks import tables as SK
from daybook.sources import csv_infer as CI


def written(spark, rows, cols):
    path = scratch_path(spark, "csv")
    SK.write_csv(spark.createDataFrame(rows, cols), path)
    return path


def test_lattice(spark):
    rows = [("1", "1.5", "007", "2024-01-30", "2024-01-30 10:00:00", "true", None, "2024-02-30", "1", "-0"),
            ("-5", "2", "12", None, "2024-01-31T10:00:00Z", "FALSE", None, "2024-02-28", "x", "1"),
            (None, "-1e3", "1", "1999-12-31", None, None, None, "2024-02-27", "2", "2")]
    cols = "whole string, dec string, zip string, day string, at string, flag string, nothing string, bad string, mixed string, minus string"
    got = {f.name: f.dataType.simpleString() for f in CI.infer(CI.read_text(spark, written(spark, rows, cols))).fields}
    assert got == {"whole": "bigint", "dec": "double", "zip": "string", "day": "date", "at": "timestamp", "flag": "boolean",
                   "nothing": "string", "bad": "string", "mixed": "string", "minus": "double"}


def test_contract_round_trip_and_empty(spark):
    path = scratch_path(spark, "contract")
    contract = T.StructType([T.StructField("a b", T.LongType()), T.StructField("d", T.DateType())])
    CI.save_contract(spark, contract, path)
    assert CI.load_contract(spark, path) == contract
    text = CI.read_text(spark, written(spark, [("1",)], "a string")).limit(0)
    assert CI.infer(text) == T.StructType([T.StructField("a", T.StringType())])


def test_rows_that_break_the_contract_are_kept(spark):
    path = written(spark, [(str(i), "n/a" if i % 10 == 3 else f"{i}.5", "x,y" if i == 1 else "z") for i in range(50)],
                   "id string, price string, note string")
    contract = T.StructType([T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType()),
                             T.StructField("note", T.StringType())])
    landed = SK.land_ingested(CI.read_typed(spark, path, contract), scratch_path(spark, "typed"))
    assert SK.rows(landed).count() == 45 and SK.rows(landed).columns == ["id", "price", "note"]
    assert SK.rows(landed).agg(F.sum("price")).first()[0] == sum(i + 0.5 for i in range(50) if i % 10 != 3)
    assert sorted(r[0] for r in SK.rejects(landed).collect()) == sorted(f"{i},n/a,z" for i in range(3, 50, 10))


@pytest.mark.parametrize("sample", [0.2, 1.0])
def test_sample_widens_or_rejects_but_never_loses(spark, sample):
    path = written(spark, [(str(i) if i % 97 else "late",) for i in range(1, 1000)], "v string")
    contract = CI.infer(CI.read_text(spark, path), sample)
    got = SK.land_ingested(CI.read_typed(spark, path, contract), scratch_path(spark, "typed"))
    assert got.count() == 999
    bad = SK.rejects(got).count()
    assert bad == (10 if contract["v"].dataType == T.LongType() else 0)
