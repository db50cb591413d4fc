"""Every catalog query against its DuckDB oracle on the smallest tables."""

import os

import pytest

import __spark_entry__ as E
from daybook.plans.catalog import ORACLE, QUERIES
from daybook.session import apply_conf
from duck_compare import compare_one, duck

SF_DIR = os.environ.get("DAYBOOK_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con(spark):
    apply_conf(spark)
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and ORACLE.items() <= E.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare_one(spark, con, SF_DIR, name, QUERIES[name], ORACLE.get(name))
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["comment_id", "product_id", "comment_rating",
                                              "days_to_review", "comment_date", "snapshot_date"]
