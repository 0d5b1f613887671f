"""Registered queries against their SQL counterparts on the smallest data."""

import os

import pytest

from checks.compare import connect, rows_of_duckdb, rows_of_spark
from checks.registry import QUERIES, Context

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def context(spark):
    return Context(spark, SF_DIR)


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(name, context, duck):
    query = QUERIES[name]
    ours = rows_of_spark(query.present(query.run(context)))
    assert ours == rows_of_duckdb(duck, query.oracle())
    assert ours, "nothing was compared"


@pytest.mark.parametrize("name", ["d10_days_past_due", "d19_d32_default_detection", "d38_d40_contagion", "w5_unwinding"])
def test_same_rows_without_ansi(name, spark, duck):
    query = QUERIES[name]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        ours = rows_of_spark(query.present(query.run(Context(spark, SF_DIR))))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert ours == rows_of_duckdb(duck, query.oracle())


def test_the_close_is_repeatable_and_keeps_every_account(spark, context):
    outputs = context.outputs
    accounts = outputs["accounts"]
    assert accounts.count() == context.t17.count() == accounts.select("id_product").distinct().count()
    snapshot = outputs["t17_dpd_credit_cards"]
    assert snapshot.select("autoid").distinct().count() == snapshot.count()
    assert not [c for c in accounts.columns if c.startswith(("asof", "bal_", "cust_", "t01_", "_"))]
