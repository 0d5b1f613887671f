import datetime
import os

import pytest
from pyspark.sql import functions as F

from checks.bank import Bank
from duebook.functions.calendar import CloseDays
from duebook.operators.default import ROW_DAY, TRIGGERS, customer_events, earliest_day, row_day_products
from duebook.plans.update import (
    conform,
    merge_columns,
    replace_slice,
    update_where,
    upsert,
    with_surrogate_key,
)
from duebook.schema import SNAPSHOT, TABLES, error_snapshot
from duebook.sources.sinks import append, write_version
from duebook.sources.tables import parquet_tables


def rows(df):
    return sorted(df.collect(), key=str)


def test_merge_takes_nulls_and_the_smallest_of_several(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    updates = spark.createDataFrame([("a", None), ("b", 9), ("b", 7), ("z", 0)], "k string, v int")
    merged = merge_columns(target, updates, "k", ["v"])
    assert rows(merged) == [("a", None), ("b", 7), ("c", 3)]
    assert merged.columns == ["k", "v"]


def test_assignments_see_the_row_before(spark):
    df = spark.createDataFrame([(1, 2), (5, 6), (None, 4)], "a int, b int")
    swapped = update_where(df, F.col("a") > 3, {"a": F.col("b"), "b": F.col("a")})
    assert rows(swapped) == [(1, 2), (6, 5), (None, 4)]


def test_replacing_a_slice_twice_changes_nothing(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (None, "n")], "day int, v string")
    new = spark.createDataFrame([(2, "z")], "day int, v string")
    once = replace_slice(df, F.col("day") == 2, new)
    assert rows(replace_slice(once, F.col("day") == 2, new)) == rows(once)
    assert once.count() == 3


def test_upsert_modes(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    source = spark.createDataFrame([("b", 5), ("c", 6)], "k string, v int")
    update = {"v": F.col("s_v")}
    insert = {"k": F.col("s_k"), "v": F.col("s_v")}
    assert rows(upsert(target, source, "k", update, insert)) == [("a", 1), ("b", 5), ("c", 6)]
    touched = upsert(target, source, "k", update, insert, touch_unmatched=True)
    assert rows(touched) == [("a", None), ("b", 5), ("c", 6)]


def test_surrogate_keys_continue_the_history(spark):
    history = spark.createDataFrame([(41,)], "autoid long")
    keyed = with_surrogate_key(spark.range(1000).repartition(7), history)
    ids = {r.autoid for r in keyed.collect()}
    assert len(ids) == 1000 and min(ids) == 42
    first = with_surrogate_key(spark.range(3).coalesce(1), history.limit(0))
    assert min(r.autoid for r in first.collect()) == 1


def test_conform_pads_with_typed_nulls(spark):
    df = conform(spark.createDataFrame([("a", "1")], "ID_PRODUCT string, dpd_ho string"), SNAPSHOT)
    assert [f.name for f in df.schema] == SNAPSHOT.fieldNames()
    assert df.first().dpd_ho == 1 and df.first().gca is None
    assert (len(SNAPSHOT), len(error_snapshot())) == (69, 48)


def test_sinks(spark, tmp_path):
    root = str(tmp_path)
    day = lambda n, v: spark.createDataFrame([(n, v)], "working_day int, v string")
    append(day(1, "a"), f"{root}/t")
    append(day(2, "c"), f"{root}/t")
    append(day(3, "x").filter("false"), f"{root}/t")
    table = parquet_tables(spark, root, ["t"])["T"]
    assert rows(table.select("working_day", "v")) == [(1, "a"), (2, "c")]
    path = write_version(table, f"{root}/v", "1")
    assert spark.read.parquet(path).count() == 2


def test_ids_from_a_known_largest_one_read_no_history(spark):
    assert min(r.autoid for r in with_surrogate_key(spark.range(5), 100).collect()) > 100


def test_trigger_events_are_read_by_day(spark, tmp_path):
    """On a table partitioned by day the scans have day filters that leave days out."""
    flags = dict.fromkeys(t.flag for t in TRIGGERS)
    day = "date '2023-08-01' + cast(id * 4 as int) as working_day"
    rows = spark.range(60).selectExpr(day, "'c' as nrp_customer", "'p' as id_product", *[f"'1' as {f}" for f in flags])
    append(rows, f"{tmp_path}/events")
    events = spark.read.parquet(f"{tmp_path}/events")
    accounts = spark.sql("select 'p' as id_product, date '2024-01-30' as working_day")
    today = datetime.date(2024, 1, 30)
    days = CloseDays.of(today, today)
    on_row_day = next(t for t in TRIGGERS if t.when == ROW_DAY)
    for df in (
        customer_events(events, days, earliest_day(accounts)),
        row_day_products(accounts, events, on_row_day),
    ):
        df.collect()
        filters = df._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("PushedFilters")[0]
        assert "working_day" in filters and ">=" in filters
    assert customer_events(events, days, earliest_day(accounts)).first().trig_is_indebtedness > today


def test_declared_schemas(spark, tmp_path):
    """They hold the columns of the derived tables, and reading with them infers nothing."""
    bank = Bank(spark, "/root/testdata/sf0.001") if os.path.isdir("/root/testdata/sf0.001") else {}
    for name, schema in TABLES.items():
        names = dict(zip(schema.names, (f.dataType for f in schema)))
        for f in bank[name].schema if bank else ():
            assert f.name in names and (names[f.name] == f.dataType or name in STORED_AS_DOUBLE), (name, f)
    rows = spark.createDataFrame([("a", 5.0)], "id_product string, overwritten_ecl double")
    rows.write.parquet(f"{tmp_path}/vw_unwinding")
    assert rows.exceptAll(parquet_tables(spark, str(tmp_path), schemas=TABLES)["vw_unwinding"]).isEmpty()


STORED_AS_DOUBLE = ("t14_unwinding", "t17_dpd_credit_cards", "atmp_t18_cc_payment_schedule")
