"""What grows with the accounts: files, parts and the rows that are shuffled."""

import datetime
import glob
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from checks.registry import Context
from duebook.config import INTENDED, OBSERVED
from duebook.operators import contagion
from duebook.plans import close as plans
from duebook.plans import lineage
from duebook.plans.lookups import HotKeys
from duebook.sources import history


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Orders with repeated and missing keys, missing customers and a frequent one."""
    top = str(tmp_path_factory.mktemp("bank"))
    orders = spark.range(700).selectExpr(
        "case when id % 50 = 7 then null when id % 40 = 9 then id - 1 else id end as o_orderkey",
        "case when id % 33 = 5 then null when id % 3 = 0 then 4 else id % 60 end as o_custkey",
        "cast(100 + id * 7.25 as double) as o_totalprice",
    )
    tables = {
        "orders": orders,
        "customer": spark.range(50).selectExpr(
            "id as c_custkey", "concat('Customer ', id) as c_name", "cast(id % 5 as int) as c_nationkey",
            "element_at(array('HOUSEHOLD', 'BUILDING', 'FURNITURE', 'MACHINERY'), cast(id % 4 + 1 as int)) as c_mktsegment"),
        "lineitem": spark.range(1400).selectExpr(
            "id div 2 as l_orderkey", "cast(id % 2 + 1 as int) as l_linenumber", "cast(id % 50 as double) as l_quantity",
            "cast(id as double) as l_extendedprice", "'R' as l_returnflag", "timestamp '2024-01-10 00:00:00' as l_shipdate"),
        "events": spark.range(900).selectExpr(
            "id as event_id", "timestamp '2024-01-01 10:00:00' + make_interval(0, 0, 0, cast(id % 30 as int)) as ts", "id % 45 as user_id",
            "element_at(array('error', 'signup', 'click', 'view', 'purchase'), cast(id % 5 + 1 as int)) as event_type"),
        "nation": spark.range(5).selectExpr("cast(id as int) as n_nationkey", "cast(id % 2 as int) as n_regionkey"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{top}/{name}.parquet")
    return top


def same(ours, theirs):
    return ours.count() == theirs.count() > 0 and ours.select(theirs.columns).exceptAll(theirs).isEmpty()


def test_files_grow_with_the_accounts(spark, folder, monkeypatch):
    monkeypatch.setattr(history, "WIDE_ROWS_PER_TASK", 100)
    bank = Context(spark, folder)
    store = bank.store("t14_unwinding")
    assert {e.buckets for e in store.entries()} == {7}
    rows = store.read("t14_unwinding", only={"working_day": datetime.date(2024, 1, 29)})
    given = bank["t14_unwinding"].filter("working_day = date '2024-01-29'")
    assert same(rows.select("id_product", "unwinding_mtd_lcy"), given.select("id_product", "unwinding_mtd_lcy"))


def test_parts_grow_with_the_accounts(spark, folder, monkeypatch):
    bank = Context(spark, folder)
    assert plans._dealt(bank.today, bank.close()) == (4, True)
    monkeypatch.setattr(plans, "WIDE_ROWS_PER_TASK", 100)
    assert plans._dealt(bank.today, bank.close()) == (7, True)
    assert plans._dealt(bank.today.filter("id_product is not null"), bank.close())[1] is False


def wide_exchanges(df, capsys):
    df.explain(mode="formatted")
    sizes = re.findall(r"^\(\d+\) Exchange.*\n(?:Input|Output) \[(\d+)\]", capsys.readouterr().out, re.M)
    assert sizes
    return sum(int(n) > 60 for n in sizes)


@pytest.mark.parametrize("hot", [HotKeys("customer_number"), HotKeys("customer_number", ("000000004",), True, 5)])
def test_customer_lookups_leave_the_accounts_in_place(spark, folder, hot, capsys):
    """Repeated products, and accounts without a product or a customer, get what they got."""
    bank = Context(spark, folder)
    close = plans.Close.of(bank.staged, bank.days, hot=hot)
    accounts = bank.today
    assert accounts.filter("id_product is null and customer_number is not null").count() > 5
    df = plans.attach_by_product(plans.by_product(accounts), accounts, close)
    plain = plans._with_customer_lookups(df, close).drop(hot.salt_column)
    narrow = plans.attach_by_customer(df, accounts, close, loose=True).drop(hot.salt_column)
    assert same(narrow, plain)
    with lineage.settings(spark, {**lineage.WIDE_ROWS, "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        named = plans.attach_by_customer(df, accounts, close)
        assert wide_exchanges(named.filter("true"), capsys) == 1


@pytest.mark.parametrize("mode", [OBSERVED, INTENDED])
def test_contagion_joins_only_what_it_can_change(spark, folder, mode):
    bank = Context(spark, folder)
    close = bank.close(mode)
    df = plans.attach_by_product(plans.by_product(bank.today), bank.today, close)
    df = plans.attach_by_customer(df, bank.today, close, loose=True)
    df = close.keep(plans.detection_and_probation(df, close), "before")
    mixed = F.pmod(F.xxhash64("account_number", "customer_number"), F.lit(12))
    df = df.withColumns(
        {
            "default_indicator": F.when(mixed < 4, "1").when(mixed > 4, "0"),
            "default_reason": F.lit(",DPD"),
            "p_default_end_date": F.when(mixed % 3 > 0, 20230301),
        }
    )
    sources, among = contagion.default_sources(df), contagion.exposure_matters(mode)
    every = contagion.contagion_steps(df, sources, close.days, mode)
    some = contagion.contagion_steps(df, sources, close.days, mode, among=among)
    assert same(some, every)
    assert 0 < df.filter(among).count() < df.filter(contagion.can_be_infected()).count()
    exposed = contagion.attach_contagion(df, sources).filter("exposed").filter(among)
    assert exposed.count() > 0
    close.clear()


def shuffled(spark):
    """Shuffle files on the disks of the session."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {name for folder in folders for _, _, names in os.walk(folder.getPath()) for name in names if name.startswith("shuffle_")}


def gone(spark, before):
    """Whether all that was shuffled since is deleted, which happens in the background."""
    for _ in range(50):
        if not shuffled(spark) - before:
            return True
        time.sleep(0.1)
    return False


def test_a_write_leaves_no_shuffled_rows(spark, folder):
    bank = Context(spark, folder)
    store, rows = bank.store("t14_unwinding"), bank["t14_unwinding"]
    dealt = rows.repartition(3, "id_product")
    before = shuffled(spark)
    dealt.write.format("noop").mode("overwrite").save()
    assert shuffled(spark) - before  # as Spark does by itself
    before, keep = shuffled(spark), lineage.Intermediate()
    kept = keep(dealt, "rows")
    assert {e.buckets for e in store._files("t14_unwinding", rows)} == {store.tables["t14_unwinding"].buckets}
    store._files("t18_cc_payment_schedule", bank["t18_cc_payment_schedule"].repartition(3, "id_product"))
    assert gone(spark, before)
    assert same(kept, rows)
    keep.clear()


@pytest.mark.parametrize("run", [None, "a day"])
def test_the_closed_accounts_replace_the_table_before_them(spark, folder, run):
    """A close that may be resumed keeps both, as the next session looks for them."""
    bank = Context(spark, folder)
    close, top = bank.close(run=run), lineage.shared_folder(spark).removeprefix("file://")
    here = lambda: set(glob.glob(f"{top}/*/before-contagion*"))
    before = here()  # of other tests
    other = close.keep(bank.today.select("id_product"), "before-contagion-of-another-result")
    outputs = plans.daily_close(close, F.lit("2024-01-30 18:00:00").cast("timestamp"))
    names = [re.sub("-[0-9a-f]{32}$", "", path.rpartition("/")[2]) for _, path in close.keep.paths]
    assert names == ["before-contagion-of-another-result", *(["before-contagion"] if run else []), "closed-accounts"]
    assert len(here() - before) == len(names) - 1
    assert outputs["accounts"].count() == bank.today.count() == other.count() > 0
    assert outputs["t17_dpd_credit_cards"].count() == 2 * bank.today.count()
    close.clear()
    assert here() == before


def test_a_published_close_leaves_its_store_alone(spark, folder):
    """What remains are the files that records name, and all rows of the history."""
    bank = Context(spark, folder)
    top = f"{lineage.shared_folder(spark)}".removeprefix("file://")
    kept, stores = (lambda: set(glob.glob(f"{top}/{spark.sparkContext.applicationId}/*"))), set(glob.glob(f"{top}/store-*"))
    before = kept()
    found = bank.close_of_a_store("t17_dpd_credit_cards")
    assert kept() == before
    made = set(glob.glob(f"{top}/store-*")) - stores
    assert len(made) == 1
    store = history.history_store(spark, made.pop(), bank.buckets)
    changes = {"/".join(e.path.split("/")[:2]) for n in (1, 2) for e in store.entries(n)}
    assert {f"{table}/{name}" for table in store.tables for name in store.files.names(f"{store.root}/{table}")} == changes
    day = F.col("working_day") == datetime.date(2024, 1, 30)
    assert found.filter(day).count() == 2 * bank.today.count()
    ids = found.agg(F.count("*"), F.count("autoid"), F.countDistinct("autoid"), F.max("autoid")).first()
    assert len(set(ids)) == 1  # no gaps
    given = bank["t17_dpd_credit_cards"].filter(~day).drop("autoid")
    assert same(found.filter(~day).select(given.columns), given)
