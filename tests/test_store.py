"""Stored tables: commits, slices, ids, keyed updates, schemas, placement."""

import datetime
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.functions.calendar import CloseDays
from duebook.operators import carry_forward, registers, unwinding
from duebook.plans import close as plans
from duebook.plans.lineage import Intermediate
from duebook.sources.evolution import Narrowed, fits, reconcile
from duebook.sources.history import close_changes, close_tables, history_store, publish, stored_tables
from duebook.sources.store import Add, Replace, ReplaceAll, Store, Stored, Update
from duebook.sources.tables import SplitRows, split_rows

DAY, BEFORE = datetime.date(2024, 1, 30), datetime.date(2024, 1, 29)


def schema(text):
    """A schema from names and Spark's names of types, without a session."""
    made = T.StructType()
    for column in re.split(r", (?=\w+ )", text):
        name, kind = column.split(" ")
        made.add(name, {"int": "integer", "bigint": "long", "smallint": "short"}.get(kind, kind))
    return made


ROWS = schema("autoid long, id_product string, working_day date, product_group string, v int")


def rows(spark, n, day, group, v=0):
    df = spark.range(n).selectExpr("concat('p', id) as id_product", f"cast(id + {v} as int) as v")
    return df.withColumns({"working_day": F.lit(day).cast("date"), "product_group": F.lit(group)})


@pytest.fixture
def store(spark, tmp_path):
    tables = {"t": Stored(ROWS, ("working_day", "product_group"), "id_product", 4, "autoid"), "u": Stored(schema("k string, v int"))}
    store = Store(spark, str(tmp_path), tables)
    yield store
    store.forget()


def counts(store, table="t"):
    found = store.read(table).groupBy("working_day", "product_group").agg(F.count("*").alias("n")).collect()
    return {(r[0], r[1]): r.n for r in found}


def test_an_empty_store(spark, store):
    assert (store.version(), store.entries(), store.largest_id("t")) == (0, [], 0)
    assert store.read("t").schema.names == ROWS.names and store.read("t").count() == 0


def test_slices_are_replaced_by_declaration(spark, store):
    store.commit(Add("t", rows(spark, 30, BEFORE, "CC").union(rows(spark, 20, DAY, "LN")).union(rows(spark, 10, None, "LN"))))
    owned = [{"working_day": DAY, "product_group": "CC"}]
    store.commit(Replace("t", rows(spark, 40, DAY, "CC"), owned))
    assert counts(store) == {(BEFORE, "CC"): 30, (DAY, "LN"): 20, (None, "LN"): 10, (DAY, "CC"): 40}
    store.commit(Replace("t", rows(spark, 0, DAY, "CC"), owned))  # a rerun without rows
    assert counts(store) == {(BEFORE, "CC"): 30, (DAY, "LN"): 20, (None, "LN"): 10}
    store.commit(Replace("t", rows(spark, 5, None, "LN"), [{"working_day": None}]))
    assert counts(store) == {(BEFORE, "CC"): 30, (DAY, "LN"): 20, (None, "LN"): 5}
    with pytest.raises(ValueError, match="outside"):
        store.commit(Replace("t", rows(spark, 1, DAY, "LN"), owned))
    with pytest.raises(ValueError, match="no slice"):
        store.commit(Replace("t", rows(spark, 1, DAY, "LN"), [{"v": 1}]))
    with pytest.raises(ValueError, match="several"):
        store.commit(Add("t", rows(spark, 1, DAY, "CC")), Add("t", rows(spark, 1, DAY, "CC")))


def test_a_failure_between_two_tables_changes_none(spark, store):
    store.commit(Add("t", rows(spark, 3, DAY, "CC")), ReplaceAll("u", spark.sql("select 'a' as k, 1 as v")))
    broken = spark.sql("select 'a' as k, raise_error('disk full') as v")
    with pytest.raises(Exception, match="disk full"):
        store.commit(Replace("t", rows(spark, 9, DAY, "CC"), [{"working_day": DAY}]), ReplaceAll("u", broken))
    assert store.version() == 1 and counts(store) == {(DAY, "CC"): 3} and store.read("u").count() == 1
    before = store.largest_id("t")
    store.commit(Replace("t", rows(spark, 9, DAY, "CC"), [{"working_day": DAY}]))
    found = store.read("t").agg(F.min("autoid"), F.max("autoid"), F.countDistinct("autoid")).first()
    assert tuple(found) == (before + 1, before + 9, 9)  # the ids of the failed commit are not used again


def test_a_record_without_its_mark_is_not_seen(spark, store):
    store.commit(ReplaceAll("u", spark.sql("select 'a' as k, 1 as v")))
    store.commit(ReplaceAll("u", spark.sql("select 'b' as k, 2 as v")))
    os.remove(f"{store.root}/_commits/version=2/_SUCCESS")
    assert store.version() == 1 and store.read("u").first().k == "a"
    assert store.commit(Add("u", spark.sql("select 'c' as k, 3 as v"))) == 3
    assert sorted(r.k for r in store.read("u").collect()) == ["a", "c"]
    assert [r.k for r in store.read("u", version=1).collect()] == ["a"]


def test_ids_are_reserved_before_rows_are_written(spark, store, monkeypatch):
    def stop(*_):
        raise OSError("lost the driver")

    with monkeypatch.context() as broken:
        broken.setattr(Store, "_written", stop)
        with pytest.raises(OSError):
            store.commit(Add("t", rows(spark, 7, DAY, "CC")))
    assert store.version() == 0 and store.largest_id("t") == 7
    store.commit(Add("t", rows(spark, 5000, DAY, "CC").repartition(7)))
    ids = [r.autoid for r in store.read("t").collect()]
    assert sorted(ids) == list(range(8, 5008))
    with pytest.raises(FileExistsError):
        store.files.create(f"{store.root}/_ids/t/{8:020d}-{5007:020d}")


def test_placed_rows_with_ids_are_shuffled_once(spark, store, monkeypatch):
    """The files with ids are written from files that lie in the buckets already."""
    plans_written = []
    files = Store._files

    def watched(self, table, df, lie=False):
        plans_written.append((lie, df))
        return files(self, table, df, lie)

    monkeypatch.setattr(Store, "_files", watched)
    odd = rows(spark, 40, DAY, "CC").withColumn("id_product", F.expr("case when v % 3 > 0 then concat('p', v % 7) end"))
    given = rows(spark, 900, BEFORE, "CC").union(rows(spark, 500, DAY, "LN")).union(odd).union(odd).repartition(6)
    store.commit(Add("t", given))
    assert [lie for lie, _ in plans_written] == [False, True]
    monkeypatch.undo()
    found = store.read("t")
    assert "Bucketed: true" in plan(found.join(found.groupBy("id_product").count(), "id_product"))[1]
    assert sorted(r.autoid for r in found.select("autoid").collect()) == list(range(1, 1481))
    columns = ["id_product", "working_day", "product_group", "v"]
    want = given.withColumn("working_day", F.col("working_day").cast("date")).select(columns)
    assert found.select(columns).exceptAll(want).isEmpty() and want.exceptAll(found.select(columns)).isEmpty()
    named = {f"{store.root}/{e.path.split('/_change=')[0]}/_change={e.path.split('_change=')[1].split('/')[0]}" for e in store.entries()}
    assert {f"{store.root}/t/{name}" for name in os.listdir(f"{store.root}/t")} == named
    for entry in store.entries():  # one file a bucket, as before
        at = [int(name.partition(".")[0].rpartition("_")[2]) for name in store.files.data_files(f"{store.root}/{entry.path}")]
        assert len(at) == len(set(at)) and set(at) <= set(range(4))


def test_ids_follow_those_of_a_table_without_a_ledger(spark, store):
    plain = Store(spark, store.root, {"t": Stored(ROWS, ("working_day", "product_group"))})
    plain.commit(Add("t", rows(spark, 3, BEFORE, "CC").withColumn("autoid", F.lit(41).cast("long"))))
    store.commit(Add("t", rows(spark, 2, DAY, "CC")))
    assert sorted(r.autoid for r in store.read("t").collect()) == [41, 41, 41, 42, 43]


def test_added_rows_with_known_keys_are_left_out(spark, store):
    new = spark.sql("select * from values ('a', 1), ('b', 2), ('b', 2) as t(k, v)")
    for _ in range(2):
        store.commit(Add("u", new, key="k"))
    assert sorted(map(tuple, store.read("u").collect())) == [("a", 1), ("b", 2)]


def files_of(store, table):
    found = {}
    for top, _, names in os.walk(f"{store.root}/{table}"):
        for name in names:
            if name.endswith(".parquet"):
                with open(f"{top}/{name}", "rb") as f:
                    found[f"{top}/{name}"] = f.read()
    return found


def test_keyed_update_leaves_other_files_alone(spark, store):
    wide = Store(spark, store.root, {"t": Stored(ROWS, ("working_day", "product_group"), "id_product", 16)})
    wide.commit(Add("t", rows(spark, 4000, DAY, "CC").union(rows(spark, 4000, BEFORE, "CC"))))
    before = files_of(wide, "t")
    updates = spark.createDataFrame([("p7", -1, "x"), ("p8", None, "x"), ("nobody", 5, "x")], "id_product string, v int, other string")
    want = wide.read("t").collect()
    want = sorted((r.working_day, r.id_product, {"p7": -1, "p8": None}.get(r.id_product, r.v)) for r in want)
    wide.commit(Update("t", updates, "id_product", ["v"]))
    after = wide.read("t")
    assert sorted((r.working_day, r.id_product, r.v) for r in after.collect()) == want
    assert {f: b for f, b in files_of(wide, "t").items() if f in before} == before
    named = {f.removeprefix("file://").removeprefix("file:") for f in after.inputFiles()}
    assert len(before) - len(named & set(before)) <= 4  # two keys on two days
    assert wide.files_with("t", updates.where("id_product = 'nobody'"), "id_product") == set()
    version = wide.version()
    wide.commit(Update("t", updates.where("id_product = 'nobody'"), "id_product", ["v"]))
    assert wide.entries(version) == wide.entries()
    # a second update also finds files by themselves, and a whole rewrite places rows again
    wide.commit(Update("t", updates.withColumn("v", F.lit(9)), "id_product", ["v"]))
    assert {r.v for r in wide.read("t").where("id_product in ('p7', 'p8')").collect()} == {9}
    assert not any(e.buckets for e in wide.entries() if e.path.endswith(".parquet"))


def test_vacuum_keeps_what_records_name(spark, store):
    for v in range(4):
        store.commit(Replace("t", rows(spark, 50, DAY, "CC", v), [{"working_day": DAY}]), ReplaceAll("u", spark.sql(f"select 'p{v}' as k, {v} as v")))
    store.commit(Update("t", spark.sql("select 'p3' as id_product, -5 as v"), "id_product", ["v"]))
    want = sorted(map(tuple, store.read("t").collect()))
    before = len(files_of(store, "t"))
    assert store.vacuum(keep=1) > 3
    assert len(files_of(store, "t")) < before and sorted(map(tuple, store.read("t").collect())) == want
    assert store.read("u").first().k == "p3" and store.vacuum(keep=1) == 0


# --- schemas ------------------------------------------------------------------


@pytest.mark.parametrize(
    ("stored", "declared", "good"),
    [
        ("int", "bigint", True), ("bigint", "int", False), ("float", "double", True), ("double", "float", False),
        ("int", "double", True), ("bigint", "double", False), ("int", "decimal(12,2)", True), ("int", "decimal(11,2)", False),
        ("decimal(10,2)", "decimal(12,4)", True), ("decimal(10,2)", "decimal(11,3)", True), ("decimal(10,2)", "decimal(10,3)", False),
        ("date", "timestamp", True), ("timestamp", "date", False), ("string", "string", True), ("int", "string", False), ("smallint", "float", True),
    ],
)
def test_types_that_fit(stored, declared, good):
    types = [schema(f"x {t}")["x"].dataType for t in (stored, declared)]
    assert fits(*types) is good


def test_a_history_of_two_schemas(spark, tmp_path):
    old, new = schema("day int, k string, n int"), schema("day int, n bigint, k string, more double")
    Store(spark, str(tmp_path), {"t": Stored(old, ("day",))}).commit(Add("t", spark.sql("select 1 as day, 'a' as k, 7 as n")))
    store = Store(spark, str(tmp_path), {"t": Stored(new, ("day",))})
    store.commit(Replace("t", spark.sql("select 2 as day, 'b' as k, 3000000000 as n, 0.5 as more"), [{"day": 2}]))
    assert sorted(map(tuple, store.read("t").collect())) == [(1, 7, "a", None), (2, 3000000000, "b", 0.5)]
    assert store.read("t", only={"day": 1}).schema == new
    store.commit(Update("t", spark.sql("select 'a' as k, 1.5 as more"), "k", ["more"]))
    assert sorted(map(tuple, store.read("t").collect())) == [(1, 7, "a", 1.5), (2, 3000000000, "b", 0.5)]
    narrow = Store(spark, str(tmp_path), {"t": Stored(old, ("day",))})
    with pytest.raises(Narrowed, match="n: bigint does not fit int; more: not declared"):
        narrow.read("t")
    before = len(files_of(store, "t"))
    with pytest.raises(Narrowed):
        narrow.commit(Add("t", spark.sql("select 3 as day, 'c' as k, 1 as n")))
    assert len(files_of(store, "t")) == before
    narrow.commit(ReplaceAll("t", spark.sql("select 3 as day, 'c' as k, 1 as n")))
    assert narrow.read("t").count() == 1


def test_reconcile_is_by_name(spark):
    df = spark.createDataFrame([(1, "a")], "N int, k string")
    assert reconcile(df, schema("k string, n bigint, x date")).collect() == [("a", 1, None)]


# --- placement ----------------------------------------------------------------


def plan(df):
    spark = df.sparkSession
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df._jdf.queryExecution().sparkPlan().toString(), df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def branch_above(text, scan):
    """The lines of a plan from a scan up to the first join above it."""
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if scan in line)
    indent = len(lines[at]) - len(lines[at].lstrip(" :+-|"))
    above = []
    for line in reversed(lines[:at]):
        depth = len(line) - len(line.lstrip(" :+-|"))
        if depth < indent:
            indent = depth
            if "Join" in line:
                break
            above.append(line)
    return "\n".join(above)


def cards(spark, tables):
    return spark.createDataFrame([(f"p{i}", f"c{i}", "VISA", i, DAY) for i in range(40)], "id_product string, customer_number string, id_product_type string, days_past_due int, working_day date")


def test_previous_day_and_register_are_not_shuffled(spark, tmp_path):
    store = history_store(spark, str(tmp_path), buckets=4)
    specs = stored_tables(4)

    def filled(name, **columns):
        names = specs[name].schema.names
        base = spark.range(60).selectExpr("concat('p', id) as id_product", "cast(id as int) as n")
        base = base.withColumns({k: F.lit(v) if not isinstance(v, F.Column) else v for k, v in columns.items()})
        return base.select(*[c for c in base.columns if c in names])

    n = F.col("n")
    store.commit(
        Add("t17_dpd_credit_cards", filled("t17_dpd_credit_cards", working_day=BEFORE, dpd_ho=n)),
        Add("t14_unwinding", filled("t14_unwinding", working_day=BEFORE, product_group="CC", unwinding_mtd_lcy=n.cast("double"))),
        ReplaceAll("t02_customer_product", filled("t02_customer_product", check_flag="0", current_days_past_due=n)),
    )
    days = CloseDays.of(DAY, DAY, DAY, BEFORE)
    tables = close_tables(store, {}, days)
    from duebook.schema import TABLES

    accounts = rows(spark, 50, DAY, "CC").select("id_product", "working_day")
    accounts = accounts.select(*[
        F.col(f.name) if f.name in ("id_product", "working_day") else F.lit(None).cast(f.dataType).alias(f.name)
        for f in TABLES["atmp_t17_dpd_credit_cards"].fields
    ])
    carried = carry_forward.carry_forward(plans.by_product(accounts, 4), tables["t17_dpd_credit_cards"], days, placed=True)
    text = plan(carried)[1]
    assert "Bucketed: true" in text and "Exchange" not in branch_above(text, "FileScan")
    assert {r.id_product: r.p_dpd_ho for r in carried.collect()} == {f"p{i}": i for i in range(50)}

    unwound = unwinding.carry_unwinding(plans.by_product(filled("t14_unwinding", working_day=DAY, product_group="CC", unwinding_mtd_lcy=0.0), 4), tables["t14_unwinding"], days)
    text = plan(unwound)[1]
    assert "Bucketed: true" in text and "Exchange" not in branch_above(text, "FileScan")
    assert {r.unwinding_mtd_lcy for r in unwound.collect()} == set(map(float, range(60)))

    today = cards(spark, tables).withColumn("bal_facility_id", F.lit("F"))
    for mode in ("observed", "intended"):
        merged = registers.merge_product_register(
            tables["t02_customer_product"], registers.product_register_source(today, 4), F.lit("2024-01-30").cast("timestamp"), mode)
        text = plan(merged)[1]
        assert "Bucketed: true" in text and "Exchange" not in branch_above(text, "FileScan")
        flags = {r.id_product: r.check_flag for r in merged.collect()}
        assert len(flags) == 60 and flags["p3"] == "1" and flags["p50"] == ("1" if mode == "observed" else "0")
    store.forget()


def test_publishing_twice_gives_the_same_tables(spark, tmp_path):
    store = history_store(spark, str(tmp_path), buckets=2)
    days = CloseDays.of(DAY, DAY, DAY, BEFORE)
    types = spark.sql("select 'VISA' as id_product_type, 'CREDIT CARD' as product_group")
    unwound = rows(spark, 6, DAY, "CC").withColumn("gca_all", F.lit(1.0)).drop("v")
    outputs = {"t14_unwinding": unwound, "tc01_product_type": types}
    assert [c.table for c in close_changes(outputs, DAY)] == ["t14_unwinding", "tc01_product_type"]
    for _ in range(2):
        publish(outputs, store, days)
    assert store.read("t14_unwinding").count() == 6 and store.read("tc01_product_type").count() == 1
    publish({"t14_unwinding": unwound.limit(0)}, store, days)
    assert store.read("t14_unwinding").count() == 0 and store.read("tc01_product_type").count() == 1


# --- restart ------------------------------------------------------------------


def test_intermediate_tables_of_a_failed_run_are_found(spark):
    key = "0" * 8
    first, other = Intermediate(key), Intermediate("1" * 8)
    assert first(spark.range(5), "a").count() == 5
    again = Intermediate(key)
    assert again(spark.range(9), "a").count() == 5  # read, not computed
    assert other(spark.range(9), "a").count() == 9
    path = again.paths[0][1].removeprefix("file://")
    os.remove(f"{path}/_SUCCESS")  # as if the write had stopped
    assert Intermediate(key)(spark.range(7), "a").count() == 7
    for keep in (again, other):
        keep.clear()
    assert not os.path.exists(path)


# --- parts of a read ----------------------------------------------------------


@pytest.mark.parametrize("kind", ["string", "long", "date", "timestamp", "double"])
def test_parts_cover_every_row_once_and_evenly(spark, kind):
    skewed = spark.range(4000).selectExpr("case when id % 3 = 0 then 77 when id % 101 = 1 then null else id * id % 9973 end as n", "id")
    value = {"date": "date_add(date '2020-01-01', cast(n as int))", "timestamp": "timestamp_seconds(n * 1000)", "string": "concat('it''s ', n)"}
    df = skewed.selectExpr(f"{value.get(kind, f'cast(n as {kind})')} as k", "id")
    parts = split_rows(df.sample(0.5, seed=1), "k", 6, quote="`").predicates
    found = [df.where(p) for p in parts]
    ids = [r.id for part in found for r in part.select("id").collect()]
    assert sorted(ids) == list(range(4000)) and 4 <= len(parts) <= 6
    assert max(part.where("n <> 77" if "n" in part.columns else "true").count() for part in found) < 2400


def test_parts_of_odd_columns(spark):
    none = spark.createDataFrame([], "k string")
    assert split_rows(none, "k", 4) == SplitRows(('"k" is null or "k" is not null',))
    one = spark.sql("select 5 as k from range(10)")
    for n in (1, 3):
        parts = split_rows(one, "k", n, quote="`").predicates
        assert sum(one.where(p).count() for p in parts) == 10
