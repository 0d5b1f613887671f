import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from duebook.plans.lineage import Intermediate, name_folder, shared_folder
from duebook.plans import lookups
from duebook.plans.lookups import (
    HotKeys,
    attach,
    attach_small,
    fits_in_broadcast,
    join_spread,
    one_row_per_key,
    spread_rows,
)


def accounts(spark):
    """A third of all rows belong to one customer, a tenth to none."""
    customer = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("c"), (F.col("id") % 997).cast("string"))
    )
    return spark.range(6000).select(F.col("id").cast("string").alias("id_product"), customer.alias("c"))


def customers(spark):
    known = spark.range(900).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("k"), "id")
    known = known.unionByName(known.limit(50).withColumn("id", F.col("id") + 1000))
    hot = spark.createDataFrame([("hot", 7), ("hot", 8)], "k string, id long")
    return one_row_per_key(known.unionByName(hot), "k", ["id"], "l_")


def test_hot_keys_are_few_and_exact(spark):
    df = accounts(spark)
    nulls = df.filter("c is null").count()
    hot = HotKeys.find(df, "c", rows_per_task=nulls - 1)
    assert hot.values == ("hot",) and hot.nulls and bool(hot)
    assert not HotKeys.find(df, "c", rows_per_task=nulls).nulls  # just at the limit
    assert HotKeys.find(df, "c", rows_per_task=100).salts == 20  # 2000 rows, 100 to a task
    assert not HotKeys.find(df.filter("c <> 'hot'"), "c", rows_per_task=nulls)
    assert len(HotKeys.find(df, "c", rows_per_task=1, most=7).values) <= 7
    every = HotKeys.find(df, "c", rows_per_task=1)
    repeated = df.filter("c is not null").groupBy("c").count().filter("count > 1").count()
    assert len(every.values) == repeated > 600


def test_more_frequent_keys_than_an_expression_lists(spark, monkeypatch):
    monkeypatch.setattr(lookups, "MOST_LISTED", 100)
    df, lookup = accounts(spark), customers(spark)
    hot = HotKeys.find(df, "c", rows_per_task=1)
    got, plain = attach(df, lookup, "c", "l_key", "id_product", hot), attach(df, lookup, "c", "l_key")
    assert got.columns == plain.columns and got.exceptAll(plain).isEmpty() and got.count() == plain.count()


@pytest.mark.parametrize("limit", [10, 300, 100_000])
def test_inner_join_dealt_by_measured_keys(spark, limit):
    """One key with a third of the left rows and one with many on both sides."""
    left = accounts(spark).withColumn("k", F.length("id_product"))
    right = spark.range(400).selectExpr(
        "case when id % 4 = 0 then 'hot' when id % 50 = 1 then null else concat('c', id % 9) end as r", "cast(id % 5 as int) as m", "id as v")
    on = [(F.col("c"), F.col("r")), (F.col("k"), F.col("m"))]
    dealt = join_spread(left, right, on, (F.col("id_product"), F.col("v")), limit)
    plain = left.join(right, (F.col("c") == F.col("r")) & (F.col("k") == F.col("m")))
    assert dealt.columns == plain.columns
    assert dealt.exceptAll(plain).isEmpty() and dealt.count() == plain.count() > 1000


def test_dealt_parts_are_bounded(spark):
    sides = [
        accounts(spark).selectExpr("c as _key0", "id_product").where("c is not null"),
        spark.range(500).selectExpr("'hot' as _key0", "id"),
    ]
    parts = {r["_key0"]: (r["_parts0"], r["_parts1"]) for r in lookups._parts_by_key(sides, ["_key0"], 100).collect()}
    assert parts == {"hot": (20, 5)}
    assert lookups._parts_by_key(sides, ["_key0"], 5000) is None


def test_few_parts_where_very_many_keys_are_frequent(spark, monkeypatch):
    monkeypatch.setattr(lookups, "MOST_HOT_KEYS", 5)
    sides = [spark.range(400).selectExpr("id % 40 as _key0"), spark.range(10).selectExpr("id as _key0")]
    assert lookups._parts_by_key(sides, ["_key0"], 3) is None  # 12 would do for each
    assert HotKeys.find(sides[0], "_key0", rows_per_task=3, most=5).values == ()


def test_spread_join_gives_the_same_rows(spark):
    df, lookup = accounts(spark), customers(spark)
    plain = attach(df, lookup, "c", "l_key")
    hot = HotKeys("c", ("hot",), nulls=True, salts=5)
    spread = attach(df, lookup, "c", "l_key", "id_product", hot)
    assert spread.columns == plain.columns
    assert sorted(map(tuple, spread.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    shared = attach(spread_rows(df, hot, "id_product"), lookup, "c", "l_key", "id_product", hot)
    assert shared.drop(hot.salt_column).exceptAll(plain).isEmpty()
    nulls = attach(df, lookup, "c", "l_key", "id_product", HotKeys("c", nulls=True, salts=64))
    assert nulls.exceptAll(plain).isEmpty() and nulls.count() == plain.count()


def test_hot_rows_reach_several_salts(spark):
    hot = HotKeys("c", ("hot",), salts=8)
    salts = spread_rows(accounts(spark), hot, "id_product").groupBy("c", hot.salt_column).count()
    sizes = [r["count"] for r in salts.filter("c = 'hot'").collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_largest_task_is_bounded(spark):
    """A key far over the limit: equal rows, and no salt with much over the limit."""
    df = accounts(spark)
    hot = HotKeys.find(df, "c", rows_per_task=250)
    spread = spread_rows(df, hot, "id_product").groupBy("c", hot.salt_column).count()
    assert max(r["count"] for r in spread.collect()) < 1.3 * 250
    lookup = customers(spark)
    got = attach(df, lookup, "c", "l_key", "id_product", hot)
    assert got.exceptAll(attach(df, lookup, "c", "l_key")).isEmpty() and got.count() == df.count()


def test_lookups_shuffled_once_are_the_same(spark):
    known = spark.range(300).selectExpr("cast(id % 250 as string) as k", "id as v")
    plain, once = (one_row_per_key(known, "k", ["v"], "l_", repeats=r) for r in (True, False))
    assert sorted(plain.collect()) == sorted(once.collect())
    text = once._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Sort" not in text[text.index("Exchange") :]  # the exchange has no sort below it


def test_broadcast_only_after_a_measure(spark):
    lookup = customers(spark)
    assert fits_in_broadcast(lookup) and not fits_in_broadcast(lookup, 10_000)
    wide = spark.range(10).selectExpr("repeat('x', 2000) as x")
    assert fits_in_broadcast(wide, 30_000) and not fits_in_broadcast(wide, 15_000)
    small = attach_small(accounts(spark), lookup, "c", "l_key")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_intermediate_tables_in_the_shared_folder(spark):
    keep = Intermediate()
    df = keep(accounts(spark), "accounts")
    assert df.count() == 6000
    assert all(f.startswith(("file:" + shared_folder(spark), "file://" + shared_folder(spark))) for f in df.inputFiles())
    assert spark.conf.get("spark.sql.codegen.maxFields") == "100"
    path = keep.paths[0][1].removeprefix("file://")
    assert os.path.isdir(path)
    keep.clear()
    assert not os.path.exists(path) and not keep.paths


def test_a_missing_folder_is_an_error(spark):
    class Bare:
        conf = {}
        sparkContext = SimpleNamespace(applicationId="bare")

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Bare())
    name_folder(Bare(), "/shared/")
    assert shared_folder(Bare()) == "/shared"
