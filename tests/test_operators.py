"""Hand-computed cases of single operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from duebook.config import INTENDED, OBSERVED
from duebook.functions.calendar import CloseDays
from duebook.operators import contagion, default, events, probation, registers, valuation
from duebook.plans.lookups import HotKeys

DAY = dt.date(2024, 1, 30)


@pytest.fixture(scope="module")
def days(spark):
    return CloseDays.of(DAY, dt.date(2024, 1, 29), None, dt.date(2024, 1, 29))


def test_carrying_amount_keeps_one_row_per_balance(spark):
    card = spark.createDataFrame([("2024-01-12",), ("2024-01-20",)], "working_day string")
    bank = spark.createDataFrame([("2024-01-19",), ("2024-01-21",)], "working_day string")
    t22 = spark.createDataFrame(
        [("2024-01-19", "p", -100.5, "1", 10), ("2024-01-19", "p", -2000.0, "1", 0), ("2024-01-12", "p", -1.0, "1", 0)],
        "working_day string, id_product string, ledger_balance double, account_code string, unamortized_fee long",
    )
    t17 = spark.createDataFrame([("p", 1.0), ("q", 2.0)], "id_product string, gca double")
    result = valuation.gross_carrying_amount(t17, t22, CloseDays.from_calendars(bank, card))
    assert result.columns == ["id_product", "gca"]
    assert sorted(result.collect(), key=str) == [("p", 2000.0), ("p", 90.5), ("q", None)]


def test_interest_accumulates_within_the_month(spark):
    t17 = spark.createDataFrame(
        [("a", "2023-10-01", 100.0, 50.0, 9.0, 9.0), ("a", "2023-10-02", 200.0, 100.0, 100.0, 50.0)],
        "id_product string, working_day string, gross_interest_daily_lcy double, gross_interest_daily_ocy double, "
        "gross_interest_mtd_lcy double, gross_interest_mtd_ocy double",
    )
    result = valuation.interest_month_to_date(t17)
    assert sorted(result.collect()) == [("a", 100.0, 50.0), ("a", 300.0, 150.0)]


def test_new_customers(spark):
    t01 = spark.createDataFrame([("1",), ("2",)], "nrp_customer string")
    t17 = spark.createDataFrame([("1",), ("3",), ("3",)], "customer_number string")
    assert registers.new_customers(t17, t01).collect() == [("3",), ("3",)]
    assert registers.new_customers(t17, t01, INTENDED).collect() == [("3",)]
    with pytest.raises(ValueError):
        registers.new_customers(t17, t01, "other")


STATUS = (
    "id_product string, retail_nonretail_indicator string, working_day date, p_working_day date, dpd_ho int, "
    "default_indicator string, default_reason string, proposed_default_ind string, is_probation string, "
    "start_probation_date date, end_probation_date date, p_default_reason string, p_is_probation string, "
    "p_proposed_default_ind string, p_start_probation_date date, p_end_probation_date date, max_dpd int"
)


def status(spark, *cases):
    base = dict(
        id_product="a", retail_nonretail_indicator="RETAIL", working_day=DAY, p_working_day=DAY - dt.timedelta(1),
        dpd_ho=0, default_indicator="0", default_reason="", proposed_default_ind="0", is_probation="0",
        start_probation_date=None, end_probation_date=None, p_default_reason=",DECEASED", p_is_probation="0",
        p_proposed_default_ind="1", p_start_probation_date=dt.date(2024, 1, 1),
        p_end_probation_date=dt.date(2024, 1, 30), max_dpd=None,
    )
    df = spark.createDataFrame([tuple({**base, **c}.values()) for c in cases], STATUS)
    return df.withColumn(
        "cust_retail",
        F.when(
            F.col("max_dpd").isNotNull(),
            F.struct("max_dpd", F.lit("0").alias("is_forbearance_last3m"), F.lit("0").alias("no_base_defaults")),
        ),
    )


def picked(df, *columns):
    return {r.id_product: tuple(r[c] for c in columns) for r in df.collect()}


def test_probation_start_observed_and_intended(spark, days):
    df = status(spark, {"id_product": "late", "max_dpd": 5}, {"id_product": "none"}, {"id_product": "on", "max_dpd": 0})
    columns = ("default_indicator", "proposed_default_ind", "default_reason", "is_probation", "start_probation_date")
    observed = picked(probation.start_customer_probation(df, days), *columns)
    assert observed["late"] == ("1", "1", "", "0", None)
    assert observed["none"] == ("1", "0", "PRB ,DECEASED", "1", dt.date(2024, 1, 1))
    assert observed["on"] == observed["none"]
    intended = picked(probation.start_customer_probation(df, days, INTENDED), *columns)
    assert intended["late"] == ("1", "1", ",DECEASED", "0", dt.date(2024, 1, 31))
    assert intended["none"] == observed["none"]


def test_probation_end_observed_and_intended(spark, days):
    df = status(
        spark,
        {"id_product": "clear", "max_dpd": 10, "p_is_probation": "1", "is_probation": "1"},
        {"id_product": "stays", "max_dpd": 70, "p_is_probation": "1", "is_probation": "1"},
    )
    columns = ("default_indicator", "is_probation", "end_probation_date")
    assert set(picked(probation.end_probation(df, days), *columns).values()) == {("0", "1", None)}
    intended = picked(probation.end_probation(df, days, INTENDED), *columns)
    assert intended == {"clear": ("0", "0", None), "stays": ("1", "1", dt.date(2024, 1, 31))}


def test_contagion_of_a_customer_with_most_accounts(spark, days):
    """The security classes of one customer are kept apart, however many accounts it has."""
    t17 = spark.range(300).select(
        F.col("id").cast("string").alias("id_product"),
        F.when(F.col("id") < 290, "big").otherwise(F.col("id").cast("string")).alias("customer_number"),
        F.when(F.col("id") == 0, "1").otherwise("0").alias("default_indicator"),
        F.lit("").alias("default_reason"), F.lit("19").alias("account_code"), F.lit(0).alias("dpd_ho"),
        F.lit("0").alias("default_contagion_indicator"), F.lit("0").alias("proposed_default_ind"),
        F.lit("0").alias("is_probation"), F.lit(None).cast("date").alias("start_probation_date"),
        F.lit(None).cast("date").alias("end_probation_date"),
    )
    t22 = t17.select(
        F.lit(dt.date(2024, 1, 29)).alias("working_day"), "id_product", "customer_number",
        (F.col("id_product").cast("int") % 2).cast("string").alias("secured_flag"),
    )
    t01 = t17.select(F.col("customer_number").alias("nrp_customer"), F.lit("PI").alias("customer_segment")).distinct()
    hot = HotKeys.find(t17, "customer_number", rows_per_task=50)
    assert hot.values == ("big",)
    for mode, changed in ((OBSERVED, "0"), (INTENDED, "1")):
        for keys in (None, hot):
            result = contagion.cross_default(t17, t22, t01, days, mode, keys)
            defaulted = result.filter("default_indicator = '1'")
            assert defaulted.count() == 145
            assert {r.default_contagion_indicator for r in defaulted.filter("id_product <> '0'").collect()} == {changed}


def test_all_reasons_of_a_product_are_appended_in_order(spark, days):
    t17 = spark.createDataFrame(
        [("p", "c", "RETAIL", "0", DAY, "0", "", "0", "1", None, None), ("j", "c", "RETAIL", "1", DAY, "0", "", "0", "1", None, None)],
        "id_product string, customer_number string, retail_nonretail_indicator string, is_joint string, working_day date, "
        "default_indicator string, default_reason string, proposed_default_ind string, is_probation string, "
        "start_probation_date date, end_probation_date date",
    )
    flags = list(dict.fromkeys(t.flag for t in default.TRIGGERS))
    bank = dt.date(2024, 1, 29)
    raised = spark.createDataFrame(
        [(bank, "c", "p", *["1"] * 9), (bank, "c", "p", *["1"] * 9), (bank, "c", "j", *["1"] * 9), (DAY, "x", "p", *["1"] * 9)],
        "working_day date, nrp_customer string, id_product string, " + ", ".join(f"{f} string" for f in flags),
    )
    cust = spark.createDataFrame(
        [("c", "RETAIL", "1", "PI", 61, "0", "0", 0.0, 0.0)],
        "nrp_customer string, retail_nonretail string, has_product string, customer_segment string, max_dpd int, "
        "is_forbearance_last3m string, no_base_defaults string, on_balance_default_eur double, total_credit_obligation double",
    )
    result = picked(default.trigger_defaults(t17, raised, cust, days), "default_reason", "end_probation_date")
    everything = "".join(f",{t.reason}" for t in default.TRIGGERS)
    assert result["p"] == (everything, dt.date(2024, 5, 29))
    assert result["j"][0] == ",CONTRACT TERMINATION,DEBT SALE,FORECLOSURE COLLATERAL,FORECLOSURE COLLATERAL"


def test_an_account_can_give_several_events(spark, days):
    reason = "x,DEBT SALE,NON ACCRUED STATUS,CROSS CONTAGION INDICATOR"
    t17 = spark.createDataFrame(
        [("c", "p", DAY, "1", "0", reason, None, 91, 90, "RETAIL", None), ("c", "q", DAY, "0", "1", reason, None, 91, 90, "RETAIL", None)],
        "customer_number string, id_product string, working_day date, default_indicator string, p_default_indicator string, "
        "default_reason string, p_default_reason string, dpd_ho int, p_dpd_ho int, retail_nonretail_indicator string, end_probation_date date",
    )
    codes = spark.createDataFrame([("DPD", "R1")], "reason_desc string, reason_code string")
    result = events.default_events(t17, codes, days)
    assert result.columns == list(events.EVENT_COLUMNS)
    assert sorted(r.default_event_id for r in result.collect()) == [
        "20240130cCROSS CONTAGION INDICATOR", "20240130cDEBT SALE", "20240130cNON ACCRUED STATUS", "20240130cR1",
    ]
    assert {r.probation_end_date for r in result.collect()} == {dt.date(2024, 4, 30)}
