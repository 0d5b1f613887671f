"""Customer, product and product-type registers, and joint loans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.config import CARD_GROUP, CARD_PRODUCT_GROUP, NONRETAIL, OBSERVED, RETAIL, check_mode
from duebook.functions.calendar import CloseDays
from duebook.operators import inputs
from duebook.operators.inputs import on_day
from duebook.plans.lookups import (
    ROWS_PER_TASK,
    HotKeys,
    attach,
    attach_small,
    join_spread,
    missing_from,
    one_row_per_key,
)
from duebook.plans.update import update_where, upsert


def new_customers(
    accounts: DataFrame, t01: DataFrame, mode: str = OBSERVED, hot: HotKeys | None = None
) -> DataFrame:
    """Customers of accounts that the master lacks.

    Observed: one row per account.  Intended: one row per customer.
    """
    key = F.col("nrp_customer")
    if not check_mode(mode):
        customers = accounts.select(F.col("customer_number").alias("nrp_customer")).distinct()
        return missing_from(customers, t01, key, key)
    known = one_row_per_key(t01, "nrp_customer", [], "known_")
    rows = accounts.select("customer_number", *(["id_product"] if hot else []))
    joined = attach(rows, known, "customer_number", "known_key", "id_product", hot)
    fresh = joined.filter(F.col("known_found").isNull())
    return fresh.select(F.col("customer_number").alias("nrp_customer"))


def new_product_types(accounts: DataFrame, types: DataFrame) -> DataFrame:
    """Product types of accounts that the register lacks, without surrounding blanks."""
    seen = accounts.select(F.trim("id_product_type").alias("id_product_type")).distinct()
    fresh = missing_from(seen, types, F.col("id_product_type"), F.trim("id_product_type"))
    return fresh.withColumn("product_group", F.lit(CARD_PRODUCT_GROUP))


def product_register(
    t02: DataFrame,
    accounts: DataFrame,
    t22: DataFrame,
    days: CloseDays,
    run_at: Column,
    mode: str = OBSERVED,
    placed: int = 0,
) -> DataFrame:
    """The register with today's accounts updated or added.

    Observed: register rows without an account are updated as well, with NULLs.  If the
    register is ``placed`` by product in so many files, only today's rows are shuffled.
    """
    columns = ["id_product", "id_product_type", "days_past_due", "customer_number"]
    source = inputs.attach_balances(accounts.select(*columns), t22, days.bank_day, ["facility_id"])
    source = product_register_source(source, placed)
    return merge_product_register(t02, source, run_at, mode)


def product_register_source(df: DataFrame, placed: int = 0) -> DataFrame:
    """Register values of accounts that carry the bank-day balance; one row per product."""
    if placed:
        df = df.repartition(placed, "id_product")
    source = df.select(
        "id_product",
        F.col("customer_number").alias("nrp_customer"),
        "id_product_type",
        F.lit(CARD_PRODUCT_GROUP).alias("product_group"),
        F.col("days_past_due").alias("current_days_past_due"),
        F.concat(F.lit(CARD_GROUP), F.col("bal_facility_id")).alias("ref_id_product"),
    )
    values = [c for c in source.columns if c != "id_product"]
    single = one_row_per_key(source, {"id_product": F.col("id_product")}, values, "")
    return single.drop("found")


def merge_product_register(t02, source, run_at: Column, mode: str = OBSERVED) -> DataFrame:
    names = ("nrp_customer", "id_product_type", "product_group", "current_days_past_due", "ref_id_product")
    values = {name: F.col(f"s_{name}") for name in names}
    update = {**values, "check_flag": F.lit("1"), "last_update": run_at}
    insert = {**update, "id_product": F.col("s_id_product"), "first_entry": run_at}
    return upsert(t02, source, "id_product", update, insert, touch_unmatched=check_mode(mode))


# Customer type code -> segment; the first two are retail.
SEGMENT_OF_TYPE = {"01": "PI", "20": "MICRO", "06": "SME"}
RETAIL_TYPES = ("01", "20")
OTHER_SEGMENT = "CORPORATE"
# Columns whose missing values are stored as empty text.
EMPTY_IF_NULL = (
    "customer_name",
    "customer_phone",
    "customer_address",
    "profit_center",
    "coconut_type",
    "marketing_group",
    "coconut_number",
    "nace_code",
    "esa_code",
)


def onboard_customers(candidates: DataFrame, t01: DataFrame) -> DataFrame:
    """Master rows for candidates that are not customers yet.

    One row per customer: of several candidates the smallest row, compared column
    by column, NULL first.
    """
    code = F.col("coconut_type")
    segment = F.lit(OTHER_SEGMENT)
    for value, name in SEGMENT_OF_TYPE.items():
        segment = F.when(code == value, name).otherwise(segment)
    retail = F.when(code.isin(*RETAIL_TYPES), RETAIL).otherwise(NONRETAIL)
    others = [c for c in candidates.columns if c != "nrp_customer"]
    first = one_row_per_key(candidates, {"nrp_customer": F.col("nrp_customer")}, others, "").drop("found")
    fresh = missing_from(first, t01, F.col("nrp_customer"), F.col("nrp_customer"))
    classified = fresh.withColumns({"retail_nonretail": retail, "customer_segment": segment})
    return classified.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in EMPTY_IF_NULL})


def backfill_esa_code(t01: DataFrame, centers: DataFrame) -> DataFrame:
    """The profit centre's code for customers that have none."""
    codes = one_row_per_key(centers, "profit_center", ["esa_code"], "center_")
    df = attach_small(t01, codes, "profit_center", "center_key", "nrp_customer")
    empty = F.col("esa_code").isNull() | (F.col("esa_code") == "")
    filled = update_where(df, empty, {"esa_code": F.col("center_esa_code")})
    return filled.select(*t01.columns)


def joint_products(
    relations: DataFrame, t22: DataFrame, days: CloseDays, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Products of joint borrowers with their joint group.

    A relation names a facility by two parts of its number.  Relations are
    reduced to one per customer and facility first, so a customer with many of
    both does not produce their product.  The balances of a customer with very many
    facilities are dealt to several tasks.
    """
    borrower = (
        (F.col("is_joint_micro") == "1")
        & (F.col("application_role_code") == "BORROWER")
        & (F.col("product_type") != "LOAN")
    )
    given = F.col("facility_id")
    groups = one_row_per_key(
        relations.filter(borrower),
        {
            "rel_customer": F.col("applicant_id"),
            "rel_branch": F.substring(given, 3, 3),
            "rel_kind": F.substring(given, 1, 2),
        },
        ["joint_group"],
        "rel_",
    )
    held = on_day(t22, days.bank_day).select("id_product", "customer_number", "facility_id")
    same = [
        (F.col("customer_number"), F.col("rel_customer")),
        (F.substring("facility_id", 7, 3), F.col("rel_branch")),
        (F.substring("facility_id", 10, 2), F.col("rel_kind")),
    ]
    by = (F.col("id_product"), F.col("rel_joint_group"))
    matched = join_spread(held, groups, same, by, rows_per_task, right_unique=True)
    return one_row_per_key(matched, "id_product", ["rel_joint_group"], "joined_")


def joint_flags(
    accounts, relations, t22, days: CloseDays, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``is_joint`` and ``joint_id`` of accounts in a joint loan."""
    joint = joint_products(relations, t22, days, rows_per_task)
    df = attach(accounts, joint, "id_product", "joined_key")
    values = {"is_joint": "1", "joint_id": F.col("joined_rel_joint_group")}
    return update_where(df, F.col("joined_found"), values).select(*accounts.columns)
