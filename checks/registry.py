"""Every registered query with its SQL counterpart.

A query names its result columns once, with a letter for the type both engines
present them in: s text (also dates), i integer, f double, r double to six
decimals, b boolean.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import steps as q
from checks.bank import SNAPSHOT_COLUMNS, Bank, with_clause
from duebook.config import INTENDED
from duebook.functions.calendar import CloseDays, latest_day, latest_day_before, latest_day_until
from duebook.functions.daycount import year_fraction
from duebook.functions.reasons import mentions_any
from duebook.operators import (
    attributes,
    carry_forward,
    commit,
    contagion,
    default,
    delinquency,
    events,
    inputs,
    probation,
    recovery,
    registers,
    unwinding,
    valuation,
)
from duebook.plans import close as plans
from duebook.plans.lineage import shared_folder
from duebook.plans.lookups import HotKeys, missing_from
from duebook.plans.update import (
    conform,
    merge_columns,
    replace_slice,
    set_everywhere,
    update_where,
    with_surrogate_key,
)
from duebook.schema import SCHEDULE, SNAPSHOT, TABLES, error_snapshot
from duebook.sources.history import buckets_for, close_tables, history_store, publish
from duebook.sources.sinks import append, write_version
from duebook.sources.store import Add, ReplaceAll, Store, Stored, Update
from duebook.sources.tables import Tables, split_rows

T17 = "atmp_t17_dpd_credit_cards"
TODAY = "t17_today"
RUN_AT = "2024-01-30 18:00:00"
SQL_TYPES = {"s": "varchar", "i": "bigint", "f": "double", "r": "double", "b": "boolean"}
SPARK_TYPES = {"s": "string", "i": "bigint", "f": "double", "r": "double", "b": "boolean"}


class Context:
    """Tables, days and frequent customers of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.bank = Bank(spark, sf_dir)

    def __getitem__(self, name: str) -> DataFrame:
        return self.bank[name]

    @property
    def t17(self) -> DataFrame:
        return self.bank[T17]

    @cached_property
    def days(self) -> CloseDays:
        days = CloseDays.from_calendars(self["w01_working_day"], self["w02_ccworking_day"])
        return days.resolved(self.bank.spark)

    @cached_property
    def hot(self) -> HotKeys:
        return HotKeys.find(self.t17, "customer_number")

    @cached_property
    def buckets(self) -> int:
        """Files that stored tables are placed in, four or as many as the accounts need."""
        return buckets_for(self["base"].count())

    @property
    def today(self) -> DataFrame:
        """Staging as a close finds it: one day."""
        return self.bank[TODAY]

    @cached_property
    def outputs(self) -> dict[str, DataFrame]:
        """All outputs of one daily close."""
        return plans.daily_close(self.close(), _run_at())

    @property
    def staged(self) -> Tables:
        """Tables as a close finds them."""
        staging = {T17: TODAY, "err_atmp_t17_dpd_credit_cards": "err_today"}
        return Tables(lambda name: self.bank[staging.get(name, name)])

    def close(self, mode: str = "observed", run: str | None = None) -> plans.Close:
        return plans.Close.of(self.staged, self.days, mode, self.hot, run=run)

    def close_of_a_store(self, name: str) -> DataFrame:
        """A stored table after a whole close that reads its tables in place."""
        store = self.store("t17_dpd_credit_cards", "t14_unwinding", "t19_default_events", "t02_customer_product", "tc01_product_type")
        tables = close_tables(store, self.staged, self.days)
        close = plans.Close.of(tables, self.days, hot=self.hot, placed=self.buckets)
        publish(plans.daily_close(close, _run_at()), store, self.days)
        close.clear()
        return store.read(name)

    def store(self, *names: str, buckets: int = 0) -> Store:
        """A new store that holds the tables named, in ``buckets`` files a slice at least."""
        root = f"{shared_folder(self.bank.spark)}/store-{uuid.uuid4().hex}"
        store = history_store(self.bank.spark, root, max(buckets, self.buckets))
        store.commit(*(Add(name, self[name]) for name in names))
        return store

    def published(self, name: str) -> DataFrame:
        """A stored table after the close has been published over it twice."""
        store = self.store(name)
        for _ in range(2):
            publish({name: self.outputs[name]}, store, self.days)
        return store.read(name)

    def published_empty(self, name: str) -> DataFrame:
        """A stored table after a close, and then one again that has no rows."""
        store, rows = self.store(name), self.outputs[name]
        publish({name: rows}, store, self.days)
        publish({name: rows.limit(0)}, store, self.days)
        return store.read(name)

    def published_in_part(self) -> DataFrame:
        """The unwinding table after a second close of both tables failed at the other."""
        names = ("t14_unwinding", "t19_default_events")
        store, rows = self.store(*names), {name: self.outputs[name] for name in names}
        publish(rows, store, self.days)
        wrong = rows["t19_default_events"].withColumn("event_start_date", F.lit("1999-01-01").cast("date"))
        try:
            publish({names[0]: rows[names[0]].limit(0), names[1]: wrong}, store, self.days)
        except ValueError:
            return store.read(names[0])
        raise AssertionError("rows outside of the slices of a close were published")

    def ids_after_a_crash(self) -> DataFrame:
        """Unwinding rows whose ids had been reserved once before, by a close that stopped."""
        store = self.store("t14_unwinding")
        lost = store.reserve("t14_unwinding", 1000)
        publish({"t14_unwinding": self.outputs["t14_unwinding"]}, store, self.days)
        rows = store.read("t14_unwinding")
        today = F.col("working_day") == self.days.card_day
        return rows.agg(
            F.count(F.lit(1)).alias("n"), F.countDistinct("autoid").alias("ids"),
            (F.min(F.when(today & (F.col("product_group") == "CC"), F.col("autoid"))) >= lost + 1000).alias("above"))

    def updated(self, name: str, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
        store = self.store(name, buckets=16)
        store.commit(Update(name, updates, key, columns))
        return store.read(name)

    def placed(self, name: str, **only) -> DataFrame:
        """A table as a store gives it, placed by product in :attr:`buckets` files a slice."""
        return self.store(name).read(name, only=only)

    def two_schemas(self) -> DataFrame:
        """The register stored before its counter became wide and a column came in."""
        root = f"{shared_folder(self.bank.spark)}/store-{uuid.uuid4().hex}"
        now = T.StructType.fromJson(TABLES["t02_customer_product"].jsonValue()).add("branch", "string")
        now["current_days_past_due"].dataType = T.LongType()
        rows, old = self["t02_customer_product"], TABLES["t02_customer_product"]
        card = F.col("product_group") == "CREDIT CARD"
        Store(self.bank.spark, root, {"r": Stored(old)}).commit(ReplaceAll("r", rows.where(card)))
        store = Store(self.bank.spark, root, {"r": Stored(now)})
        store.commit(Add("r", rows.where(~card).withColumn("branch", F.lit("B1"))))
        return store.read("r")

    def resumed_engine(self) -> DataFrame:
        """The default engine of a second close that finds the first one's table."""
        run = uuid.uuid4().hex
        plans.default_engine(self.today, self.close(run=run))
        return plans.default_engine(self.today, self.close(run=run))

    def read_by_parts(self, name: str, column: str, parts: int) -> DataFrame:
        """A table read condition by condition, as several tasks would read it."""
        conditions = split_rows(self[name], column, parts, quote="`").predicates
        whole = self[name].where(conditions[0])
        for condition in conditions[1:]:
            whole = whole.union(self[name].where(condition))
        return whole

    def stored(self, write: Callable[[str], None]) -> DataFrame:
        """What ``write`` leaves in a new folder."""
        path = f"{shared_folder(self.bank.spark)}/stored-{uuid.uuid4().hex}"
        return self.bank.spark.read.parquet(write(path) or path)


@dataclass(frozen=True)
class Query:
    columns: str
    run: Callable[[Context], DataFrame]
    tables: Sequence[str]
    sql: str  # a FROM item or a whole statement over the CTEs
    ctes: Sequence[tuple[str, str]] = ()

    def present(self, df: DataFrame) -> DataFrame:
        shown = []
        for name, kind in self.spec():
            value = F.col(name).cast(SPARK_TYPES[kind])
            shown.append((F.round(value, 6) if kind == "r" else value).alias(name))
        return df.select(*shown)

    def spec(self) -> list[tuple[str, str]]:
        pairs = []
        for item in self.columns.split():
            name, _, kind = item.partition(":")
            pairs.append((name, kind or "s"))
        return pairs

    def oracle(self) -> str:
        ctes = [with_clause("w01_working_day", "w02_ccworking_day", *self.tables), q.DAYS]
        # long chains name earlier steps several times: work each step out once
        kept = "materialized " if len(self.ctes) > 12 else ""
        ctes += [f"{name} as {kept}({text})" for name, text in self.ctes]
        shown = []
        for name, kind in self.spec():
            value = f"cast({name} as {SQL_TYPES[kind]})"
            shown.append((f"round({value}, 6)" if kind == "r" else value) + f" as {name}")
        body = self.sql if self.sql.split()[0].isidentifier() and " " not in self.sql else f"({self.sql})"
        return f"with {', '.join(ctes)}\nselect {', '.join(shown)} from {body} z"


QUERIES: dict[str, Query] = {}


def add(name, columns, run, tables, sql, ctes=()):
    QUERIES[name] = Query(columns, run, tables, sql, tuple(ctes))


def chain(step_list, start=T17):
    """CTEs that run the steps in order; returns them and the last name."""
    ctes, previous = [], start
    for number, step in enumerate(step_list):
        name = f"step{number}"
        ctes.append((name, step(previous)))
        previous = name
    return ctes, previous


def add_steps(name, columns, run, tables, step_list, start=T17):
    ctes, last = chain(step_list, start)
    add(name, columns, run, [T17, *tables], last, ctes)


STATUS = (
    "id_product default_indicator default_reason proposed_default_ind is_probation "
    "start_probation_date end_probation_date"
)
PREVIOUS = "p_is_probation p_proposed_default_ind p_start_probation_date p_end_probation_date"
CONTAGION = STATUS + " default_contagion_indicator"
COUNTERS = (
    "times_past_due:i maximum_days_past_due:i total_days_past_due:i current_days_in_excess:i "
    "maxdpd_current_month:i absorbing_status_flag:i date_absorbing_status exposure_at_absorbing:f"
)
ATTRIBUTES = (
    "historical_default_indicator default_amount:f default_start_date:i default_end_date:i "
    "default_id interest_rate_default:f"
)
DETECT_TABLES = [
    "technical_default",
    "atmp_default_triggers",
    "atmp_customer",
    "t01_customer",
    "tc08_configuration_table",
]

# --- calendars, scans, predicates ---------------------------------------------------

add("a1_latest_day", "working_day", lambda c: latest_day(c["w02_ccworking_day"]), [],
    f"select {q.CC} as working_day")
add("a2_latest_day_until", "working_day",
    lambda c: latest_day_until(c["w01_working_day"], c.days.card_day), [],
    f"select {q.ASOF} as working_day")
add("a3_latest_day_before", "working_day",
    lambda c: latest_day_before(c["w02_ccworking_day"], c.days.card_day), [],
    f"select {q.PREV} as working_day")
add("a4_next_day", "working_day n:i",
    lambda c: c["w02_ccworking_day"].agg(F.count(F.lit(1)).alias("n")).withColumn("working_day", c.days.next_day), [],
    f"select {q.NEXT} as working_day, (select count(*) from w02_ccworking_day) as n")
add("a5_largest_id", "largest:i",
    lambda c: c["t17_dpd_credit_cards"].agg(F.max("autoid").alias("largest")), ["t17_dpd_credit_cards"],
    "select max(autoid) as largest from t17_dpd_credit_cards")
add("a6_sum_by_product", "id_product sum_amount_event:f",
    lambda c: recovery.recovery_movements(c["t26_writteoff_recovery"], c.days), ["t26_writteoff_recovery"],
    q.movements_sql())
add("a7_distinct_keys", "id_product",
    lambda c: default.technical_products(c["technical_default"], c.days).select(F.col("tech_product_key").alias("id_product")),
    ["technical_default"], f"select distinct id_product from technical_default where system_date = {q.WD}")
add("a8_row_count", "n:i", lambda c: c["t22_card_balance"].agg(F.count(F.lit(1)).alias("n")),
    ["t22_card_balance"], "select count(*) as n from t22_card_balance")
add("s3_scan_of_a_day", "id_product customer_number ledger_balance:f",
    lambda c: inputs.on_day(c["t22_card_balance"], c.days.bank_day), ["t22_card_balance"],
    f"select * from t22_card_balance where working_day = {q.WD}")
add("s5_merge_columns", "id_product card_balance:f working_day",
    lambda c: merge_columns(
        c.t17,
        c["t26_writteoff_recovery"].select(
            "id_product", F.col("amount_event").alias("card_balance"), "working_day"),
        "id_product", ["card_balance", "working_day"]),
    [T17, "t26_writteoff_recovery"],
    "select t.id_product, coalesce(u.amount_event, t.card_balance) as card_balance, coalesce(u.working_day, t.working_day) as working_day from "
    f"{T17} t left join (select *, row_number() over (partition by id_product order by amount_event, working_day) as rn from t26_writteoff_recovery) u on t.id_product = u.id_product and u.rn = 1")
add("s6_update_takes_nulls", "id_product joint_id",
    lambda c: merge_columns(
        c.t17,
        c["vw_unwinding"].select(
            "id_product", F.col("overwritten_ecl").cast("int").cast("string").alias("joint_id")),
        "id_product", ["joint_id"]),
    [T17, "vw_unwinding"],
    f"select t.id_product, case when v.id_product is not null then cast(cast(v.overwritten_ecl as int) as varchar) else t.joint_id end as joint_id from {T17} t left join vw_unwinding v on t.id_product = v.id_product")
add("s5_keyed_update_of_files", "id_product current_days_past_due:i check_flag",
    lambda c: c.updated(
        "t02_customer_product",
        c.t17.filter("cast(account_number as bigint) % 1000 = 0").select(
            "id_product", F.col("dpd_ho").alias("current_days_past_due"), F.lit(None).cast("string").alias("check_flag")),
        "id_product", ["current_days_past_due", "check_flag"]),
    [T17, "t02_customer_product"],
    "select r.id_product, case when t.id_product is not null then t.dpd_ho else r.current_days_past_due end as current_days_past_due, "
    f"case when t.id_product is null then r.check_flag end as check_flag from t02_customer_product r left join (select * from {T17} where cast(account_number as bigint) % 1000 = 0) t on r.id_product = t.id_product")
add("s7_set_everywhere", "id_product p_working_day",
    lambda c: set_everywhere(c.t17, "p_working_day", c.days.previous_day), [T17],
    f"select id_product, {q.PREV} as p_working_day from {T17}")
add("s11_surrogate_key", "n:i ids:i above:b",
    lambda c: with_surrogate_key(c.t17, c["t17_dpd_credit_cards"]).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("autoid").alias("ids"),
        (F.min("autoid") > c["t17_dpd_credit_cards"].agg(F.max("autoid")).scalar()).alias("above")),
    [T17], f"select count(*) as n, count(distinct id_product) as ids, true as above from {T17}")
add("s12_schema_padding", "id_product working_day autoid:i eba_status gca:f",
    lambda c: conform(c["err_atmp_t17_dpd_credit_cards"].drop("eba_status", "gca"), SNAPSHOT),
    ["err_atmp_t17_dpd_credit_cards"],
    "select id_product, working_day, null as autoid, null as eba_status, null as gca from err_atmp_t17_dpd_credit_cards")
add("s12_schema_change", "id_product current_days_past_due:i branch product_group", lambda c: c.two_schemas(),
    ["t02_customer_product"],
    "select id_product, current_days_past_due, case when product_group <> 'CREDIT CARD' then 'B1' end as branch, product_group from t02_customer_product")
add("s3_read_by_parts", "id_product working_day ledger_balance:f",
    lambda c: c.read_by_parts("t22_card_balance", "id_product", 8), ["t22_card_balance"], "t22_card_balance")
add("s3_read_by_parts_of_numbers", "autoid:i id_product",
    lambda c: c.read_by_parts("t14_unwinding", "autoid", 8), ["t14_unwinding"], "t14_unwinding")
add("s4_append", "id_product working_day",
    lambda c: c.stored(lambda path: [append(c[t].select("id_product", "working_day"), path) for t in ("t22_card_balance", "t14_unwinding")] and None),
    ["t22_card_balance", "t14_unwinding"],
    "select id_product, working_day from t22_card_balance union all select id_product, working_day from t14_unwinding")
add("s8_full_overwrite", "id_product gca_all:f",
    lambda c: c.stored(lambda path: [write_version(c["t14_unwinding"].select("id_product", value.alias("gca_all")), path, v) for v, value in (("1", -F.col("gca_all")), ("2", F.col("gca_all")))][-1]),
    ["t14_unwinding"], "select id_product, gca_all from t14_unwinding")
add("s9_append_nothing", "id_product working_day",
    lambda c: c.stored(lambda path: [append(df.select("id_product", "working_day"), path) for df in (c["t14_unwinding"], c["t14_unwinding"].limit(0))] and None),
    ["t14_unwinding"], "select id_product, working_day from t14_unwinding")
add("s14_replace_slice", "id_product working_day product_group gca_all:f account_number",
    lambda c: unwinding.with_todays_rows(
        c["t14_unwinding"],
        unwinding.insert_unwinding(c.t17, c["t22_card_balance"], c["t20_exchange_rate"], c["vw_unwinding"], c.days),
        c.days),
    [T17, "t14_unwinding", "t22_card_balance", "t20_exchange_rate", "vw_unwinding"],
    f"select id_product, working_day, product_group, gca_all, cast(null as varchar) as account_number from t14_unwinding t where not ({q.CARDS_TODAY}) "
    f"union all select id_product, working_day, product_group, gca_all, account_number from ({q.unwinding_rows(T17)}) n")
add("s14_replace_events", "customer_number account_id default_trigger_id event_start_date default_event_id",
    lambda c: replace_slice(
        c["t19_default_events"], events.todays_card_events(c.days),
        events.default_events(c.t17, c["tc_default_reason"], c.days)),
    [T17, "t19_default_events", "tc_default_reason"],
    "select customer_number, account_id, default_trigger_id, event_start_date, cast(null as varchar) as default_event_id from t19_default_events "
    f"where not (event_start_date = {q.CC} and substring(account_id, 1, 2) = 'CC' and length(account_id) = 26 and substring(account_id, 12, 2) in ('18', '19')) "
    f"union all select customer_number, account_id, default_trigger_id, event_start_date, default_event_id from ({q.event_rows(T17)}) n")
add("p5_sequential_and_simultaneous", "id_product a:i b:i",
    lambda c: update_where(
        c.t17.select("id_product", F.col("dpd_ho").alias("a"), F.col("p_dpd_ho").alias("b")),
        F.col("a") > 90, {"a": F.col("b"), "b": F.col("a")}),
    [T17],
    f"select id_product, case when dpd_ho > 90 then p_dpd_ho else dpd_ho end as a, case when dpd_ho > 90 then dpd_ho else p_dpd_ho end as b from {T17}")
add("p9_in_list", "id_product writteoff_recovery amount_event:f",
    lambda c: c["t26_writteoff_recovery"].filter(F.upper("writteoff_recovery").isin("WA", "WO", "REP", "DS")),
    ["t26_writteoff_recovery"],
    "select * from t26_writteoff_recovery where upper(writteoff_recovery) in ('WA','WO','REP','DS')")
add("p10_contains_and_suffix", "id_product default_reason p_default_reason",
    lambda c: c.t17.filter(
        F.col("default_reason").endswith("CROSS DEFAULT PULLING EFFECT") | F.col("p_default_reason").contains("DECEASED")),
    [T17], f"select * from {T17} where default_reason like '%CROSS DEFAULT PULLING EFFECT' or p_default_reason like '%DECEASED%'")
add("p11_any_deal_reason", "id_product p_default_reason",
    lambda c: c.t17.filter(mentions_any(F.col("p_default_reason"), probation.DEAL_REASONS)), [T17],
    f"select * from {T17} t where " + q.DEAL_CASE.split(" and ", 1)[1][:-1])
add("p12_inside_period", "id_product working_day",
    lambda c: c.t17.filter(F.col("working_day").between(F.col("p_start_probation_date"), F.col("p_end_probation_date"))),
    [T17], f"select * from {T17} where working_day between p_start_probation_date and p_end_probation_date")
add("p14_card_ids", "id_product", lambda c: c.t17.filter(F.substring("id_product", 12, 2) == "19"), [T17],
    f"select id_product from {T17} where substring(id_product, 12, 2) = '19'")
add("p15_not_todays_events", "customer_number account_id event_start_date",
    lambda c: c["t19_default_events"].filter(~events.todays_card_events(c.days)), ["t19_default_events"],
    f"select * from t19_default_events where not (event_start_date = {q.CC} and substring(account_id, 1, 2) = 'CC' and length(account_id) = 26 and substring(account_id, 12, 2) in ('18','19'))")

# --- joins ---------------------------------------------------------------------------

add("j1_left_lookup", "id_product t01_customer_segment t01_found:b",
    lambda c: inputs.attach_master(c.t17, c["t01_customer"], ["customer_segment"], c.hot), [T17, "t01_customer"],
    f"select t.id_product, m.customer_segment as t01_customer_segment, case when m.nrp_customer is not null then true end as t01_found from {T17} t {q.T01}")
add("j2_left_composite", "id_product breach:b",
    lambda c: default.attach_row_day_events(c.t17, c["atmp_default_triggers"], default.TRIGGERS[6]).withColumn(
        "breach", F.col(default.TRIGGERS[6].column).isNotNull()),
    [T17, "atmp_default_triggers"],
    f"select t.id_product, exists (select 1 from atmp_default_triggers e where e.id_product = t.id_product and e.working_day = t.working_day and e.breach_contract_covenants = '1') as breach from {T17} t")
add("j3_left_with_own_conditions", "id_product default_indicator default_reason",
    lambda c: delinquency_customer(c), [T17, "t01_customer"],
    q.customer_default(True)(T17))
add("j4_window_of_events", "id_product hit:b",
    lambda c: _window_hits(c), [T17, "atmp_default_triggers"],
    f"select t.id_product, exists (select 1 from atmp_default_triggers e where e.nrp_customer = t.customer_number and e.is_indebtedness = '1' and t.working_day <= {q.months('e.working_day', 3)}) as hit from {T17} t")
add("j5_inner_balance_and_rate", "id_product ledger_balance:f eur_rate:f",
    lambda c: _balances_in_eur(c), ["t22_card_balance", "t20_exchange_rate"],
    f"select b.id_product, b.ledger_balance, r.eur_rate from t22_card_balance b join t20_exchange_rate r on b.working_day = r.working_day and b.account_currency = r.currency where b.working_day = {q.WD}")
JOINT_SQL = (
    "select b.id_product, min(t.joint_group) as joint_group from customer_relations t join t22_card_balance b on b.customer_number = t.applicant_id "
    "and substring(b.facility_id, 7, 3) = substring(t.facility_id, 3, 3) and substring(b.facility_id, 10, 2) = substring(t.facility_id, 1, 2) "
    f"where b.working_day = {q.WD} and t.is_joint_micro = '1' and t.application_role_code = 'BORROWER' and t.product_type <> 'LOAN' group by b.id_product"
)
add("j6_join_on_parts_of_ids", "id_product joint_group",
    lambda c: registers.joint_products(c["customer_relations"], c["t22_card_balance"], c.days).select(
        F.col("joined_key").alias("id_product"), F.col("joined_rel_joint_group").alias("joint_group")),
    ["customer_relations", "t22_card_balance"], JOINT_SQL)
add("j7_anti_join", "nrp_customer",
    lambda c: missing_from(c["atmp_customer"], c["t01_customer"], F.col("nrp_customer"), F.col("nrp_customer")),
    ["atmp_customer", "t01_customer"],
    "select nrp_customer from atmp_customer where nrp_customer not in (select nrp_customer from t01_customer)")
add("j10_previous_day", "id_product before:f",
    lambda c: unwinding.previous_month_to_date(c["t14_unwinding"], c.days).select(
        F.col("prev_key").alias("id_product"), F.col("prev_unwinding_mtd_lcy").alias("before")),
    ["t14_unwinding"],
    f"select id_product, unwinding_mtd_lcy as before from t14_unwinding where working_day = {q.PREV}")
add("j11_exists", "id_product distressed:b",
    lambda c: inputs.attach_customers(c.t17, c["atmp_customer"], columns=[], hot=c.hot).withColumn(
        "distressed", F.coalesce("cust_distressed", F.lit(False))),
    [T17, "atmp_customer"],
    f"select id_product, customer_number in (select nrp_customer from atmp_customer where retail_nonretail = 'RETAIL' and has_product = '1' and max_dpd > 60) as distressed from {T17}")


def delinquency_customer(c: Context) -> DataFrame:
    df = inputs.attach_master(c.t17, c["t01_customer"], ["default_indicator"], c.hot)
    return default.customer_status(df, INTENDED)


def _window_hits(c: Context) -> DataFrame:
    trigger = default.TRIGGERS[4]
    lookup = default.customer_events(c["atmp_default_triggers"], c.days, default.earliest_day(c.t17), [trigger])
    df = default.attach(c.t17, lookup, "customer_number", "trig_customer", "id_product", c.hot)
    return df.withColumn("hit", F.coalesce(F.col("working_day") <= F.col(trigger.column), F.lit(False)))


def _balances_in_eur(c: Context) -> DataFrame:
    held = inputs.on_day(c["t22_card_balance"], c.days.bank_day)
    df = inputs.attach_rates(held, c["t20_exchange_rate"], c.days.bank_day, "account_currency", "eur_rate", "fx_")
    return df.filter("fx_found").withColumnRenamed("fx_eur_rate", "eur_rate")


# --- reusable functions -----------------------------------------------------------------

add("d1_year_fraction", "id_product basis:i fraction:r",
    lambda c: c.t17.select("id_product", "dpd_ho2", F.expr("dpd_ho % 9").alias("basis"),
                           year_fraction(F.col("date_since_pd_ho2"), F.col("p_end_probation_date"), F.expr("dpd_ho % 9")).alias("fraction")),
    [T17],
    f"select id_product, dpd_ho % 9 as basis, {q.year_frac('date_since_pd_ho2', 'p_end_probation_date', '(dpd_ho % 9)')} as fraction from {T17}")
T14_KEY = "working_day id_product product_group"
add_steps("d2_daily_unwinding", T14_KEY + " unwinding_daily_lcy:r",
          lambda c: unwinding.daily_unwinding_amounts(c["t14_unwinding"], c.days), ["t14_unwinding"],
          [q.daily_unwinding()], "t14_unwinding")
add_steps("d3_month_unwinding", T14_KEY + " unwinding_mtd_lcy:f",
          lambda c: unwinding.month_unwinding_amounts(c["t14_unwinding"], c.days), ["t14_unwinding"],
          [q.month_unwinding()], "t14_unwinding")
INTEREST = "id_product gross_interest_mtd_lcy:f gross_interest_mtd_ocy:f"
add_steps("d4_interest_month_to_date", INTEREST, lambda c: valuation.interest_month_to_date(c.t17), [], [q.interest])
add_steps("d5_materiality", "id_product materiality_level:f", lambda c: _materiality(c),
          ["t22_card_balance", "t20_exchange_rate", "tc08_configuration_table"], [q.materiality])
add_steps("d6_second_date", "id_product date_since_pd_ho2", lambda c: _second(c),
          ["t22_card_balance", "t20_exchange_rate", "atmp_customer", "tc08_configuration_table"], [q.second_date])
add_steps("d7_distinct_reasons", "id_product default_reason",
          lambda c: default.without_repeated_reasons(c.t17), [], [q.unique_reasons])


def _materiality(c: Context) -> DataFrame:
    columns = ["ledger_balance", "account_currency"]
    df = inputs.attach_balances(c.t17, c["t22_card_balance"], c.days.bank_day, columns)
    df = delinquency.attach_bank_day_rates(df, c["t20_exchange_rate"], c.days)
    return delinquency.materiality(inputs.attach_settings(df, c["tc08_configuration_table"]))


def _second(c: Context, mode: str = "observed") -> DataFrame:
    return delinquency.second_counter(
        c.t17, c["t22_card_balance"], c["t20_exchange_rate"], c["atmp_customer"],
        c["tc08_configuration_table"], c.days, mode, c.hot)


add("j10_previous_day_in_place", "id_product before:f",
    lambda c: unwinding.previous_month_to_date(
        c.placed("t14_unwinding", working_day=c.days.dates(c.bank.spark)[3]), c.days).select(
        F.col("prev_key").alias("id_product"), F.col("prev_unwinding_mtd_lcy").alias("before")),
    ["t14_unwinding"],
    f"select id_product, unwinding_mtd_lcy as before from t14_unwinding where working_day = {q.PREV}")

# --- load, delinquency ---------------------------------------------------------------------

CARRIED = " ".join(
    f"{t}:{k}" for t, k in zip(
        q.CARRIED,
        "f i i i i i s f s s f i i f f s s s s s s s s f s f f i".split(), strict=True))
add_steps("d8_carry_forward", f"id_product p_working_day {CARRIED}",
          lambda c: carry_forward.carry_forward(c.t17, c["t17_dpd_credit_cards"], c.days),
          ["t17_dpd_credit_cards"], [q.carry_forward])
add_steps("d8_carry_forward_in_place", f"id_product p_working_day {CARRIED}",
          lambda c: carry_forward.carry_forward(
              plans.by_product(c.t17, c.buckets),
              c.placed("t17_dpd_credit_cards", working_day=c.days.dates(c.bank.spark)[3]), c.days, placed=True),
          ["t17_dpd_credit_cards"], [q.carry_forward])
add_steps("d9_segment_refresh", "id_product retail_nonretail_indicator",
          lambda c: delinquency.segment_refresh(c.t17, c["t01_customer"], c.hot), ["t01_customer"], [q.segment])
DPD_TABLES = ["t22_card_balance", "t20_exchange_rate", "atmp_joint_dpd", "t01_customer", "tc08_configuration_table"]
add_steps("d10_days_past_due", "id_product date_since_pd_ho dpd_ho:i materiality_level:f",
          lambda c: delinquency.days_past_due(c.t17, *[c[t] for t in DPD_TABLES], c.days, c.hot), DPD_TABLES, q.DPD)


def _with_card_rate(c: Context) -> DataFrame:
    return inputs.attach_rates(c.t17, c["t20_exchange_rate"], c.days.bank_day, "card_ccy", "eur_rate", "cardfx_")


add_steps("d10b_retail_counter", "id_product dpd_ho:i",
          lambda c: delinquency.count_days_past_due(_with_card_rate(c), c.days), ["t20_exchange_rate"], [q.dpd_counter])
add_steps("d10c_joint_counter", "id_product dpd_ho:i",
          lambda c: delinquency.joint_days_past_due(inputs.attach_joint(c.t17, c["atmp_joint_dpd"])),
          ["atmp_joint_dpd"], [q.dpd_joint])
add_steps("d10d_customer_counter", "id_product dpd_ho:i",
          lambda c: delinquency.customer_days_past_due(inputs.attach_master(c.t17, c["t01_customer"], ["dpd_ho"], c.hot)),
          ["t01_customer"], [q.dpd_customer])
add_steps("d10e_past_due_since", "id_product date_since_pd_ho",
          lambda c: delinquency.past_due_since(c.t17), [], [q.dpd_since])
SECOND_TABLES = ["t22_card_balance", "t20_exchange_rate", "atmp_customer", "tc08_configuration_table"]
add_steps("d11_second_counter", "id_product date_since_pd_ho2 dpd_ho2:i", _second, SECOND_TABLES, q.SECOND)
add_steps("d11_second_counter_intended", "id_product date_since_pd_ho2 dpd_ho2:i",
          lambda c: _second(c, INTENDED), SECOND_TABLES, [q.second_date, q.second_counter(True)])


def _customer_columns(c: Context) -> DataFrame:
    return inputs.attach_customers(c.t17, c["atmp_customer"], hot=c.hot)


for _name, _columns, _run, _steps in (
    ("d12_times_past_due", "times_past_due:i", lambda c: delinquency.times_past_due(c.t17), [q.times]),
    ("d13_maximum_days_past_due", "maximum_days_past_due:i",
     lambda c: delinquency.maximum_days_past_due(_customer_columns(c)), [q.maximum]),
    ("d14_total_days_past_due", "total_days_past_due:i", lambda c: delinquency.total_days_past_due(c.t17), [q.total]),
    ("d15_current_days_in_excess", "current_days_in_excess:i",
     lambda c: delinquency.current_days_in_excess(c.t17), [q.excess]),
    ("d16_month_maximum", "maxdpd_current_month:i",
     lambda c: delinquency.month_maximum(_customer_columns(c)), [q.month_max]),
    ("d17_absorbing_status", "absorbing_status_flag:i date_absorbing_status exposure_at_absorbing:f",
     lambda c: delinquency.absorbing_status(c.t17), q.ABSORBING),
    ("d12_d17_counters", COUNTERS, lambda c: delinquency.counters(c.t17, c["atmp_customer"], c.hot), q.COUNTERS),
    ("d18_eba_status", "eba_status eba_status_start_date", lambda c: delinquency.eba_status(c.t17), [q.eba]),
):
    add_steps(_name, "id_product " + _columns, _run, ["atmp_customer"], _steps)

# --- default detection ------------------------------------------------------------------------

add_steps("d19_technical_reset", "id_product " + PREVIOUS,
          lambda c: default.technical_reset(c.t17, c["technical_default"], c.days, c.hot),
          ["technical_default"], q.TECHNICAL)
add_steps("d20_initial_status", STATUS, lambda c: default.initial_status(c.t17), [], [q.initial])
for _suffix, _mode in (("", "observed"), ("_intended", INTENDED)):
    add_steps(f"d21_days_past_due_default{_suffix}", STATUS,
              lambda c, m=_mode: default.days_past_due_default(
                  default.initial_status(c.t17), c["tc08_configuration_table"], c.days, m),
              ["tc08_configuration_table"], [q.initial, q.dpd_default(bool(_suffix))])
for _number, (_name, _step) in enumerate(q.TRIGGERS.items()):
    add_steps(_name, STATUS,
              lambda c, t=default.TRIGGERS[_number]: default.trigger_defaults(
                  c.t17, c["atmp_default_triggers"], c["atmp_customer"], c.days, [t], c.hot),
              ["atmp_default_triggers", "atmp_customer"], _step)
add_steps("d22_d31_all_triggers", STATUS,
          lambda c: default.trigger_defaults(
              c.t17, c["atmp_default_triggers"], c["atmp_customer"], c.days, hot=c.hot),
          ["atmp_default_triggers", "atmp_customer"], q.ALL_TRIGGERS)
for _suffix, _mode in (("", "observed"), ("_intended", INTENDED)):
    add_steps(f"d32_customer_default{_suffix}", "id_product default_indicator default_reason",
              lambda c, m=_mode: default.customer_default(c.t17, c["t01_customer"], m, c.hot),
              ["t01_customer"], [q.customer_default(bool(_suffix)), q.unique_reasons])
add_steps("d19_d32_default_detection", f"{STATUS} {PREVIOUS}",
          lambda c: default.default_detection(c.t17, *[c[t] for t in DETECT_TABLES], c.days, hot=c.hot),
          DETECT_TABLES, q.DETECTION)

# --- probation -----------------------------------------------------------------------------------


def _overdue(c: Context) -> DataFrame:
    return probation.with_customer_overdue(c.t17, c["atmp_customer"], c.hot)


for _suffix, _mode in (("", "observed"), ("_intended", INTENDED)):
    _i = bool(_suffix)
    add_steps(f"d33_customer_probation_start{_suffix}", STATUS,
              lambda c, m=_mode: probation.start_customer_probation(_overdue(c), c.days, m),
              ["atmp_customer"], [q.with_overdue, *q.start(q.customer_case(_i), "t.cust_max_dpd", _i)])
    add_steps(f"d34_deal_probation_start{_suffix}", STATUS,
              lambda c, m=_mode: probation.start_deal_probation(_overdue(c), c.days, m),
              ["atmp_customer"], [q.with_overdue, *q.start(q.DEAL_CASE, "t.dpd_ho", _i)])
    add_steps(f"d33_d36_probation{_suffix}", STATUS,
              lambda c, m=_mode: probation.probation(c.t17, c["atmp_customer"], c.days, m, c.hot),
              ["atmp_customer"], [q.with_overdue, *q.probation(_i)])
    add_steps(f"d37_probation_end{_suffix}", STATUS,
              lambda c, m=_mode: probation.probation_end(c.t17, c["atmp_customer"], c.days, m, c.hot),
              ["atmp_customer"], [q.with_overdue, q.end_probation(_i)])
add_steps("d35_customer_probation_continue", STATUS,
          lambda c: probation.continue_customer_probation(_overdue(c), c.days),
          ["atmp_customer"], [q.with_overdue, *q.proceed(q.customer_case(), "t.cust_max_dpd")])
add_steps("d36_deal_probation_continue", STATUS,
          lambda c: probation.continue_deal_probation(_overdue(c), c.days),
          ["atmp_customer"], [q.with_overdue, *q.proceed(q.DEAL_CASE, "t.dpd_ho")])

# --- contagion and attributes ------------------------------------------------------------------------

CROSS_TABLES = ["t22_card_balance", "t01_customer"]
PULL_TABLES = ["atmp_customer", "tc08_configuration_table"]


def _contagion(c: Context, mode: str) -> DataFrame:
    return contagion.contagion(
        c.t17, *[c[t] for t in CROSS_TABLES + PULL_TABLES], c.days, mode, c.hot)


def _merge_back(columns, condition):
    """The last step: only rows that meet the condition are merged into the accounts."""
    return lambda p: q.update(
        T17, q.where("u.id_product is not null", {k: f"u.{k}" for k in columns}),
        f"left join (select * from {p} where {condition}) u on t.id_product = u.id_product")


for _suffix, _mode in (("", "observed"), ("_intended", INTENDED)):
    _i = bool(_suffix)
    add_steps(f"d38_cross_default{_suffix}", CONTAGION,
              lambda c, m=_mode: contagion.cross_default(c.t17, *[c[t] for t in CROSS_TABLES], c.days, m, c.hot),
              CROSS_TABLES, q.cross_default(_i))
    add_steps(f"d39_pulling_effect{_suffix}", CONTAGION,
              lambda c, m=_mode: contagion.pulling_effect(c.t17, *[c[t] for t in PULL_TABLES], c.days, m, c.hot),
              PULL_TABLES, q.pulling(_i))
    _merged = [] if _i else [_merge_back(q.CONTAGION_COLUMNS, q.HAD_DEFAULT)]
    add_steps(f"d38_d40_contagion{_suffix}", CONTAGION,
              lambda c, m=_mode: _contagion(c, m), CROSS_TABLES + PULL_TABLES,
              [*q.cross_default(_i), *q.pulling(_i), q.repeated, *_merged])
    add_steps(f"d41_d46_default_attributes{_suffix}", "id_product " + ATTRIBUTES,
              lambda c, m=_mode: attributes.default_attributes(
                  c.t17, c["t22_card_balance"], c["atmp_customer"], c.days, m, c.hot),
              ["t22_card_balance", "atmp_customer"], q.attributes(_i))
add_steps("d40_repeated_default", "id_product end_probation_date",
          lambda c: contagion.repeated_default(c.t17).filter(contagion.had_default()), [],
          [q.repeated, lambda p: f"select * from {p} where {q.HAD_DEFAULT}"])
for _name in ("d41_historical_default_indicator", "d42_default_amount:f", "d43_default_start_date:i",
              "d44_default_end_date:i", "d45_default_id", "d46_interest_rate_default:f"):
    _key = _name.partition(":")[0]
    add_steps(_key, "id_product " + _name.partition("_")[2],
              lambda c: attributes.default_attributes(
                  c.t17, c["t22_card_balance"], c["atmp_customer"], c.days, hot=c.hot),
              ["t22_card_balance", "atmp_customer"], q.attributes())

# --- recovery, events, valuation ---------------------------------------------------------------------------

add("d47_recovery_movements", "id_product sum_amount_event:f",
    lambda c: recovery.recovery_movements(c["t26_writteoff_recovery"], c.days), ["t26_writteoff_recovery"], q.movements_sql())
RECOVERED = "daily_payment:r monthly_recover:r monthly_recover_default:r monthly_recover_absorbing:r"
add_steps("d48_daily_payment", "id_product daily_payment:r",
          lambda c: recovery.monthly_recovery(c.t17, c["t26_writteoff_recovery"], c.days),
          ["t26_writteoff_recovery"], [q.payment])
add_steps("d49_monthly_recovery", "id_product " + RECOVERED,
          lambda c: recovery.monthly_recovery(c.t17, c["t26_writteoff_recovery"], c.days),
          ["t26_writteoff_recovery"], q.RECOVERY)
EVENT_COLUMNS = " ".join(events.EVENT_COLUMNS)


def _events(c: Context) -> DataFrame:
    return events.default_events(c.t17, c["tc_default_reason"], c.days)


add("d50_default_events", EVENT_COLUMNS, _events, [T17, "tc_default_reason"], q.event_rows(T17))
add("u1_union_of_events", "default_trigger_description n:i",
    lambda c: _events(c).groupBy("default_trigger_description").agg(F.count(F.lit(1)).alias("n")),
    [T17, "tc_default_reason"],
    f"select default_trigger_description, count(*) as n from ({q.event_rows(T17)}) x group by default_trigger_description")
for _key, (_event, _condition) in q.EVENTS.items():
    add(_key, EVENT_COLUMNS,
        lambda c, e=_event: _events(c).filter(F.col("default_trigger_description") == e),
        [T17, "tc_default_reason"], q.event_rows(T17, _key))
add_steps("d51_gross_carrying_amount", "id_product gca:f",
          lambda c: valuation.gross_carrying_amount(c.t17, c["t22_card_balance"], c.days), ["t22_card_balance"], [q.gca])
add_steps("d52_interest_merged", INTEREST + " working_day",
          lambda c: merge_columns(
              c.t17, valuation.interest_month_to_date(c.t17), "id_product",
              ["gross_interest_mtd_lcy", "gross_interest_mtd_ocy"]), [], [q.interest])

# --- unwinding ------------------------------------------------------------------------------------------

UNWINDING_TABLES = ["t22_card_balance", "t20_exchange_rate", "vw_unwinding"]
UNWINDING_ROW = (
    T14_KEY + " facility_id account_number p_working_day closing_day p_closing_day retail_nonretail gca_all:r "
    "calculation_basis:i interest_rate:f provision_fund:f deal_ccy unwinding_daily_lcy:f unwinding_mtd_lcy:f "
    "unwinding_daily_ocy:f unwinding_mtd_ocy:f"
)
add("d53_insert_unwinding", UNWINDING_ROW,
    lambda c: unwinding.insert_unwinding(c.t17, *[c[t] for t in UNWINDING_TABLES], c.days),
    [T17, *UNWINDING_TABLES], q.unwinding_rows(T17))
add_steps("d54_carry_unwinding", T14_KEY + " unwinding_mtd_lcy:f",
          lambda c: unwinding.carry_unwinding(c["t14_unwinding"], c["t14_unwinding"], c.days),
          ["t14_unwinding"], [q.carry_unwinding], "t14_unwinding")
add_steps("d55_daily_unwinding", T14_KEY + " unwinding_daily_lcy:r",
          lambda c: unwinding.daily_unwinding_amounts(c["t14_unwinding"], c.days),
          ["t14_unwinding"], [q.daily_unwinding()], "t14_unwinding")
add_steps("d56_month_unwinding", T14_KEY + " unwinding_mtd_lcy:r",
          lambda c: unwinding.month_unwinding_amounts(
              unwinding.daily_unwinding_amounts(c["t14_unwinding"], c.days), c.days).filter(
              unwinding.todays_cards(c.days)),
          ["t14_unwinding"],
          [q.daily_unwinding(), q.month_unwinding(), lambda p: f"select t.* from {p} t where {q.CARDS_TODAY}"], "t14_unwinding")
add_steps("d57_original_currency", T14_KEY + " unwinding_daily_ocy:r unwinding_mtd_ocy:r",
          lambda c: unwinding.original_currency_amounts(c["t14_unwinding"], c["t20_exchange_rate"], c.days),
          ["t14_unwinding", "t20_exchange_rate"], [q.original_currency()], "t14_unwinding")

# --- registers ------------------------------------------------------------------------------------------------

NEW_CUSTOMERS = f"select {{}} customer_number as nrp_customer from {T17} where customer_number not in (select nrp_customer from t01_customer)"
add("d58_new_customers", "nrp_customer", lambda c: registers.new_customers(c.t17, c["t01_customer"], hot=c.hot),
    [T17, "t01_customer"], NEW_CUSTOMERS.format(""))
add("d58_new_customers_intended", "nrp_customer",
    lambda c: registers.new_customers(c.t17, c["t01_customer"], INTENDED), [T17, "t01_customer"],
    NEW_CUSTOMERS.format("distinct"))
add("d59_new_product_types", "id_product_type product_group",
    lambda c: registers.new_product_types(c.t17, c["tc01_product_type"]), [T17, "tc01_product_type"],
    f"select distinct trim(id_product_type) as id_product_type, 'CREDIT CARD' as product_group from {T17} where trim(id_product_type) not in (select trim(id_product_type) from tc01_product_type)")
REGISTER = "id_product nrp_customer id_product_type product_group check_flag current_days_past_due:i ref_id_product first_entry last_update"


def _register_sql(intended: bool, accounts: str = T17) -> str:
    source = (
        f"select t.id_product, t.id_product_type, t.days_past_due, t.customer_number, 'CC' || b.facility_id as ref_id_product from {accounts} t "
        f"left join (select * from t22_card_balance where working_day = {q.WD}) b on t.id_product = b.id_product"
    )
    hit = "s.id_product is not null" if intended else "true"
    at = f"cast('{RUN_AT}' as timestamp)"
    value = lambda new, old: f"case when r.id_product is null or {hit} then {new} else r.{old} end as {old}"
    return (
        "select coalesce(r.id_product, s.id_product) as id_product, "
        + value("s.customer_number", "nrp_customer") + ", " + value("s.id_product_type", "id_product_type") + ", "
        + value("case when s.id_product is not null then 'CREDIT CARD' end", "product_group") + ", "
        + value("'1'", "check_flag") + ", " + value("s.days_past_due", "current_days_past_due") + ", "
        + value("s.ref_id_product", "ref_id_product") + ", " + value(at, "last_update") + ", "
        + f"case when r.id_product is null then {at} else r.first_entry end as first_entry "
        + f"from t02_customer_product r full outer join ({source}) s on r.id_product = s.id_product"
    )


def _run_at() -> Column:
    return F.lit(RUN_AT).cast("timestamp")


for _suffix, _mode in (("", "observed"), ("_intended", INTENDED)):
    add(f"d60_product_register{_suffix}", REGISTER,
        lambda c, m=_mode: registers.product_register(
            c["t02_customer_product"], c.t17, c["t22_card_balance"], c.days, _run_at(), m),
        [T17, "t02_customer_product", "t22_card_balance"], _register_sql(bool(_suffix)))
    add(f"d60_register_in_place{_suffix}", REGISTER,
        lambda c, m=_mode: registers.product_register(
            c.placed("t02_customer_product"), c.t17, c["t22_card_balance"], c.days, _run_at(), m, placed=c.buckets),
        [T17, "t02_customer_product", "t22_card_balance"], _register_sql(bool(_suffix)))
add("j8_full_outer_upsert", "id_product inserted:b",
    lambda c: registers.product_register(
        c["t02_customer_product"], c.t17, c["t22_card_balance"], c.days, _run_at()).withColumn(
        "inserted", F.col("first_entry") == _run_at()),
    [T17, "t02_customer_product"],
    f"select coalesce(r.id_product, s.id_product) as id_product, r.id_product is null as inserted from t02_customer_product r full outer join {T17} s on r.id_product = s.id_product")
ONBOARD = (
    "nrp_customer customer_name customer_phone customer_address profit_center coconut_type marketing_group coconut_number "
    "customer_officer_code customer_officer_name nace_code esa_code retail_nonretail customer_segment"
)
add("d61_onboard_customers", ONBOARD,
    lambda c: registers.onboard_customers(c["onboarding_candidates"], c["t01_customer"]),
    ["onboarding_candidates", "t01_customer"],
    "select nrp_customer, coalesce(customer_name, '') as customer_name, coalesce(customer_phone, '') as customer_phone, coalesce(customer_address, '') as customer_address, "
    "coalesce(profit_center, '') as profit_center, coalesce(coconut_type, '') as coconut_type, coalesce(marketing_group, '') as marketing_group, coalesce(coconut_number, '') as coconut_number, "
    "customer_officer_code, customer_officer_name, coalesce(nace_code, '') as nace_code, coalesce(esa_code, '') as esa_code, "
    "case when coconut_type in ('01', '20') then 'RETAIL' else 'NONRETAIL' end as retail_nonretail, "
    "case coconut_type when '01' then 'PI' when '20' then 'MICRO' when '06' then 'SME' else 'CORPORATE' end as customer_segment "
    "from (select * from onboarding_candidates qualify row_number() over (partition by nrp_customer order by customer_name) = 1) o where nrp_customer not in (select nrp_customer from t01_customer)")
add("d62_esa_code", "nrp_customer profit_center esa_code",
    lambda c: registers.backfill_esa_code(c["t01_customer"], c["tc03_profit_center"]),
    ["t01_customer", "tc03_profit_center"],
    "select m.nrp_customer, m.profit_center, case when m.esa_code is null or m.esa_code = '' then p.esa_code else m.esa_code end as esa_code from t01_customer m left join tc03_profit_center p on m.profit_center = p.profit_center")
add("d63_joint_flags", "id_product is_joint joint_id",
    lambda c: registers.joint_flags(c.t17, c["customer_relations"], c["t22_card_balance"], c.days),
    [T17, "customer_relations", "t22_card_balance"],
    f"select t.id_product, case when j.id_product is not null then '1' else t.is_joint end as is_joint, case when j.id_product is not null then j.joint_group else t.joint_id end as joint_id from {T17} t left join ({JOINT_SQL}) j on t.id_product = j.id_product")

# --- commits ------------------------------------------------------------------------------------------------------

KINDS = {"string": "s", "date": "s", "int": "i", "bigint": "i", "double": "f"}


def _columns_of(schema) -> str:
    return " ".join(
        f"{f.name}:{KINDS[f.dataType.simpleString()]}" for f in schema.fields if f.name != "autoid")


ZERO = ("dpd_ho", "dpd_ho2", "standart_interest_rate", "penalty_interest_rate", "interest_rate_default")


def _snapshot_sql(accounts: str) -> str:
    shown = [f"coalesce({c}, 0) as {c}" if c in ZERO else c for c in SNAPSHOT_COLUMNS]
    return f"select working_day, {', '.join(shown)} from {accounts}"


add("d64_commit_accounts", _columns_of(SNAPSHOT), lambda c: commit.snapshot(c.t17, c["t17_dpd_credit_cards"]),
    [T17], _snapshot_sql(T17))
_narrow = {f.name for f in error_snapshot().fields}


def _rejected_sql(rejected: str) -> str:
    shown = ", ".join(c if c in _narrow else f"null as {c}" for c in SNAPSHOT_COLUMNS)
    return f"select working_day, {shown} from {rejected}"


add("d65_commit_rejected", _columns_of(SNAPSHOT),
    lambda c: commit.rejected_snapshot(c["err_atmp_t17_dpd_credit_cards"], c["t17_dpd_credit_cards"]),
    ["err_atmp_t17_dpd_credit_cards"], _rejected_sql("err_atmp_t17_dpd_credit_cards"))
add("d66_commit_schedule", _columns_of(SCHEDULE),
    lambda c: commit.schedule_snapshot(c["atmp_t18_cc_payment_schedule"], c["t18_cc_payment_schedule"]),
    ["atmp_t18_cc_payment_schedule"], "atmp_t18_cc_payment_schedule")

# --- compositions ---------------------------------------------------------------------------------------------------

ENGINE_TABLES = [*DETECT_TABLES, "t22_card_balance"]


def _engine_steps(merge_base, start=TODAY):
    """Detection to attributes; the merge after contagion needs the relation before it."""
    before, last = chain([*merge_base, *q.DETECTION, q.with_overdue, *q.probation(), q.end_probation()], start)
    ctes, number = list(before), len(before)
    base = last
    for step in [*q.cross_default(), *q.pulling(), q.repeated]:
        name = f"step{number}"
        ctes.append((name, step(last)))
        last, number = name, number + 1
    merged = q.update(
        base, q.where("u.id_product is not null", {k: f"u.{k}" for k in q.CONTAGION_COLUMNS}),
        f"left join (select * from {last} where {q.HAD_DEFAULT}) u on t.id_product = u.id_product")
    ctes.append((f"step{number}", merged))
    last, number = f"step{number}", number + 1
    for step in q.attributes():
        name = f"step{number}"
        ctes.append((name, step(last)))
        last, number = name, number + 1
    return ctes, last


def _extend(ctes, last, step_list):
    ctes = list(ctes)
    for step in step_list:
        name = f"step{len(ctes)}"
        ctes.append((name, step(last)))
        last = name
    return ctes, last


_ctes, _last = _engine_steps([])
add("w4_default_engine", f"{CONTAGION} {PREVIOUS} {ATTRIBUTES}",
    lambda c: plans.default_engine(c.today, c.close()), [TODAY, *ENGINE_TABLES], _last, _ctes)

add("w1_resumed_engine", f"{CONTAGION} {PREVIOUS} {ATTRIBUTES}",
    lambda c: c.resumed_engine(), [TODAY, *ENGINE_TABLES], _last, _ctes)

CLOSE_COLUMNS = (
    f"{CONTAGION} {PREVIOUS} {ATTRIBUTES} {COUNTERS} {RECOVERED} retail_nonretail_indicator materiality_level:f dpd_ho:i "
    "date_since_pd_ho date_since_pd_ho2 dpd_ho2:i eba_status eba_status_start_date gca:f gross_interest_mtd_lcy:f gross_interest_mtd_ocy:f"
)
CLOSE_TABLES = list(dict.fromkeys([
    *ENGINE_TABLES, *DPD_TABLES, "t26_writteoff_recovery", "vw_unwinding", "tc_default_reason", "t17_dpd_credit_cards",
    "t14_unwinding", "t02_customer_product", "tc01_product_type", "t19_default_events"]))
_formulas = [q.segment, *q.DPD, *q.SECOND, *q.COUNTERS]
_late = [*q.RECOVERY, q.eba, q.gca, q.interest]
_ctes, _last = _extend(*_engine_steps(_formulas), _late)
add("w3_account_formulas", CLOSE_COLUMNS, lambda c: plans.account_formulas(c.today, c.close()),
    [TODAY, *CLOSE_TABLES], _last, _ctes)
_ctes, _last = _extend(*_engine_steps([q.carry_forward, *_formulas]), _late)
add("w2_daily_close", CLOSE_COLUMNS + " p_working_day", lambda c: c.outputs["accounts"],
    [TODAY, *CLOSE_TABLES], _last, _ctes)
_rejected_today = _rejected_sql("err_today")
_history = f"select * from ({_snapshot_sql(_last)}) a union all select * from ({_rejected_today}) r"
add("w2_daily_close_history", _columns_of(SNAPSHOT), lambda c: c.outputs["t17_dpd_credit_cards"],
    [TODAY, "err_today", *CLOSE_TABLES], _history, _ctes)
add("w2_published_history", _columns_of(SNAPSHOT), lambda c: c.published("t17_dpd_credit_cards"),
    [TODAY, "err_today", *CLOSE_TABLES],
    f"{_history} union all select working_day, {', '.join(SNAPSHOT_COLUMNS)} from t17_dpd_credit_cards where working_day <> {q.CC}", _ctes)
add("w2_close_of_a_store", _columns_of(SNAPSHOT), lambda c: c.close_of_a_store("t17_dpd_credit_cards"),
    [TODAY, "err_today", *CLOSE_TABLES],
    f"{_history} union all select working_day, {', '.join(SNAPSHOT_COLUMNS)} from t17_dpd_credit_cards where working_day <> {q.CC}", _ctes)
add("w2_history_ids", "n:i ids:i above:b",
    lambda c: c.outputs["t17_dpd_credit_cards"].agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("autoid").alias("ids"),
        (F.min("autoid") > c["t17_dpd_credit_cards"].agg(F.max("autoid")).scalar()).alias("above")),
    [TODAY, "err_today", "t17_dpd_credit_cards"],
    f"select 2 * count(*) as n, 2 * count(*) as ids, true as above from {TODAY}")
EVENT_ROW = "customer_number account_id default_trigger_id event_start_date default_event_id probation_end_date"
_todays_cards = f"event_start_date = {q.CC} and substring(account_id, 1, 2) = 'CC' and length(account_id) = 26 and substring(account_id, 12, 2) in ('18', '19')"
_log = (
    "select customer_number, account_id, default_trigger_id, event_start_date, null as default_event_id, null as probation_end_date "
    f"from t19_default_events where not ({_todays_cards})"
)
_new_events = f"union all select customer_number, account_id, default_trigger_id, event_start_date, default_event_id, probation_end_date from ({q.event_rows(_last)}) n"
add("w2_daily_close_events", EVENT_ROW, lambda c: c.outputs["t19_default_events"], [TODAY, *CLOSE_TABLES],
    f"{_log} and event_start_date = {q.CC} {_new_events}", _ctes)
add("w2_published_events", EVENT_ROW, lambda c: c.published("t19_default_events"), [TODAY, *CLOSE_TABLES],
    f"{_log} {_new_events}", _ctes)
_types = f"select distinct trim(id_product_type) as id_product_type, 'CREDIT CARD' as product_group from {TODAY} where trim(id_product_type) not in (select trim(id_product_type) from tc01_product_type)"
add("w2_published_events_empty", EVENT_ROW, lambda c: c.published_empty("t19_default_events"), ["t19_default_events"],
    "select customer_number, account_id, default_trigger_id, event_start_date, null as default_event_id, null as probation_end_date "
    f"from t19_default_events where event_start_date <> {q.CC}")
add("w2_published_product_types", "id_product_type product_group", lambda c: c.published("tc01_product_type"),
    [TODAY, "tc01_product_type"], f"{_types} union all select id_product_type, product_group from tc01_product_type")
add("w2_daily_close_product_types", "id_product_type product_group", lambda c: c.outputs["tc01_product_type"],
    [TODAY, "tc01_product_type"],
    f"select distinct trim(id_product_type) as id_product_type, 'CREDIT CARD' as product_group from {TODAY} where trim(id_product_type) not in (select trim(id_product_type) from tc01_product_type)")
add("w2_daily_close_schedule", _columns_of(SCHEDULE), lambda c: c.outputs["t18_cc_payment_schedule"],
    ["atmp_t18_cc_payment_schedule"], "atmp_t18_cc_payment_schedule")
add("w2_daily_close_register", REGISTER, lambda c: c.outputs["t02_customer_product"],
    [TODAY, *CLOSE_TABLES], _register_sql(False, _last), _ctes)
add("w2_published_register", REGISTER, lambda c: c.published("t02_customer_product"),
    [TODAY, *CLOSE_TABLES], _register_sql(False, _last), _ctes)
_unwound, _rows = _extend(_ctes, _last, [q.unwinding_rows, *q.UNWINDING])
add("w2_daily_close_unwinding", UNWINDING_ROW, lambda c: c.outputs["t14_unwinding"],
    [TODAY, *CLOSE_TABLES], _rows, _unwound)
_unwinding_names = [n for n, _ in QUERIES["w2_daily_close_unwinding"].spec()]
_before = ("facility_id", "account_number", "p_working_day", "retail_nonretail")
_others = (
    "select " + ", ".join(f"null as {n}" if n in _before else n for n in _unwinding_names)
    + f" from t14_unwinding where not (working_day = {q.CC} and product_group = 'CC')"
)
_published = f"select {', '.join(_unwinding_names)} from {_rows} union all {_others}"
add("w2_published_unwinding", UNWINDING_ROW, lambda c: c.published("t14_unwinding"),
    [TODAY, *CLOSE_TABLES], _published, _unwound)
add("w2_published_in_part", UNWINDING_ROW, lambda c: c.published_in_part(),
    [TODAY, *CLOSE_TABLES], _published, _unwound)
add("w2_published_unwinding_empty", UNWINDING_ROW, lambda c: c.published_empty("t14_unwinding"),
    ["t14_unwinding"], _others)
add("w2_ids_after_a_crash", "n:i ids:i above:b", lambda c: c.ids_after_a_crash(),
    [TODAY, *CLOSE_TABLES], f"select count(*) as n, count(*) as ids, true as above from ({_published}) p", _unwound)
add("w2_unwinding_ids", "n:i ids:i above:b",
    lambda c: c.outputs["t14_unwinding"].agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("autoid").alias("ids"),
        (F.min("autoid") > c["t14_unwinding"].agg(F.max("autoid")).scalar()).alias("above")),
    [TODAY, *CLOSE_TABLES], f"select count(*) as n, count(*) as ids, true as above from {_rows}", _unwound)
_unwound, _rows = _extend([], TODAY, [q.unwinding_rows, *q.UNWINDING])
add("w5_unwinding", UNWINDING_ROW, lambda c: plans.unwinding_close(c.today, c.close()),
    [TODAY, "t14_unwinding", *UNWINDING_TABLES], _rows, _unwound)

