"""SQL counterparts of the operators, one statement per step.

Each function takes the name of the previous relation and returns a statement
(or a list of statements, run in order) over the bank tables.  Where the jobs
assign columns one after the other, so does the SQL: one statement per column.
"""

from __future__ import annotations

DAYS = """days as (select cc, wd, (select max(working_day) from w01_working_day where working_day <= cc) as asof_day,
  (select max(working_day) from w02_ccworking_day where working_day < cc) as prev_day
  from (select (select max(working_day) from w02_ccworking_day) as cc, (select max(working_day) from w01_working_day) as wd) x)"""
CC = "(select cc from days)"
WD = "(select wd from days)"
ASOF = "(select asof_day from days)"
PREV = "(select prev_day from days)"
NEXT = f"({CC} + 1)"


def months(day: str, n: int) -> str:
    return f"cast({day} + interval ({n}) month as date)"


NEXT_MONTH = months(CC, 1)


def update(prev: str, values: dict[str, str], joins: str = "") -> str:
    assigned = ", ".join(f"{value} as {name}" for name, value in values.items())
    return f"select t.* replace ({assigned}) from {prev} t {joins}"


def where(hit: str, values: dict[str, str]) -> dict[str, str]:
    return {k: f"case when {hit} then {v} else t.{k} end" for k, v in values.items()}


def one_by_one(hit: str, values: dict[str, str]):
    """A statement per column: each sees what the ones before have changed."""
    return [lambda p, k=k, v=v: update(p, where(hit, {k: v})) for k, v in values.items()]


# --- carry forward --------------------------------------------------------------

CARRIED = {
    f"p_{c}": c
    for c in """amount_past_due dpd_ho times_past_due maximum_days_past_due total_days_past_due current_days_in_excess
    date_absorbing_status exposure_at_absorbing historical_default_indicator default_indicator default_amount default_start_date
    default_end_date monthly_recover_default monthly_recover_absorbing proposed_default_ind is_probation start_probation_date
    end_probation_date default_reason date_since_pd_ho date_since_pd_ho2""".split()
}
CARRIED |= {
    c: c
    for c in "default_id interest_rate_default eba_status_start_date gross_interest_mtd_lcy gross_interest_mtd_ocy".split()
}
CARRIED["maxdpd_month"] = "maxdpd_current_month"


def carry_forward(p):
    values = {
        k: f"case when h.id_product is not null then h.{v} else t.{k} end" for k, v in CARRIED.items()
    }
    values["p_working_day"] = PREV
    return update(
        p,
        values,
        f"left join (select * from t17_dpd_credit_cards where working_day = {PREV}) h on t.id_product = h.id_product",
    )


# --- delinquency ------------------------------------------------------------------

SEG = "t.retail_nonretail_indicator"
T01 = "left join t01_customer m on t.customer_number = m.nrp_customer"
CUST = "left join atmp_customer c on t.customer_number = c.nrp_customer"
CFG = f"left join tc08_configuration_table g on {SEG} = g.segment_type"


def fx_balance(columns):
    return (
        f"left join (select b.id_product, {columns} from t22_card_balance b join t20_exchange_rate r "
        f"on b.working_day = r.working_day and b.account_currency = r.currency where b.working_day = {WD}) f on t.id_product = f.id_product"
    )


def segment(p):
    return update(
        p, {"retail_nonretail_indicator": f"coalesce(m.retail_nonretail, {SEG})"}, T01
    )


def materiality(p):
    share = "g.percentage_threshold / 100 * f.ledger_balance"
    value = (
        "case when g.pd_threshold is not null and g.percentage_threshold is not null and f.ledger_balance is not null then "
        f"case when g.pd_threshold >= {share} then g.pd_threshold else {share} end else t.materiality_level end"
    )
    return update(p, {"materiality_level": value}, fx_balance("b.ledger_balance") + " " + CFG)


def dpd_counter(p):
    x = "t.amount_past_due * r.eur_rate"
    grown = f"t.p_dpd_ho + date_diff('day', t.p_working_day, {WD})"
    value = (
        f"case when {SEG} = 'RETAIL' then case when {x} > t.materiality_level and t.p_dpd_ho = 0 then 1 "
        f"when {x} > t.materiality_level and t.p_dpd_ho > 0 then {grown} "
        f"when {x} <= t.materiality_level and t.amount_past_due > 0 and t.p_dpd_ho > 0 and t.amount_past_due >= t.p_amount_past_due then {grown} "
        "else 0 end else t.dpd_ho end"
    )
    return update(
        p,
        {"dpd_ho": value},
        f"left join (select * from t20_exchange_rate where working_day = {WD}) r on t.card_ccy = r.currency",
    )


def dpd_joint(p):
    value = f"case when {SEG} = 'RETAIL' and t.is_joint = '1' then j.dpd_ho else t.dpd_ho end"
    return update(p, {"dpd_ho": value}, "left join atmp_joint_dpd j on t.joint_id = j.joint_id")


def dpd_customer(p):
    value = f"case when {SEG} = 'NONRETAIL' and m.dpd_ho is not null then m.dpd_ho else t.dpd_ho end"
    return update(p, {"dpd_ho": value}, T01)


def dpd_since(p):
    return update(
        p,
        {
            "date_since_pd_ho": "case when t.dpd_ho > 0 and t.p_date_since_pd_ho is not null then t.working_day - cast(t.dpd_ho as int) "
            "when t.dpd_ho > 0 and t.p_date_since_pd_ho is null then t.working_day else null end"
        },
    )


DPD = [materiality, dpd_counter, dpd_joint, dpd_customer, dpd_since]


def second_date(p):
    value = (
        "case when t.amount_past_due > 0 then coalesce(case when t.amount_past_due / f.eur_rate > g.pd_threshold2 "
        "then coalesce(t.p_date_since_pd_ho2, t.working_day) end, t.date_since_pd_ho2) else t.date_since_pd_ho2 end"
    )
    return update(p, {"date_since_pd_ho2": value}, fx_balance("r.eur_rate") + " " + CFG)


def second_counter(intended=False):
    names = "('NON-RETAIL', 'NONRETAIL')" if intended else "('NON-RETAIL')"

    def step(p):
        value = (
            f"case when {SEG} = 'RETAIL' then case when t.date_since_pd_ho2 is not null then date_diff('day', t.date_since_pd_ho2, t.working_day) else 0 end "
            f"when {SEG} in {names} then c.dpd_ho2 else t.dpd_ho2 end"
        )
        return update(p, {"dpd_ho2": value}, CUST)

    return step


SECOND = [second_date, second_counter()]


def times(p):
    return update(
        p,
        {
            "times_past_due": "case when t.p_dpd_ho = 0 and t.dpd_ho > 0 then coalesce(t.p_times_past_due, 0) + 1 else coalesce(t.p_times_past_due, 0) end"
        },
    )


def maximum(p):
    own = "case when t.dpd_ho > coalesce(t.p_maximum_days_past_due, 0) then t.dpd_ho else coalesce(t.p_maximum_days_past_due, 0) end"
    value = f"case when {SEG} = 'NONRETAIL' and c.nrp_customer is not null then c.maximum_days_past_due else {own} end"
    return update(p, {"maximum_days_past_due": value}, CUST)


def total(p):
    return update(
        p,
        {
            "total_days_past_due": "case when t.dpd_ho > 0 then coalesce(t.p_total_days_past_due, 0) + 1 else coalesce(t.p_total_days_past_due, 0) end"
        },
    )


def excess(p):
    return update(
        p,
        {
            "current_days_in_excess": "case when t.dpd_ho > 0 and day(t.working_day) = 1 then 1 when t.dpd_ho > 0 and day(t.working_day) <> 1 "
            "then coalesce(t.p_current_days_in_excess, 0) + 1 else 0 end"
        },
    )


def month_max(p):
    own = (
        f"case when {SEG} = 'RETAIL' then case when strftime(t.working_day, '%d') = '01' then t.dpd_ho else "
        "case when coalesce(t.maxdpd_month, 0) > t.dpd_ho then coalesce(t.maxdpd_month, 0) else t.dpd_ho end end else t.maxdpd_current_month end"
    )
    value = f"case when {SEG} = 'NONRETAIL' and c.nrp_customer is not null then c.maxdpd_current_month else {own} end"
    return update(p, {"maxdpd_current_month": value}, CUST)


def absorbing_flag(p):
    return update(
        p, {"absorbing_status_flag": "case when t.maximum_days_past_due >= 180 then 1 else 0 end"}
    )


def absorbing_rest(p):
    return update(
        p,
        {
            "date_absorbing_status": "case when t.absorbing_status_flag = 1 and t.p_date_absorbing_status is null then t.working_day else t.p_date_absorbing_status end",
            "exposure_at_absorbing": "case when t.absorbing_status_flag = 1 and coalesce(t.p_exposure_at_absorbing, 0) = 0 and t.card_balance > 0 "
            "then t.card_balance else coalesce(t.p_exposure_at_absorbing, 0) end",
        },
    )


ABSORBING = [absorbing_flag, absorbing_rest]
COUNTERS = [times, maximum, total, excess, month_max, *ABSORBING]


def eba(p):
    return update(
        p,
        {
            "eba_status": "case when t.default_indicator = '1' then 'NPE' else 'PE' end",
            "eba_status_start_date": "case when t.default_indicator = '1' and t.p_default_indicator = '0' then t.working_day "
            "when t.default_indicator = '0' and t.p_default_indicator = '1' then t.working_day else coalesce(t.eba_status_start_date, t.working_day) end",
        },
    )


# --- default -----------------------------------------------------------------------

RESET = {
    "p_is_probation": "'0'",
    "p_proposed_default_ind": "'0'",
    "p_start_probation_date": "null",
    "p_end_probation_date": "null",
}


def technical(key):
    def step(p):
        keys = f"(select distinct {key} as k from technical_default where system_date = {WD})"
        return update(p, where("x.k is not null", RESET), f"left join {keys} x on t.{key} = x.k")

    return step


TECHNICAL = [technical("id_product"), technical("customer_number")]


def initial(p):
    return update(
        p,
        {
            "default_indicator": "'0'",
            "default_reason": "''",
            "proposed_default_ind": "'0'",
            "is_probation": "t.p_is_probation",
            "start_probation_date": "t.p_start_probation_date",
            "end_probation_date": "t.p_end_probation_date",
        },
    )


def defaulted(reason):
    return {
        "default_indicator": "'1'",
        "default_reason": reason,
        "proposed_default_ind": "'1'",
        "is_probation": "'0'",
        "start_probation_date": NEXT_MONTH,
        "end_probation_date": months(NEXT_MONTH, 3),
    }


def dpd_default(intended=False):
    label = "RETAIL" if intended else "Retail"

    def step(p):
        limit = "(select min(dpd_threshold) from tc08_configuration_table where segment_type = 'RETAIL')"
        hit = f"t.dpd_ho > {limit} and {SEG} = '{label}'"
        return update(p, where(hit, defaulted("',DPD,' || t.p_default_reason")))

    return step


def trigger(reason, flag, key, rule, single=False, distressed=False):
    """One trigger block: an existence test, a status change, a reason appended."""
    column = "nrp_customer" if key == "customer_number" else "id_product"
    same = {
        "bank": f"e.working_day = {WD}",
        "row": "e.working_day = t.working_day",
        "window": f"t.working_day <= {months('e.working_day', 3)}",
    }[rule]
    hit = f"{SEG} = 'RETAIL' and exists (select 1 from atmp_default_triggers e where e.{column} = t.{key} and e.{flag} = '1' and {same})"
    if single:
        hit += " and t.is_joint = '0'"
    if distressed:
        hit += " and t.customer_number in (select nrp_customer from atmp_customer where retail_nonretail = 'RETAIL' and has_product = '1' and max_dpd > 60)"

    def mark(p):
        return f"select t.*, ({hit}) as triggered from {p} t"

    def apply(p):
        return update(p, where("t.triggered", defaulted(f"t.default_reason || ',{reason}'"))).replace(
            "select t.* replace", "select t.* exclude (triggered) replace", 1
        )

    return [mark, apply]


TRIGGERS = {
    "d22_deceased": trigger("DECEASED", "is_decease_cust", "customer_number", "bank", True),
    "d23_bankruptcy": trigger("BANKCRUPTCY", "is_bankcruptcy", "customer_number", "bank", True),
    "d24_contract_termination": trigger("CONTRACT TERMINATION", "is_terminated_contract", "id_product", "bank"),
    "d25_loss_of_income": trigger("LOSS OF SUFFICIENT INCOME", "loss_of_sufficient_income", "customer_number", "window", True, True),
    "d26_indebtedness": trigger("INDEBTEDNESS", "is_indebtedness", "customer_number", "window", True, True),
    "d27_non_accrued_status": trigger("NON ACCRUED STATUS", "non_accrued_status", "id_product", "bank", True),
    "d28_breach_of_covenants": trigger("BREACH OF COVENANTS", "breach_contract_covenants", "id_product", "row"),
    "d29_debt_sale": trigger("DEBT SALE", "is_dept_sale_npv", "id_product", "bank"),
    "d30_foreclosure": trigger("FORECLOSURE COLLATERAL", "is_foreclosure_collateral", "id_product", "bank"),
    "d31_fraud": trigger("FORECLOSURE COLLATERAL", "is_foreclosure_collateral", "id_product", "bank"),
}


def customer_default(intended=False):
    def step(p):
        kept = "t.default_reason" if intended else "''"
        return update(
            p,
            {
                "default_indicator": "case when m.nrp_customer is not null then m.default_indicator else t.default_indicator end",
                "default_reason": f"case when m.nrp_customer is not null and m.default_indicator = '1' then ',DPD' when m.nrp_customer is not null then '' else {kept} end",
            },
            f"{T01} and {SEG} = 'NONRETAIL'",
        )

    return step


def unique_reasons(p):
    words = "string_split(t.default_reason, ',')"
    value = (
        f"case when t.default_indicator = '1' then coalesce(array_to_string(list_filter({words}, lambda x, i: list_position({words}, x) = i), ','), '') "
        "else t.default_reason end"
    )
    return update(p, {"default_reason": value})


ALL_TRIGGERS = [step for block in TRIGGERS.values() for step in block]
DETECTION = [*TECHNICAL, initial, dpd_default(), *ALL_TRIGGERS, customer_default(), unique_reasons]


# --- probation ----------------------------------------------------------------------

DEAL_CASE = f"({SEG} = 'RETAIL' and (" + " or ".join(
    f"t.p_default_reason like '%{x}%'"
    for x in (
        "DPD",
        "DEBT SALE",
        "FORECLOSURE COLLATERAL",
        "POCI",
        "CROSS",
        "CREDIT RISK ADJUSTMENT",
        "CONTRACT TERMINATION",
        "NON ACCRUED STATUS",
        "BREACH OF COVENANTS",
    )
) + "))"


def customer_case(intended=False):
    first = "BANKCRUPTCY" if intended else "BANKRUPTACY"
    names = (first, "DECEASED", "LOSS OF SUFFICIENT INCOME", "INDEBTEDNESS")
    return "(" + " or ".join(f"t.p_default_reason like '%{x}%'" for x in names) + ")"


def with_overdue(p):
    return (
        f"select t.*, c.max_dpd as cust_max_dpd, c.is_forbearance_last3m as cust_forbearance, c.no_base_defaults as cust_base "
        f"from {p} t left join (select * from atmp_customer where retail_nonretail = 'RETAIL' and has_product = '1') c on t.customer_number = c.nrp_customer"
    )


def start(case, late, intended=False):
    hit = f"{case} and t.p_is_probation = '0' and t.proposed_default_ind = '0' and t.p_proposed_default_ind = '1'"
    values = {
        "default_indicator": "'1'",
        "proposed_default_ind": f"case when {late} > 0 then '1' else '0' end",
        "default_reason": f"case when {late} > 0 then t.p_default_reason else 'PRB ' || t.p_default_reason end",
        "is_probation": f"case when {late} > 0 then '0' else '1' end",
        "start_probation_date": f"case when {late} > 0 then {NEXT} else t.p_start_probation_date end",
        "end_probation_date": f"case when {late} > 0 then {months(NEXT, 3)} else t.p_end_probation_date end",
    }
    if intended:
        return [lambda p: update(p, where(hit, values))]
    return one_by_one(hit, values)


def proceed(case, late):
    hit = f"{case} and t.working_day between t.p_start_probation_date and t.p_end_probation_date and t.is_probation = '1'"
    return one_by_one(
        hit,
        {
            "default_indicator": "'1'",
            "proposed_default_ind": "'0'",
            "default_reason": "case when t.p_is_probation = '0' then t.default_reason else t.p_default_reason end",
            "is_probation": "'1'",
            "start_probation_date": f"case when {late} > 10 then {NEXT} else t.p_start_probation_date end",
            "end_probation_date": f"case when {late} > 10 then {months(NEXT, 3)} else t.p_end_probation_date end",
        },
    )


def probation(intended=False):
    return [
        *start(customer_case(intended), "t.cust_max_dpd", intended),
        *start(DEAL_CASE, "t.dpd_ho", intended),
        *proceed(customer_case(intended), "t.cust_max_dpd"),
        *proceed(DEAL_CASE, "t.dpd_ho"),
    ]


def end_probation(intended=False):
    """New values beside the old ones, then the period test, then the merge by key."""

    def step(p):
        clear = "(s.cust_max_dpd < 60 and s.cust_forbearance = '0' and s.cust_base = '0')"
        new = {
            "default_indicator": f"case when {clear} then '0' else '1' end",
            "default_reason": f"case when {clear} then '' else s.p_default_reason end",
            "proposed_default_ind": "'0'",
            "is_probation": f"case when {clear} then '0' else '1' end",
            "start_probation_date": f"case when {clear} then null else s.p_start_probation_date end",
            "end_probation_date": f"case when {clear} then null else {NEXT} end",
        }
        values = ", ".join(f"{v} as {k}" for k, v in new.items())
        tested = "s.p_end_probation_date" if intended else "n.end_probation_date"
        current = "s.is_probation" if intended else "n.is_probation"
        inner = (
            f"select n.* from (select s.id_product, {values} from {p} s) n join {p} s on n.id_product = s.id_product "
            f"where {tested} > s.p_working_day and {tested} <= s.working_day and s.p_is_probation = '1' and {current} = '1'"
        )
        return update(
            p,
            where("u.id_product is not null", {k: f"u.{k}" for k in new}),
            f"left join ({inner}) u on t.id_product = u.id_product",
        )

    return step


# --- contagion ------------------------------------------------------------------------


def infect_values(reason):
    return {
        "default_indicator": "'1'",
        "default_contagion_indicator": "'1'",
        "default_reason": f"case when t.dpd_ho = 0 then 'PRB {reason}' else '{reason}' end",
        "proposed_default_ind": "case when t.dpd_ho = 0 then '0' else '1' end",
        "is_probation": "case when t.dpd_ho = 0 then '1' else '0' end",
        "start_probation_date": NEXT,
        "end_probation_date": months(NEXT, 3),
    }


def exposed_products(p):
    """Adds the products that share customer and security class with a default."""
    return (
        f"select t.*, t.id_product in (select b.id_product from t22_card_balance b join (select distinct b2.customer_number, b2.secured_flag, b2.working_day "
        f"from {p} a join t01_customer m on a.customer_number = m.nrp_customer join t22_card_balance b2 on a.id_product = b2.id_product and b2.working_day = {WD} "
        "where a.default_indicator = '1' and a.default_reason not in ('PRB CROSS DEFAULT PULLING EFFECT', 'CROSS DEFAULT PULLING EFFECT') "
        "and m.customer_segment = 'PI' and a.account_code <> '1914000000') d "
        "on b.customer_number = d.customer_number and b.secured_flag = d.secured_flag and b.working_day = d.working_day) as is_exposed "
        f"from {p} t"
    )


def pulled_customers(p):
    share = "coalesce((select min(pulling_percentage) / 100 from tc08_configuration_table where segment_type = 'RETAIL'), 0.2)"
    return (
        f"select t.*, t.customer_number in (select nrp_customer from atmp_customer where customer_segment = 'PI' and on_balance_default_eur > 0 and has_product = '1' "
        f"and total_credit_obligation > on_balance_default_eur and on_balance_default_eur > {share} * total_credit_obligation) as is_pulled from {p} t"
    )


def infect(flag, reason, intended=False):
    hit = f"t.{flag} and t.default_indicator = '0' and t.account_code <> '1914000000'"
    values = infect_values(reason)
    if intended:
        return [lambda p: update(p, where(hit, values))]
    return one_by_one(hit, values)


def cross_default(intended=False):
    return [exposed_products, *infect("is_exposed", "CROSS CONTAGION INDICATOR", intended)]


def pulling(intended=False):
    return [pulled_customers, *infect("is_pulled", "CROSS DEFAULT PULLING EFFECT", intended)]


def as_date(number):
    return f"cast(strptime(cast({number} as varchar), '%Y%m%d') as date)"


def repeated(p):
    alive = "instr(t.default_reason, 'DECEASED') = 0"
    year = months("t.start_probation_date", 12)
    return update(
        p,
        {
            "end_probation_date": f"case when t.p_default_indicator = '0' and t.default_indicator = '1' and {months('t.working_day', -12)} <= {as_date('t.p_default_end_date')} and {alive} then {year} "
            "when t.p_end_probation_date > t.p_working_day and t.p_end_probation_date <= t.working_day then t.end_probation_date "
            f"when t.p_default_indicator = '1' and t.default_indicator = '1' and {months(as_date('t.p_default_end_date'), 12)} >= {as_date('t.p_default_start_date')} and {alive} then {year} "
            "else t.end_probation_date end"
        },
    )


HAD_DEFAULT = (
    "retail_nonretail_indicator = 'RETAIL' and default_indicator = '1' and p_default_end_date is not null"
)
CONTAGION_COLUMNS = list(infect_values(""))


# --- attributes --------------------------------------------------------------------------

ON = "t.p_default_indicator = '0' and t.default_indicator = '1'"
STAY = "t.p_default_indicator = '1' and t.default_indicator = '1'"
OFF = "t.p_default_indicator = '1' and t.default_indicator = '0'"
EVE = "cast(strftime(t.working_day - 1, '%Y%m%d') as int)"


def attributes(intended=False):
    who = "true" if intended else f"{SEG} = 'RETAIL'"

    def first(p):
        start = f"case when {ON} then {EVE} when {STAY} then coalesce(t.p_default_start_date, {EVE}) else null end"
        if intended:
            start = f"case when {SEG} = 'NONRETAIL' then cast(strftime(c.default_start_date, '%Y%m%d') as int) else {start} end"
        values = {
            "historical_default_indicator": "case when t.p_historical_default_indicator = '0' and t.default_indicator = '1' then '1' else coalesce(t.p_historical_default_indicator, '0') end",
            "default_amount": f"case when {ON} then case when b.ledger_balance <= 0 then abs(b.ledger_balance) else 0 end when {STAY} then coalesce(t.p_default_amount, 0) else 0 end",
            "default_start_date": start,
            "default_end_date": f"case when {OFF} then {EVE} else t.p_default_end_date end",
            "interest_rate_default": f"case when {ON} then t.standart_interest_rate when t.default_indicator = '0' then 0 else coalesce(t.interest_rate_default, t.standart_interest_rate) end",
        }
        return update(
            p,
            where(who, values),
            f"left join (select * from t22_card_balance where working_day = {WD}) b on t.id_product = b.id_product {CUST}",
        )

    def second(p):
        fresh = "t.customer_number || t.id_product || cast(t.default_start_date as varchar)"
        value = f"case when {ON} then {fresh} when t.default_indicator = '0' then null else coalesce(t.default_id, {fresh}) end"
        return update(p, where(who, {"default_id": value}))

    return [first, second]


# --- recovery, valuation, interest ---------------------------------------------------------


def movements_sql():
    return (
        f"select id_product, sum(amount_event) as sum_amount_event from t26_writteoff_recovery where working_day = {WD} "
        "and upper(writteoff_recovery) in ('WA', 'WO', 'REP', 'DS') group by id_product"
    )


def payment(p):
    value = "case when t.p_amount_past_due > t.amount_past_due then t.p_amount_past_due - t.amount_past_due - coalesce(v.sum_amount_event, 0) else 0 end"
    return update(
        p,
        {"daily_payment": value},
        f"left join ({movements_sql()}) v on t.id_product = v.id_product",
    )


def recoveries(p):
    first = "strftime(t.p_working_day, '%d') = '01'"
    return update(
        p,
        {
            "monthly_recover": f"case when {first} then t.daily_payment else coalesce(t.p_monthly_recover, 0) + t.daily_payment end",
            "monthly_recover_default": f"case when {first} and t.default_indicator = '1' then t.daily_payment when {first} and t.default_indicator = '0' then 0 "
            "when t.default_indicator = '1' then coalesce(t.p_monthly_recover_default, 0) + t.daily_payment else coalesce(t.p_monthly_recover_default, 0) end",
            "monthly_recover_absorbing": f"case when {first} and t.absorbing_status_flag = 1 then t.daily_payment when {first} or t.absorbing_status_flag = 0 then 0 "
            "when t.absorbing_status_flag = 1 then coalesce(t.p_monthly_recover_absorbing, 0) + t.daily_payment else 0 end",
        },
    )


RECOVERY = [payment, recoveries]


def gca(p):
    value = "case when b.ledger_balance >= 0 or b.account_code = '1914000000' then 0 else abs(b.ledger_balance) - b.unamortized_fee end"
    return update(
        p,
        {"gca": f"case when ({value}) < 0 then 0 else ({value}) end"},
        f"left join (select * from t22_card_balance where working_day = {ASOF}) b on t.id_product = b.id_product",
    )


def interest(p):
    return update(
        p,
        {
            f"gross_interest_mtd_{c}": f"case when strftime(t.working_day, '%d') = '01' then t.gross_interest_daily_{c} else t.gross_interest_mtd_{c} + t.gross_interest_daily_{c} end"
            for c in ("lcy", "ocy")
        },
    )


# --- events -----------------------------------------------------------------------------------


def has(column, name, suffix):
    return f"{column} like '%{name}'" if suffix else f"instr({column}, '{name}') > 0"


EVENTS = {
    "d50a_dpd": (
        "DPD",
        "default_indicator = '1' and p_dpd_ho <= 90 and dpd_ho > 90 and retail_nonretail_indicator = 'RETAIL'",
    )
}
for _key, _name, _suffix in (
    ("d50b_contract_termination", "CONTRACT TERMINATION", False),
    ("d50c_debt_sale", "DEBT SALE", False),
    ("d50d_foreclosure", "FORECLOSURE COLLATERAL", False),
    ("d50e_contagion", "CROSS CONTAGION INDICATOR", True),
    ("d50f_pulling_effect", "CROSS DEFAULT PULLING EFFECT", True),
    ("d50g_credit_risk_adjustment", "CREDIT RISK ADJUSTMENT", False),
    ("d50h_non_accrued_status", "NON ACCRUED STATUS", False),
    ("d50i_breach_of_covenants", "BREACH OF COVENANTS", False),
):
    _now, _old = has("default_reason", _name, _suffix), has("p_default_reason", _name, _suffix)
    EVENTS[_key] = (
        _name,
        f"(default_indicator = '1' and p_default_indicator = '0' and {_now}) or ({_now} and not ({_old}))",
    )


def event_rows(p, *keys):
    """UNION ALL of one filter per event."""
    parts = []
    for key in keys or EVENTS:
        name, condition = EVENTS[key]
        code = f"coalesce((select min(reason_code) from tc_default_reason where reason_desc = '{name}'), '{name}')"
        parts.append(
            f"select customer_number, id_product as account_id, {code} as default_trigger_id, '{name}' as default_trigger_description, cast(null as varchar) as default_object, "
            f"working_day as event_start_date, 'ACTIVE' as event_status, cast(null as date) as probation_end_reset_date, coalesce(end_probation_date, {months(NEXT, 3)}) as probation_end_date, "
            f"cast(null as varchar) as corresponding_default_event_id, strftime(working_day, '%Y%m%d') || customer_number || {code} as default_event_id, cast(null as varchar) as autoid "
            f"from {p} where {condition}"
        )
    return " union all ".join(parts)


# --- unwinding ----------------------------------------------------------------------------------

CARDS_TODAY = f"t.product_group = 'CC' and t.working_day = {CC}"


def year_frac(a, b, basis):
    d1, d2 = f"least(day({a}), 30)", f"least(day({b}), 30)"
    bond = (
        f"case when day({b}) = 1 and day({a}) < 31 and day(last_day({a})) = 31 then date_diff('day', {a}, {b}) - 1 "
        f"else (year({b}) - year({a})) * 360 + (month({b}) - month({a})) * 30 + {d2} - {d1} end"
    )
    act = f"date_diff('day', {a}, {b})"
    return (
        f"round(case when {basis} in (3, 7) then ({bond}) / 360e0 when {basis} in (1, 4) then {act} / 365e0 "
        f"when {basis} in (2, 5) then {act} / 360e0 when {basis} = 6 then {act} / 366e0 else 0e0 end, 9)"
    )


def unwinding_rows(p):
    return (
        "select t.working_day, t.id_product, b.facility_id, t.account_number, t.p_working_day, t.working_day as closing_day, t.p_working_day as p_closing_day, 'CC' as product_group, "
        "t.retail_nonretail_indicator as retail_nonretail, t.gca * r.all_rate as gca_all, b.calculation_basis, t.standart_interest_rate as interest_rate, "
        "coalesce(v.overwritten_ecl, 0) as provision_fund, cast(0 as decimal(22,2)) as unwinding_daily_lcy, cast(0 as decimal(22,2)) as unwinding_mtd_lcy, "
        "cast(0 as decimal(22,2)) as unwinding_daily_ocy, cast(0 as decimal(22,2)) as unwinding_mtd_ocy, t.account_currency as deal_ccy "
        f"from {p} t join t22_card_balance b on t.id_product = b.id_product and b.working_day = {ASOF} "
        "join t20_exchange_rate r on b.working_day = r.working_day and b.account_currency = r.currency left join vw_unwinding v on t.id_product = v.id_product"
    )


def money(expression, rounded):
    return f"cast({expression} as decimal(22,2))" if rounded else expression


def carry_unwinding(p):
    return update(
        p,
        where(f"{CARDS_TODAY} and s.id_product is not null", {"unwinding_mtd_lcy": "s.unwinding_mtd_lcy"}),
        f"left join (select id_product, unwinding_mtd_lcy from t14_unwinding where working_day = {PREV}) s on t.id_product = s.id_product",
    )


def daily_unwinding(rounded=False):
    def step(p):
        amount = f"greatest(t.gca_all - t.provision_fund, 0) * (pow(1 + t.interest_rate / 100, {year_frac('t.p_closing_day', 't.closing_day', 't.calculation_basis')}) - 1)"
        return update(p, where(CARDS_TODAY, {"unwinding_daily_lcy": money(amount, rounded)}))

    return step


def month_unwinding(rounded=False):
    def step(p):
        amount = "case when day(t.working_day) = 1 then coalesce(t.unwinding_daily_lcy, 0) else coalesce(t.unwinding_daily_lcy, 0) + coalesce(t.unwinding_mtd_lcy, 0) end"
        return update(p, where(CARDS_TODAY, {"unwinding_mtd_lcy": money(amount, rounded)}))

    return step


def original_currency(rounded=False):
    def step(p):
        values = {
            f"unwinding_{s}_ocy": money(f"t.unwinding_{s}_lcy / x.all_rate", rounded) for s in ("daily", "mtd")
        }
        return update(
            p,
            where(CARDS_TODAY, values),
            "left join t20_exchange_rate x on t.deal_ccy = x.currency and t.working_day = x.working_day",
        )

    return step


UNWINDING = [carry_unwinding, daily_unwinding(True), month_unwinding(True), original_currency(True)]
