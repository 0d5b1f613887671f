"""Bank tables derived from the given Parquet tables.

The bank's own tables are not in the test data, so each one is a view over
``orders``, ``customer``, ``lineitem``, ``events`` and ``nation``.  One text per
table serves both engines: Spark runs it with DataFrames bound to the
``{name}`` placeholders, DuckDB runs it as a chain of CTEs.  ``@each(a|b)``
stands for "one row per listed value", which the two dialects spell differently.
"""

from __future__ import annotations

import re
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

RAW_TABLES = ("orders", "customer", "lineitem", "events", "nation")

VIEWS: dict[str, str] = {}

VIEWS["w02_ccworking_day"] = """
select distinct cast(ts as date) as working_day from {events}
"""

VIEWS["w01_working_day"] = """
select working_day from {w02_ccworking_day} where working_day < date '2024-01-29'
union all select date '2024-01-31'
"""

VIEWS["base"] = """
select o_orderkey as k, o_custkey as c, cast(round(o_totalprice*100) as bigint) as cents,
  lpad(cast(o_custkey as string),9,'0') as customer_number,
  concat('CC', lpad(cast(o_custkey as string),9,'0'), case when o_orderkey%3=0 then '19' else '18' end, lpad(cast(o_orderkey as string),13,'0')) as id_product,
  date '2024-01-01' + cast(o_orderkey%32 as int) as working_day
from {orders}
"""

VIEWS["t01_customer"] = """
select lpad(cast(c_custkey as string),9,'0') as nrp_customer,
  case when c_custkey%5<3 then 'RETAIL' else 'NONRETAIL' end as retail_nonretail,
  case when c_mktsegment in ('HOUSEHOLD','BUILDING') then 'PI' when c_mktsegment='FURNITURE' then 'MICRO' when c_mktsegment='MACHINERY' then 'SME' else 'CORPORATE' end as customer_segment,
  case when c_custkey%11=0 then '1' else '0' end as default_indicator,
  cast(case when c_custkey%7=0 then null else c_custkey%200 end as int) as dpd_ho,
  concat('PC', cast(c_nationkey as string)) as profit_center,
  case when c_custkey%6=0 then '' when c_custkey%6=1 then null else 'S11' end as esa_code
from {customer} where c_custkey%10<>9
"""

VIEWS["atmp_customer"] = """
select lpad(cast(c_custkey as string),9,'0') as nrp_customer,
  case when c_custkey%5<3 then 'RETAIL' else 'NONRETAIL' end as retail_nonretail,
  case when c_custkey%12=0 then '0' else '1' end as has_product,
  case when c_mktsegment in ('HOUSEHOLD','BUILDING') then 'PI' else 'SME' end as customer_segment,
  cast(c_custkey%120 as int) as max_dpd, cast(c_custkey%400 as int) as maximum_days_past_due,
  cast(c_custkey%90 as int) as maxdpd_current_month, cast(c_custkey%75 as int) as dpd_ho2,
  case when c_custkey%4=0 then '1' else '0' end as is_forbearance_last3m,
  case when c_custkey%6=0 then '1' else '0' end as no_base_defaults,
  cast(c_custkey%50 as double) as on_balance_default_eur, cast(c_custkey%170 as double) as total_credit_obligation,
  date '2023-06-01' + cast(c_custkey%100 as int) as default_start_date
from {customer}
"""

VIEWS["atmp_t17_dpd_credit_cards"] = """
select working_day, working_day - cast(1 as int) as p_working_day, id_product, customer_number,
  lpad(cast(k as string),10,'0') as account_number, case when k%13=0 then '1914000000' else '1913000000' end as account_code,
  case k%3 when 0 then 'EUR' when 1 then 'USD' else 'ALL' end as account_currency,
  case k%4 when 0 then 'EUR' when 1 then 'USD' else 'ALL' end as card_ccy,
  case k%5 when 0 then 'VISA ' when 1 then ' VISA' when 2 then 'GOLD' when 3 then 'AMEX' else 'MC' end as id_product_type,
  case when c%20=19 then 'Retail' when c%20=18 then 'NON-RETAIL' when c%5<3 then 'RETAIL' else 'NONRETAIL' end as retail_nonretail_indicator,
  case when k%12=0 then '1' else '0' end as is_joint, case when k%12=0 then concat('J', cast(cast(floor(k/24) as bigint) as string)) else null end as joint_id,
  floor(cents*(k%7)/1e3)/1e2 as amount_past_due, floor(cents*((k+1)%7)/1e3)/1e2 as p_amount_past_due,
  cast(k%45 as int) as days_past_due, floor(cents*(k%3)/1e2)/1e2 as card_balance, floor(cents/1e2)/1e2 as gca, 10.0e0 as materiality_level,
  cast(k%200 as int) as dpd_ho, cast(case when k%4=0 then 0 else (k*7)%180 end as int) as p_dpd_ho, cast(k%60 as int) as dpd_ho2,
  cast(null as date) as date_since_pd_ho,
  case when k%3=0 then null else working_day - cast(k%90 as int) end as p_date_since_pd_ho,
  case when k%5=0 then null else working_day - cast(k%120 as int) end as p_date_since_pd_ho2,
  case when k%6=0 then null else working_day - cast(k%30 as int) end as date_since_pd_ho2,
  cast(k%5 as int) as times_past_due, cast(k%190 as int) as maximum_days_past_due, cast(k%77 as int) as total_days_past_due, cast(k%19 as int) as current_days_in_excess,
  cast(case when k%8=0 then null else k%9 end as int) as p_times_past_due, cast(case when k%8=1 then null else k%260 end as int) as p_maximum_days_past_due,
  cast(case when k%8=2 then null else k%300 end as int) as p_total_days_past_due, cast(case when k%8=3 then null else k%31 end as int) as p_current_days_in_excess,
  cast(case when k%8=4 then null else k%90 end as int) as maxdpd_month, cast(k%33 as int) as maxdpd_current_month,
  case when k%7=0 then working_day - cast(40 as int) else null end as p_date_absorbing_status, case when k%7=0 then 100.0e0 when k%7=1 then 0.0e0 else null end as p_exposure_at_absorbing,
  case when k%21=0 then working_day - cast(50 as int) else null end as date_absorbing_status, cast(k%9 as double) as exposure_at_absorbing,
  case when k%9=0 or k%10=1 then '1' else '0' end as default_indicator, case when k%8=0 then '1' else '0' end as p_default_indicator,
  case when k%9=0 then '1' else '0' end as historical_default_indicator,
  case when k%14=0 then '1' when k%14=1 then null else '0' end as p_historical_default_indicator, '0' as default_contagion_indicator,
  case k%11 when 0 then ',DPD' when 1 then ',DECEASED' when 2 then ',DEBT SALE,CONTRACT TERMINATION' when 3 then 'CROSS CONTAGION INDICATOR' when 4 then 'PRB CROSS DEFAULT PULLING EFFECT' when 5 then null when 6 then ',NON ACCRUED STATUS,DPD,DPD' when 8 then ',FORECLOSURE COLLATERAL' when 9 then ',CREDIT RISK ADJUSTMENT' when 10 then ',BREACH OF COVENANTS' else '' end as default_reason,
  case k%9 when 0 then ',DPD' when 1 then ',DECEASED' when 2 then ',LOSS OF SUFFICIENT INCOME' when 3 then ',INDEBTEDNESS' when 4 then ',BANKCRUPTCY' when 5 then null when 6 then 'CROSS CONTAGION INDICATOR' when 7 then ',DEBT SALE' else '' end as p_default_reason,
  case when k%4=1 then '1' else '0' end as proposed_default_ind, case when k%3<>0 then '1' else '0' end as p_proposed_default_ind,
  case when k%5=2 then '1' else '0' end as is_probation, case when k%5=2 and k%2=0 then '1' else '0' end as p_is_probation,
  working_day - cast(k%60 as int) as start_probation_date, case when k%11=0 then null else working_day + cast(k%60 as int) end as end_probation_date,
  working_day - cast(k%80 as int) as p_start_probation_date, working_day + cast(k%51 as int) - cast(20 as int) as p_end_probation_date,
  cast(case when k%9=0 then 20230201 + k%28 else null end as int) as default_start_date, cast(case when k%10=3 then 20230401 + k%28 else null end as int) as default_end_date,
  cast(case when k%8=0 then 20230101 + k%28 else null end as int) as p_default_start_date, cast(case when k%3=0 then 20230301 + k%28 when k%3=1 then 20220301 else null end as int) as p_default_end_date,
  case when k%9=0 then 41.5e0 else 0.0e0 end as default_amount,
  case when k%10=0 then null else 55.5e0 end as p_default_amount, case when k%16=0 then 'OLD-ID' else null end as default_id,
  case when k%15=0 then null else 12.5e0 end as interest_rate_default, cast(5 + k%20 as double) as standart_interest_rate, cast(case when k%6=5 then null else 3 end as double) as penalty_interest_rate,
  case when k%6=1 then null else 10.25e0 end as p_monthly_recover, case when k%6=2 then null else 4.5e0 end as p_monthly_recover_default, case when k%6=3 then null else 2.5e0 end as p_monthly_recover_absorbing,
  0.0e0 as daily_payment, cast(k%12 as double)/4e0 as monthly_recover, cast(k%14 as double)/4e0 as monthly_recover_default, cast(k%16 as double)/4e0 as monthly_recover_absorbing,
  cast(case when k%7=2 then null else k%2 end as int) as absorbing_status_flag,
  case when k%2=0 then 'PE' else 'NPE' end as eba_status, case when k%13=0 then null else working_day - cast(5 as int) end as eba_status_start_date,
  cast(k%40 as double)/4e0 as gross_interest_daily_lcy, cast(k%30 as double)/4e0 as gross_interest_daily_ocy, cast(k%400 as double)/4e0 as gross_interest_mtd_lcy, cast(k%300 as double)/4e0 as gross_interest_mtd_ocy,
  working_day - cast(k%10 as int) as date_since_pd_ol, cast(k%70 as double)/4e0 as delinquency_amount_mp, working_day - cast(k%25 as int) as last_unpaid_due_date_mp, cast(10 + k%8 as double) as minimum_payment,
  cast(k%22 as double)/4e0 as ol_da, cast(k%18 as int) as ol_dpd, concat('B', cast(k%30 as string)) as branch_code, cast(k%4 as string) as account_sequence, concat('4', lpad(cast(k as string),15,'0')) as card_number,
  working_day + cast(k%900 as int) as card_expire_date, cast(1000 + k%5000 as double) as card_limit, working_day + cast(k%28 as int) as next_payment_date, cast(k%333 as double)/4e0 as last_statement_balance,
  cast(k%111 as double)/4e0 as sum_of_payments, cast(k%6 as int) as number_of_payments_past_due, working_day - cast(k%33 as int) as date_since_past_due, cast(18 + k%3 as double) as cashwithdrawal_interest_rate
from {base}
"""

VIEWS["t20_exchange_rate"] = """
select working_day, currency, case currency when 'EUR' then 1.0e0 when 'USD' then 0.9e0 + day(working_day)/1.024e3 else 0.0096e0 + day(working_day)/1.048576e6 end as eur_rate, case currency when 'EUR' then 104.0e0 + day(working_day)/8e0 when 'USD' then 95.5e0 + day(working_day)/16e0 else 1.0e0 end as all_rate
from (select working_day, @each('EUR'|'USD'|'ALL') as currency from (select working_day from {w01_working_day} union select working_day from {w02_ccworking_day}) w) x
"""

VIEWS["t22_card_balance"] = """
select working_day, id_product, customer_number, case when k%13=0 then '1914000000' else '1913000000' end as account_code,
  case when k%6=0 then (cents + 1700*day(working_day))/1e2 else -(cents + 1700*day(working_day))/1e2 end as ledger_balance, cast((k + day(working_day))%50 as double) as unamortized_fee,
  case k%3 when 0 then 'EUR' when 1 then 'USD' else 'ALL' end as account_currency, lpad(cast(k as string),12,'0') as facility_id,
  cast((k + day(working_day))%8 as int) as calculation_basis, case when (k + day(working_day))%2=0 then '1' else '0' end as secured_flag
from (select k, cents, id_product, customer_number, @each(date '2024-01-28'|date '2024-01-29'|date '2024-01-30'|date '2024-01-31') as working_day from {base}) x where k%17<>0
"""

VIEWS["t26_writteoff_recovery"] = """
select date '2024-01-31' - cast(l_linenumber%4 as int) as working_day, id_product, case (l_orderkey + l_linenumber)%5 when 0 then 'wa' when 1 then 'WO' when 2 then 'Rep' when 3 then 'DS' else 'XX' end as writteoff_recovery, cast(l_quantity as double) as amount_event
from {lineitem} join {base} on l_orderkey = k
"""

VIEWS["atmp_default_triggers"] = """
select cast(e.ts as date) + cast(1 as int) as working_day, b.customer_number as nrp_customer, b.id_product,
  case when e.event_type='error' then '1' else '0' end as is_decease_cust, case when e.event_type='signup' then '1' else '0' end as is_bankcruptcy,
  case when e.event_type='click' then '1' else '0' end as is_terminated_contract, case when e.event_type='view' then '1' else '0' end as loss_of_sufficient_income,
  case when e.event_type='purchase' then '1' else '0' end as is_indebtedness, case when e.event_id%5=0 then '1' else '0' end as non_accrued_status,
  case when e.event_id%5=1 then '1' else '0' end as breach_contract_covenants, case when e.event_id%5=2 then '1' else '0' end as is_dept_sale_npv, case when e.event_id%5=3 then '1' else '0' end as is_foreclosure_collateral
from {events} e join {base} b on e.user_id = b.c
"""

VIEWS["technical_default"] = """
select cast(e.ts as date) + cast(1 as int) as system_date, b.id_product, b.customer_number
from {events} e join {base} b on e.user_id = b.c where e.event_type = 'error'
"""

VIEWS["tc08_configuration_table"] = """
select 'RETAIL' as segment_type, 100.0e0 as pd_threshold, 1.0e0 as percentage_threshold, 90 as dpd_threshold, 5 as retention_year, 20.0e0 as pulling_percentage, 50.0e0 as pd_threshold2, 30 as max_debtor_dpd_forbearance, 1.0e0 as percentage_threshold2
union all select 'NONRETAIL', 500.0e0, 1.0e0, 90, 7, 20.0e0, 250.0e0, 30, 1.0e0
"""

VIEWS["tc_default_reason"] = """
select 'DPD' as reason_desc, 'R01' as reason_code union all select 'DEBT SALE', 'R02' union all select 'CONTRACT TERMINATION', 'R03' union all select 'CROSS CONTAGION INDICATOR', 'R04' union all select 'NON ACCRUED STATUS', 'R05'
"""

VIEWS["atmp_joint_dpd"] = """
select concat('J', cast(cast(floor(k/24) as bigint) as string)) as joint_id, cast(max(k*3%200) as int) as dpd_ho from {base} group by cast(floor(k/24) as bigint)
"""

VIEWS["customer_relations"] = """
select customer_number as applicant_id, concat(substring(lpad(cast(k as string),12,'0'),10,2), substring(lpad(cast(k as string),12,'0'),7,3)) as facility_id, case when k%2=0 then '1' else '0' end as is_joint_micro,
  case when k%3=0 then 'GUARANTOR' else 'BORROWER' end as application_role_code, case when k%5=0 then 'LOAN' else 'CARD' end as product_type, concat('G', cast(k%25 as string)) as joint_group
from {base}
"""

VIEWS["vw_unwinding"] = """
select id_product, case when k%9=0 then null else cast(k%1000 as double) end as overwritten_ecl from {base} where k%5<>0
"""

VIEWS["t02_customer_product"] = """
select id_product, customer_number as nrp_customer, 'OLD' as id_product_type, 'CREDIT CARD' as product_group, '0' as check_flag, cast(1 as int) as current_days_past_due, 'CC0' as ref_id_product,
  cast('2023-06-01 00:00:00' as timestamp) as first_entry, cast('2023-06-02 00:00:00' as timestamp) as last_update from {base} where k%3<>1
union all select concat('ZZ', id_product), customer_number, 'OLD', 'LOAN', '0', cast(9 as int), 'X',
  cast('2023-06-01 00:00:00' as timestamp), cast('2023-06-02 00:00:00' as timestamp) from {base} where k%100=0
"""

VIEWS["tc01_product_type"] = """
select 'VISA' as id_product_type, 'CREDIT CARD' as product_group union all select ' MC ', 'CREDIT CARD'
"""

VIEWS["tc03_profit_center"] = """
select distinct concat('PC', cast(n_nationkey as string)) as profit_center, concat('S', cast(n_regionkey as string)) as esa_code from {nation}
"""

VIEWS["t14_unwinding"] = """
select cast(k*4 + day(b.day) - 27 as bigint) as autoid, b.day as working_day, b.id_product, case when k%10=0 then 'LN' else 'CC' end as product_group, b.day as closing_day, b.day - cast(1 + k%3 as int) as p_closing_day,
  cast(k%8 as int) as calculation_basis, cast(5 + k%20 as double) as interest_rate, floor(cents/1e2)/1e2 as gca_all, cast(k%1000 as double) as provision_fund,
  cast(k%11 as double) as unwinding_daily_lcy, case when k%6=0 then null else cast((k + day(b.day))%90 as double) end as unwinding_mtd_lcy, 0.0e0 as unwinding_daily_ocy, 0.0e0 as unwinding_mtd_ocy,
  case k%3 when 0 then 'EUR' when 1 then 'USD' else 'ALL' end as deal_ccy
from (select k, cents, id_product, @each(date '2024-01-28'|date '2024-01-29'|date '2024-01-30') as day from {base}) b where k%4<>0 or b.day = date '2024-01-30'
"""

VIEWS["t17_dpd_credit_cards"] = """
select cast(cast(account_number as bigint) + 1 as bigint) as autoid, s.* from (
  select * from {atmp_history_rows} where cast(account_number as bigint)%9<>0) s
union all
select cast(cast(account_number as bigint) + 100000001 as bigint) as autoid, date '2024-01-26' as working_day, s.* from (
  select * from {atmp_history_tail} where cast(account_number as bigint)%4=0) s
"""

# Columns a committed snapshot keeps, in commit order (without autoid and working_day).
SNAPSHOT_COLUMNS = """
amount_past_due date_since_pd_ol days_past_due delinquency_amount_mp last_unpaid_due_date_mp minimum_payment ol_da ol_dpd
branch_code customer_number account_code account_currency account_sequence account_number id_product id_product_type
card_number card_balance card_expire_date card_ccy card_limit next_payment_date last_statement_balance sum_of_payments
dpd_ho retail_nonretail_indicator times_past_due maximum_days_past_due total_days_past_due current_days_in_excess
number_of_payments_past_due date_since_past_due absorbing_status_flag date_absorbing_status exposure_at_absorbing
default_contagion_indicator default_indicator historical_default_indicator default_reason default_amount
default_start_date default_end_date default_id monthly_recover monthly_recover_default monthly_recover_absorbing
proposed_default_ind is_probation start_probation_date end_probation_date standart_interest_rate penalty_interest_rate
cashwithdrawal_interest_rate interest_rate_default date_since_pd_ho date_since_pd_ho2 dpd_ho2 eba_status
eba_status_start_date maxdpd_current_month is_joint joint_id gca gross_interest_daily_lcy gross_interest_mtd_lcy
gross_interest_daily_ocy gross_interest_mtd_ocy
""".split()

VIEWS["atmp_history_tail"] = (
    "select " + ", ".join(SNAPSHOT_COLUMNS) + " from {atmp_t17_dpd_credit_cards}"
)
VIEWS["atmp_history_rows"] = (
    "select date '2024-01-29' as working_day, "
    + ", ".join(SNAPSHOT_COLUMNS)
    + " from {atmp_t17_dpd_credit_cards}"
)

VIEWS["err_atmp_t17_dpd_credit_cards"] = """
select * from {atmp_t17_dpd_credit_cards}
"""

VIEWS["atmp_t18_cc_payment_schedule"] = """
select b.id_product, cast(l.l_shipdate as date) as principal_payment_date, l.l_extendedprice as principal_payment_amount,
  cast(l.l_shipdate as date) + cast(5 as int) as interest_payment_date, l.l_quantity as interest_payment_amount, b.customer_number,
  cast(10 + b.k%8 as double) as minimum_payment, cast(l.l_linenumber as double) as penalty_interest_rate, l.l_quantity*2 as penalty_interest_amount,
  date '2024-01-30' as working_day, cast(b.k%40 as double) as last_sum_of_payment, cast(b.k%44 as double) as payment_amount,
  case when l.l_returnflag='R' then '1' else '0' end as is_pastdue, cast(l.l_linenumber as int) as period, cast(l.l_shipdate as date) + cast(20 as int) as due_date_dlq
from {lineitem} l join {base} b on l.l_orderkey = b.k
"""

VIEWS["t18_cc_payment_schedule"] = """
select cast(l_orderkey*10 + l_linenumber as bigint) as autoid, concat('H', cast(l_orderkey as string)) as id_product, date '2024-01-29' as working_day from {lineitem}
"""

VIEWS["t19_default_events"] = """
select customer_number, case when k%7=0 then concat('LN', substring(id_product,3,24)) else id_product end as account_id, 'R01' as default_trigger_id, 'DPD' as default_trigger_description,
  date '2024-01-31' - cast(k%4 as int) as event_start_date, 'ACTIVE' as event_status
from {base}
"""

VIEWS["onboarding_candidates"] = """
select lpad(cast(c_custkey as string),9,'0') as nrp_customer, case when copy = 1 then c_name else concat('A ', c_name) end as customer_name, case when c_custkey%3=0 then null else concat('+', cast(c_custkey as string)) end as customer_phone,
  cast(null as string) as customer_address, concat('PC', cast(c_nationkey as string)) as profit_center, case c_custkey%5 when 0 then '01' when 1 then '20' when 2 then '06' when 3 then '10' else null end as coconut_type,
  c_mktsegment as marketing_group, cast(c_custkey as string) as coconut_number, concat('O', cast(c_custkey%9 as string)) as customer_officer_code, cast(null as string) as customer_officer_name,
  case when c_custkey%4=0 then null else 'N1' end as nace_code, case when c_custkey%6=0 then '' when c_custkey%6=1 then null else 'S11' end as esa_code
from (select *, @each(1|2) as copy from {customer}) twice where copy = 1 or c_custkey%3<>0
"""

# Staging holds one day: the tables of a whole close.
VIEWS["base_today"] = VIEWS["base"].replace("date '2024-01-01' + cast(o_orderkey%32 as int)", "date '2024-01-30'")
VIEWS["t17_today"] = VIEWS["atmp_t17_dpd_credit_cards"].replace("{base}", "{base_today}")
VIEWS["err_today"] = "select * from {t17_today}"

_EACH = re.compile(r"@each\(([^)]*)\)")


def _dialect(text: str, engine: str) -> str:
    def expand(match: re.Match) -> str:
        values = ", ".join(match.group(1).split("|"))
        return f"explode(array({values}))" if engine == "spark" else f"unnest([{values}])"

    return _EACH.sub(expand, text)


def _inputs(name: str) -> list[str]:
    names = {field for _, field, _, _ in Formatter().parse(VIEWS[name]) if field}
    return sorted(names)


class Bank:
    """The derived tables of one data folder, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in RAW_TABLES:
                self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                inputs = {n: self[n] for n in _inputs(name)}
                self._frames[name] = self.spark.sql(_dialect(VIEWS[name], "spark"), **inputs)
        return self._frames[name]


def with_clause(*names: str) -> str:
    """CTEs for the named tables and everything they derive from (DuckDB)."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in RAW_TABLES or name in ordered:
            return
        for needed in _inputs(name):
            visit(needed)
        ordered.append(name)

    for name in names:
        visit(name)
    ctes = []
    for name in ordered:
        text = _dialect(VIEWS[name], "duckdb").format(**{n: n for n in _inputs(name)})
        ctes.append(f"{name} as ({text.strip()})")
    return ",\n".join(ctes)
