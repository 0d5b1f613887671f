"""Columns and types of the history tables, stated once.

Fixed values: names and order are those of the bank's history tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SNAPSHOT = _struct(
    """
autoid bigint, working_day date, amount_past_due double, date_since_pd_ol date, days_past_due int,
delinquency_amount_mp double, last_unpaid_due_date_mp date, minimum_payment double, ol_da double,
ol_dpd int, branch_code string, customer_number string, account_code string,
account_currency string, account_sequence string, account_number string, id_product string,
id_product_type string, card_number string, card_balance double, card_expire_date date,
card_ccy string, card_limit double, next_payment_date date, last_statement_balance double,
sum_of_payments double, dpd_ho int, retail_nonretail_indicator string, times_past_due int,
maximum_days_past_due int, total_days_past_due int, current_days_in_excess int,
number_of_payments_past_due int, date_since_past_due date, absorbing_status_flag int,
date_absorbing_status date, exposure_at_absorbing double, default_contagion_indicator string,
default_indicator string, historical_default_indicator string, default_reason string,
default_amount double, default_start_date int, default_end_date int, default_id string,
monthly_recover double, monthly_recover_default double, monthly_recover_absorbing double,
proposed_default_ind string, is_probation string, start_probation_date date,
end_probation_date date, standart_interest_rate double, penalty_interest_rate double,
cashwithdrawal_interest_rate double, interest_rate_default double, date_since_pd_ho date,
date_since_pd_ho2 date, dpd_ho2 int, eba_status string, eba_status_start_date date,
maxdpd_current_month int, is_joint string, joint_id string, gca double,
gross_interest_daily_lcy double, gross_interest_mtd_lcy double,
gross_interest_daily_ocy double, gross_interest_mtd_ocy double
"""
)
UNWINDING = _struct(
    """
autoid bigint, working_day date, id_product string, facility_id string, account_number string,
p_working_day date, closing_day date, p_closing_day date, product_group string,
retail_nonretail string, gca_all double, calculation_basis int, interest_rate double,
provision_fund double, unwinding_daily_lcy double, unwinding_mtd_lcy double,
unwinding_daily_ocy double, unwinding_mtd_ocy double, deal_ccy string
"""
)
SNAPSHOT_ZERO_DEFAULTS = (
    "dpd_ho",
    "dpd_ho2",
    "standart_interest_rate",
    "penalty_interest_rate",
    "interest_rate_default",
)
# Rejected rows are committed up to this column.
LAST_ERROR_COLUMN = "monthly_recover_absorbing"

SCHEDULE = _struct(
    """
autoid bigint, id_product string, principal_payment_date date, principal_payment_amount double,
interest_payment_date date, interest_payment_amount double, customer_number string,
minimum_payment double, penalty_interest_rate double, penalty_interest_amount double,
working_day date, last_sum_of_payment double, payment_amount double, is_pastdue string,
period int, due_date_dlq date
"""
)


def error_snapshot() -> T.StructType:
    names = SNAPSHOT.fieldNames()
    return T.StructType(SNAPSHOT.fields[: names.index(LAST_ERROR_COLUMN) + 1])


# The columns of every table that a close reads, for reading without inference.
TABLES: dict[str, T.StructType] = {
    "t17_dpd_credit_cards": SNAPSHOT,
    "t18_cc_payment_schedule": SCHEDULE,
    "atmp_t18_cc_payment_schedule": T.StructType(SCHEDULE.fields[1:]),
    "t14_unwinding": UNWINDING,
    "w01_working_day": _struct(
        """
working_day date
"""
    ),
    "w02_ccworking_day": _struct(
        """
working_day date
"""
    ),
    "atmp_t17_dpd_credit_cards": _struct(
        """
working_day date, p_working_day date, id_product string, customer_number string, account_number
string, account_code string, account_currency string, card_ccy string, id_product_type string,
retail_nonretail_indicator string, is_joint string, joint_id string, amount_past_due double,
p_amount_past_due double, days_past_due int, card_balance double, gca double, materiality_level
double, dpd_ho int, p_dpd_ho int, dpd_ho2 int, date_since_pd_ho date, p_date_since_pd_ho date,
p_date_since_pd_ho2 date, date_since_pd_ho2 date, times_past_due int, maximum_days_past_due int,
total_days_past_due int, current_days_in_excess int, p_times_past_due int,
p_maximum_days_past_due int, p_total_days_past_due int, p_current_days_in_excess int,
maxdpd_month int, maxdpd_current_month int, p_date_absorbing_status date,
p_exposure_at_absorbing double, date_absorbing_status date, exposure_at_absorbing double,
default_indicator string, p_default_indicator string, historical_default_indicator string,
p_historical_default_indicator string, default_contagion_indicator string, default_reason
string, p_default_reason string, proposed_default_ind string, p_proposed_default_ind string,
is_probation string, p_is_probation string, start_probation_date date, end_probation_date date,
p_start_probation_date date, p_end_probation_date date, default_start_date int, default_end_date
int, p_default_start_date int, p_default_end_date int, default_amount double, p_default_amount
double, default_id string, interest_rate_default double, standart_interest_rate double,
penalty_interest_rate double, p_monthly_recover double, p_monthly_recover_default double,
p_monthly_recover_absorbing double, daily_payment double, monthly_recover double,
monthly_recover_default double, monthly_recover_absorbing double, absorbing_status_flag int,
eba_status string, eba_status_start_date date, gross_interest_daily_lcy double,
gross_interest_daily_ocy double, gross_interest_mtd_lcy double, gross_interest_mtd_ocy double,
date_since_pd_ol date, delinquency_amount_mp double, last_unpaid_due_date_mp date,
minimum_payment double, ol_da double, ol_dpd int, branch_code string, account_sequence string,
card_number string, card_expire_date date, card_limit double, next_payment_date date,
last_statement_balance double, sum_of_payments double, number_of_payments_past_due int,
date_since_past_due date, cashwithdrawal_interest_rate double
"""
    ),
    "t01_customer": _struct(
        """
nrp_customer string, retail_nonretail string, customer_segment string, default_indicator string,
dpd_ho int, profit_center string, esa_code string
"""
    ),
    "atmp_customer": _struct(
        """
nrp_customer string, retail_nonretail string, has_product string, customer_segment string,
max_dpd int, maximum_days_past_due int, maxdpd_current_month int, dpd_ho2 int,
is_forbearance_last3m string, no_base_defaults string, on_balance_default_eur double,
total_credit_obligation double, default_start_date date
"""
    ),
    "t20_exchange_rate": _struct(
        """
working_day date, currency string, eur_rate double, all_rate double
"""
    ),
    "t22_card_balance": _struct(
        """
working_day date, id_product string, customer_number string, account_code string, ledger_balance
double, unamortized_fee double, account_currency string, facility_id string, calculation_basis
int, secured_flag string
"""
    ),
    "t26_writteoff_recovery": _struct(
        """
working_day date, id_product string, writteoff_recovery string, amount_event double
"""
    ),
    "atmp_default_triggers": _struct(
        """
working_day date, nrp_customer string, id_product string, is_decease_cust string, is_bankcruptcy
string, is_terminated_contract string, loss_of_sufficient_income string, is_indebtedness string,
non_accrued_status string, breach_contract_covenants string, is_dept_sale_npv string,
is_foreclosure_collateral string
"""
    ),
    "technical_default": _struct(
        """
system_date date, id_product string, customer_number string
"""
    ),
    "tc08_configuration_table": _struct(
        """
segment_type string, pd_threshold double, percentage_threshold double, dpd_threshold int,
retention_year int, pulling_percentage double, pd_threshold2 double, max_debtor_dpd_forbearance
int, percentage_threshold2 double
"""
    ),
    "tc_default_reason": _struct(
        """
reason_desc string, reason_code string
"""
    ),
    "atmp_joint_dpd": _struct(
        """
joint_id string, dpd_ho int
"""
    ),
    "customer_relations": _struct(
        """
applicant_id string, facility_id string, is_joint_micro string, application_role_code string,
product_type string, joint_group string
"""
    ),
    "vw_unwinding": _struct(
        """
id_product string, overwritten_ecl double
"""
    ),
    "t02_customer_product": _struct(
        """
id_product string, nrp_customer string, id_product_type string, product_group string, check_flag
string, current_days_past_due int, ref_id_product string, first_entry timestamp, last_update
timestamp
"""
    ),
    "tc01_product_type": _struct(
        """
id_product_type string, product_group string
"""
    ),
    "tc03_profit_center": _struct(
        """
profit_center string, esa_code string
"""
    ),
    "t19_default_events": _struct(
        """
customer_number string, account_id string, default_trigger_id string,
default_trigger_description string, default_object string, event_start_date date,
event_status string, probation_end_reset_date date, probation_end_date date,
corresponding_default_event_id string, default_event_id string, autoid string
"""
    ),
}
TABLES["err_atmp_t17_dpd_credit_cards"] = TABLES["atmp_t17_dpd_credit_cards"]
