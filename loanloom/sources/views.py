"""Lending tables derived from the supplied star schema.

Each text runs unchanged in Spark SQL and in ANSI engines; ``{orders}`` and the like stand for the
base table. The arithmetic is integer, so both give the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from loanloom.session import compiled

LOANS = """
SELECT o_orderkey AS loan_id,
  concat(CASE WHEN o_custkey % 2 = 0 THEN 'A' ELSE 'B' END, CAST(o_orderkey AS STRING)) AS loan_no,
  CASE WHEN o_custkey % 2 = 0 THEN 'a' ELSE 'b' END AS branch,
  CAST(o_orderdate AS DATE) AS release_date, o_totalprice AS principal,
  o_totalprice * 1.25 AS total_due, o_totalprice * 0.25 AS pending_due,
  CASE o_orderstatus WHEN 'F' THEN 'Fully Paid' WHEN 'O' THEN 'Open'
    ELSE CASE o_orderkey % 3 WHEN 0 THEN 'Denied' WHEN 1 THEN 'Not Taken Up' ELSE 'Processing' END END AS status,
  o_orderpriority AS product
FROM {orders}
"""

REPAYMENTS = """
SELECT l_orderkey AS loan_id, CAST(l_shipdate AS DATE) AS collection_date, l_extendedprice AS amount
FROM {lineitem}
"""

# Both branches deliver dates as text: branch a in ISO form, branch b day first.
RAW_LOANS = """
SELECT o_orderkey AS loan_id, CASE WHEN o_custkey % 2 = 0 THEN 'a' ELSE 'b' END AS branch,
  CASE WHEN o_custkey % 2 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
    ELSE concat(CAST(day(o_orderdate) AS STRING), '/', CAST(month(o_orderdate) AS STRING), '/', CAST(year(o_orderdate) AS STRING))
  END AS released,
  o_totalprice AS principal,
  CASE o_orderstatus WHEN 'F' THEN 'Fully Paid' WHEN 'O' THEN 'Open'
    ELSE CASE o_orderkey % 3 WHEN 0 THEN 'Denied' WHEN 1 THEN 'Not Taken Up' ELSE 'Processing' END END AS status,
  o_orderpriority AS product
FROM {orders}
"""

# The repayment side repeats the branch of its loan by the same parity rule on the order key, so that
# both text formats occur there too.
RAW_REPAYMENTS = """
SELECT l_orderkey AS loan_id, CASE WHEN l_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS branch,
  CASE WHEN l_orderkey % 2 = 0 THEN CAST(CAST(l_shipdate AS DATE) AS STRING)
    ELSE concat(CAST(day(l_shipdate) AS STRING), '/', CAST(month(l_shipdate) AS STRING), '/', CAST(year(l_shipdate) AS STRING))
  END AS collected,
  l_extendedprice AS amount
FROM {lineitem}
"""

APPLICATIONS = """
SELECT o_orderkey AS application_id, o_custkey AS borrower_id,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS request_date,
  CAST(DATE '1950-01-01' + CAST((o_custkey * 37) % 15000 AS INT) AS DATE) AS dob,
  CASE WHEN o_custkey % 2 = 0 THEN 'Male' ELSE 'FEMALE' END AS gender,
  CAST((o_orderkey * 13) % 400 AS DOUBLE) AS account_age_days,
  CAST((o_orderkey * 7) % 11 AS DOUBLE) AS count_nsf_90_days,
  CAST((o_orderkey * 5) % 8 AS DOUBLE) AS count_nsf_30_days,
  CAST((o_orderkey * 3) % 7 AS DOUBLE) AS count_stop_payment_90_days,
  CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE CAST((o_orderkey * 31) % 12000 - 7000 AS DOUBLE) END AS balance_min,
  o_totalprice AS principal,
  CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE o_totalprice + CAST((o_orderkey * 17) % 400 AS DOUBLE) - 150 END AS total_paid
FROM {orders}
"""

REQUESTS = """
SELECT DISTINCT user_id AS request_id,
  CAST(DATE '2024-01-31' - CAST(user_id % 10 AS INT) AS DATE) AS request_date
FROM {events}
"""

TRANSACTIONS = """
SELECT event_id AS trx_id, user_id AS request_id, CAST(ts AS DATE) AS trx_date, value AS amount,
  CASE event_id % 12 WHEN 0 THEN 'NSF return Service Charge' WHEN 1 THEN 'RTN FUNDS HELD'
    WHEN 2 THEN 'stop  payment fee' WHEN 3 THEN 'PAP Return' WHEN 4 THEN 'Bingham Law'
    WHEN 5 THEN 'Internet Banking CORRECTION' WHEN 6 THEN 'reversal' WHEN 7 THEN 'EFFET REFUSÉ SANS PROVISION'
    ELSE event_type END AS description
FROM {events}
"""

SCORED = """
SELECT l_orderkey AS loan_id, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
  CAST((l_orderkey * 7919 + l_partkey * 104729 + l_suppkey * 31) % 10007 AS DOUBLE) / 10007 AS p,
  l_extendedprice - 30000 AS profit
FROM {lineitem}
"""

# Two model scores per application, so that decisions can be checked without a fitted model.
APPLICATION_SCORES = """
SELECT o_orderkey AS application_id,
  CAST((o_orderkey * 7919 + o_custkey * 31) % 10007 AS DOUBLE) / 10007 AS refusal_score,
  CAST((o_orderkey * 104729 + o_custkey * 17) % 9973 AS DOUBLE) / 9973 AS default_score
FROM {orders}
"""

THRESHOLD_RECORDS = """
SELECT event_id AS record_id, ts AS created_at,
  CAST(CAST(json_k AS INT) % 19 * 5 + 5 AS DOUBLE) / 100 AS refusal_threshold,
  CAST((CAST(json_k AS INT) * 7) % 19 * 5 + 5 AS DOUBLE) / 100 AS default_threshold
FROM (SELECT event_id, ts, event_id * 31 % 100 AS json_k FROM {events}) e
"""

# One trial run per order, one trial per line item; repeated (run, time) pairs occur.
TRIALS = """
SELECT l_orderkey AS run_id, l_linenumber AS record_id,
  CAST(l_quantity * 10 + l_linenumber AS DOUBLE) AS wall_clock_time,
  CAST((l_partkey * 7 + l_suppkey * 13) % 1000 AS DOUBLE) / 1000 AS validation_loss
FROM {lineitem}
"""

# The attributes of one application, all double, in the order of the request.
ATTRIBUTES = [
    "sum_micro_loan_payments_current_month", "sum_micro_loan_payments_previous_month",
    "sum_micro_loan_payments_2_months_ago", "recurring_deposits_current_month",
    "recurring_deposits_previous_month", "recurring_deposits_2_months_ago", "count_active_days",
    "sum_total_income_current_month", "sum_total_income_previous_month", "sum_total_income_2_months_ago",
    "sum_loan_payments_current_month", "sum_loan_payments_previous_month", "sum_loan_payments_2_months_ago",
    "sum_loan_deposits_30_days", "sum_loan_deposits_60_days", "sum_loan_deposits_90_days",
    "sum_government_income_current_month", "sum_government_income_previous_month",
    "sum_government_income_2_months_ago", "sum_employment_insurance_income_current_month",
    "sum_employment_insurance_income_previous_month", "sum_employment_insurance_income_2_months_ago",
    "sum_employer_income_current_month", "sum_employer_income_previous_month",
    "sum_employer_income_2_months_ago", "sum_disability_income_current_month",
    "sum_disability_income_previous_month", "sum_disability_income_2_months_ago",
    "average_monthly_recurring_transfers_out_complex",
    "average_closing_balance_day_after_employer_income", "average_closing_balance_day_of_employer_income",
    "balance_90_days_ago", "balance_current", "count_loan_payments_current_month",
    "count_loan_payments_previous_month", "count_distinct_micro_lenders",
    "count_days_negative_balance_90_days", "sum_non_employer_income_current_month",
    "sum_non_employer_income_previous_month", "sum_non_employer_income_2_months_ago",
    "sum_non_employer_income", "average_closing_balance_day_of_income",
    "average_monthly_micro_loan_payments_complex", "average_monthly_utility_payments_complex",
    "telecom_payments_average", "other_loan_payments_average", "utility_payments_average",
    "average_closing_balance_day_after_income", "average_micro_loan_payment",
    "average_monthly_free_cash_flow", "average_monthly_nsf_fees_count",
    "average_monthly_recurring_transfers_in_complex", "average_employer_income_deposit",
]


def _whole_number(name: str) -> str:
    i = ATTRIBUTES.index(name)
    modulus = 12 + i % 7 if name.startswith("count_") else 997 + 10 * i
    return f"CAST((o_orderkey * {7 + 2 * i} + o_custkey * {3 + i}) % {modulus} AS DOUBLE)"


def _attribute_sql() -> str:
    """Whole-number attributes by modular arithmetic; every seventh has nulls, counts stay small."""
    parts = []
    for i, name in enumerate(ATTRIBUTES):
        value = _whole_number(name)
        if i % 7 == 3:
            value = f"CASE WHEN o_orderkey % {61 + i} = 0 THEN NULL ELSE {value} END"
        parts.append(f"{value} AS {name}")
    return ",\n  ".join(parts)


# Applications with every attribute. The outcome follows balance_current and the NSF counts, so that a
# model has something to learn.
PROFILES = (
    """
SELECT o_orderkey AS application_id, o_orderkey AS Id,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS request_date,
  CASE WHEN o_orderkey % 101 = 0 THEN 'unknown'
    ELSE CAST(CAST(DATE '1950-01-01' + CAST((o_custkey * 37) % 15000 AS INT) AS DATE) AS STRING) END AS dob,
  CASE WHEN o_custkey % 2 = 0 THEN 'Male' ELSE 'FEMALE' END AS gender,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Weekly' WHEN '2-HIGH' THEN 'BiWeekly' WHEN '3-MEDIUM' THEN 'Monthly'
    WHEN '4-NOT SPECIFIED' THEN 'TwiceAMonth' ELSE NULL END AS employer_income_frequency,
  CAST((o_orderkey * 13) % 400 AS DOUBLE) AS account_age_days,
  CAST((o_orderkey * 7) % 11 AS DOUBLE) AS count_nsf_90_days,
  CAST((o_orderkey * 5) % 8 AS DOUBLE) AS count_nsf_30_days,
  CAST((o_orderkey * 3) % 7 AS DOUBLE) AS count_stop_payment_90_days,
  CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE CAST((o_orderkey * 31) % 12000 - 7000 AS DOUBLE) END AS balance_min,
  CASE WHEN o_orderkey % 103 = 0 THEN 'timeout' ELSE NULL END AS error,
  o_totalprice AS principal,
  CASE WHEN o_orderkey % 83 = 0 THEN NULL
    ELSE o_totalprice + """
    + _whole_number("balance_current")
    + """ / 4 - CAST((o_orderkey * 7) % 11 AS DOUBLE) * 12 - CAST((o_orderkey * 11) % 60 AS DOUBLE) END AS total_paid,
  """
    + _attribute_sql()
    + """
FROM {orders}
"""
)

TEXTS: dict[str, str] = {
    "loans": LOANS,
    "repayments": REPAYMENTS,
    "raw_loans": RAW_LOANS,
    "raw_repayments": RAW_REPAYMENTS,
    "applications": APPLICATIONS,
    "requests": REQUESTS,
    "transactions": TRANSACTIONS,
    "scored": SCORED,
    "application_scores": APPLICATION_SCORES,
    "threshold_records": THRESHOLD_RECORDS,
    "trials": TRIALS,
    "profiles": PROFILES,
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The derived table as a lazy DataFrame over the parquet scan."""
    compiled(spark)  # views of many columns are long methods
    text = TEXTS[name]
    return spark.sql(text, **{base: table(spark, sf_dir, base) for base in set(_PLACEHOLDER.findall(text))})


def with_views(sql: str, names: list[str]) -> str:
    """``sql`` with the named views put before it as common table expressions."""
    if not names:
        return sql
    ctes = ",\n".join(f"{name} AS ({_PLACEHOLDER.sub(lambda m: m.group(1), TEXTS[name])})" for name in names)
    body = sql.strip()
    for opening in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(opening):
            return f"{opening}{ctes},\n{body[len(opening):]}"
    return f"WITH {ctes}\n{body}"
