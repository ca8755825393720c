"""Registered queries: projections, filters and table assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from loanloom.operators import cleaning, joins, splits
from loanloom.plans import training
from loanloom.plans.registry import query
from loanloom.sources import readers, validation
from loanloom.sources.feature_spec import DEFAULT_SPEC, REFUSAL_SPEC
from loanloom.sources.views import table, view

AGE_SQL = "CAST(datesub('year', TRY_CAST(dob AS DATE), TRY_CAST(request_date AS DATE)) AS INT) AS age"


def _profiles(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "profiles")


def _applications(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "applications")


@query(
    "p1_keep_known",
    "SELECT " + ", ".join(
        c for c in DEFAULT_SPEC.variables if c != "status"
    ) + " FROM profiles",
    over="profiles",
)
def p1_keep_known(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.keep_known(_profiles(spark, sf), DEFAULT_SPEC)


@query("p2_rename", "SELECT loan_id AS Id, release_date AS released, principal AS principal_amount FROM loans", over="loans")
def p2_rename(spark: SparkSession, sf: str) -> DataFrame:
    loans = view(spark, sf, "loans").select("loan_id", "release_date", "principal")
    return cleaning.rename(loans, {"loan_id": "Id", "release_date": "released", "principal": "principal_amount"})


@query("p3_tag", "SELECT application_id, 1 AS refused, 'a' AS source FROM applications", over="applications")
def p3_tag(spark: SparkSession, sf: str) -> DataFrame:
    df = _applications(spark, sf).select("application_id")
    return cleaning.tag(cleaning.tag(df, "refused", 1), "source", "a")


@query(
    "p4_harmonise",
    "SELECT application_id, CAST(borrower_id AS VARCHAR) AS Id, lower(gender) AS gender FROM applications",
    over="applications",
)
def p4_harmonise(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.harmonise(_applications(spark, sf), "borrower_id").select("application_id", "Id", "gender")


@query(
    "p5_rolling_sums",
    """SELECT application_id,
  recurring_deposits_current_month + recurring_deposits_previous_month + recurring_deposits_2_months_ago AS recurring_deposits_90_days,
  sum_micro_loan_payments_current_month + sum_micro_loan_payments_previous_month AS sum_micro_loans_60_days FROM profiles""",
    over="profiles",
)
def p5_rolling_sums(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.rolling_sums(_profiles(spark, sf)).select(
        "application_id", "recurring_deposits_90_days", "sum_micro_loans_60_days"
    )


@query("p6_profit", "SELECT application_id, round(total_paid - principal, 2) AS profit FROM applications", over="applications")
def p6_profit(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.with_profit(_applications(spark, sf)).select("application_id", F.round("profit", 2).alias("profit"))


@query(
    "p7_default_label",
    "SELECT application_id, CASE WHEN total_paid - principal < 50 THEN 1 ELSE 0 END AS status FROM applications",
    over="applications",
)
def p7_default_label(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.with_default_label(cleaning.with_profit(_applications(spark, sf))).select("application_id", "status")


@query(
    "p8_month_key",
    """SELECT application_id, strftime(request_date, '%Y-%m') AS request_month_key,
  CAST(year(request_date) AS INT) AS request_year, CAST(month(request_date) AS INT) AS request_month FROM applications""",
    over="applications",
)
def p8_month_key(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.with_month_key(_applications(spark, sf)).select(
        "application_id", "request_month_key", "request_year", "request_month"
    )


@query(
    "p9_flag_in",
    """SELECT application_id, coalesce(strftime(request_date, '%Y-%m') IN ('1997-04'), false) AS validation_flag,
  coalesce(strftime(request_date, '%Y-%m') IN ('1997-05'), false) AS test_flag FROM applications""",
    over="applications",
)
def p9_flag_in(spark: SparkSession, sf: str) -> DataFrame:
    df = cleaning.with_month_key(_applications(spark, sf))
    df = cleaning.flag_in(df, "request_month_key", ["1997-04"], "validation_flag")
    df = cleaning.flag_in(df, "request_month_key", ["1997-05"], "test_flag")
    return df.select("application_id", "validation_flag", "test_flag")


@query(
    "p10_recency_weight",
    """SELECT application_id, CASE WHEN year(request_date) = 1997 THEN round(month(request_date) / 12.0, 10) ELSE 1.0 END::DOUBLE AS weight
FROM applications""",
    over="applications",
)
def p10_recency_weight(spark: SparkSession, sf: str) -> DataFrame:
    df = cleaning.with_month_key(_applications(spark, sf))
    return cleaning.with_recency_weight(df, ramp_year=1997).select("application_id", F.round("weight", 10).alias("weight"))


@query("p11_age", f"SELECT application_id, {AGE_SQL} FROM profiles", over="profiles")
def p11_age(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.with_age(_profiles(spark, sf)).select("application_id", "age")


@query(
    "p12_non_classified_income",
    "SELECT application_id, " + ", ".join(
        f"sum_non_employer_income_{m} - sum_government_income_{m} AS non_classified_income_{m}" for m in cleaning.MONTHS
    ) + " FROM profiles",
    over="profiles",
)
def p12_non_classified_income(spark: SparkSession, sf: str) -> DataFrame:
    df = cleaning.with_non_classified_income(_profiles(spark, sf))
    return df.select("application_id", *[f"non_classified_income_{m}" for m in cleaning.MONTHS])


@query(
    "p13_repayment_capacity",
    "SELECT application_id, round(sum_employer_income_current_month - sum_loan_deposits_90_days / 3.0, 8) AS monthly_repayment_capacity FROM profiles",
    over="profiles",
)
def p13_repayment_capacity(spark: SparkSession, sf: str) -> DataFrame:
    df = cleaning.with_repayment_capacity(_profiles(spark, sf))
    return df.select("application_id", F.round("monthly_repayment_capacity", 8).alias("monthly_repayment_capacity"))


@query(
    "p14_income_minus_microloan",
    "SELECT application_id, average_employer_income_deposit - average_micro_loan_payment AS avg_employer_income_minus_microloan_payment FROM profiles",
    over="profiles",
)
def p14_income_minus_microloan(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.with_income_minus_microloan(_profiles(spark, sf)).select(
        "application_id", "avg_employer_income_minus_microloan_payment"
    )


ENGINEERED_SQL = (
    f"{AGE_SQL}, "
    + ", ".join(f"sum_non_employer_income_{m} - sum_government_income_{m} AS non_classified_income_{m}" for m in cleaning.MONTHS)
    + ", round(sum_employer_income_current_month - sum_loan_deposits_90_days / 3.0, 8) AS monthly_repayment_capacity"
)


@query(
    "p15_features_default",
    "SELECT application_id, " + ", ".join([*DEFAULT_SPEC.categorical, *DEFAULT_SPEC.numeric]) + f", {ENGINEERED_SQL}, "
    "average_employer_income_deposit - average_micro_loan_payment AS avg_employer_income_minus_microloan_payment FROM profiles",
    over="profiles",
)
def p15_features_default(spark: SparkSession, sf: str) -> DataFrame:
    df = cleaning.feature_engineer(_profiles(spark, sf), DEFAULT_SPEC, cleaning.MODEL_STEPS["default"], ["application_id"])
    return df.withColumn("monthly_repayment_capacity", F.round("monthly_repayment_capacity", 8))


@query(
    "p15_features_refusal",
    "SELECT application_id, " + ", ".join(REFUSAL_SPEC.numeric) + f", {ENGINEERED_SQL} FROM profiles",
    over="profiles",
)
def p15_features_refusal(spark: SparkSession, sf: str) -> DataFrame:
    df = cleaning.feature_engineer(_profiles(spark, sf), REFUSAL_SPEC, cleaning.MODEL_STEPS["refusal"], ["application_id"])
    return df.withColumn("monthly_repayment_capacity", F.round("monthly_repayment_capacity", 8))


@query(
    "p20_strip_punctuation",
    r"SELECT doc_id, regexp_replace(text, '[!-/:-@\[-`{-~]', '', 'g') AS text FROM documents",
)
def p20_strip_punctuation(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.strip_punctuation(table(spark, sf, "documents").select("doc_id", "text"), "text")


@query(
    "p21_fill_missing",
    """SELECT application_id, coalesce(balance_min, -1) AS balance_min, coalesce(total_paid, -1) AS total_paid FROM applications""",
    over="applications",
)
def p21_fill_missing(spark: SparkSession, sf: str) -> DataFrame:
    df = _applications(spark, sf).select("application_id", "balance_min", "total_paid")
    return cleaning.fill_missing(df, -1, ["balance_min", "total_paid"])


@query(
    "p22_encode_categories",
    """SELECT application_id, gender_code AS gender, freq_code AS employer_income_frequency FROM (
SELECT application_id, CAST(dense_rank() OVER (ORDER BY gender) - 1 AS INT) AS gender_code,
  CASE WHEN employer_income_frequency IS NULL THEN -1 ELSE CAST(dense_rank() OVER (ORDER BY employer_income_frequency NULLS LAST) - 1 AS INT) END AS freq_code
FROM profiles) q""",
    over="profiles",
)
def p22_encode_categories(spark: SparkSession, sf: str) -> DataFrame:
    df = _profiles(spark, sf).select("application_id", "gender", "employer_income_frequency")
    return cleaning.encode_categories(df)


@query("p23_drop_unusable", "SELECT gender, employer_income_frequency, account_age_days, error FROM profiles", over="profiles")
def p23_drop_unusable(spark: SparkSession, sf: str) -> DataFrame:
    df = _profiles(spark, sf).select(
        "application_id", "gender", "dob", "request_date", "employer_income_frequency", "account_age_days", "error"
    )
    return cleaning.drop_unusable(df, ["application_id"])


@query(
    "p24_common_columns",
    """SELECT application_id, request_date, dob, gender, account_age_days, count_nsf_90_days, count_nsf_30_days,
  count_stop_payment_90_days, balance_min, principal, total_paid FROM profiles""",
    over="profiles",
)
def p24_common_columns(spark: SparkSession, sf: str) -> DataFrame:
    profiles = _profiles(spark, sf)
    shared, _, _ = cleaning.common_columns(profiles, _applications(spark, sf))
    return profiles.select(shared)


@query(
    "p25_select_like",
    "SELECT count_nsf_90_days, count_nsf_30_days, count_stop_payment_90_days, count_active_days FROM profiles",
    over="profiles",
)
def p25_select_like(spark: SparkSession, sf: str) -> DataFrame:
    exclude = [
        "count_loan_payments_current_month", "count_loan_payments_previous_month", "count_distinct_micro_lenders",
        "count_days_negative_balance_90_days",
    ]
    return cleaning.select_like(_profiles(spark, sf), "count_", exclude)


@query(
    "f1_filter_thresholds",
    "SELECT application_id, balance_min FROM applications WHERE balance_min IS NULL OR balance_min >= -5000",
    over="applications",
)
def f1_filter_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.filter_thresholds(_applications(spark, sf), DEFAULT_SPEC).select("application_id", "balance_min")


@query(
    "f2_filter_quality",
    "SELECT application_id FROM profiles WHERE error IS NULL AND Id IS NOT NULL AND request_date IS NOT NULL AND account_age_days > 0",
    over="profiles",
)
def f2_filter_quality(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.filter_quality(_profiles(spark, sf)).select("application_id")


@query(
    "f3_filter_audit",
    """SELECT CASE WHEN NOT (balance_min IS NULL OR balance_min >= -5000) THEN 'balance_min below minimum'
  WHEN error IS NOT NULL THEN 'error present' WHEN Id IS NULL THEN 'Id missing' WHEN request_date IS NULL THEN 'request_date missing'
  WHEN NOT account_age_days > 0 THEN 'account_age_days not positive' ELSE 'kept' END AS rule, count(*) AS row_count
FROM profiles GROUP BY rule""",
    over="profiles",
)
def f3_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    df = _profiles(spark, sf)
    return cleaning.filter_audit(df, [*cleaning.threshold_rules(df, DEFAULT_SPEC), *cleaning.quality_rules(df)])


@query(
    "f4_prescreen",
    """SELECT application_id FROM applications WHERE account_age_days >= 85 AND count_nsf_90_days <= 8
  AND count_nsf_30_days <= 6 AND count_stop_payment_90_days <= 4""",
    over="applications",
)
def f4_prescreen(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.prescreen(_applications(spark, sf)).select("application_id")


@query(
    "f5_auto_refuse_basic",
    """SELECT application_id, account_age_days < 85 OR count_nsf_90_days > 8 OR count_nsf_30_days > 6 OR count_stop_payment_90_days > 4 AS auto_refuse_basic
FROM applications""",
    over="applications",
)
def f5_auto_refuse_basic(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.with_auto_refuse_basic(_applications(spark, sf)).select("application_id", "auto_refuse_basic")


@query(
    "f7_for_month",
    "SELECT application_id, request_date FROM applications WHERE strftime(request_date, '%Y-%m') = '1997-04'",
    over="applications",
)
def f7_for_month(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.for_month(_applications(spark, sf), "1997-04").select("application_id", "request_date")


@query(
    "f8_drop_missing",
    f"SELECT * FROM (SELECT application_id, {AGE_SQL} FROM profiles) q WHERE age IS NOT NULL",
    over="profiles",
)
def f8_drop_missing(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.drop_missing(cleaning.with_age(_profiles(spark, sf)), ["age"]).select("application_id", "age")


PROPS = T.StructType([T.StructField("k", T.IntegerType())])


@query(
    "s4_expand_json",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
)
def s4_expand_json(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "props")
    return readers.expand_json(events, "props", PROPS)


RAW_REQUEST_SQL = """SELECT application_id,
  CASE WHEN application_id % 53 = 0 THEN 'other' WHEN application_id % 59 = 0 THEN NULL ELSE lower(gender) END AS gender,
  dob, request_date,
  CASE WHEN application_id % 47 = 0 THEN 'abc' ELSE CAST(CAST(account_age_days AS INT) AS STRING) END AS account_age_days,
  CASE WHEN application_id % 43 = 0 THEN '2.5' ELSE CAST(CAST(count_distinct_micro_lenders AS INT) AS STRING) END AS count_distinct_micro_lenders
FROM {profiles}"""


@query(
    "s15_validate_applications",
    f"""WITH raw AS ({RAW_REQUEST_SQL.format(profiles="profiles")}),
checked AS (SELECT application_id,
  CASE WHEN gender IS NULL THEN 'gender: missing' WHEN gender NOT IN ('male', 'female') THEN 'gender: not allowed' END AS e1,
  CASE WHEN dob IS NULL THEN 'dob: missing' WHEN TRY_CAST(dob AS DATE) IS NULL THEN 'dob: not a date' END AS e2,
  CASE WHEN request_date IS NULL THEN 'request_date: missing' WHEN TRY_CAST(request_date AS DATE) IS NULL THEN 'request_date: not a date' END AS e3,
  CASE WHEN account_age_days IS NULL THEN 'account_age_days: missing' WHEN TRY_CAST(account_age_days AS DOUBLE) IS NULL THEN 'account_age_days: not a number' END AS e4,
  CASE WHEN count_distinct_micro_lenders IS NULL THEN 'count_distinct_micro_lenders: missing'
    WHEN NOT regexp_full_match(count_distinct_micro_lenders, '-?[0-9]+') THEN 'count_distinct_micro_lenders: not an integer' END AS e5 FROM raw)
SELECT application_id, concat_ws('; ', e1, e2, e3, e4, e5) AS errors,
  e1 IS NULL AND e2 IS NULL AND e3 IS NULL AND e4 IS NULL AND e5 IS NULL AS valid FROM checked""",
    over="profiles",
)
def s15_validate_applications(spark: SparkSession, sf: str) -> DataFrame:
    raw = spark.sql(RAW_REQUEST_SQL, profiles=_profiles(spark, sf))
    checked = validation.with_errors(raw, validation.REQUEST_RULES, only=raw.columns)
    return checked.select("application_id", F.array_join("errors", "; ").alias("errors"), (F.size("errors") == 0).alias("valid"))


@query(
    "j1_join_one_to_one",
    "SELECT a.application_id, a.request_date, l.release_date, l.principal FROM applications a JOIN loans l ON a.application_id = l.loan_id",
    over="applications loans",
)
def j1_join_one_to_one(spark: SparkSession, sf: str) -> DataFrame:
    loans = view(spark, sf, "loans").select(F.col("loan_id").alias("application_id"), "release_date", "principal")
    return joins.join_one_to_one(_applications(spark, sf).select("application_id", "request_date"), loans, ["application_id"])


@query(
    "j7_keep_scored",
    "SELECT loan_id, principal FROM loans WHERE loan_id IN (SELECT loan_id FROM scored WHERE p >= 0.9)",
    over="loans scored",
)
def j7_keep_scored(spark: SparkSession, sf: str) -> DataFrame:
    scored = view(spark, sf, "scored").filter(F.col("p") >= 0.9)
    return joins.keep_scored(view(spark, sf, "loans").select("loan_id", "principal"), scored, ["loan_id"])


@query(
    "j8_lost_rows",
    "SELECT loan_id, principal FROM loans WHERE loan_id NOT IN (SELECT loan_id FROM repayments)",
    over="loans repayments",
)
def j8_lost_rows(spark: SparkSession, sf: str) -> DataFrame:
    return joins.lost_rows(view(spark, sf, "loans").select("loan_id", "principal"), view(spark, sf, "repayments"), ["loan_id"])


@query(
    "j11_null_safe_join",
    """WITH days AS (SELECT request_date, count(*) AS same_day FROM applications GROUP BY request_date)
SELECT application_id, a.request_date, same_day FROM applications a JOIN days d ON a.request_date IS NOT DISTINCT FROM d.request_date""",
    over="applications",
)
def j11_null_safe_join(spark: SparkSession, sf: str) -> DataFrame:
    apps = _applications(spark, sf).select("application_id", "request_date")
    days = apps.groupBy("request_date").agg(F.count(F.lit(1)).alias("same_day"))
    return joins.null_safe_join(apps, days, ["request_date"])


@query(
    "u1_union_tables",
    """SELECT application_id, principal, balance_min, NULL::VARCHAR AS status FROM applications
UNION ALL SELECT loan_id, principal, NULL, status FROM loans""",
    over="applications loans",
)
def u1_union_tables(spark: SparkSession, sf: str) -> DataFrame:
    loans = view(spark, sf, "loans").select(F.col("loan_id").alias("application_id"), "principal", "status")
    return joins.union_tables(_applications(spark, sf).select("application_id", "principal", "balance_min"), loans)


@query("u2_dedupe", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def u2_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    return joins.dedupe(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


@query("u3_reassemble", "SELECT application_id, principal FROM applications", over="applications")
def u3_reassemble(spark: SparkSession, sf: str) -> DataFrame:
    df = _applications(spark, sf).select("application_id", "principal")
    split = splits.split_random(df, 0.15, "application_id", seed=7)
    parts = [split.filter(F.col("split") == s).drop("split") for s in ("train", "test")]
    return joins.reassemble(parts, expected=df)


@query(
    "u4_monthly_training",
    """WITH a AS (SELECT DISTINCT application_id, request_date, gender, balance_min FROM (SELECT * FROM applications UNION ALL SELECT * FROM applications) q
  WHERE strftime(request_date, '%Y-%m') = '1997-04'),
o AS (SELECT l.loan_id, l.release_date, l.principal, p.paid AS total_paid, l.status FROM loans l
  JOIN (SELECT loan_id, round(sum(amount), 2) AS paid FROM repayments GROUP BY loan_id) p ON l.loan_id = p.loan_id)
SELECT a.application_id, request_date, gender, balance_min, release_date, principal, total_paid, status AS loan_status,
  round(total_paid - principal, 2) AS profit FROM a JOIN o ON a.application_id = o.loan_id""",
    over="applications loans repayments",
)
def u4_monthly_training(spark: SparkSession, sf: str) -> DataFrame:
    apps = _applications(spark, sf).select("application_id", "request_date", "gender", "balance_min")
    paid = view(spark, sf, "repayments").groupBy("loan_id").agg(F.round(F.sum("amount"), 2).alias("Paid Amount"))
    outcomes = view(spark, sf, "loans").join(paid, "loan_id").select(
        F.col("loan_id").alias("Loan Id"), F.col("release_date").alias("Released Date"),
        F.col("principal").alias("Principal Amount"), "Paid Amount", F.col("status").alias("Loan Status Name"),
    )
    names = {**training.OUTCOME_NAMES, "Loan Id": "application_id"}
    result = training.build_monthly_training(apps.unionByName(apps), outcomes, "1997-04", "application_id", names)
    return result.withColumn("profit", F.round("profit", 2))


@query(
    "u5_refusal_training",
    """SELECT application_id, Id, gender, balance_min, 0 AS refused, NULL::DOUBLE AS recurring_deposits_90_days FROM
  (SELECT application_id, CAST(application_id AS VARCHAR) AS Id, lower(gender) AS gender, balance_min, account_age_days, request_date, error FROM profiles WHERE Id % 2 = 0) a
WHERE (balance_min IS NULL OR balance_min >= -5000) AND error IS NULL AND request_date IS NOT NULL AND account_age_days > 0
UNION ALL
SELECT application_id, CAST(application_id AS VARCHAR), lower(gender), balance_min, 1,
  recurring_deposits_current_month + recurring_deposits_previous_month + recurring_deposits_2_months_ago FROM profiles
WHERE Id % 2 = 1 AND account_age_days >= 85 AND count_nsf_90_days <= 8 AND count_nsf_30_days <= 6 AND count_stop_payment_90_days <= 4""",
    over="profiles",
)
def u5_refusal_training(spark: SparkSession, sf: str) -> DataFrame:
    df = _profiles(spark, sf)
    accepted, refused = df.filter(F.col("Id") % 2 == 0), df.filter(F.col("Id") % 2 == 1)
    result = training.build_refusal_training(accepted, refused, DEFAULT_SPEC, "application_id", "application_id")
    return result.select("application_id", "Id", "gender", "balance_min", "refused", "recurring_deposits_90_days")


@query("l1_sort", "SELECT loan_id, release_date, principal FROM loans ORDER BY release_date, principal DESC, loan_id", over="loans")
def l1_sort(spark: SparkSession, sf: str) -> DataFrame:
    df = view(spark, sf, "loans").select("loan_id", "release_date", "principal")
    return df.orderBy("release_date", F.desc("principal"), "loan_id")


@query(
    "l4_sample_by_status",
    None,
)
def l4_sample_by_status(spark: SparkSession, sf: str) -> DataFrame:
    sample = cleaning.sample_by_status(view(spark, sf, "loans"), "status", "loan_id", n=1, seed=11)
    return cleaning.fill_missing(sample, -1, ["principal", "total_due"])
