"""Registered queries: vintage analysis and returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loanloom.operators import cleaning, cohorts, joins
from loanloom.plans import products, vintage
from loanloom.plans.registry import query
from loanloom.session import shared_dir
from loanloom.sources.views import view

AGED_SQL = """aged AS (
  SELECT l.loan_id, l.branch, l.principal, l.release_date, r.collection_date, r.amount,
    CAST(year(l.release_date) AS INT) AS release_year, CAST(month(l.release_date) AS INT) AS release_month,
    CAST(year(r.collection_date) AS INT) AS collection_year, CAST(month(r.collection_date) AS INT) AS collection_month,
    CAST(floor(datediff('day', l.release_date, r.collection_date) / 7.0) AS INT) AS weeks_since_release
  FROM loans l JOIN repayments r ON l.loan_id = r.loan_id WHERE l.status NOT IN ('Not Taken Up', 'Denied'))"""


def _loans(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "loans")


def _repayments(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "repayments")


def _aged(spark: SparkSession, sf: str) -> DataFrame:
    return vintage.aged_repayments(_loans(spark, sf), _repayments(spark, sf))


def money(column: str, digits: int = 2):
    return F.round(F.col(column), digits).alias(column)


@query(
    "w2_normalised_curve",
    f"""WITH {AGED_SQL},
weekly AS (SELECT release_year, weeks_since_release, sum(amount) AS amount FROM aged
  WHERE weeks_since_release >= 0 GROUP BY ALL),
running AS (SELECT *, sum(amount) OVER w AS cumul FROM weekly
  WINDOW w AS (PARTITION BY release_year ORDER BY weeks_since_release ROWS UNBOUNDED PRECEDING))
SELECT release_year, weeks_since_release, round(amount, 2) AS amount, round(cumul, 2) AS cumul_cashflow,
  round(cumul / nullif(abs(first_value(cumul) OVER (PARTITION BY release_year ORDER BY weeks_since_release)), 0) * 1000000, 1) AS cumul_normalised
FROM running""",
    over="loans repayments",
)
def w2_normalised_curve(spark: SparkSession, sf: str) -> DataFrame:
    cohort = ["release_year"]
    weekly = cohorts.weekly_cashflows(_aged(spark, sf), cohort)
    return vintage.cashflow_curve(weekly, cohort).select(
        "release_year", "weeks_since_release", money("amount"), money("cumul_cashflow"), money("cumul_normalised", 1)
    )


@query(
    "w1_cumulative_cashflow",
    f"""WITH {AGED_SQL},
weekly AS (SELECT branch, release_year, release_month, weeks_since_release, sum(amount) AS amount FROM aged
  WHERE weeks_since_release >= 0 GROUP BY ALL)
SELECT branch, release_year, release_month, weeks_since_release, round(amount, 2) AS amount,
  round(sum(amount) OVER (PARTITION BY branch, release_year, release_month ORDER BY weeks_since_release ROWS UNBOUNDED PRECEDING), 2) AS cumul_cashflow
FROM weekly""",
    over="loans repayments",
)
def w1_cumulative_cashflow(spark: SparkSession, sf: str) -> DataFrame:
    cohort = ["branch", "release_year", "release_month"]
    curve = cohorts.cumulative_cashflow(cohorts.weekly_cashflows(_aged(spark, sf), cohort), cohort)
    return curve.select(*cohort, "weeks_since_release", money("amount"), money("cumul_cashflow"))


@query(
    "w3_principal_collected_pct",
    f"""WITH {AGED_SQL},
weekly AS (SELECT branch, weeks_since_release, sum(amount) AS amount FROM aged WHERE weeks_since_release >= 0 GROUP BY ALL),
totals AS (SELECT branch, sum(principal) AS principal FROM loans WHERE status NOT IN ('Not Taken Up', 'Denied') GROUP BY branch)
SELECT branch, weeks_since_release, round(sum(amount) OVER (PARTITION BY branch ORDER BY weeks_since_release ROWS UNBOUNDED PRECEDING) / principal, 8) AS principal_collected_pct
FROM weekly JOIN totals USING (branch)""",
    over="loans repayments",
)
def w3_principal_collected_pct(spark: SparkSession, sf: str) -> DataFrame:
    weekly = cohorts.weekly_cashflows(_aged(spark, sf), ["branch"])
    totals = cohorts.disbursed_by(cohorts.disbursed(_loans(spark, sf)), ["branch"])
    report = cohorts.principal_collected_pct(weekly, totals, ["branch"])
    return report.select("branch", "weeks_since_release", money("principal_collected_pct", 8))


@query(
    "p16_quarter",
    """SELECT loan_id, CASE WHEN month(release_date) <= 3 THEN 'Q1' WHEN month(release_date) <= 6 THEN 'Q2'
  WHEN month(release_date) <= 9 THEN 'Q3' ELSE 'Q4' END AS release_quarter FROM loans""",
    over="loans",
)
def p16_quarter(spark: SparkSession, sf: str) -> DataFrame:
    df = cohorts.with_date_parts(_loans(spark, sf), "release_date", "release")
    return cohorts.with_quarter(df, "release_month", "release_quarter").select("loan_id", "release_quarter")


@query("p17_parse_dates", "SELECT loan_id, branch, release_date FROM loans", over="loans")
def p17_parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    return vintage.with_branch_date(view(spark, sf, "raw_loans"), "released", "release_date").select(
        "loan_id", "branch", "release_date"
    )


@query(
    "p18_date_parts",
    """SELECT loan_id, CAST(year(release_date) AS INT) AS release_year, CAST(month(release_date) AS INT) AS release_month,
  CAST(day(release_date) AS INT) AS release_day FROM loans""",
    over="loans",
)
def p18_date_parts(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts.with_date_parts(_loans(spark, sf), "release_date", "release").select(
        "loan_id", "release_year", "release_month", "release_day"
    )


@query(
    "p19_loan_age",
    """SELECT r.loan_id, r.collection_date, r.amount, CAST(datediff('day', l.release_date, r.collection_date) AS INT) AS days_since_release,
  CAST(floor(datediff('day', l.release_date, r.collection_date) / 7.0) AS INT) AS weeks_since_release
FROM loans l JOIN repayments r ON l.loan_id = r.loan_id""",
    over="loans repayments",
)
def p19_loan_age(spark: SparkSession, sf: str) -> DataFrame:
    df = _repayments(spark, sf).join(_loans(spark, sf).select("loan_id", "release_date"), "loan_id")
    return cohorts.with_loan_age(df).select("loan_id", "collection_date", "amount", "days_since_release", "weeks_since_release")


@query("f6_disbursed", "SELECT loan_id, status FROM loans WHERE status IS NULL OR status NOT IN ('Not Taken Up', 'Denied')", over="loans")
def f6_disbursed(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts.disbursed(_loans(spark, sf)).select("loan_id", "status")


@query(
    "f9_week_window",
    f"WITH {AGED_SQL} SELECT loan_id, collection_date, amount, weeks_since_release FROM aged WHERE weeks_since_release BETWEEN 0 AND 60",
    over="loans repayments",
)
def f9_week_window(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts.week_window(_aged(spark, sf), 0, 60).select("loan_id", "collection_date", "amount", "weeks_since_release")


@query(
    "f10_comparable_cutoff",
    f"""WITH {AGED_SQL},
kept AS (SELECT * FROM aged WHERE weeks_since_release >= 0)
SELECT release_year, weeks_since_release, round(sum(amount), 2) AS amount FROM kept
WHERE weeks_since_release <= (SELECT max(weeks_since_release) FROM kept WHERE release_year = 2000) AND release_month <= 3
GROUP BY ALL""",
    over="loans repayments",
)
def f10_comparable_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    kept = cohorts.comparable_cutoff(cohorts.week_window(_aged(spark, sf), 0), "release_year", 2000)
    return cohorts.collected_by(kept, ["release_year", "weeks_since_release"]).select(
        "release_year", "weeks_since_release", money("amount")
    )


@query(
    "j2_loan_cashflows",
    """SELECT l.loan_id, l.branch, l.principal, r.collection_date, r.amount
FROM loans l LEFT JOIN repayments r ON l.loan_id = r.loan_id""",
    over="loans repayments",
)
def j2_loan_cashflows(spark: SparkSession, sf: str) -> DataFrame:
    loans = _loans(spark, sf).select("loan_id", "branch", "principal")
    return joins.loan_cashflows(loans, _repayments(spark, sf))


@query(
    "j3_repayments_with_loans",
    """SELECT r.loan_id, l.branch, l.status, r.collection_date, r.amount
FROM (SELECT * FROM loans WHERE status NOT IN ('Denied', 'Not Taken Up', 'Processing')) l
RIGHT JOIN repayments r ON l.loan_id = r.loan_id""",
    over="loans repayments",
)
def j3_repayments_with_loans(spark: SparkSession, sf: str) -> DataFrame:
    loans = cohorts.disbursed(_loans(spark, sf), cohorts.NOT_DISBURSED_OR_PENDING).select("loan_id", "branch", "status")
    return joins.repayments_with_loans(loans, _repayments(spark, sf))


MONTH = ["release_year", "release_month"]


@query(
    "j4_collected_vs_disbursed",
    f"""WITH {AGED_SQL},
c AS (SELECT release_year, release_month, collection_year, collection_month, sum(amount) AS amount FROM aged GROUP BY ALL),
d AS (SELECT CAST(year(release_date) AS INT) AS release_year, CAST(month(release_date) AS INT) AS release_month, sum(principal) AS principal
  FROM loans WHERE status NOT IN ('Not Taken Up', 'Denied') GROUP BY ALL)
SELECT release_year, release_month, collection_year, collection_month, round(amount, 2) AS amount, round(principal, 2) AS principal
FROM c LEFT JOIN d USING (release_year, release_month)""",
    over="loans repayments",
)
def j4_collected_vs_disbursed(spark: SparkSession, sf: str) -> DataFrame:
    collected = cohorts.collected_by(_aged(spark, sf), [*MONTH, "collection_year", "collection_month"])
    released = cohorts.with_date_parts(cohorts.disbursed(_loans(spark, sf)), "release_date", "release")
    joined = joins.collected_vs_disbursed(collected, cohorts.disbursed_by(released, MONTH), MONTH)
    return joined.select(*MONTH, "collection_year", "collection_month", money("amount"), money("principal"))


@query(
    "j5_curve_with_total",
    f"""WITH {AGED_SQL},
c AS (SELECT branch, weeks_since_release, sum(amount) AS amount FROM aged GROUP BY ALL),
d AS (SELECT branch, sum(principal) AS principal FROM loans WHERE status NOT IN ('Not Taken Up', 'Denied') GROUP BY branch)
SELECT branch, weeks_since_release, round(amount, 2) AS amount, round(principal, 2) AS principal FROM c JOIN d USING (branch)""",
    over="loans repayments",
)
def j5_curve_with_total(spark: SparkSession, sf: str) -> DataFrame:
    curve = cohorts.collected_by(_aged(spark, sf), ["branch", "weeks_since_release"])
    totals = cohorts.disbursed_by(cohorts.disbursed(_loans(spark, sf)), ["branch"])
    joined = joins.curve_with_total(curve, totals, ["branch"])
    return joined.select("branch", "weeks_since_release", money("amount"), money("principal"))


@query(
    "a1_disbursed_by",
    """SELECT CAST(year(release_date) AS INT) AS release_year, CAST(month(release_date) AS INT) AS release_month, round(sum(principal), 2) AS principal
FROM loans WHERE status NOT IN ('Not Taken Up', 'Denied') GROUP BY ALL""",
    over="loans",
)
def a1_disbursed_by(spark: SparkSession, sf: str) -> DataFrame:
    released = cohorts.with_date_parts(cohorts.disbursed(_loans(spark, sf)), "release_date", "release")
    return cohorts.disbursed_by(released, MONTH).select(*MONTH, money("principal"))


@query(
    "a2_collected_by",
    f"""WITH {AGED_SQL}
SELECT release_year, release_month, collection_year, collection_month, round(sum(amount), 2) AS amount FROM aged GROUP BY ALL""",
    over="loans repayments",
)
def a2_collected_by(spark: SparkSession, sf: str) -> DataFrame:
    keys = [*MONTH, "collection_year", "collection_month"]
    return cohorts.collected_by(_aged(spark, sf), keys).select(*keys, money("amount"))


@query(
    "a3_group_totals",
    """SELECT product, round(sum(principal), 2) AS principal, count(DISTINCT loan_id) AS loans FROM loans
WHERE status NOT IN ('Denied', 'Not Taken Up', 'Processing') GROUP BY product""",
    over="loans",
)
def a3_group_totals(spark: SparkSession, sf: str) -> DataFrame:
    loans = cohorts.disbursed(_loans(spark, sf), cohorts.NOT_DISBURSED_OR_PENDING)
    return cohorts.group_totals(loans, ["product"], "principal", "loan_id").select("product", money("principal"), "loans")


@query(
    "a4_disbursed_from_merged",
    f"""WITH {AGED_SQL},
per_loan AS (SELECT release_year, release_month, loan_id, max(principal) AS principal FROM aged GROUP BY ALL)
SELECT release_year, concat('Q', CAST(ceil(release_month / 3.0) AS INT)) AS release_quarter, round(sum(principal), 2) AS principal
FROM per_loan GROUP BY ALL""",
    over="loans repayments",
)
def a4_disbursed_from_merged(spark: SparkSession, sf: str) -> DataFrame:
    merged = cohorts.with_quarter(_aged(spark, sf), "release_month", "release_quarter")
    keys = ["release_year", "release_quarter"]
    return cohorts.disbursed_from_merged(merged, keys).select(*keys, money("principal"))


GAPS_SQL = """paid AS (SELECT loan_id, sum(amount) AS paid FROM repayments GROUP BY loan_id),
gaps AS (SELECT l.loan_id, total_due - (coalesce(paid, 0) + principal) AS pending_computed, pending_due,
  total_due - (coalesce(paid, 0) + principal) - pending_due AS gap
  FROM loans l LEFT JOIN paid p ON l.loan_id = p.loan_id)"""


@query(
    "a5_reconcile_balances",
    f"WITH {GAPS_SQL} SELECT loan_id, round(pending_computed, 4) AS pending_computed, round(gap, 2) AS gap FROM gaps WHERE abs(gap) > 1",
    over="loans repayments",
)
def a5_reconcile_balances(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts.reconcile_balances(_loans(spark, sf), _repayments(spark, sf)).select(
        "loan_id", money("pending_computed", 4), money("gap")
    )


@query(
    "a5_mean_gap",
    f"WITH {GAPS_SQL} SELECT count(*) AS loans, round(avg(gap), 4) AS mean_gap FROM gaps WHERE abs(gap) > 1",
    over="loans repayments",
)
def a5_mean_gap(spark: SparkSession, sf: str) -> DataFrame:
    unbalanced = cohorts.reconcile_balances(_loans(spark, sf), _repayments(spark, sf))
    return cohorts.mean_gap(unbalanced).select("loans", money("mean_gap", 4))


MONTHLY_SQL = f"""{AGED_SQL},
c AS (SELECT branch, release_year, release_month, collection_year, collection_month, sum(amount) AS amount FROM aged GROUP BY ALL),
d AS (SELECT branch, CAST(year(release_date) AS INT) AS release_year, CAST(month(release_date) AS INT) AS release_month, sum(principal) AS principal
  FROM loans WHERE status NOT IN ('Not Taken Up', 'Denied') GROUP BY ALL),
cq AS (SELECT branch, release_year, concat('Q', CAST(ceil(release_month / 3.0) AS INT)) AS release_quarter, collection_year,
  concat('Q', CAST(ceil(collection_month / 3.0) AS INT)) AS collection_quarter, amount, release_month FROM c),
both_branches AS (SELECT * FROM cq UNION ALL SELECT * REPLACE ('all' AS branch) FROM cq),
both_disbursed AS (SELECT * FROM d UNION ALL SELECT * REPLACE ('all' AS branch) FROM d)"""


def _monthly(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    keys = ["branch", *MONTH]
    collected = cohorts.collected_by(_aged(spark, sf), [*keys, "collection_year", "collection_month"])
    released = cohorts.with_date_parts(cohorts.disbursed(_loans(spark, sf)), "release_date", "release")
    return collected, cohorts.disbursed_by(released, keys)


QUARTERS = ["branch", "release_year", "release_quarter", "collection_year", "collection_quarter"]


@query(
    "a6_quarterly_collected_pct",
    f"""WITH {MONTHLY_SQL},
p AS (SELECT branch, release_year, concat('Q', CAST(ceil(release_month / 3.0) AS INT)) AS release_quarter, sum(principal) AS principal FROM both_disbursed GROUP BY ALL),
a AS (SELECT branch, release_year, release_quarter, collection_year, collection_quarter, sum(amount) AS amount FROM both_branches GROUP BY ALL)
SELECT branch, release_year, release_quarter, collection_year, collection_quarter, round(amount, 2) AS amount,
  round(principal, 2) AS principal, round(amount / principal, 8) AS collected_pct FROM a LEFT JOIN p USING (branch, release_year, release_quarter)""",
    over="loans repayments",
)
def a6_quarterly_collected_pct(spark: SparkSession, sf: str) -> DataFrame:
    result = cohorts.quarterly_collected_pct(*_monthly(spark, sf))
    return result.select(*QUARTERS, money("amount"), money("principal"), money("collected_pct", 8))


@query(
    "a6_quarterly_repeated_principal",
    f"""WITH {MONTHLY_SQL},
m AS (SELECT b.*, x.principal FROM both_branches b LEFT JOIN
  (SELECT * FROM both_disbursed) x ON b.branch = x.branch AND b.release_year = x.release_year AND b.release_month = x.release_month),
-- branch 'all' repeats the principal of each branch's own months
o AS (SELECT 'all' AS branch, q.release_year, q.release_quarter, q.collection_year, q.collection_quarter, q.amount, d.principal
  FROM cq q LEFT JOIN d ON q.branch = d.branch AND q.release_year = d.release_year AND q.release_month = d.release_month),
u AS (SELECT branch, release_year, release_quarter, collection_year, collection_quarter, amount, principal FROM m WHERE branch <> 'all'
  UNION ALL SELECT * FROM o)
SELECT branch, release_year, release_quarter, collection_year, collection_quarter, round(sum(amount), 2) AS amount,
  round(sum(principal), 2) AS principal, round(sum(amount) / sum(principal), 8) AS collected_pct
FROM u WHERE release_year = collection_year AND release_quarter = 'Q1' AND collection_quarter = 'Q1' GROUP BY ALL""",
    over="loans repayments",
)
def a6_quarterly_repeated_principal(spark: SparkSession, sf: str) -> DataFrame:
    result = cohorts.same_quarter(cohorts.quarterly_collected_pct(*_monthly(spark, sf), repeat_principal=True))
    return result.select(*QUARTERS, money("amount"), money("principal"), money("collected_pct", 8))


WEEKLY_SQL = f"""{AGED_SQL},
flows AS (SELECT release_year, weeks_since_release, amount FROM aged WHERE weeks_since_release >= 0
  UNION ALL SELECT CAST(year(release_date) AS INT), 0, -principal FROM loans WHERE status NOT IN ('Not Taken Up', 'Denied')),
weekly AS (SELECT release_year, weeks_since_release, sum(amount) AS amount FROM flows GROUP BY ALL),
dense AS (SELECT w.release_year, w.week AS weeks_since_release, coalesce(f.amount, 0) AS amount
  FROM (SELECT release_year, CAST(unnest(generate_series(0, max(weeks_since_release))) AS INT) AS week FROM weekly GROUP BY release_year) w
  LEFT JOIN weekly f ON f.release_year = w.release_year AND f.weeks_since_release = w.week)"""


def _weekly_with_origination(spark: SparkSession, sf: str) -> DataFrame:
    loans = cohorts.with_date_parts(cohorts.disbursed(_loans(spark, sf)), "release_date", "release")
    weekly = cohorts.weekly_cashflows(_aged(spark, sf), ["release_year"])
    return cohorts.weekly_with_origination(weekly, cohorts.disbursed_by(loans, ["release_year"]), ["release_year"])


@query(
    "d1_weekly_cashflows",
    f"""WITH {AGED_SQL} SELECT branch, release_year, weeks_since_release, round(sum(amount), 2) AS amount
FROM aged WHERE weeks_since_release >= 0 GROUP BY ALL""",
    over="loans repayments",
)
def d1_weekly_cashflows(spark: SparkSession, sf: str) -> DataFrame:
    cohort = ["branch", "release_year"]
    return cohorts.weekly_cashflows(_aged(spark, sf), cohort).select(*cohort, "weeks_since_release", money("amount"))


@query(
    "d2_with_origination",
    """SELECT loan_id, collection_date, amount FROM repayments
UNION ALL SELECT loan_id, release_date, -principal FROM loans WHERE status NOT IN ('Not Taken Up', 'Denied')""",
    over="loans repayments",
)
def d2_with_origination(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts.with_origination(cohorts.disbursed(_loans(spark, sf)), _repayments(spark, sf))


@query(
    "d3_densify_weeks",
    f"WITH {WEEKLY_SQL} SELECT release_year, weeks_since_release, round(amount, 2) AS amount FROM dense",
    over="loans repayments",
)
def d3_densify_weeks(spark: SparkSession, sf: str) -> DataFrame:
    dense = cohorts.densify_weeks(_weekly_with_origination(spark, sf), ["release_year"])
    return dense.select("release_year", "weeks_since_release", money("amount"))


IRR_SQL = f"""WITH RECURSIVE {WEEKLY_SQL},
f AS (SELECT release_year, list({{'w': weeks_since_release, 'a': amount}}) AS flows, max(weeks_since_release) AS last FROM dense GROUP BY release_year),
b AS (SELECT release_year, flows, last, 0 AS step, CAST(-0.999999 AS DOUBLE) AS low, CAST(1000000 AS DOUBLE) AS high,
    sign(list_sum(list_transform(flows, lambda x: x.a * pow(0.000001, last - x.w)))) AS sign_low,
    sign(list_sum(list_transform(flows, lambda x: x.a * pow(1000001.0, -x.w)))) AS sign_high FROM f
  UNION ALL
  SELECT release_year, flows, last, step + 1, CASE WHEN same THEN mid ELSE low END, CASE WHEN same THEN high ELSE mid END, sign_low, sign_high
  FROM (SELECT *, (low + high) / 2 AS mid,
      sign(list_sum(list_transform(flows, lambda x: x.a * pow(1 + (low + high) / 2, CASE WHEN low + high < 0 THEN last - x.w ELSE -x.w END)))) = sign_low AS same
      FROM b WHERE step < 100) s)
SELECT release_year, round(CASE WHEN sign_low * sign_high < 0 THEN (low + high) / 2 END, 8) AS weekly_irr"""


@query("d4_weekly_irr", IRR_SQL + " FROM b WHERE step = 100", over="loans repayments")
def d4_weekly_irr(spark: SparkSession, sf: str) -> DataFrame:
    dense = cohorts.densify_weeks(_weekly_with_origination(spark, sf), ["release_year"])
    return cohorts.weekly_irr(dense, ["release_year"]).select("release_year", money("weekly_irr", 8))


@query(
    "d5_yearly_irr",
    IRR_SQL
    + ", round(CASE WHEN sign_low * sign_high < 0 THEN pow(1 + (low + high) / 2, 52) - 1 END, 6) AS yearly_irr FROM b WHERE step = 100",
    over="loans repayments",
)
def d5_yearly_irr(spark: SparkSession, sf: str) -> DataFrame:
    dense = cohorts.densify_weeks(_weekly_with_origination(spark, sf), ["release_year"])
    rates = cohorts.with_yearly_irr(cohorts.weekly_irr(dense, ["release_year"]))
    return rates.select("release_year", money("weekly_irr", 8), money("yearly_irr", 6))


RAW_AGED_SQL = """parsed_loans AS (SELECT loan_id, branch, principal, status,
    CASE WHEN branch = 'b' THEN CAST(strptime(released, '%d/%m/%Y') AS DATE) ELSE CAST(released AS DATE) END AS release_date FROM raw_loans
    WHERE status NOT IN ('Not Taken Up', 'Denied')),
parsed_paid AS (SELECT loan_id, amount,
    CASE WHEN branch = 'b' THEN CAST(strptime(collected, '%d/%m/%Y') AS DATE) ELSE CAST(collected AS DATE) END AS collection_date FROM raw_repayments),
paid_and_lent AS (SELECT * FROM parsed_paid UNION ALL SELECT loan_id, -principal, release_date FROM parsed_loans),
aged AS (SELECT l.branch, CAST(year(release_date) AS INT) AS release_year, CAST(month(release_date) AS INT) AS release_month, amount,
  CAST(floor(datediff('day', release_date, collection_date) / 7.0) AS INT) AS weeks_since_release
  FROM parsed_loans l JOIN paid_and_lent r ON l.loan_id = r.loan_id)"""


def _raw_report(spark: SparkSession, sf: str, **options) -> vintage.VintageReport:
    loans = vintage.with_branch_date(view(spark, sf, "raw_loans"), "released", "release_date")
    paid = vintage.with_branch_date(view(spark, sf, "raw_repayments"), "collected", "collection_date")
    return vintage.vintage_report(loans, paid, newest_year=2000, **options)


@query(
    "d6_vintage_curve",
    f"""WITH {RAW_AGED_SQL},
weekly AS (SELECT branch, release_year, weeks_since_release, sum(amount) AS amount FROM aged WHERE weeks_since_release >= 0 GROUP BY ALL),
dense AS (SELECT w.branch, w.release_year, w.week AS weeks_since_release, coalesce(f.amount, 0) AS amount
  FROM (SELECT branch, release_year, CAST(unnest(generate_series(0, max(weeks_since_release))) AS INT) AS week FROM weekly GROUP BY branch, release_year) w
  LEFT JOIN weekly f ON f.branch = w.branch AND f.release_year = w.release_year AND f.weeks_since_release = w.week)
SELECT branch, release_year, weeks_since_release, round(amount, 2) AS amount,
  round(sum(amount) OVER (PARTITION BY branch, release_year ORDER BY weeks_since_release ROWS UNBOUNDED PRECEDING), 2) AS cumul_cashflow FROM dense""",
    over="raw_loans raw_repayments",
)
def d6_vintage_curve(spark: SparkSession, sf: str) -> DataFrame:
    return _raw_report(spark, sf).curve.select(
        "branch", "release_year", "weeks_since_release", money("amount"), money("cumul_cashflow")
    )


@query(
    "d6_vintage_comparable",
    f"""WITH {RAW_AGED_SQL},
weekly AS (SELECT branch, release_year, weeks_since_release, sum(amount) AS amount FROM aged WHERE weeks_since_release >= 0
  AND weeks_since_release <= (SELECT max(weeks_since_release) FROM aged WHERE release_year = 2000) AND release_month <= 3 GROUP BY ALL)
SELECT branch, release_year, weeks_since_release, round(amount, 2) AS amount,
  round(sum(amount) OVER (PARTITION BY branch, release_year ORDER BY weeks_since_release ROWS UNBOUNDED PRECEDING), 2) AS cumul_cashflow FROM weekly""",
    over="raw_loans raw_repayments",
)
def d6_vintage_comparable(spark: SparkSession, sf: str) -> DataFrame:
    return _raw_report(spark, sf).comparable_curve.select(
        "branch", "release_year", "weeks_since_release", money("amount"), money("cumul_cashflow")
    )


@query(
    "d6_vintage_quarterly",
    f"""WITH {RAW_AGED_SQL.replace("paid_and_lent AS (SELECT * FROM parsed_paid UNION ALL SELECT loan_id, -principal, release_date FROM parsed_loans)", "paid_and_lent AS (SELECT * FROM parsed_paid)").replace("AS release_month, amount,", "AS release_month, CAST(year(collection_date) AS INT) AS collection_year, CAST(month(collection_date) AS INT) AS collection_month, amount,")},
cq AS (SELECT branch, release_year, concat('Q', CAST(ceil(release_month / 3.0) AS INT)) AS release_quarter, collection_year,
  concat('Q', CAST(ceil(collection_month / 3.0) AS INT)) AS collection_quarter, amount FROM aged),
a AS (SELECT branch, release_year, release_quarter, collection_year, collection_quarter, sum(amount) AS amount FROM
  (SELECT * FROM cq UNION ALL SELECT * REPLACE ('all' AS branch) FROM cq) u GROUP BY ALL),
lq AS (SELECT branch, CAST(year(release_date) AS INT) AS release_year, concat('Q', CAST(ceil(month(release_date) / 3.0) AS INT)) AS release_quarter, principal FROM parsed_loans),
p AS (SELECT branch, release_year, release_quarter, sum(principal) AS principal FROM
  (SELECT * FROM lq UNION ALL SELECT * REPLACE ('all' AS branch) FROM lq) u GROUP BY ALL)
SELECT branch, release_year, release_quarter, collection_year, collection_quarter, round(amount, 2) AS amount, round(principal, 2) AS principal,
  round(amount / principal, 8) AS collected_pct FROM a LEFT JOIN p USING (branch, release_year, release_quarter)""",
    over="raw_loans raw_repayments",
)
def d6_vintage_quarterly(spark: SparkSession, sf: str) -> DataFrame:
    """From base tables written to the shared folder, as a run of the whole report would."""
    report = _raw_report(spark, sf, work_dir=shared_dir(spark, "vintage"))
    return report.quarterly.select(*QUARTERS, money("amount"), money("principal"), money("collected_pct", 8))


@query(
    "d7_product_repayment_report",
    """WITH l AS (SELECT loan_id, principal, release_date, product IN ('1-URGENT', '2-HIGH') AS in_group FROM loans
  WHERE status NOT IN ('Denied', 'Not Taken Up', 'Processing')),
w AS (SELECT in_group, CAST(floor(datediff('day', release_date, collection_date) / 7.0) AS INT) AS weeks_since_release, sum(amount) AS amount
  FROM l RIGHT JOIN repayments r ON l.loan_id = r.loan_id WHERE in_group IS NOT NULL GROUP BY ALL),
t AS (SELECT in_group, sum(principal) AS principal, count(DISTINCT loan_id) AS loans_released FROM l GROUP BY in_group)
SELECT in_group, weeks_since_release, round(amount, 2) AS amount,
  round(sum(amount) OVER (PARTITION BY in_group ORDER BY weeks_since_release ROWS UNBOUNDED PRECEDING), 2) AS cumul_cashflow,
  round(principal, 2) AS principal, loans_released,
  round(sum(amount) OVER (PARTITION BY in_group ORDER BY weeks_since_release ROWS UNBOUNDED PRECEDING) / principal, 8) AS principal_collected_pct
FROM w JOIN t USING (in_group)""",
    over="loans repayments",
)
def d7_product_repayment_report(spark: SparkSession, sf: str) -> DataFrame:
    report = products.product_repayment_report(_loans(spark, sf), _repayments(spark, sf), ["1-URGENT", "2-HIGH"])
    return report.select(
        "in_group", "weeks_since_release", money("amount"), money("cumul_cashflow"), money("principal"),
        "loans_released", money("principal_collected_pct", 8),
    )


@query("f11_lookup", "SELECT * FROM loans WHERE loan_no = (SELECT max(loan_no) FROM loans)", over="loans")
def f11_lookup(spark: SparkSession, sf: str) -> DataFrame:
    loans = _loans(spark, sf)
    return cleaning.lookup(loans, "loan_no", loans.agg(F.max("loan_no")).scalar())


@query(
    "p26_dates_to_text",
    "SELECT loan_id, strftime(release_date, '%Y-%m-%d') AS release_date, CAST(year(release_date) AS VARCHAR) AS release_year FROM loans",
    over="loans",
)
def p26_dates_to_text(spark: SparkSession, sf: str) -> DataFrame:
    df = _loans(spark, sf).select("loan_id", "release_date", F.year("release_date").cast("double").alias("release_year"))
    return cleaning.whole_numbers_to_text(cleaning.dates_to_text(df), ["release_year"])
