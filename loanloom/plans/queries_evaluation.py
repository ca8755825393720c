"""Registered queries: profiles, distributions, evaluation and feature selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loanloom.operators import cleaning, distribution, evaluation, joins, ordered, profile, selection
from loanloom.plans.queries_cleaning import PROPS
from loanloom.plans.registry import query
from loanloom.sources import readers
from loanloom.sources.views import table, view


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "scored")


def _predicted(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.above(_scored(spark, sf), "p", 0.55)


PRED_SQL = "pred AS (SELECT *, CASE WHEN p > 0.55 THEN 1 ELSE 0 END AS y_pred FROM scored)"

# --- profiles --------------------------------------------------------------------------------------


@query(
    "a7_value_counts",
    "SELECT branch, status, count(*) AS n, round(count(*) / (SELECT count(*) FROM loans), 10) AS share FROM loans GROUP BY branch, status",
    over="loans",
)
def a7_value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.value_counts(view(spark, sf, "loans"), ["branch", "status"], normalize=True), 10, "share")


STATUSES = ["Fully Paid", "Open", "Denied", "Not Taken Up", "Processing", "Refused"]


@query(
    "a8_status_matrix",
    "SELECT branch, " + ", ".join(f"nullif(count(*) FILTER (WHERE status = '{s}'), 0) AS \"{s}\"" for s in STATUSES)
    + " FROM loans GROUP BY branch",
    over="loans",
)
def a8_status_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return profile.status_matrix(view(spark, sf, "loans"), "branch", "status", STATUSES)


NULLABLE = ["request_date", "balance_min", "total_paid"]


@query(
    "a9_null_profile",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM applications" for c in NULLABLE),
    over="applications",
)
def a9_null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_profile(view(spark, sf, "applications"))


@query(
    "a9_total_nulls",
    "SELECT CAST(" + " + ".join(f"(count(*) - count({c}))" for c in NULLABLE) + " AS BIGINT) AS nulls FROM applications",
    over="applications",
)
def a9_total_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return profile.total_nulls(view(spark, sf, "applications"))


@query(
    "a10_table_profile",
    """SELECT count(*) AS row_count, count(DISTINCT loan_id) AS distinct_keys, min(collection_date) AS first_date,
  max(collection_date) AS last_date FROM repayments""",
    over="repayments",
)
def a10_table_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.table_profile(view(spark, sf, "repayments"), "loan_id", "collection_date")


# --- distributions ---------------------------------------------------------------------------------

PERCENT_LIST = ", ".join(str(p) for p in distribution.PERCENTILES)


@query(
    "a11_score_percentiles",
    f"""WITH q AS (SELECT quantile_cont(p, [{', '.join(str(p / 100) for p in distribution.PERCENTILES)}]) AS v FROM scored)
SELECT unnest([{PERCENT_LIST}]) AS percentile, round(unnest(v), 12) AS score FROM q""",
    over="scored",
)
def a11_score_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(distribution.score_percentiles(_scored(spark, sf), "p"), 12, "score")


@query(
    "a11_amount_percentiles",
    f"""WITH q AS (SELECT quantile_cont(profit, [{', '.join(str(p / 100) for p in distribution.PERCENTILES)}]) AS v FROM scored)
SELECT unnest([{PERCENT_LIST}]) AS percentile, round(unnest(v), 4) AS score FROM q""",
    over="scored",
)
def a11_amount_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(distribution.score_percentiles(_scored(spark, sf), "profit"), 4, "score")


EDGES_SQL = """m AS (SELECT min(p) AS lo, max(p) AS hi FROM scored),
b AS (SELECT CAST(i AS INT) AS bin, CASE WHEN i = 1 THEN lo - (hi - lo) * 0.001 ELSE lo + (i - 1) * ((hi - lo) / 10) END AS low,
  CASE WHEN i = 10 THEN hi ELSE lo + i * ((hi - lo) / 10) END AS high FROM m, generate_series(1, 10) g(i))"""


@query(
    "a12_histogram",
    f"""WITH {EDGES_SQL}
SELECT bin, round(low, 10) AS low, round(high, 10) AS high, count(p) AS n FROM b LEFT JOIN scored ON p > low AND p <= high GROUP BY ALL""",
    over="scored",
)
def a12_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(distribution.histogram(_scored(spark, sf), "p"), 10, "low", "high")


QUANTILE_EDGES_SQL = """e AS (SELECT list_sort(list_distinct(quantile_cont({x}, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS edges FROM {source}),
binned AS (SELECT s.*, CAST(1 + len(list_filter(edges[2:len(edges) - 1], lambda v: v < {x})) AS INT) AS bin FROM {source} s, e WHERE {x} IS NOT NULL)"""


@query(
    "a13_quantile_bins",
    f"WITH {QUANTILE_EDGES_SQL.format(x='count_nsf_90_days', source='applications')} SELECT application_id, bin FROM binned",
    over="applications",
)
def a13_quantile_bins(spark: SparkSession, sf: str) -> DataFrame:
    binned = distribution.quantile_bins(view(spark, sf, "applications"), "count_nsf_90_days", 10)
    return binned.select("application_id", "bin")


@query(
    "a14_lift_quantiles",
    f"""WITH {QUANTILE_EDGES_SQL.format(x='p', source='scored')}
SELECT bin, count(*) AS n, round(avg(y), 8) AS mean_outcome FROM binned GROUP BY bin""",
    over="scored",
)
def a14_lift_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(distribution.lift_table(_scored(spark, sf), "p", "y", q=10), 8, "mean_outcome").drop("low", "high")


@query(
    "a14_lift_bins",
    f"""WITH {EDGES_SQL}
SELECT bin, count(p) AS n, round(avg(profit), 6) AS mean_outcome FROM b LEFT JOIN scored ON p > low AND p <= high GROUP BY bin""",
    over="scored",
)
def a14_lift_bins(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(distribution.lift_table(_scored(spark, sf), "p", "profit", bins=10), 6, "mean_outcome").drop("low", "high")


@query(
    "a14_lift_category",
    "SELECT status, count(*) AS n, round(avg(principal), 6) AS mean_outcome FROM loans GROUP BY status",
    over="loans",
)
def a14_lift_category(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(distribution.lift_table(view(spark, sf, "loans"), "status", "principal", q=10), 6, "mean_outcome")


# --- evaluation ------------------------------------------------------------------------------------


def _confusion_sql(share: str) -> str:
    return f"""WITH {PRED_SQL}, c AS (SELECT y AS actual, y_pred AS predicted, count(*) AS n FROM pred GROUP BY ALL)
SELECT actual, predicted, n, round(n / {share}, 10) AS share FROM c"""


@query("a15_confusion_by_true", _confusion_sql("sum(n) OVER (PARTITION BY actual)"), over="scored")
def a15_confusion_by_true(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.confusion(_predicted(spark, sf), normalize="true"), 10, "share")


@query("a15_confusion_by_pred", _confusion_sql("sum(n) OVER (PARTITION BY predicted)"), over="scored")
def a15_confusion_by_pred(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.confusion(_predicted(spark, sf), normalize="pred"), 10, "share")


@query("a15_confusion_by_all", _confusion_sql("sum(n) OVER ()"), over="scored")
def a15_confusion_by_all(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.confusion(_predicted(spark, sf), normalize="all"), 10, "share")


REPORT_SQL = f"""{PRED_SQL}, k AS (SELECT unnest([0, 1]) AS k),
pr AS (SELECT k, count(*) FILTER (WHERE y = k AND y_pred = k) / nullif(count(*) FILTER (WHERE y_pred = k), 0) AS p,
  count(*) FILTER (WHERE y = k AND y_pred = k) / nullif(count(*) FILTER (WHERE y = k), 0) AS r,
  count(*) FILTER (WHERE y = k) AS s FROM pred, k GROUP BY k),
f AS (SELECT k, coalesce(p, 0) AS p, coalesce(r, 0) AS r, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f, s FROM pr)"""


@query(
    "a16_classification_report",
    f"""WITH {REPORT_SQL}, rows AS (
SELECT CAST(k AS VARCHAR) AS class, p, r, f, s FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, (SELECT avg(CASE WHEN y = y_pred THEN 1.0 ELSE 0 END) FROM pred), (SELECT count(*) FROM pred)
UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), CAST(sum(s) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s), CAST(sum(s) AS BIGINT) FROM f)
SELECT class, round(p, 10) AS "precision", round(r, 10) AS recall, round(f, 10) AS f1_score, s AS support FROM rows""",
    over="scored",
)
def a16_classification_report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.classification_report(_predicted(spark, sf)), 10, "precision", "recall", "f1_score")


@query(
    "a17_precision_recall_f",
    f"""WITH {REPORT_SQL} SELECT round(p, 10) AS precision_1, round(r, 10) AS recall_1, round(5 * p * r / (4 * p + r), 10) AS fscore FROM f WHERE k = 1""",
    over="scored",
)
def a17_precision_recall_f(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.precision_recall_f(_predicted(spark, sf), beta=2.0), 10, "precision_1", "recall_1", "fscore")


@query("a18_pr_metric", f"WITH {REPORT_SQL} SELECT round(-f, 10) AS metric FROM f WHERE k = 1", over="scored")
def a18_pr_metric(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.pr_metric(_scored(spark, sf), "p", "y", 0.55), 10, "metric")


@query(
    "a19_profit_metric",
    f"""WITH {PRED_SQL}, s AS (SELECT CAST(sum(CASE WHEN y_pred = 1 THEN 0 WHEN y = 0 THEN 385 ELSE -120 END) AS BIGINT) AS profit_pred,
  CAST(sum(CASE WHEN y = 0 THEN 385 ELSE -120 END) AS BIGINT) AS profit_actual, sum(y_pred) AS refused FROM pred)
SELECT profit_pred, profit_actual, CASE WHEN refused = 0 THEN 99999999 ELSE profit_actual - profit_pred END AS metric FROM s""",
    over="scored",
)
def a19_profit_metric(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.profit_metric(_scored(spark, sf), "p", "y", 0.55)


@query(
    "a20_profitability",
    f"""WITH {PRED_SQL} SELECT round(sum(profit) FILTER (WHERE y_pred = 0), 2) AS predicted_profit, round(sum(profit) FILTER (WHERE y_pred = 1), 2) AS anti_profit,
  round(sum(profit), 2) AS actual_profit, count(*) AS loans, count(*) FILTER (WHERE y_pred = 1) AS denied,
  round(sum(profit) FILTER (WHERE y_pred = 1) / count(*), 6) AS anti_profit_per_loan,
  round(sum(profit) FILTER (WHERE y_pred = 1) / count(*) FILTER (WHERE y_pred = 1), 6) AS anti_profit_per_denied FROM pred""",
    over="scored",
)
def a20_profitability(spark: SparkSession, sf: str) -> DataFrame:
    result = evaluation.profitability(_predicted(spark, sf))
    result = rounded(result, 2, "predicted_profit", "anti_profit", "actual_profit")
    return rounded(result, 6, "anti_profit_per_loan", "anti_profit_per_denied")


@query(
    "a21_p90_accuracy",
    """SELECT CAST(sum(CASE WHEN p >= (SELECT quantile_cont(p, 0.9) FROM scored) THEN y ELSE 0 END)
  - sum(CASE WHEN p <= (SELECT quantile_cont(p, 0.1) FROM scored) THEN y ELSE 0 END) AS BIGINT) AS delta FROM scored""",
    over="scored",
)
def a21_p90_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.p90_accuracy(_scored(spark, sf))


def _auc_sql(weight: str) -> str:
    return f"""WITH g AS (SELECT p, sum(CASE WHEN y = 1 THEN {weight} ELSE 0 END) AS pos, sum(CASE WHEN y = 0 THEN {weight} ELSE 0 END) AS neg FROM scored GROUP BY p),
r AS (SELECT pos, neg, sum(neg) OVER (ORDER BY p) - neg AS before FROM g)
SELECT round(sum(pos * (before + neg / 2)) / (sum(pos) * sum(neg)), 10) AS auc FROM r"""


@query("a22_roc_auc", _auc_sql("1.0::DOUBLE"), over="scored")
def a22_roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.roc_auc(_scored(spark, sf)), 10, "auc")


@query("a22_roc_auc_weighted", _auc_sql("(1 + loan_id % 3)::DOUBLE"), over="scored")
def a22_roc_auc_weighted(spark: SparkSession, sf: str) -> DataFrame:
    weighted = _scored(spark, sf).withColumn("w", 1 + F.col("loan_id") % 3)
    return rounded(evaluation.roc_auc(weighted, weight="w"), 10, "auc")


@query(
    "a23_positive_rates",
    f"""WITH {PRED_SQL} SELECT count(*) FILTER (WHERE y = 1) AS actual, round(avg(y) * 100, 1) AS actual_pct,
  count(*) FILTER (WHERE y_pred = 1) AS predicted, round(avg(y_pred) * 100, 1) AS predicted_pct FROM pred""",
    over="scored",
)
def a23_positive_rates(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.positive_rates(_predicted(spark, sf))


MONTHLY_SCORED = """SELECT s.loan_id, s.p, s.profit, a.request_date FROM {scored} s JOIN {applications} a ON s.loan_id = a.application_id"""
BY_MONTH_SQL = f"""ms AS ({MONTHLY_SCORED.format(scored='scored', applications='applications')}),
bm AS (SELECT strftime(request_date, '%Y-%m') AS month, avg(profit) AS a FROM ms
  WHERE p >= (SELECT quantile_cont(p, 0.9) FROM scored) AND request_date IS NOT NULL GROUP BY month)"""


def _anti_profit(spark: SparkSession, sf: str) -> DataFrame:
    scored = _scored(spark, sf)
    [cut] = distribution.percentile_values(scored, "p", [90])
    dated = spark.sql(MONTHLY_SCORED, scored=scored, applications=view(spark, sf, "applications"))
    return evaluation.anti_profit_by_month(dated, "p", cut)


@query(
    "a24_anti_profit_by_month",
    f"WITH {BY_MONTH_SQL} SELECT month, round_even(a, 0) AS anti_profit_per_loan FROM bm",
    over="scored applications",
)
def a24_anti_profit_by_month(spark: SparkSession, sf: str) -> DataFrame:
    return _anti_profit(spark, sf)


@query(
    "a24_mean_anti_profit",
    f"WITH {BY_MONTH_SQL} SELECT round(avg(round_even(a, 0)), 8) AS mean_anti_profit FROM bm",
    over="scored applications",
)
def a24_mean_anti_profit(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.mean_anti_profit(_anti_profit(spark, sf)), 8, "mean_anti_profit")


@query(
    "a30_backtest_summary",
    f"""WITH {REPORT_SQL} SELECT (SELECT count(*) FROM pred) AS loans, (SELECT count(*) FROM pred WHERE y_pred = 1) AS predicted_positives,
  s AS actual_positives, round((SELECT avg(y_pred) FROM pred), 10) AS predicted_share,
  round((SELECT avg(CASE WHEN y = y_pred THEN 1.0 ELSE 0 END) FROM pred), 10) AS accuracy, round(p, 10) AS precision_1, round(r, 10) AS recall_1,
  round(f, 10) AS f1_1, round((SELECT sum(profit) FROM pred WHERE y_pred = 1), 2) AS total_anti_profit,
  round((SELECT avg(profit) FROM pred WHERE y_pred = 1), 6) AS avg_anti_profit FROM f WHERE k = 1""",
    over="scored",
)
def a30_backtest_summary(spark: SparkSession, sf: str) -> DataFrame:
    summary = evaluation.backtest_summary(_predicted(spark, sf))
    summary = rounded(summary, 10, "predicted_share", "accuracy", "precision_1", "recall_1", "f1_1")
    return rounded(rounded(summary, 2, "total_anti_profit"), 6, "avg_anti_profit")


@query(
    "a31_acceptance",
    """SELECT count(*) AS scored, round(avg(CASE WHEN k / 100.0 >= 0.2 THEN 0.0 ELSE 1.0 END), 10) AS acceptance_rate, round(avg(k / 100.0), 10) AS mean_score
FROM (SELECT CAST(json_extract_string(props, '$.k') AS INT)::DOUBLE AS k FROM events) q""",
)
def a31_acceptance(spark: SparkSession, sf: str) -> DataFrame:
    logged = readers.expand_json(table(spark, sf, "events").select("event_id", "props"), "props", PROPS)
    result = evaluation.acceptance(logged.withColumn("pred_proba", F.col("k") / 100), "pred_proba", 0.2)
    return rounded(result, 10, "acceptance_rate", "mean_score")


BACKTEST_SQL = """pred AS (SELECT profit, CASE WHEN profit < 50 THEN 1 ELSE 0 END AS y, CASE WHEN p >= (SELECT quantile_cont(p, 0.8) FROM scored) THEN 1 ELSE 0 END AS y_pred FROM
  (SELECT s.* FROM scored s JOIN applications a ON s.loan_id = a.application_id WHERE strftime(request_date, '%Y-%m') = '1997-04') m)"""


@query(
    "m15_backtest",
    "WITH " + REPORT_SQL.replace(PRED_SQL, BACKTEST_SQL) + """ SELECT (SELECT count(*) FROM pred) AS loans,
  (SELECT count(*) FROM pred WHERE y_pred = 1) AS predicted_positives, s AS actual_positives, round(p, 10) AS precision_1, round(r, 10) AS recall_1,
  round((SELECT sum(profit) FROM pred WHERE y_pred = 1), 2) AS total_anti_profit FROM f WHERE k = 1""",
    over="scored applications",
)
def m15_backtest(spark: SparkSession, sf: str) -> DataFrame:
    scored = _scored(spark, sf)
    [cut] = distribution.percentile_values(scored, "p", [80])
    month = cleaning.for_month(view(spark, sf, "applications"), "1997-04").select(F.col("application_id").alias("loan_id"))
    summary, _ = evaluation.backtest(scored.join(month, "loan_id"), "p", cut)
    summary = rounded(rounded(summary, 10, "precision_1", "recall_1"), 2, "total_anti_profit")
    return summary.select("loans", "predicted_positives", "actual_positives", "precision_1", "recall_1", "total_anti_profit")


@query(
    "w5_learning_curve",
    """WITH b AS (SELECT run_id, wall_clock_time, min(validation_loss) AS loss FROM trials GROUP BY ALL)
SELECT run_id, wall_clock_time, round(1 - min(loss) OVER (PARTITION BY run_id ORDER BY wall_clock_time), 10) AS best_accuracy FROM b""",
    over="trials",
)
def w5_learning_curve(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.learning_curve(view(spark, sf, "trials")), 10, "best_accuracy")


# --- feature selection -----------------------------------------------------------------------------

TESTED = ["balance_current", "count_nsf_90_days", "count_nsf_30_days", "balance_min", "recurring_deposits_current_month",
          "sum_loan_deposits_90_days", "principal", "account_age_days"]
LABELLED_SQL = "labelled AS (SELECT *, CASE WHEN total_paid - principal < 50 THEN 1 ELSE 0 END AS status FROM profiles)"


def _welch_sql(variables: list[str]) -> str:
    parts = []
    for v in variables:
        parts.append(
            f"SELECT '{v}' AS variable, count({v}) FILTER (WHERE status = 0) AS n0, avg({v}) FILTER (WHERE status = 0) AS m0, var_samp({v}) FILTER (WHERE status = 0) AS v0, "
            f"count({v}) FILTER (WHERE status = 1) AS n1, avg({v}) FILTER (WHERE status = 1) AS m1, var_samp({v}) FILTER (WHERE status = 1) AS v1 FROM labelled"
        )
    union = " UNION ALL ".join(parts)
    return f"""{LABELLED_SQL}, st AS ({union}),
tt AS (SELECT variable, (m1 - m0) / sqrt(v0 / n0 + v1 / n1) AS t,
  pow(v0 / n0 + v1 / n1, 2) / (pow(v0 / n0, 2) / (n0 - 1) + pow(v1 / n1, 2) / (n1 - 1)) AS freedom FROM st)"""


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.with_default_label(cleaning.with_profit(view(spark, sf, "profiles")))


def _tests(spark: SparkSession, sf: str, variables: list[str]) -> DataFrame:
    return selection.with_p_value(selection.welch_t(_labelled(spark, sf), variables, "status"))


@query(
    "a25_welch_t",
    f"WITH {_welch_sql(TESTED)} SELECT variable, round(t, 8) AS t, round(freedom, 4) AS freedom FROM tt",
    over="profiles",
)
def a25_welch_t(spark: SparkSession, sf: str) -> DataFrame:
    tests = selection.welch_t(_labelled(spark, sf), TESTED, "status")
    return rounded(rounded(tests, 8, "t"), 4, "freedom").select("variable", "t", "freedom")


# With thousands of degrees of freedom p < 0.001 means |t| above the normal value 3.2905, corrected
# for the degrees of freedom by the first term of its expansion.
SIGNIFICANT_SQL = "abs(t) > 3.2905267 + (pow(3.2905267, 3) + 3.2905267) / (4 * freedom)"


@query(
    "l2_top_variables",
    f"""WITH {_welch_sql(TESTED)} SELECT variable, round(abs(t), 8) AS abs_t FROM tt WHERE {SIGNIFICANT_SQL} ORDER BY abs(t) DESC LIMIT 2 OFFSET 1""",
    over="profiles",
)
def l2_top_variables(spark: SparkSession, sf: str) -> DataFrame:
    top = selection.top_variables(_tests(spark, sf, TESTED), n=2, offset=1)
    return rounded(top, 8, "abs_t").select("variable", "abs_t")


@query(
    "l3_combine_top",
    f"""WITH {_welch_sql(TESTED)},
a AS (SELECT * FROM tt WHERE {SIGNIFICANT_SQL} AND variable LIKE 'count_%' ORDER BY abs(t) DESC LIMIT 10),
b AS (SELECT * FROM tt WHERE {SIGNIFICANT_SQL} AND variable LIKE 'balance_%' ORDER BY abs(t) DESC LIMIT 10)
SELECT variable, round(abs(t), 8) AS abs_t FROM (SELECT * FROM a UNION ALL SELECT * FROM b) u ORDER BY abs(t) DESC""",
    over="profiles",
)
def l3_combine_top(spark: SparkSession, sf: str) -> DataFrame:
    tops = [
        selection.top_variables(_tests(spark, sf, [v for v in TESTED if v.startswith(prefix)]))
        for prefix in ("count_", "balance_")
    ]
    return rounded(selection.combine_top(*tops), 8, "abs_t").select("variable", "abs_t")


RANKED = ["count_nsf_90_days", "account_age_days", "balance_current", "principal", "doubled"]
RANKED_WITH_GAPS = ["balance_min", "count_nsf_30_days", "total_paid"]


def _spearman_sql(variables: list[str], complete: bool) -> str:
    """Cells as (var1, var2, value), each pair ranked on its complete rows."""
    parts = []
    for a in variables:
        for b in variables:
            if a == b:
                parts.append(f"SELECT '{a}' AS var1, '{b}' AS var2, 1.0::DOUBLE AS value")
                continue
            ranks = ", ".join(
                f"rank() OVER (ORDER BY {v}) + (count(*) OVER (PARTITION BY {v}) - 1) / 2.0 AS {n}" for v, n in ((a, "ra"), (b, "rb"))
            )
            parts.append(
                f"SELECT '{a}' AS var1, '{b}' AS var2, round(corr(ra, rb), 8) AS value FROM (SELECT {ranks} FROM src WHERE {a} IS NOT NULL AND {b} IS NOT NULL) q"
            )
    return "src AS (SELECT *, principal * 2 AS doubled FROM profiles), cells AS (" + " UNION ALL ".join(parts) + ")"


def _matrix(spark: SparkSession, sf: str, variables: list[str]) -> DataFrame:
    source = view(spark, sf, "profiles").withColumn("doubled", F.col("principal") * 2)
    return selection.spearman(source, variables)


def _matrix_sql(variables: list[str]) -> str:
    columns = ", ".join(f"max(value) FILTER (WHERE var2 = '{v}') AS {v}" for v in variables)
    return f"WITH {_spearman_sql(variables, True)} SELECT var1 AS variable, {columns} FROM cells GROUP BY var1"


@query("a26_spearman", _matrix_sql(RANKED), over="profiles")
def a26_spearman(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_matrix(spark, sf, RANKED), 8, *RANKED)


@query("a26_spearman_with_gaps", _matrix_sql(RANKED_WITH_GAPS), over="profiles")
def a26_spearman_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_matrix(spark, sf, RANKED_WITH_GAPS), 8, *RANKED_WITH_GAPS)


@query(
    "a27_melt",
    """SELECT application_id, 'account_age_days' AS variable, account_age_days AS value FROM applications
UNION ALL SELECT application_id, 'balance_min', balance_min FROM applications""",
    over="applications",
)
def a27_melt(spark: SparkSession, sf: str) -> DataFrame:
    df = view(spark, sf, "applications").select("application_id", "account_age_days", "balance_min")
    return selection.melt(df, ["application_id"])


PAIRS_SQL = f"{_spearman_sql(RANKED, True)}, pairs AS (SELECT var1, var2, value FROM cells WHERE var1 <> var2 AND value >= 0.9)"


@query("a28_correlated_pairs", f"WITH {PAIRS_SQL} SELECT * FROM pairs", over="profiles")
def a28_correlated_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(selection.correlated_pairs(_matrix(spark, sf, RANKED)), 8, "value")


@query(
    "j6_attach_correlates",
    f"""WITH {_welch_sql(['principal', 'count_nsf_90_days', 'balance_current'])}, {PAIRS_SQL}
SELECT variable, round(abs(t), 8) AS abs_t, var1, var2, value FROM tt LEFT JOIN pairs ON variable = var1""",
    over="profiles",
)
def j6_attach_correlates(spark: SparkSession, sf: str) -> DataFrame:
    variables = selection.welch_t(_labelled(spark, sf), ["principal", "count_nsf_90_days", "balance_current"], "status")
    pairs = selection.correlated_pairs(_matrix(spark, sf, RANKED))
    attached = joins.attach_correlates(variables.select("variable", "abs_t"), pairs)
    return rounded(attached, 8, "abs_t", "value")


@query(
    "a29_subset_importance",
    """WITH s AS (SELECT [p_brand, p_type, concat('size', p_size % 5)] AS features, p_retailprice / 3000 AS loss FROM part)
SELECT f AS feature, count(*) AS draws, round(avg(loss), 8) AS average_loss FROM (SELECT unnest(features) AS f, loss FROM s) q GROUP BY f""",
)
def a29_subset_importance(spark: SparkSession, sf: str) -> DataFrame:
    size = F.concat(F.lit("size"), F.col("p_size") % 5)
    losses = table(spark, sf, "part").select(
        F.array("p_brand", "p_type", size).alias("features"), (F.col("p_retailprice") / 3000).alias("loss")
    )
    return rounded(selection.subset_importance(losses), 8, "average_loss")


@query(
    "ordered_ranked_values",
    """SELECT p, n, n_before, n_before + (n + 1) / 2 AS average_rank FROM (SELECT p, count(*) AS n,
  CAST(sum(count(*)) OVER (ORDER BY p) - count(*) AS BIGINT) AS n_before FROM scored GROUP BY p) q""",
    over="scored",
)
def ordered_ranked_values(spark: SparkSession, sf: str) -> DataFrame:
    """The ranking under AUC, percentiles and rank correlation."""
    return ordered.ranked_values(_scored(spark, sf), "p").withColumn("n_before", F.col("n_before").cast("bigint"))
