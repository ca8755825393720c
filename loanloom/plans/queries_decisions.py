"""Registered queries: transaction rules, documents, thresholds and decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loanloom.functions import text
from loanloom.operators import decision, distribution, history, joins, profile, rules
from loanloom.plans.registry import query
from loanloom.session import shared_dir
from loanloom.sources import documents, validation
from loanloom.sources.views import table, view


def _pattern(alternatives: list[str]) -> str:
    return text.any_of(alternatives).replace("'", "''")


STOP_SQL = f"regexp_matches(description, '{_pattern(text.STOP_PAYMENT_ALTERNATIVES)}', 'i')"
NSF_SQL = f"regexp_matches(description, '{_pattern(text.NSF_ALTERNATIVES)}', 'i')"
LAWYER_SQL = f"regexp_matches(description, '{_pattern(text.LAWYER_ALTERNATIVES)}', 'i')"
CLASS_SQL = f"CASE WHEN {STOP_SQL} THEN 'stop_payment' WHEN {LAWYER_SQL} THEN 'lawyer' WHEN {NSF_SQL} THEN 'nsf' END"


def _transactions(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "transactions")


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "requests")


@query("r1_stop_payment", f"SELECT trx_id, {STOP_SQL} AS matched FROM transactions", over="transactions")
def r1_stop_payment(spark: SparkSession, sf: str) -> DataFrame:
    return _transactions(spark, sf).select("trx_id", text.is_stop_payment(F.col("description")).alias("matched"))


@query("r2_nsf", f"SELECT trx_id, {NSF_SQL} AS matched FROM transactions", over="transactions")
def r2_nsf(spark: SparkSession, sf: str) -> DataFrame:
    return _transactions(spark, sf).select("trx_id", text.is_nsf(F.col("description")).alias("matched"))


@query("r3_lawyer", f"SELECT trx_id, {LAWYER_SQL} AS matched FROM transactions", over="transactions")
def r3_lawyer(spark: SparkSession, sf: str) -> DataFrame:
    return _transactions(spark, sf).select("trx_id", text.is_lawyer(F.col("description")).alias("matched"))


@query("r4_transaction_class", f"SELECT trx_id, description, {CLASS_SQL} AS trx_class FROM transactions", over="transactions")
def r4_transaction_class(spark: SparkSession, sf: str) -> DataFrame:
    return rules.classify_transactions(_transactions(spark, sf)).select("trx_id", "description", "trx_class")


def flags_sql(long_days: int, short_days: int) -> str:
    since = lambda days: f"trx_date >= request_date - {days}"
    return f"""classed AS (SELECT request_id, trx_date, {CLASS_SQL} AS trx_class FROM transactions),
flags AS (SELECT r.request_id,
  CAST(count(*) FILTER (WHERE trx_class = 'stop_payment' AND {since(long_days)}) AS BIGINT) AS stop_payments_long,
  CAST(count(*) FILTER (WHERE trx_class = 'nsf' AND {since(long_days)}) AS BIGINT) AS nsf_long,
  CAST(count(*) FILTER (WHERE trx_class = 'nsf' AND {since(short_days)}) AS BIGINT) AS nsf_short,
  CAST(count(*) FILTER (WHERE trx_class = 'lawyer' AND {since(long_days)}) AS BIGINT) AS lawyer_long
  FROM requests r LEFT JOIN classed c ON r.request_id = c.request_id GROUP BY r.request_id)"""


REFUSE_SQL = "(stop_payments_long >= 4 OR nsf_long >= 8 OR nsf_short >= 6 OR lawyer_long >= 1)"


@query("r5_transaction_flags", f"WITH {flags_sql(90, 30)} SELECT * FROM flags", over="requests transactions")
def r5_transaction_flags(spark: SparkSession, sf: str) -> DataFrame:
    return rules.transaction_flags(_requests(spark, sf), _transactions(spark, sf))


@query("r5_transaction_flags_10_3", f"WITH {flags_sql(10, 3)} SELECT * FROM flags", over="requests transactions")
def r5_transaction_flags_10_3(spark: SparkSession, sf: str) -> DataFrame:
    return rules.transaction_flags(_requests(spark, sf), _transactions(spark, sf), 10, 3)


@query(
    "r5_account_flags",
    f"""WITH classed AS (SELECT request_id, trx_date, {CLASS_SQL} AS trx_class FROM transactions)
SELECT t.trx_id, t.request_id AS account_id, t.trx_date AS request_date,
  count(*) FILTER (WHERE trx_class = 'stop_payment') AS stop_payments_long, count(*) FILTER (WHERE trx_class = 'nsf') AS nsf_long,
  count(*) FILTER (WHERE trx_class = 'nsf' AND c.trx_date >= t.trx_date - 3) AS nsf_short, count(*) FILTER (WHERE trx_class = 'lawyer') AS lawyer_long
FROM transactions t LEFT JOIN classed c ON c.request_id = t.request_id AND c.trx_date BETWEEN t.trx_date - 10 AND t.trx_date GROUP BY ALL""",
    over="transactions",
)
def r5_account_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Each transaction asks for the counts of its account until its own day: as many requests as rows."""
    trx = _transactions(spark, sf).withColumnRenamed("request_id", "account_id")
    asked = trx.select("trx_id", "account_id", F.col("trx_date").alias("request_date"))
    return rules.account_flags(asked, rules.account_history(trx), 10, 3, until_request=True)


@query("r5_account_flags_stored", f"WITH {flags_sql(10, 3)} SELECT * FROM flags", over="requests transactions")
def r5_account_flags_stored(spark: SparkSession, sf: str) -> DataFrame:
    """A history stored after one half of the transactions, the other half added to it, and the requests looked up in that."""
    trx, path = _transactions(spark, sf), shared_dir(spark, "history")
    first = F.col("trx_id") % 2 == 0
    rules.account_history(trx.filter(first), "request_id").write.parquet(path)
    late = rules.daily_classes(trx.filter(~first))
    counted = history.merged(spark.read.parquet(path), late, "request_id", rules.CLASSES)
    return rules.account_flags(_requests(spark, sf), counted, 10, 3, account="request_id").drop("request_date")


@query(
    "r6_auto_refuse_computed",
    f"WITH {flags_sql(10, 3)} SELECT request_id, {REFUSE_SQL} AS auto_refuse_computed FROM flags",
    over="requests transactions",
)
def r6_auto_refuse_computed(spark: SparkSession, sf: str) -> DataFrame:
    flagged = rules.auto_refuse_computed(_requests(spark, sf), _transactions(spark, sf), long_days=10, short_days=3)
    return flagged.select("request_id", "auto_refuse_computed")


# Requests with the account history that the basic rule needs.
REQUEST_HISTORY = """SELECT r.request_id, r.request_date, a.account_age_days, a.count_nsf_90_days, a.count_nsf_30_days,
  a.count_stop_payment_90_days FROM {requests} r JOIN {applications} a ON r.request_id = a.application_id"""
BASIC_SQL = "(account_age_days < 85 OR count_nsf_90_days > 8 OR count_nsf_30_days > 6 OR count_stop_payment_90_days > 4)"


@query(
    "r7_auto_refuse",
    f"""WITH history AS ({REQUEST_HISTORY.format(requests="requests", applications="applications")}), {flags_sql(10, 3)}
SELECT h.request_id, {BASIC_SQL} AS auto_refuse_basic, {REFUSE_SQL} AS auto_refuse_computed, {BASIC_SQL} OR {REFUSE_SQL} AS auto_refuse
FROM history h JOIN flags f ON h.request_id = f.request_id""",
    over="requests transactions applications",
)
def r7_auto_refuse(spark: SparkSession, sf: str) -> DataFrame:
    history = spark.sql(REQUEST_HISTORY, requests=_requests(spark, sf), applications=view(spark, sf, "applications"))
    refused = rules.auto_refuse(history, _transactions(spark, sf), long_days=10, short_days=3)
    return refused.select("request_id", "auto_refuse_basic", "auto_refuse_computed", "auto_refuse")


@query(
    "j9_lookback_join",
    """SELECT r.request_id, r.request_date, trx_id, trx_date FROM requests r JOIN transactions t
ON r.request_id = t.request_id AND trx_date >= request_date - 10""",
    over="requests transactions",
)
def j9_lookback_join(spark: SparkSession, sf: str) -> DataFrame:
    trx = _transactions(spark, sf).select("request_id", "trx_id", "trx_date")
    return joins.lookback_join(_requests(spark, sf), trx, 10)


@query(
    "s6_latest_thresholds",
    """SELECT refusal_threshold, default_threshold, created_at FROM threshold_records ORDER BY created_at DESC, record_id DESC LIMIT 1""",
    over="threshold_records",
)
def s6_latest_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    newest = joins.latest_thresholds(view(spark, sf, "threshold_records"), tie="record_id")
    return newest.select("refusal_threshold", "default_threshold", "created_at")


@query(
    "j10_thresholds_latest",
    """SELECT application_id, t.refusal_threshold, t.default_threshold FROM applications,
(SELECT * FROM threshold_records ORDER BY created_at DESC, record_id DESC LIMIT 1) t""",
    over="applications threshold_records",
)
def j10_thresholds_latest(spark: SparkSession, sf: str) -> DataFrame:
    apps = view(spark, sf, "applications").select("application_id")
    return joins.with_thresholds(apps, view(spark, sf, "threshold_records"), tie="record_id")


@query(
    "j10_thresholds_as_of",
    """WITH asked AS (SELECT request_id, CAST(request_date - 25 AS DATE) AS request_date FROM requests),
v AS (SELECT *, row_number() OVER (PARTITION BY CAST(created_at AS DATE) ORDER BY created_at DESC, record_id DESC) AS rn FROM threshold_records)
SELECT a.request_id, a.request_date, v.refusal_threshold, v.default_threshold
FROM asked a ASOF LEFT JOIN (SELECT CAST(created_at AS DATE) AS day, refusal_threshold, default_threshold FROM v WHERE rn = 1) v ON a.request_date >= v.day""",
    over="requests threshold_records",
)
def j10_thresholds_as_of(spark: SparkSession, sf: str) -> DataFrame:
    asked = _requests(spark, sf).withColumn("request_date", F.date_sub("request_date", 25))
    return joins.with_thresholds(asked, view(spark, sf, "threshold_records"), as_of="request_date", tie="record_id")


@query(
    "j10_thresholds_at_time",
    """WITH asked AS (SELECT request_id, CAST(request_date - 25 AS TIMESTAMP) + INTERVAL 1 HOUR * (request_id % 24) AS asked_at FROM requests),
v AS (SELECT *, row_number() OVER (PARTITION BY created_at ORDER BY record_id DESC) AS rn FROM threshold_records)
SELECT a.request_id, v.refusal_threshold, v.default_threshold
FROM asked a ASOF LEFT JOIN (SELECT created_at, refusal_threshold, default_threshold FROM v WHERE rn = 1) v ON a.asked_at >= v.created_at""",
    over="requests threshold_records",
)
def j10_thresholds_at_time(spark: SparkSession, sf: str) -> DataFrame:
    """Requests at some hour get the last version created until then."""
    at = F.date_sub("request_date", 25).cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("request_id") % 24).cast("int"))
    asked = _requests(spark, sf).select("request_id", at.alias("asked_at"))
    return joins.with_thresholds(asked, view(spark, sf, "threshold_records"), as_of="asked_at", tie="record_id").drop("asked_at")


def request_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One document per event: none, one or two accounts, the first with two transactions."""
    c = F.col
    trx = lambda suffix, shift: F.struct(
        F.date_add(c("trx_date"), shift).alias("Date"),
        F.lit(None).cast("string").alias("Code"),
        c("description").alias("Description"),
        c("amount").alias("Debit"),
        F.lit(None).cast("double").alias("Credit"),
        (c("amount") * 2).alias("Balance"),
        F.concat(c("trx_id").cast("string"), F.lit(suffix)).alias("Id"),
    )
    holder = F.struct(
        F.concat(F.lit("Holder "), c("request_id")).alias("Name"),
        F.create_map(F.lit("City"), F.concat(F.lit("Town "), c("request_id") % 9)).alias("Address"),
        F.concat(c("request_id"), F.lit("@example.org")).alias("Email"),
        F.lit("000").alias("PhoneNumber"),
    )

    def account(name: str, *transactions):
        text_field = lambda n: F.lit(None).cast("string").alias(n)
        return F.struct(
            F.array(*transactions).alias("Transactions"),
            *[text_field(n) for n in ("TransitNumber", "InstitutionNumber", "Title", "AccountNumber", "LastFourDigits")],
            F.create_map(F.lit("Current"), c("amount").cast("string")).alias("Balance"),
            F.lit("Operations").alias("Category"),
            F.lit("Chequing").alias("Type"),
            F.lit("CAD").alias("Currency"),
            holder.alias("Holder"),
            F.concat(c("trx_id").cast("string"), F.lit(name)).alias("Id"),
        )

    first, second = account("x", trx("a", 0), trx("b", 1)), account("y", trx("c", 2))
    accounts = (
        F.when(c("trx_id") % 7 == 0, F.array().cast(documents.DOCUMENT["Accounts"].dataType))
        .when(c("trx_id") % 3 == 0, F.array(first, second))
        .otherwise(F.array(first))
    )
    status = F.when(c("trx_id") % 10 == 0, 500).otherwise(200)
    document = F.struct(status.alias("HttpStatusCode"), accounts.alias("Accounts"))
    return _transactions(spark, sf).select(c("trx_id").alias("document_id"), "request_id", document.alias("document"))


FLAT_SQL = """SELECT trx_id AS document_id, concat(trx_id, 'x') AS account_id, concat(trx_id, 'a') AS trx_id, trx_date, description, amount AS debit FROM transactions WHERE trx_id % 7 <> 0
UNION ALL SELECT trx_id, concat(trx_id, 'x'), concat(trx_id, 'b'), CAST(trx_date + 1 AS DATE), description, amount FROM transactions WHERE trx_id % 7 <> 0
UNION ALL SELECT trx_id, concat(trx_id, 'y'), concat(trx_id, 'c'), CAST(trx_date + 2 AS DATE), description, amount FROM transactions WHERE trx_id % 7 <> 0 AND trx_id % 3 = 0"""
FLAT_COLUMNS = ["document_id", "account_id", "trx_id", "trx_date", "description", "debit"]


@query("s5_flatten_transactions", FLAT_SQL, over="transactions")
def s5_flatten_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return documents.flatten_transactions(request_documents(spark, sf), ["document_id"]).select(*FLAT_COLUMNS)


@query(
    "s5_flatten_keep_empty",
    FLAT_SQL + " UNION ALL SELECT trx_id, NULL, NULL, NULL, NULL, NULL FROM transactions WHERE trx_id % 7 = 0",
    over="transactions",
)
def s5_flatten_keep_empty(spark: SparkSession, sf: str) -> DataFrame:
    flat = documents.flatten_transactions(request_documents(spark, sf), ["document_id"], keep_empty=True)
    return flat.select(*FLAT_COLUMNS)


@query(
    "s9_account_holders",
    """SELECT trx_id AS document_id, concat('Holder ', request_id) AS name, concat('Town ', request_id % 9) AS city,
  concat(request_id, '@example.org') AS email, '000' AS phone_number FROM transactions WHERE trx_id % 10 <> 0 AND trx_id % 7 <> 0""",
    over="transactions",
)
def s9_account_holders(spark: SparkSession, sf: str) -> DataFrame:
    holders = documents.account_holders(request_documents(spark, sf), ["document_id"])
    return holders.select("document_id", "name", F.col("address")["City"].alias("city"), "email", "phone_number")


@query(
    "r5_document_flags",
    f"""WITH flat AS ({FLAT_SQL}), classed AS (SELECT document_id, trx_date, {CLASS_SQL} AS trx_class FROM flat),
asked AS (SELECT trx_id AS document_id, CAST(DATE '2024-01-10' + CAST(trx_id % 20 AS INT) AS DATE) AS request_date FROM transactions)
SELECT a.document_id,
  CAST(count(*) FILTER (WHERE trx_class = 'stop_payment' AND trx_date >= request_date - 10) AS BIGINT) AS stop_payments_long,
  CAST(count(*) FILTER (WHERE trx_class = 'nsf' AND trx_date >= request_date - 10) AS BIGINT) AS nsf_long,
  CAST(count(*) FILTER (WHERE trx_class = 'nsf' AND trx_date >= request_date - 3) AS BIGINT) AS nsf_short,
  CAST(count(*) FILTER (WHERE trx_class = 'lawyer' AND trx_date >= request_date - 10) AS BIGINT) AS lawyer_long
FROM asked a LEFT JOIN classed c ON a.document_id = c.document_id GROUP BY a.document_id""",
    over="transactions",
)
def r5_document_flags(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_add(F.lit("2024-01-10").cast("date"), (F.col("document_id") % 20).cast("int"))
    asked = request_documents(spark, sf).withColumn("request_date", day)
    return rules.document_flags(asked, long_days=10, short_days=3).select("document_id", *rules.FLAGS)


@query(
    "s15_validate_documents",
    """SELECT trx_id AS document_id, concat_ws('; ',
  CASE WHEN trx_id % 13 = 0 THEN 'HttpStatusCode: missing' END, CASE WHEN trx_id % 17 = 0 AND trx_id % 7 <> 0 THEN 'holder: not an email' END,
  CASE WHEN trx_id % 19 = 0 AND trx_id % 7 <> 0 THEN 'transaction: field missing' END) AS errors FROM transactions""",
    over="transactions",
)
def s15_validate_documents(spark: SparkSession, sf: str) -> DataFrame:
    df, n = request_documents(spark, sf), F.col("document_id")
    spoil = lambda a: a.withField("Holder.Email", F.when(n % 17 == 0, "nobody").otherwise(a["Holder"]["Email"])).withField(
        "Transactions", F.transform(a["Transactions"], lambda t: t.withField("Description", F.when(n % 19 != 0, t["Description"])))
    )
    document = F.struct(
        F.when(n % 13 != 0, F.col("document.HttpStatusCode")).alias("HttpStatusCode"),
        F.transform("document.Accounts", spoil).alias("Accounts"),
    )
    checked = df.select("document_id", document.alias("document"))
    return checked.select("document_id", F.array_join(validation.document_errors(), "; ").alias("errors"))


def scored_percentiles(spark: SparkSession, sf: str) -> list[list[float]]:
    scores = view(spark, sf, "application_scores")
    return distribution.percentile_values_of(scores, ["refusal_score", "default_score"])


def _edges_sql(column: str, source: str) -> str:
    return f"(SELECT quantile_cont({column}, [{', '.join(str(p / 100) for p in distribution.PERCENTILES)}]) FROM {source})"


def bucket_sql(score: str, edges: str) -> str:
    return f"CAST((len(list_filter({edges}, lambda e: e <= {score})) + 1) * 5 AS INT)"


@query(
    "w4_percentile_bucket",
    f"""WITH e AS (SELECT {_edges_sql('p', 'scored')} AS edges)
SELECT loan_id, p, {bucket_sql('p', 'edges')} AS percentile FROM scored, e""",
    over="scored",
)
def w4_percentile_bucket(spark: SparkSession, sf: str) -> DataFrame:
    scored = view(spark, sf, "scored")
    values = distribution.percentile_values(scored, "p")
    return distribution.percentile_bucket(scored, "p", values).select("loan_id", "p", "percentile")


@query(
    "m11_classify_threshold",
    "SELECT loan_id, p, CASE WHEN p >= 0.55 THEN 1 ELSE 0 END AS y_pred FROM scored",
    over="scored",
)
def m11_classify_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return decision.classify(view(spark, sf, "scored"), "p", threshold=0.55).select("loan_id", "p", "y_pred")


@query(
    "m11_classify_percentile",
    "SELECT loan_id, p, CASE WHEN p >= (SELECT quantile_cont(p, 0.8) FROM scored) THEN 1 ELSE 0 END AS y_pred FROM scored",
    over="scored",
)
def m11_classify_percentile(spark: SparkSession, sf: str) -> DataFrame:
    return decision.classify(view(spark, sf, "scored"), "p", percentile=80).select("loan_id", "p", "y_pred")


HISTORY_COLUMNS = [
    "application_id", "request_date", "account_age_days", "count_nsf_90_days", "count_nsf_30_days",
    "count_stop_payment_90_days", "balance_min",
]

UNDERWRITE_SQL = f"""WITH requests AS (SELECT application_id AS request_id, request_date FROM applications),
{flags_sql(90, 30)},
thr AS (SELECT CAST(round(refusal_threshold * 100) AS INT) AS rk, CAST(round(default_threshold * 100) AS INT) AS dk
  FROM threshold_records ORDER BY created_at DESC, record_id DESC LIMIT 1),
e AS (SELECT {_edges_sql('refusal_score', 'application_scores')} AS re, {_edges_sql('default_score', 'application_scores')} AS de),
j AS (SELECT a.application_id, s.refusal_score AS rs, s.default_score AS ds, {BASIC_SQL} OR {REFUSE_SQL} AS auto,
    (balance_min IS NULL OR balance_min >= -5000) AND a.request_date IS NOT NULL AND account_age_days > 0 AS passes,
    {bucket_sql('s.refusal_score', 're')} AS rp, {bucket_sql('s.default_score', 'de')} AS dp,
    s.refusal_score >= re[CAST(rk / 5 AS INT)] OR s.default_score >= de[CAST(dk / 5 AS INT)] AS over_cut
  FROM applications a JOIN flags f ON a.application_id = f.request_id JOIN application_scores s ON a.application_id = s.application_id, thr, e)
SELECT application_id, CASE WHEN auto THEN 'refuse' WHEN NOT passes THEN 'n/a' WHEN over_cut THEN 'refuse' ELSE 'accept' END AS uw_decision,
  CASE WHEN auto THEN 1 WHEN NOT passes THEN 0 ELSE round((rs + ds) / 2, 10) END::DOUBLE AS score,
  CASE WHEN auto THEN 100 WHEN NOT passes THEN 0 ELSE (rp + dp) / 2 END::DOUBLE AS percentile,
  CASE WHEN auto THEN 'auto_refuse' WHEN NOT passes THEN 'Empty dataframe after filtering' END AS info,
  CASE WHEN NOT auto AND passes THEN rs END AS refusal_score, CASE WHEN NOT auto AND passes THEN ds END AS default_score,
  CASE WHEN NOT auto AND passes THEN rp END AS refusal_percentile, CASE WHEN NOT auto AND passes THEN dp END AS default_percentile FROM j"""
DECISION_COLUMNS = [
    "application_id", "uw_decision", "score", "percentile", "info", "refusal_score", "default_score",
    "refusal_percentile", "default_percentile",
]


def underwritten(spark: SparkSession, sf: str) -> DataFrame:
    trx = _transactions(spark, sf).withColumnRenamed("request_id", "application_id")
    return decision.underwrite(
        view(spark, sf, "applications").select(*HISTORY_COLUMNS),
        trx,
        view(spark, sf, "application_scores"),
        view(spark, sf, "threshold_records"),
        *scored_percentiles(spark, sf),
        tie="record_id",
    )


@query("m12_underwrite", UNDERWRITE_SQL, over="applications transactions application_scores threshold_records")
def m12_underwrite(spark: SparkSession, sf: str) -> DataFrame:
    return underwritten(spark, sf).withColumn("score", F.round("score", 10)).select(*DECISION_COLUMNS)


@query(
    "m13_combined_decision",
    """WITH cuts AS (SELECT quantile_cont(refusal_score, 0.25) AS rc, quantile_cont(default_score, 0.9) AS dc FROM application_scores)
SELECT application_id, CASE WHEN refusal_score >= rc OR default_score >= dc THEN 'refuse' ELSE 'accept' END AS uw_decision FROM application_scores, cuts""",
    over="application_scores",
)
def m13_combined_decision(spark: SparkSession, sf: str) -> DataFrame:
    refusal, default = scored_percentiles(spark, sf)
    cuts = dict(zip(distribution.PERCENTILES, refusal))[25], dict(zip(distribution.PERCENTILES, default))[90]
    return decision.combined_decision(view(spark, sf, "application_scores"), *cuts).select("application_id", "uw_decision")


@query(
    "m13_decision_share",
    """WITH cuts AS (SELECT quantile_cont(refusal_score, 0.25) AS rc, quantile_cont(default_score, 0.9) AS dc FROM application_scores),
d AS (SELECT CASE WHEN refusal_score >= rc OR default_score >= dc THEN 'refuse' ELSE 'accept' END AS uw_decision FROM application_scores, cuts)
SELECT uw_decision, count(*) AS n, round(count(*) / (SELECT count(*) FROM d), 10) AS share FROM d GROUP BY uw_decision""",
    over="application_scores",
)
def m13_decision_share(spark: SparkSession, sf: str) -> DataFrame:
    shares = profile.value_counts(m13_combined_decision(spark, sf), ["uw_decision"], normalize=True)
    return shares.withColumn("share", F.round("share", 10))


@query(
    "m14_threshold_key",
    """WITH t AS (SELECT event_id, event_id % 101 / 100.0::DOUBLE AS threshold FROM events),
k AS (SELECT *, CAST(round(threshold * 100) AS INT) AS k FROM t)
SELECT event_id, threshold, CASE WHEN k BETWEEN 5 AND 95 AND k % 5 = 0 THEN k END AS step,
  CASE WHEN NOT (k BETWEEN 5 AND 95 AND k % 5 = 0) THEN 'threshold is not one of the percentiles 5, 10, ... 95' END AS step_error FROM k""",
)
def m14_threshold_key(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").select("event_id", (F.col("event_id") % 101 / F.lit(100.0)).alias("threshold"))
    return decision.with_threshold_key(df, "threshold", "step")


@query(
    "m16_false_negatives",
    "SELECT loan_id, p, profit FROM scored WHERE y = 1 AND p < 0.55",
    over="scored",
)
def m16_false_negatives(spark: SparkSession, sf: str) -> DataFrame:
    flagged = decision.classify(view(spark, sf, "scored"), "p", threshold=0.55)
    return decision.false_negatives(flagged).select("loan_id", "p", "profit")
