"""Registered queries: write-and-read-back of every sink and source, and the streaming jobs.

Files go to a new folder below the shared folder of the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loanloom.operators import decision, evaluation
from loanloom.plans import queries_decisions as qd
from loanloom.plans.registry import query
from loanloom.session import shared_dir
from loanloom.sources import decision_log, feature_spec, readers, sinks
from loanloom.sources.views import TEXTS, table, view
from loanloom.streaming import applications as streamed_applications, decisions as streamed_decisions, flags as streamed_flags, recent


@query("s1_csv_scan", "SELECT * FROM loans", over="loans")
def s1_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    loans, path = view(spark, sf, "loans"), shared_dir(spark, "csv")
    sinks.write_table(loans, path, "csv")
    return readers.read_table(spark, path, loans.schema)


@query("s1_csv_quoted", "SELECT doc_id, nullif(text, '') AS text FROM documents")
def s1_csv_quoted(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with quotes, commas and line breaks, written with doubled quotes."""
    docs, path = table(spark, sf, "documents").select("doc_id", "text"), shared_dir(spark, "csv")
    sinks.write_table(docs, path, "csv")
    return readers.read_table(spark, path, docs.schema, multi_line=True)


@query("s2_latin1_scan", "SELECT trx_id, description, amount FROM transactions", over="transactions")
def s2_latin1_scan(spark: SparkSession, sf: str) -> DataFrame:
    trx = view(spark, sf, "transactions").select("trx_id", "description", "amount")
    path = shared_dir(spark, "latin1")
    trx.write.option("header", True).option("escape", '"').option("encoding", readers.LATIN_1).csv(path)
    return readers.read_table(spark, path, trx.schema, encoding=readers.LATIN_1)


@query(
    "s3_monthly_scan",
    "SELECT loan_id, principal, CAST(year(release_date) AS INT) AS release_year FROM loans",
    over="loans",
)
def s3_monthly_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Files of several periods, written in one go and read in one scan; the period comes from the path of the row's file."""
    loans, base = view(spark, sf, "loans").select("loan_id", "principal", "release_date"), shared_dir(spark, "periods")
    sinks.write_table(loans.withColumn("outcomes", F.year("release_date")), base, "csv", ["outcomes"])
    df = readers.read_monthly(spark, [f"{base}/outcomes=*"], loans.schema, with_path=True)
    year = F.regexp_extract("source_path", r"outcomes=(\d{4})", 1).cast("int")
    return df.select("loan_id", "principal", year.alias("release_year"))


@query("s7_write_table", "SELECT loan_id, branch, principal, release_date FROM loans", over="loans")
def s7_write_table(spark: SparkSession, sf: str) -> DataFrame:
    loans = view(spark, sf, "loans").select("loan_id", "branch", "principal", "release_date")
    path = shared_dir(spark, "table")
    sinks.write_table(loans, path, partition_by=["branch"])
    return spark.read.parquet(path)


LOG_SQL = f"""SELECT application_id, uw_decision AS decision, replace(info, 'auto_refuse', 'auto-refuse') AS info, refusal_score, refusal_percentile, default_score, default_percentile FROM ({qd.UNDERWRITE_SQL}) d"""


def read_log(spark: SparkSession, base: str) -> DataFrame:
    """Log rows with the application id out of their attributes; filtered-out applications have none."""
    return linked_log(spark.read.parquet(f"{base}/logs"), spark.read.parquet(f"{base}/attributes"))


def linked_log(logs: DataFrame, attributes: DataFrame) -> DataFrame:
    application = F.get_json_object("attributes_json", "$.application_id").cast("bigint").alias("application_id")
    linked = attributes.select(F.col("decision_id").alias("id"), application)
    return logs.join(linked, "id", "left").select(
        "application_id", "decision", "info", "refusal_score", "refusal_percentile", "default_score", "default_percentile"
    )


LOGGED_SQL = LOG_SQL.replace("SELECT application_id,", "SELECT CASE WHEN uw_decision <> 'n/a' THEN application_id END AS application_id,", 1)


@query("s8_write_decisions", LOGGED_SQL, over="applications transactions application_scores threshold_records")
def s8_write_decisions(spark: SparkSession, sf: str) -> DataFrame:
    base = shared_dir(spark, "decisions")
    decided = qd.underwritten(spark, sf).withColumn("organization", F.lit("default"))
    sinks.write_decisions(decided, base, qd.HISTORY_COLUMNS)
    return read_log(spark, base)


@query("s8_committed_log", LOGGED_SQL, over="applications transactions application_scores threshold_records")
def s8_committed_log(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches, one of them written again after a first attempt over all applications, and an attempt that was never committed."""
    base = shared_dir(spark, "decision-log")
    decided = qd.underwritten(spark, sf).withColumn("organization", F.lit("default"))
    even = F.col("application_id") % 2 == 0
    for rows, batch in ((decided, "even"), (decided.filter(~even), "odd"), (decided.filter(even), "even")):
        decision_log.write_decisions(rows, base, qd.HISTORY_COLUMNS, batch_id=batch)
    sinks.write_table(decision_log.read(spark, base, "logs").drop("batch_id"), f"{base}/logs/batch_id=lost/attempt=crashed")
    tables = decision_log.read_all(spark, base, ["logs", "attributes"])
    return linked_log(tables["logs"], tables["attributes"])


@query(
    "s8_account_holders",
    """SELECT trx_id AS application_id, concat('Holder ', request_id) AS name, concat(request_id, '@example.org') AS email FROM transactions
WHERE trx_id % 10 <> 0 AND trx_id % 7 <> 0 AND trx_id % 11 <> 0""",
    over="transactions",
)
def s8_account_holders(spark: SparkSession, sf: str) -> DataFrame:
    """The holder table of the log: none for applications that were filtered out."""
    base = shared_dir(spark, "holders")
    nothing = F.lit(None)
    decided = qd.request_documents(spark, sf).select(
        F.col("document_id").alias("application_id"), F.lit("2024-01-01").cast("date").alias("request_date"),
        F.when(F.col("document_id") % 11 == 0, decision.NOT_SCORED).otherwise(decision.ACCEPT).alias("uw_decision"),
        nothing.cast("string").alias("info"), F.lit("default").alias("organization"), "document",
        *[nothing.cast("double").alias(c) for c in sinks.LOG_COLUMNS],
    )
    sinks.write_decisions(decided, base, ["application_id", "request_date"], "document")
    holders, attributes = spark.read.parquet(f"{base}/account_holder"), spark.read.parquet(f"{base}/attributes")
    application = F.get_json_object("attributes_json", "$.application_id").cast("bigint").alias("application_id")
    return holders.join(attributes.select("decision_id", application), "decision_id").select("application_id", "name", "email")


@query(
    "s10_feature_config",
    """SELECT c_mktsegment AS variable, 'numeric' AS type, min(c_acctbal) AS threshold_min, max(c_acctbal) AS threshold_max FROM customer GROUP BY ALL
UNION ALL SELECT 'status', 'target', NULL, NULL""",
)
def s10_feature_config(spark: SparkSession, sf: str) -> DataFrame:
    """A config table written, read as a feature config, and turned into a table again."""
    rows = table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("variable")).agg(
        F.lit("numeric").alias("type"), F.min("c_acctbal").alias("threshold_min"), F.max("c_acctbal").alias("threshold_max")
    )
    path = shared_dir(spark, "config")
    sinks.write_table(rows.unionByName(feature_spec.FeatureSpec("status", []).to_table(spark)), path, "csv")
    return feature_spec.read_feature_spec(spark, path).to_table(spark)


@query(
    "s12_read_trials",
    "SELECT l_partkey AS record_id, l_quantity AS wall_clock_time, l_discount AS validation_loss, l_tax AS max_depth, l_linestatus AS learner FROM lineitem",
)
def s12_read_trials(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "trials")
    trials = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("record_id"), F.col("l_quantity").alias("wall_clock_time"),
        F.col("l_discount").alias("validation_loss"), F.struct(F.col("l_tax").alias("max_depth")).alias("config"),
        F.col("l_linestatus").alias("learner"),
    )
    closing = table(spark, sf, "region").select(F.col("r_regionkey").alias("curr_best_record_id"))
    sinks.write_table(trials, path, "json")
    sinks.write_table(closing, path, "json", mode="append")
    return readers.read_trials(spark, path).select(
        "record_id", "wall_clock_time", "validation_loss", F.col("config")["max_depth"].alias("max_depth"), "learner"
    )


@query(
    "s13_write_metrics",
    """WITH pred AS (SELECT *, CASE WHEN p > t THEN 1 ELSE 0 END AS y_pred, run_id FROM scored, (VALUES ('loose', 0.8), ('strict', 0.5)) v(run_id, t)),
m AS (SELECT run_id, count(*) FILTER (WHERE y = 1 AND y_pred = 1) / count(*) FILTER (WHERE y_pred = 1) AS precision_1,
  count(*) FILTER (WHERE y = 1 AND y_pred = 1) / count(*) FILTER (WHERE y = 1) AS recall_1 FROM pred GROUP BY run_id)
SELECT run_id, 'precision_1' AS metric, round(precision_1, 10) AS value FROM m UNION ALL SELECT run_id, 'recall_1', round(recall_1, 10) FROM m
UNION ALL SELECT run_id, 'fscore', round(2 * precision_1 * recall_1 / (precision_1 + recall_1), 10) FROM m""",
    over="scored",
)
def s13_write_metrics(spark: SparkSession, sf: str) -> DataFrame:
    path, scored = shared_dir(spark, "metrics"), view(spark, sf, "scored")
    for run_id, threshold in (("loose", 0.8), ("strict", 0.5)):
        sinks.write_metrics(evaluation.precision_recall_f(evaluation.above(scored, "p", threshold)), path, run_id)
    return spark.read.parquet(path).select("run_id", "metric", F.round("value", 10).alias("value"))


@query(
    "s14_export_scored",
    """SELECT p AS y_pred_proba, CASE WHEN p >= 0.55 THEN 1 ELSE 0 END AS y_pred, y AS y_test, loan_id AS test_loan_id, profit AS test_profit FROM scored""",
    over="scored",
)
def s14_export_scored(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "export")
    flagged = decision.classify(view(spark, sf, "scored"), "p", threshold=0.55)
    exported = flagged.withColumn("y_pred_proba", F.col("p")).withColumnRenamed("y", "y_test")
    sinks.export_scored(exported, path, [], ["loan_id", "profit"])
    schema = sinks.scored_export(exported, [], ["loan_id", "profit"]).schema
    return readers.read_table(spark, path, schema)


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One base table as a stream of files, be it one file or a folder of part files: a pattern may name either."""
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parque[t]")


@query("t1_stream_decisions", LOGGED_SQL, over="applications transactions application_scores threshold_records")
def t1_stream_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """All applications through the stream; the written log equals the batch result."""
    base, checkpoint = shared_dir(spark, "stream-decisions"), shared_dir(spark, "stream-checkpoint")
    applications = spark.sql(TEXTS["applications"], orders=_stream(spark, sf, "orders")).select(*qd.HISTORY_COLUMNS)
    trx = view(spark, sf, "transactions").withColumnRenamed("request_id", "application_id")
    scores, thresholds = view(spark, sf, "application_scores"), view(spark, sf, "threshold_records")
    percentiles = qd.scored_percentiles(spark, sf)

    def decide_batch(batch: DataFrame) -> DataFrame:
        return decision.underwrite(batch, trx, scores, thresholds, *percentiles, tie="record_id")

    streamed_decisions.stream_decisions(applications, decide_batch, base, checkpoint, qd.HISTORY_COLUMNS).awaitTermination()
    return read_log(spark, base)


@query("t1_stream_committed", LOGGED_SQL, over="applications transactions application_scores threshold_records")
def t1_stream_committed(spark: SparkSession, sf: str) -> DataFrame:
    """The same stream into a log whose batches are committed."""
    base, checkpoint = shared_dir(spark, "stream-log"), shared_dir(spark, "stream-checkpoint")
    applications = spark.sql(TEXTS["applications"], orders=_stream(spark, sf, "orders")).select(*qd.HISTORY_COLUMNS)
    trx = view(spark, sf, "transactions").withColumnRenamed("request_id", "application_id")
    scores, thresholds = view(spark, sf, "application_scores"), view(spark, sf, "threshold_records")
    percentiles = qd.scored_percentiles(spark, sf)
    streamed_decisions.stream_decisions(
        applications, lambda batch: decision.underwrite(batch, trx, scores, thresholds, *percentiles, tie="record_id"), base, checkpoint,
        qd.HISTORY_COLUMNS, write_batch=decision_log.write_decisions,
    ).awaitTermination()
    tables = decision_log.read_all(spark, base, ["logs", "attributes"])
    return linked_log(tables["logs"], tables["attributes"])


TIMED = TEXTS["transactions"].replace("CAST(ts AS DATE) AS trx_date", "ts, CAST(ts AS DATE) AS trx_date")
WINDOWS_SQL = f"""classed AS (SELECT request_id, trx_date, {qd.CLASS_SQL} AS trx_class FROM transactions),
placed AS (SELECT request_id, trx_class, CAST(epoch(trx_date) // 86400 AS BIGINT) AS day FROM classed WHERE trx_class IS NOT NULL)"""
COUNTS_SQL = ", ".join(f"CAST(count(*) FILTER (WHERE trx_class = '{c}') AS BIGINT) AS {c}" for c in streamed_flags.CLASSES)


@query(
    "t2_stream_flags",
    f"""WITH {WINDOWS_SQL}, spread AS (SELECT request_id, trx_class, day - day % 5 - 5 * k AS start FROM placed, (VALUES (0), (1)) v(k))
SELECT request_id, CAST(DATE '1970-01-01' + CAST(start AS INT) AS DATE) AS window_start, {COUNTS_SQL} FROM spread GROUP BY request_id, start""",
    over="transactions",
)
def t2_stream_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Ten-day windows every five days over the whole event stream."""
    out, checkpoint = shared_dir(spark, "stream-flags"), shared_dir(spark, "stream-checkpoint")
    trx = spark.sql(TIMED, events=_stream(spark, sf, "events"))
    counts = streamed_flags.stream_transaction_flags(trx, "60 days", "10 days", "5 days")
    streamed_flags.write_updates(counts, out, checkpoint).awaitTermination()
    latest = streamed_flags.latest_updates(spark.read.parquet(out), ["request_id", "window_start", "window_end"])
    return latest.select("request_id", F.to_date("window_start").alias("window_start"), *streamed_flags.CLASSES)


@query(
    "t2_stream_daily",
    f"""WITH {WINDOWS_SQL} SELECT request_id, CAST(DATE '1970-01-01' + CAST(day AS INT) AS DATE) AS trx_date, {COUNTS_SQL} FROM placed GROUP BY request_id, day""",
    over="transactions",
)
def t2_stream_daily(spark: SparkSession, sf: str) -> DataFrame:
    out, checkpoint = shared_dir(spark, "stream-daily"), shared_dir(spark, "stream-checkpoint")
    trx = spark.sql(TIMED, events=_stream(spark, sf, "events"))
    streamed_flags.write_updates(streamed_flags.stream_daily_classes(trx, "60 days"), out, checkpoint).awaitTermination()
    return streamed_flags.latest_updates(spark.read.parquet(out), ["request_id", "trx_date"])


@query(
    "t2_stream_recent",
    f"""WITH classed AS (SELECT request_id, trx_date, {qd.CLASS_SQL} AS trx_class FROM transactions),
newest AS (SELECT request_id, max(trx_date) AS as_of FROM classed WHERE trx_class IS NOT NULL GROUP BY request_id)
SELECT n.request_id, n.as_of, count(*) FILTER (WHERE trx_class = 'stop_payment') AS stop_payments_long, count(*) FILTER (WHERE trx_class = 'nsf') AS nsf_long,
  count(*) FILTER (WHERE trx_class = 'nsf' AND trx_date >= as_of - 3) AS nsf_short, count(*) FILTER (WHERE trx_class = 'lawyer') AS lawyer_long
FROM newest n JOIN classed c ON n.request_id = c.request_id AND trx_date >= as_of - 10 GROUP BY ALL""",
    over="transactions",
)
def t2_stream_recent(spark: SparkSession, sf: str) -> DataFrame:
    """Ten and three days up to each account's newest transaction, from rings of daily counts over the whole event stream."""
    out, checkpoint = shared_dir(spark, "stream-recent"), shared_dir(spark, "stream-checkpoint")
    trx = spark.sql(TIMED, events=_stream(spark, sf, "events"))
    recent.write_recent(recent.stream_recent_flags(trx, "60 days", 10, 3), out, checkpoint).awaitTermination()
    return recent.latest(spark.read.parquet(out))


@query(
    "t1_stream_two_streams",
    f"""WITH classed AS (SELECT request_id, trx_date, {qd.CLASS_SQL} AS trx_class FROM transactions)
SELECT t.trx_id AS application_id, t.request_id, count(*) FILTER (WHERE trx_class = 'stop_payment') AS stop_payments_long, count(*) FILTER (WHERE trx_class = 'nsf') AS nsf_long,
  count(*) FILTER (WHERE trx_class = 'nsf' AND c.trx_date >= t.trx_date - 3) AS nsf_short, count(*) FILTER (WHERE trx_class = 'lawyer') AS lawyer_long
FROM transactions t LEFT JOIN classed c ON c.request_id = t.request_id AND c.trx_date BETWEEN t.trx_date - 10 AND t.trx_date GROUP BY ALL""",
    over="transactions",
)
def t1_stream_two_streams(spark: SparkSession, sf: str) -> DataFrame:
    """Every event asks as an application for the counts of its account; events and their copy for the transactions are two streams.

    A closing event far in the future lets the watermark pass the last application; it is itself not given out.
    """
    path, out, checkpoint = (shared_dir(spark, d) for d in ("stream-events", "stream-applications", "stream-checkpoint"))
    events = table(spark, sf, "events")
    closing = events.limit(1).withColumn("event_id", F.lit(-1).cast(events.schema["event_id"].dataType)).withColumn("ts", F.lit("2100-01-01").cast(events.schema["ts"].dataType))
    events.write.parquet(path)
    closing.withColumn("event_type", F.lit("NSF")).write.mode("append").parquet(path)
    stream = lambda: spark.sql(TIMED, events=spark.readStream.schema(events.schema).parquet(path))
    asked = stream().select(F.col("trx_id").alias("application_id"), "request_id", F.col("ts").alias("asked_at"))
    counted = streamed_applications.flagged_applications(asked, stream(), "60 days", 10, 3)
    streamed_flags.write_updates(counted, out, checkpoint, mode="append").awaitTermination()
    return spark.read.parquet(out).drop("batch_id", "asked_at")
