import datetime as dt
import random

from pyspark.sql import functions as F

from loanloom.operators import decision, rules
from loanloom.sources import decision_log
from loanloom.streaming import applications, decisions, flags

ASKED = "application_id long, request_id string, asked_at timestamp, nsf_long string, ts int"
TRX = "trx_id long, request_id string, ts timestamp, description string"
TEXTS = ["NSF", "RTN FUNDS HELD", "Bingham Law", "groceries"]
START = dt.datetime(2024, 3, 1)


def at(day, hour=1):
    return START + dt.timedelta(days=day, hours=hour)


def put(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def streamed(spark, tmp_path):
    read = lambda folder, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / folder))
    return applications.flagged_applications(read("asked", ASKED), read("trx", TRX), "5 days", 10, 3)


def run(spark, tmp_path):
    flags.write_updates(streamed(spark, tmp_path), str(tmp_path / "out"), str(tmp_path / "chk"), mode="append").awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).drop("batch_id").collect()
    return {r.application_id: r for r in rows}, len(rows)


def close(spark, tmp_path):
    """Rows far ahead in both streams, behind which all before are settled."""
    put(spark, tmp_path / "asked", [(-1, "end", at(900), None, 0)], ASKED)
    put(spark, tmp_path / "trx", [(-1, "end", at(900), "NSF")], TRX)


def expected(asked, trx):
    found, seen = {}, {}
    for i, account, when, _, _ in asked:
        if i is not None and when is not None:
            seen[i] = (account, when)
    own = {t[0]: t for t in trx if t[1] is not None and t[2] is not None}
    for i, (account, when) in seen.items():
        days = lambda t: (when.date() - t[2].date()).days
        count = lambda description, most: sum(t[1] == account and t[3] == description and 0 <= days(t) <= most for t in own.values())
        found[i] = (count("RTN FUNDS HELD", 10), count("NSF", 10), count("NSF", 3), count("Bingham Law", 10))
    return found


def test_streams_equal_batch_over_a_restart(spark, tmp_path):
    rng = random.Random(8)
    day = lambda i: at(i // 5 + rng.randrange(-2, 3), rng.randrange(24))
    asked = [(i, rng.choice(["a", "b", "c", None]), day(i), "x", 7) for i in range(100)] + [(500, "a", None, "x", 7), (None, "a", at(3), "x", 7)]
    trx = [(i, rng.choice(["a", "b", "d", None]), day(i // 2), rng.choice(TEXTS)) for i in range(200)] + [(900, "a", None, "NSF")]
    for part in (0, 1):
        put(spark, tmp_path / "asked", asked[part * 50 : 50 if not part else None] + asked[:2] * (1 - part), ASKED)
        put(spark, tmp_path / "trx", trx[part * 100 : 100 if not part else None], TRX)
        run(spark, tmp_path)
    close(spark, tmp_path)
    got, n = run(spark, tmp_path)
    want = expected(asked, trx)
    assert n == len(got) and {i: tuple(r[f] for f in rules.FLAGS) for i, r in got.items()} == want
    assert {r.ts for r in got.values()} == {7}
    batch = applications.flagged_applications(spark.createDataFrame(asked, ASKED), spark.createDataFrame(trx, TRX), "5 days", 10, 3)
    assert {r.application_id: tuple(r[f] for f in rules.FLAGS) for r in batch.collect()} == want


def test_late_transactions_within_the_delay_count(spark, tmp_path):
    put(spark, tmp_path / "asked", [(1, "a", at(20), None, 0), (2, "none", at(20), None, 0)], ASKED)
    put(spark, tmp_path / "trx", [(1, "a", at(20, 0), "NSF")], TRX)
    run(spark, tmp_path)
    put(spark, tmp_path / "trx", [(2, "a", at(17), "NSF"), (3, "a", at(24), "NSF")], TRX)
    run(spark, tmp_path)
    close(spark, tmp_path)
    got, _ = run(spark, tmp_path)
    assert [tuple(got[i][f] for f in rules.FLAGS) for i in (1, 2)] == [(0, 2, 2, 0), (0, 0, 0, 0)]
    put(spark, tmp_path / "trx", [(4, "a", at(20), "NSF")], TRX)
    assert run(spark, tmp_path)[1] == 2


def test_decisions_with_thresholds_of_the_event_time(spark, tmp_path):
    """Two streams to a committed log; each application is judged by the thresholds in force when it was asked."""
    schema = "application_id long, request_id string, asked_at timestamp, balance_min double, account_age_days double, count_nsf_90_days double, count_nsf_30_days double, count_stop_payment_90_days double"
    plain = (0.0, 200.0, 0.0, 0.0, 0.0)
    put(spark, tmp_path / "asked", [(1, "a", at(1), *plain), (2, "a", at(9), *plain), (3, "law", at(9), *plain)], schema)
    put(spark, tmp_path / "asked", [(-1, "end", at(900), *plain)], schema)
    put(spark, tmp_path / "trx", [(1, "law", at(8), "Bingham Law"), (2, "end", at(900), "NSF")], TRX)
    read = lambda folder, kind: spark.readStream.schema(kind).parquet(str(tmp_path / folder))
    values = [i / 100 for i in range(5, 100, 5)]
    scores = spark.createDataFrame([(i, 0.4, 0.4) for i in (1, 2, 3)], "application_id long, refusal_score double, default_score double")
    records = spark.createDataFrame([(at(0), 0.5, 0.5), (at(5), 0.3, 0.3)], "created_at timestamp, refusal_threshold double, default_threshold double")

    def decide_batch(batch):
        dated = batch.withColumn("request_date", F.to_date("asked_at"))
        return decision.underwrite_flagged(dated, scores, records, values, values, as_of="asked_at")

    base = str(tmp_path / "log")
    counted = applications.flagged_applications(read("asked", schema), read("trx", TRX), "5 days")
    decisions.stream_decisions(
        counted, decide_batch, base, str(tmp_path / "chk"), ["application_id", "request_date"], write_batch=decision_log.write_decisions
    ).awaitTermination()
    tables = decision_log.read_all(spark, base, ["logs", "attributes"])
    number = F.get_json_object("attributes_json", "$.application_id").cast("int").alias("n")
    rows = tables["logs"].join(tables["attributes"].select(F.col("decision_id").alias("id"), number), "id").orderBy("n").collect()
    assert [(r.n, r.decision, r["info"]) for r in rows] == [(1, "accept", None), (2, "refuse", None), (3, "refuse", "auto-refuse")]
