import datetime as dt

from pyspark.sql import functions as F

from loanloom.streaming import decisions, flags

SCHEMA = "trx_id long, request_id string, ts timestamp, description string"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def files(spark, tmp_path, *batches):
    """One file per batch, read in this order."""
    src = tmp_path / "src"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(src / f"b{i}"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
    return stream.parquet(str(src))


def run(spark, tmp_path, counts, keys):
    out = str(tmp_path / "out")
    flags.write_updates(counts, out, str(tmp_path / "chk")).awaitTermination()
    rows = flags.latest_updates(spark.read.parquet(out), keys).orderBy(*keys).collect()
    return [tuple(r) for r in rows]


def test_daily_counts_drop_copies_and_late_rows(spark, tmp_path):
    first = [(1, "r", at(1), "NSF"), (1, "r", at(1), "NSF"), (2, "r", at(1, 5), "Bingham Law"), (3, "r", at(20), "groceries"), (4, "r", at(20), "user fees")]
    second = [(5, "r", at(2), "NSF"), (6, "r", at(19), "NSF")]
    stream = files(spark, tmp_path, first, [(9, "q", at(20, 1), "NSF")], second)
    got = run(spark, tmp_path, flags.stream_daily_classes(stream, "5 days"), ["request_id", "trx_date"])
    assert got == [
        ("q", dt.date(2024, 1, 20), 0, 1, 0),
        ("r", dt.date(2024, 1, 1), 0, 1, 1),
        ("r", dt.date(2024, 1, 19), 0, 1, 0),
        ("r", dt.date(2024, 1, 20), 1, 0, 0),
    ]


def test_sliding_windows_equal_batch(spark, tmp_path):
    rows = [(i, f"r{i % 3}", at(1 + i % 25), "NSF" if i % 2 else "User Fees") for i in range(200)]
    stream = files(spark, tmp_path, rows[:100], rows[100:])
    counts = flags.stream_transaction_flags(stream, "60 days", "9 days", "3 days")
    keys = ["request_id", "window_start", "window_end"]
    batch = flags.stream_transaction_flags(spark.createDataFrame(rows, SCHEMA), "60 days", "9 days", "3 days")
    assert run(spark, tmp_path, counts, keys) == [tuple(r) for r in batch.orderBy(*keys).collect()]


def test_decisions_arrive_once(spark, tmp_path):
    src, out, checkpoint = (str(tmp_path / n) for n in ("src", "out", "chk"))
    columns = "application_id long, request_date date"
    put = lambda *ids: spark.createDataFrame([(i, dt.date(2024, 1, 1)) for i in ids], columns).write.mode("append").parquet(src)

    def decide(batch):
        nothing = F.lit(None)
        extra = {c: nothing.cast("double") for c in ("refusal_score", "refusal_percentile", "default_score", "default_percentile")}
        return batch.withColumns({"uw_decision": F.lit("accept"), "info": nothing.cast("string"), **extra})

    def go():
        stream = spark.readStream.schema(columns).parquet(src)
        decisions.stream_decisions(stream, decide, out, checkpoint, ["application_id"]).awaitTermination()
        return spark.read.parquet(f"{out}/logs").count()

    put(1, 2, 3)
    assert go() == 3
    assert go() == 3
    put(4)
    assert go() == 4
