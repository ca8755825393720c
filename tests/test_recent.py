import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from loanloom.operators import rules
from loanloom.streaming import recent

SCHEMA = "trx_id long, request_id string, ts timestamp, description string"
START = dt.datetime(2024, 1, 1)
TEXTS = ["NSF", "RTN FUNDS HELD", "Bingham Law", "groceries"]


def at(day, hour=1):
    return START + dt.timedelta(days=day, hours=hour)


def put(spark, src, rows):
    """One more file of the stream."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)


def run(spark, tmp_path, delay="5 days", long_days=10, short_days=3):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "src"))
    counts = recent.stream_recent_flags(stream, delay, long_days, short_days)
    recent.write_recent(counts, str(tmp_path / "out"), str(tmp_path / "chk")).awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


def told(updates):
    return {r.request_id: tuple(r)[1:] for r in recent.latest(updates).collect()}


def test_ring_equals_counting():
    rng = np.random.default_rng(3)
    for size in (1, 4, 11):
        ring, seen = recent.Ring(size), []
        for _ in range(60):
            days, kinds = np.sort(rng.integers(0, 200, 1)).repeat(5) + rng.integers(-6, 7, 5), rng.integers(0, 3, 5)
            ring.add(days, kinds)
            seen += list(zip(days, kinds))
            assert ring.newest == max(d for d, _ in seen)
            for kind in range(3):
                for back in range(size):
                    assert ring.over(kind, back) == sum(k == kind and ring.newest - back <= d for d, k in seen), (size, kind, back)
            assert ring.counts.shape == (3, size)


def test_stream_equals_batch_over_a_restart(spark, tmp_path):
    """Rows out of order within the delay, in several files; the stream is ended and taken up again between them."""
    rng = random.Random(4)
    rows = [(i, f"r{rng.randrange(4)}", at(i // 10 + rng.randrange(-2, 3), rng.randrange(24)), rng.choice(TEXTS)) for i in range(400)]
    src = str(tmp_path / "src")
    for part in range(0, 400, 100):
        put(spark, src, rows[part : part + 100])
        updates = run(spark, tmp_path)
    trx = spark.createDataFrame(rows, SCHEMA).withColumn("trx_date", F.to_date("ts"))
    newest = rules.classified_only(trx).groupBy("request_id").agg(F.max("trx_date").alias("request_date"))
    expected = rules.account_flags(newest, rules.account_history(trx, "request_id"), 10, 3, True, "request_id")
    assert told(updates) == {r.request_id: tuple(r)[1:] for r in expected.collect()}


def test_late_rows_copies_and_missing_values(spark, tmp_path):
    src = str(tmp_path / "src")
    put(spark, src, [(1, "r", at(0), "NSF"), (1, "r", at(0), "NSF"), (2, None, at(0), "NSF"), (3, "r", None, "NSF"), (4, "r", at(0), None)])
    run(spark, tmp_path)
    put(spark, src, [(5, "r", at(9), "NSF")])
    run(spark, tmp_path)
    put(spark, src, [(6, "r", at(1), "NSF"), (7, "r", at(8), "NSF")])
    assert told(run(spark, tmp_path)) == {"r": (at(9).date(), 0, 3, 2, 0)}


def test_silent_accounts_are_forgotten(spark, tmp_path):
    src = str(tmp_path / "src")
    put(spark, src, [(1, "gone", at(0), "NSF"), (2, "here", at(0), "NSF")])
    run(spark, tmp_path)
    put(spark, src, [(3, "here", at(30), "Bingham Law")])
    updates = run(spark, tmp_path)
    last = updates.filter("request_id = 'gone' AND expired").collect()
    assert [(r.as_of, r.nsf_long) for r in last] == [(at(11).date(), 0)]
    assert told(updates) == {"here": (at(30).date(), 0, 0, 0, 1)}
    put(spark, src, [(4, "gone", at(31), "NSF")])
    assert told(run(spark, tmp_path))["gone"] == (at(31).date(), 0, 1, 1, 0)


def test_empty_stream(spark, tmp_path):
    put(spark, str(tmp_path / "src"), [(1, "r", at(0), "groceries")])
    run(spark, tmp_path, "5 days")
    assert not list((tmp_path / "out").glob("batch_id=*/*.parquet")) or told(spark.read.parquet(str(tmp_path / "out"))) == {}
