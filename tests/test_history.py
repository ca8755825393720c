import datetime as dt
import random

from pyspark.sql import functions as F

from loanloom.operators import history, rules

START = dt.date(2023, 1, 1)
DAILY = "account_id string, trx_date date, a long, b long"
SPANS = {"a_long": ("a", 40), "a_short": ("a", 3), "b_long": ("b", 40)}


def on(n):
    return None if n is None else START + dt.timedelta(days=n)


def expected(rows, account, day, column, days, until):
    if account is None or day is None:
        return 0
    low = day - dt.timedelta(days=days)
    return sum((r[2 if column == "a" else 3] or 0) for r in rows if r[0] == account and r[1] and low <= r[1] and (not until or r[1] <= day))


def test_look_back_equals_brute_force(spark):
    rng = random.Random(5)
    accounts = ["hot"] * 6 + ["u", "v", "w", None]
    rows = [(rng.choice(accounts), on(rng.choice([None, *range(0, 200, 7), *range(60, 130)])), rng.choice([0, 1, 3, None]), rng.randint(-1, 2)) for _ in range(600)]
    asked = [(i, rng.choice([*accounts, "unknown"]), on(rng.choice([None, *range(-50, 260, 3)]))) for i in range(300)]
    asks = spark.createDataFrame(asked, "id int, account_id string, request_date date")
    counted = history.blocks(spark.createDataFrame(rows, DAILY), "account_id", ["a", "b"])
    for until in (False, True):
        got = {r.id: r for r in history.look_back(asks, counted, "account_id", "request_date", SPANS, until).collect()}
        assert len(got) == len(asked)
        for i, account, day in asked:
            assert [got[i][s] for s in SPANS] == [expected(rows, account, day, c, d, until) for c, d in SPANS.values()], (i, account, day, until)


def test_an_account_is_one_row_a_block(spark):
    """However many rows a hot account has, the look-up meets one per block of 32 days."""
    rows = spark.range(50_000).select(
        F.lit("hot").alias("account_id"), F.date_add(F.lit(START), (F.col("id") % 320).cast("int")).alias("trx_date"), F.lit(1).alias("a"), F.lit(0).alias("b")
    )
    counted = history.blocks(rows, "account_id", ["a", "b"])
    assert counted.count() <= 11 and counted.agg(F.max(F.size("days"))).first()[0] <= history.BLOCK_DAYS


def test_history_in_parts_equals_the_whole(spark):
    rng = random.Random(6)
    rows = [(rng.choice("xyz"), on(rng.randrange(150)), rng.randint(0, 2), 1) for _ in range(300)]
    taken_back = [("x", on(10), -1, -1)]
    whole = history.blocks(spark.createDataFrame(rows + taken_back, DAILY), "account_id", ["a", "b"])
    parts = history.blocks(spark.createDataFrame(rows[::2], DAILY), "account_id", ["a", "b"])
    for more in (rows[1::2], taken_back):
        parts = history.merged(parts, spark.createDataFrame(more, DAILY), "account_id", ["a", "b"])
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))


def test_empty_repeated_and_clashing(spark):
    counted = history.blocks(spark.createDataFrame([], DAILY), "account_id", ["a", "b"])
    asks = spark.createDataFrame([("x", on(1), 7, 8, 9)] * 2, "account_id string, request_date date, block int, days int, a_short int")
    got = history.look_back(asks, counted, "account_id", "request_date", SPANS)
    assert got.columns == ["account_id", "request_date", "block", "days", *SPANS]
    assert [tuple(r) for r in got.collect()] == [("x", on(1), 7, 8, 0, 0, 0)] * 2
    assert history.look_back(asks.limit(0), counted, "account_id", "request_date", SPANS).count() == 0


def test_account_flags_equal_flags_per_request(spark):
    rng = random.Random(7)
    texts = ["NSF", "RTN FUNDS HELD", "Bingham Law", "groceries", None]
    trx = spark.createDataFrame([(f"r{rng.randrange(8)}", on(rng.randrange(200)), rng.choice(texts)) for _ in range(400)], "request_id string, trx_date date, description string")
    requests = spark.createDataFrame([(f"r{i}", on(150 + i)) for i in range(9)], "request_id string, request_date date")
    for until in (False, True):
        looked = rules.account_flags(requests, rules.account_history(trx, "request_id"), until_request=until, account="request_id")
        direct = rules.transaction_flags(requests, trx, until_request=until)
        assert sorted(looked.drop("request_date").collect()) == sorted(direct.collect())
