import datetime as dt

import pytest
from pyspark.sql import types as T

from loanloom.operators import decision, rules

DAY = dt.date(2024, 3, 31)


def days_before(n):
    return DAY - dt.timedelta(days=n)


def flags(spark, trx, **kw):
    requests = spark.createDataFrame([("r", DAY), ("empty", DAY)], "request_id string, request_date date")
    df = spark.createDataFrame(trx, "request_id string, trx_date date, description string")
    return {r.request_id: r.asDict() for r in rules.auto_refuse_computed(requests, df, **kw).collect()}


def test_window_edges_and_priority(spark):
    trx = [
        ("r", days_before(90), "NSF"), ("r", days_before(91), "NSF"), ("r", days_before(30), "NSF"), ("r", days_before(31), "NSF"),
        ("r", days_before(-5), "NSF"), ("r", days_before(1), "RTN FUNDS HELD"), ("r", days_before(1), "Aird & Berlis reversal"),
        ("r", days_before(1), "groceries"), ("r", None, "NSF"), ("other", days_before(1), "NSF"),
    ]
    got = flags(spark, trx)
    assert got["r"] == {"request_id": "r", "stop_payments_long": 1, "nsf_long": 4, "nsf_short": 2, "lawyer_long": 1, "auto_refuse_computed": True}
    assert got["empty"]["nsf_long"] == 0 and got["empty"]["auto_refuse_computed"] is False
    assert flags(spark, trx, until_request=True)["r"]["nsf_short"] == 1


@pytest.mark.parametrize(
    "description, age, count, refused",
    [("NSF", 60, 7, False), ("NSF", 60, 8, True), ("NSF", 3, 5, False), ("NSF", 3, 6, True), ("user fees", 3, 3, False), ("user fees", 3, 4, True), ("Stein Monast", 89, 1, True)],
)
def test_refusal_limits(spark, description, age, count, refused):
    assert flags(spark, [("r", days_before(age), description)] * count)["r"]["auto_refuse_computed"] is refused


VALUES = [i / 100 for i in range(5, 100, 5)]


def scored(spark, *rows):
    schema = (
        "application_id int, auto_refuse boolean, balance_min double, account_age_days double, request_date date, "
        "refusal_score double, default_score double, refusal_threshold double, default_threshold double"
    )
    return {r.application_id: r for r in decision.decide(spark.createDataFrame(list(rows), schema), VALUES, VALUES).collect()}


def test_every_outcome(spark):
    ok = (0.0, 100.0, DAY)
    got = scored(
        spark,
        (1, True, *ok, 0.1, 0.1, 0.75, 0.6),
        (2, False, -9000.0, 100.0, DAY, 0.1, 0.1, 0.75, 0.6),
        (3, False, None, 100.0, DAY, 0.1, 0.1, 0.75, 0.6),
        (4, False, *ok, 0.75, 0.1, 0.75, 0.6),
        (5, False, *ok, 0.749, 0.599, 0.75, 0.6),
        (6, False, *ok, 0.1, 0.6, 0.75, 0.6),
        (7, False, *ok, 0.1, 0.1, 0.57, 0.6),
        (8, False, *ok, 0.1, 0.1, None, 0.6),
        (9, False, *ok, None, 0.1, 0.75, 0.6),
        (10, True, None, None, None, None, None, None, None),
    )
    assert {k: r.uw_decision for k, r in got.items()} == {
        1: "refuse", 2: "n/a", 3: "accept", 4: "refuse", 5: "accept", 6: "refuse", 7: "error", 8: "error", 9: "n/a", 10: "refuse"
    }
    assert (got[1].score, got[1].percentile, got[1].info, got[1].refusal_score) == (1.0, 100.0, "auto_refuse", None)
    assert (got[2].score, got[2].percentile, got[2].info) == (0.0, 0.0, "Empty dataframe after filtering")
    assert got[5].score == pytest.approx((0.749 + 0.599) / 2)
    assert (got[5].refusal_percentile, got[5].default_percentile, got[5].percentile) == (75, 60, 67.5)


@pytest.mark.parametrize("threshold, key", [(0.6, 60), (0.75, 75), (0.57, None), (0.58, None), (0.95, 95), (1.0, None), (0.0, None), (None, None), (0.29, None)])
def test_threshold_key(spark, threshold, key):
    df = spark.createDataFrame([(threshold,)], "t double")
    row = decision.with_threshold_key(df, "t", "k").first()
    assert row.k == key and (row.k_error is None) == (key is not None)


def test_classify_needs_exactly_one_cut(spark):
    df = spark.createDataFrame([(0.1,), (0.5,), (None,)], "p double")
    for cuts in ({}, {"threshold": 0.5, "percentile": 50}):
        with pytest.raises(ValueError):
            decision.classify(df, "p", **cuts)
    assert [r.y_pred for r in decision.classify(df, "p", threshold=0.5).collect()] == [0, 1, 0]


def test_underwrite_keeps_every_row(spark):
    columns = "application_id int, request_date date, account_age_days double, count_nsf_90_days double, count_nsf_30_days double, count_stop_payment_90_days double, balance_min double"
    apps = spark.createDataFrame([(i, DAY, 100.0, 0.0, 0.0, 0.0, 0.0) for i in range(5)], columns)
    trx = spark.createDataFrame([(1, days_before(1), "Bingham Law"), (77, days_before(1), "NSF")], "application_id int, trx_date date, description string")
    scores = spark.createDataFrame([(i, 0.2, 0.9 if i == 2 else 0.2) for i in range(4)], "application_id int, refusal_score double, default_score double")
    thresholds = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), 0.05, 0.05), (dt.datetime(2024, 2, 1), 0.75, 0.6)], "created_at timestamp, refusal_threshold double, default_threshold double"
    )
    got = {r.application_id: r.uw_decision for r in decision.underwrite(apps, trx, scores, thresholds, VALUES, VALUES).collect()}
    assert got == {0: "accept", 1: "refuse", 2: "refuse", 3: "accept", 4: "n/a"}
    earlier = thresholds.filter("created_at < '2024-01-15'")
    assert decision.underwrite(apps, trx, scores, earlier, VALUES, VALUES).filter("uw_decision = 'accept'").count() == 0
    none = decision.underwrite(apps, trx, scores, thresholds.limit(0), VALUES, VALUES)
    assert {r.uw_decision for r in none.filter("application_id = 0").collect()} == {"error"}


def test_flags_inside_documents_equal_flags_by_join(spark):
    from loanloom.sources import documents

    names = ["NSF", "user fees", "Bingham Law", "groceries", "RTN FUNDS HELD", None]
    trx = [(days_before(i % 100), None, names[i % 6], 1.0, None, None, str(i)) for i in range(120)] + [(None, None, "NSF", 1.0, None, None, "x")]
    holder = ("n", {}, "e@x.y", "1")
    account = lambda t: (t, None, None, None, None, None, {}, "c", "t", "CAD", holder, "a")
    rows = [("r1", DAY, (200, [account(trx[:60]), account(trx[60:]), account(None)])), ("r2", DAY, None), ("r3", DAY, (200, [])), ("r4", None, (200, [account(trx)]))]
    schema = T.StructType(
        [T.StructField("request_id", T.StringType()), T.StructField("request_date", T.DateType()), T.StructField("document", documents.DOCUMENT)]
    )
    df = spark.createDataFrame(rows, schema)
    flat = documents.flatten_transactions(df, ["request_id"])
    for until in (False, True):
        joined = rules.transaction_flags(df.select("request_id", "request_date"), flat, until_request=until)
        inside = rules.document_flags(df, until_request=until).select(joined.columns)
        assert sorted(map(tuple, inside.collect())) == sorted(map(tuple, joined.collect()))
        assert inside.filter("nsf_long > 0").count() == 1
