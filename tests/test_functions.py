import math

import pytest
from pyspark.sql import functions as F

from loanloom.functions import dates, irr, student_t, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "dob, asked, years",
    [
        ("2000-02-29", "2023-02-28", 23),
        ("2000-02-29", "2024-02-29", 24),
        ("2000-02-29", "2023-03-01", 23),
        ("2000-01-31", "2023-02-28", 23),
        ("2000-06-01", "1999-01-01", -1),
        ("2000-06-02", "2020-06-01", 19),
        ("2000-06-02T10:00:00", "2020-06-02T01:00:00", 20),
        ("nonsense", "2020-06-01", None),
        ("2000-06-02", None, None),
    ],
)
def test_age(spark, dob, asked, years):
    parsed = [dates.parse_date(F.lit(d).cast("string")) for d in (dob, asked)]
    assert one(spark, dates.completed_years(*parsed)) == years


@pytest.mark.parametrize(
    "value, dayfirst, expected",
    [
        ("2023-10-03", False, "2023-10-03"),
        ("3/10/2023", True, "2023-10-03"),
        ("03/10/2023", True, "2023-10-03"),
        ("31/02/2023", True, None),
        ("x", False, None),
    ],
)
def test_parse_date(spark, value, dayfirst, expected):
    got = one(spark, dates.parse_date(F.lit(value), dayfirst))
    assert (got and got.isoformat()) == expected


@pytest.mark.parametrize("days, weeks", [(0, 0), (6, 0), (7, 1), (-1, -1), (-7, -1), (-8, -2)])
def test_weeks(spark, days, weeks):
    assert one(spark, dates.weeks_from_days(F.lit(days))) == weeks


@pytest.mark.parametrize("month, quarter", [(1, "Q1"), (3, "Q1"), (4, "Q2"), (9, "Q3"), (12, "Q4"), (None, None)])
def test_quarter(spark, month, quarter):
    assert one(spark, dates.quarter_name(F.lit(month).cast("int"))) == quarter


CLASSES = {
    "RTN FUNDS HELD": "stop_payment",
    "Internet Banking CORRECTION": "stop_payment",
    "stop  payment fee": "stop_payment",
    "Returned Item Stopped": "stop_payment",
    "rtn stop payt": "stop_payment",
    "NSF return Service Charge": "nsf",
    "xNSF": None,
    "ÉNSF": None,
    "PAP Return": "nsf",
    "EFFET REFUSÉ SANS PROVISION": "nsf",
    "effet refuse sans provision": "nsf",
    "Returned cheque - NSF": "nsf",
    "br0072": "nsf",
    "reversal": "nsf",
    "Bingham Law": "lawyer",
    "Aird & Berlis reversal": "lawyer",
    "boyle&co": "lawyer",
    "The Advocates' Society": None,
    "The Advocates’Society": "lawyer",
    "The Advocates Society": "lawyer",
    "groceries": None,
    "": None,
    None: None,
}


def test_transaction_classes_are_stable(spark):
    df = spark.createDataFrame([(k, v) for k, v in CLASSES.items()], "description string, expected string")
    for _ in range(5):
        rows = df.repartition(3).withColumn("got", text.transaction_class(F.col("description"))).collect()
        assert {r.description: r.got for r in rows} == CLASSES


def test_strip_punctuation(spark):
    assert one(spark, text.without_punctuation(F.lit("Hey! What-s up, é “x” \\ ^_`{|}~$"))) == "Hey Whats up é “x”  "


@pytest.mark.parametrize(
    "flows, expected",
    [([-1000, 300, 420, 680], 0.163406), ([-100, 60, 60], 0.130662), ([10, 5], None), ([-100, 50], -0.5), ([-100, 0, 0, 100], 0.0)],
)
def test_irr(spark, flows, expected):
    array = F.array(*[F.struct(F.lit(i).alias("week"), F.lit(float(a)).alias("amount")) for i, a in enumerate(flows)])
    got = one(spark, irr.irr(array))
    assert got is None if expected is None else got == pytest.approx(expected, abs=1e-6)


def test_irr_over_many_weeks(spark):
    """Hundreds of weeks neither overflow nor divide by zero."""
    flows = [(0, -1000.0)] + [(w, 4.0) for w in range(1, 600)]
    array = F.array(*[F.struct(F.lit(w).alias("week"), F.lit(a).alias("amount")) for w, a in flows])
    rate = one(spark, irr.irr(array))
    assert sum(a / (1 + rate) ** w for w, a in flows) == pytest.approx(0, abs=1e-6)


@pytest.mark.parametrize(
    "t, df, p",
    [(2.0, 10.0, 0.073388), (3.0, 5.0, 0.0300992), (1.0, 1.0, 0.5), (0.0, 7.0, 1.0), (-2.0, 10.0, 0.073388), (3.290527, 1e7, 0.001)],
)
def test_p_value(t, df, p):
    assert student_t.two_sided(t, df) == pytest.approx(p, rel=1e-4)


def test_p_value_tail_and_missing():
    assert 0 <= student_t.two_sided(60.0, 5000.0) < 1e-100
    assert student_t.two_sided(math.nan, 3.0) is None
