import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanloom.operators import cohorts
from loanloom.plans import products, vintage

RNG = np.random.default_rng(9)
N = 300
LOANS = pd.DataFrame(
    {
        "loan_id": range(N),
        "branch": RNG.choice(["a", "b"], N),
        "release_date": [dt.date(2022, 1, 1) + dt.timedelta(days=int(d)) for d in RNG.integers(0, 900, N)],
        "principal": RNG.integers(100, 1000, N).astype(float),
        "status": RNG.choice(["Open", "Fully Paid", "Denied", "Not Taken Up", None], N),
        "product": RNG.choice(["x", "y", "z"], N),
    }
)
PAID = pd.DataFrame({"loan_id": RNG.integers(0, N + 20, 3000), "amount": RNG.integers(1, 90, 3000).astype(float)})
PAID["collection_date"] = [dt.date(2022, 1, 1) + dt.timedelta(days=int(d)) for d in RNG.integers(0, 1200, 3000)]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.createDataFrame(LOANS), spark.createDataFrame(PAID)


def merged():
    out = LOANS[~LOANS.status.isin(["Denied", "Not Taken Up"])]
    df = out.merge(PAID, on="loan_id")
    days = (pd.to_datetime(df.collection_date) - pd.to_datetime(df.release_date)).dt.days
    df["week"] = np.floor(days / 7).astype(int)
    df["release_year"] = pd.to_datetime(df.release_date).dt.year
    df["release_month"] = pd.to_datetime(df.release_date).dt.month
    return df


def cells(df, *columns):
    return {tuple(r[c] for c in columns[:-1]): r[columns[-1]] for r in df.collect()}


def close(got, expected):
    assert got.keys() == expected.keys()
    for k in got:
        assert got[k] == pytest.approx(expected[k]), k


def test_plain_curve(tables):
    report = vintage.vintage_report(*tables, newest_year=2024, origination=False, dense=False)
    df = merged()
    weekly = df[df.week >= 0].groupby(["branch", "release_year", "week"]).amount.sum()
    cumulative = weekly.groupby(level=[0, 1]).cumsum()
    close(cells(report.curve, "branch", "release_year", "weeks_since_release", "cumul_cashflow"), cumulative.to_dict())
    first = cumulative.groupby(level=[0, 1]).transform("first").abs()
    close(
        cells(report.curve, "branch", "release_year", "weeks_since_release", "cumul_normalised"),
        (cumulative / first * 1_000_000).to_dict(),
    )


def test_curve_with_origination_and_dense_weeks(tables):
    report = vintage.vintage_report(*tables, newest_year=2024)
    loans, paid = tables
    rows = vintage.aged_repayments(loans, cohorts.with_origination(cohorts.disbursed(loans), paid))
    weekly = cohorts.weekly_cashflows(rows, ["branch", "release_year"])
    by_rows = cells(weekly, "branch", "release_year", "weeks_since_release", "amount")
    dense = cells(report.weekly, "branch", "release_year", "weeks_since_release", "amount")
    close({k: v for k, v in dense.items() if k in by_rows}, by_rows)
    assert all(v == 0 for k, v in dense.items() if k not in by_rows)
    for branch, year in {k[:2] for k in dense}:
        weeks = sorted(k[2] for k in dense if k[:2] == (branch, year))
        assert weeks == list(range(weeks[-1] + 1))


def test_comparable_weeks(tables):
    report = vintage.vintage_report(*tables, newest_year=2024, origination=False)
    df = merged()
    df = df[df.week >= 0]
    limit = df[df.release_year == 2024].week.max()
    kept = df[(df.week <= limit) & (df.release_month <= 3)].groupby(["branch", "release_year", "week"]).amount.sum()
    close(cells(report.comparable_curve, "branch", "release_year", "weeks_since_release", "amount"), kept.to_dict())
    loans, paid = tables
    rows = cohorts.week_window(vintage.aged_repayments(loans, paid), 0)
    by_rows = cohorts.collected_by(
        cohorts.comparable_cutoff(rows, "release_year", 2024), ["branch", "release_year", "weeks_since_release"]
    )
    close(cells(by_rows, "branch", "release_year", "weeks_since_release", "amount"), kept.to_dict())


def test_report_from_written_tables(tables, tmp_path):
    lazy = vintage.vintage_report(*tables, newest_year=2024)
    kept = vintage.vintage_report(*tables, newest_year=2024, work_dir=str(tmp_path / "w"))
    for part in ("curve", "returns", "quarterly", "collected_monthly", "disbursed_monthly"):
        a, b = (sorted(map(str, getattr(r, part).select(*[
            F.round(f.name, 6) if f.dataType.simpleString() == "double" else f.name for f in getattr(r, part).schema.fields
        ]).collect())) for r in (lazy, kept))
        assert a == b and a


def test_returns_by_position_and_by_week(spark):
    rows = [("c", 0, -100.0), ("c", 2, 60.0), ("c", 4, 60.0), ("d", 0, 5.0), ("d", 1, 5.0)]
    weekly = spark.createDataFrame(rows, "cohort string, weeks_since_release int, amount double")
    rate = lambda **kw: {r.cohort: r.weekly_irr for r in cohorts.weekly_irr(weekly, ["cohort"], **kw).collect()}
    assert rate(positional=True)["c"] == pytest.approx(0.130662, abs=1e-6)
    assert rate()["c"] == pytest.approx(1.130662**0.5 - 1, abs=1e-6)
    assert rate()["d"] is None
    assert cohorts.with_yearly_irr(cohorts.weekly_irr(weekly, ["cohort"])).filter("cohort = 'c'").first().yearly_irr == pytest.approx(
        1.130662**26 - 1, rel=1e-4
    )


def test_quarterly_share_counts_principal_once(spark):
    collected = spark.createDataFrame(
        [("a", 2024, 1, 2024, 1, 10.0), ("a", 2024, 1, 2024, 2, 20.0), ("a", 2024, 2, 2024, 2, 5.0), ("b", 2024, 1, 2024, 1, 1.0)],
        "branch string, release_year int, release_month int, collection_year int, collection_month int, amount double",
    )
    lent = spark.createDataFrame([("a", 2024, 1, 100.0), ("a", 2024, 2, 50.0), ("b", 2024, 1, 10.0)], "branch string, release_year int, release_month int, principal double")
    share = lambda **kw: {r.branch: (r.amount, r.principal) for r in cohorts.quarterly_collected_pct(collected, lent, **kw).collect()}
    assert share() == {"a": (35.0, 150.0), "b": (1.0, 10.0), "all": (36.0, 160.0)}
    assert share(repeat_principal=True) == {"a": (35.0, 250.0), "b": (1.0, 10.0), "all": (36.0, 260.0)}
    assert set(share(by_branch=True)) == {"a", "b"} and set(share(by_branch=False)) == {"all"}


def test_product_report(tables):
    loans, paid = tables
    rows = products.product_repayment_report(loans, paid, ["x"]).collect()
    out = LOANS[~LOANS.status.isin(["Denied", "Not Taken Up", "Processing"])].assign(g=lambda d: d["product"].isin(["x"]))
    df = out.merge(PAID, on="loan_id", how="right")
    df = df[df.g.notna()]
    df["week"] = np.floor((pd.to_datetime(df.collection_date) - pd.to_datetime(df.release_date)).dt.days / 7).astype(int)
    cumulative = df.groupby([df.g.astype(bool), "week"]).amount.sum().groupby(level=0).cumsum()
    total = out.groupby("g").principal.sum()
    close(
        {(r.in_group, r.weeks_since_release): r.principal_collected_pct for r in rows},
        {k: v / total[k[0]] for k, v in cumulative.to_dict().items()},
    )


def test_balance_gaps(spark):
    loans = spark.createDataFrame([(1, 100.0, 150.0, 20.0), (2, 100.0, 130.0, 30.0)], "loan_id int, principal double, total_due double, pending_due double")
    paid = spark.createDataFrame([(1, 10.0), (1, 10.0)], "loan_id int, amount double")
    rows = cohorts.reconcile_balances(loans, paid).collect()
    assert [(r.loan_id, r.pending_computed, r.gap) for r in rows] == [(1, 30.0, 10.0)]
    assert cohorts.mean_gap(cohorts.reconcile_balances(loans, paid)).first().mean_gap == 10.0
