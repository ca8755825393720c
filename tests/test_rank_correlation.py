import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanloom.operators import joins, ordered, selection


def gappy(n, p, seed, values=12):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, values, (n, p)).astype(float)
    x[:, 1] = np.round(x[:, 0] + rng.normal(size=n))
    x[rng.random((n, p)) < rng.random(p) * 0.5] = np.nan
    return x


def frame(spark, x):
    names = [f"c{i}" for i in range(x.shape[1])]
    rows = [(i, *(None if np.isnan(v) and i % 2 else float(v) for v in r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in names)), names


def check(spark, x):
    df, names = frame(spark, x)
    got = selection.spearman(df, names).toPandas().set_index("variable").loc[names, names].astype(float)
    data = pd.DataFrame(x, columns=names)
    for a in names:
        for b in names:
            both = data[[a, b] if a != b else [a]].dropna().rank()
            value = 1.0 if a == b else both[a].corr(both[b]) if len(both) > 1 and both.std().min() > 0 else np.nan
            assert got.loc[a, b] == pytest.approx(value, abs=1e-12, nan_ok=True), (a, b)


def test_pairs_with_gaps_equal_pandas(spark):
    x = gappy(400, 6, 1)
    x[:, 3] = 4.0  # constant
    x[::2, 4], x[1::2, 5] = np.nan, np.nan  # never together
    check(spark, x)


def test_values_in_ranges_and_joins_without_broadcast(spark, monkeypatch):
    """Many distinct values, cut into ranges; rank tables too large to broadcast; one value that holds a third of the rows."""
    monkeypatch.setattr(ordered, "VALUES_PER_RANGE", 40)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(selection, "ROWS_AT_ONCE", 64)
    x = gappy(500, 4, 2, values=300)
    x[::3, 2] = 7.0
    check(spark, x)


def test_jobs_do_not_grow_with_pairs(spark):
    """Three times the columns have nine times the pairs, but adaptive execution runs at most three times the exchanges."""
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for p in (10, 30):
        df, names = frame(spark, gappy(60, p, p))
        group = f"spearman-{p}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            half = selection._pairwise_correlations(df.select(*[F.when(ordered.present(F.col(c)), F.col(c)).alias(c) for c in names]), names, ordered.spread_of(df, *names))
            assert half.count() == p * (p - 1) // 2
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs.append(len(tracker.getJobIdsForGroup(group)))
    assert 0 < jobs[1] <= 3 * jobs[0], jobs
