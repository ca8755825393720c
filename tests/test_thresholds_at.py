import datetime

from loanloom.operators import joins


def test_thresholds_at_a_time_gather_no_versions(spark):
    """Versions of one second, of the hour before and of days before; a null time gets none, and no day's versions are held as one value."""
    at = lambda day, hour, minute=0, second=0: datetime.datetime(2024, 1, day, hour, minute, second)
    records = spark.createDataFrame(
        [(1, at(1, 5), 0.1), (2, at(3, 9, 30), 0.2), (3, at(3, 9, 30), 0.3), (4, at(3, 10, 15), 0.4), (5, None, 0.9), (6, at(3, 10, 15, 1), None)],
        "id int, created_at timestamp_ntz, t double",
    )
    asked = [(at(1, 4), None), (at(1, 5), 0.1), (at(3, 9, 29), 0.1), (at(3, 9, 30), 0.3), (at(3, 10, 14), 0.3), (at(3, 10, 15), 0.4), (at(3, 11), None), (None, None)]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(asked)] * 2, "n int, a timestamp_ntz")
    got = joins.with_thresholds(df, records, as_of="a", tie="id")
    assert got.columns == ["n", "a", "t"] and sorted((r.n, r.t is None, r.t) for r in got.collect()) == sorted([(i, t is None, t) for i, (_, t) in enumerate(asked)] * 2)
    assert "collect_list" not in got._jdf.queryExecution().optimizedPlan().toString()
