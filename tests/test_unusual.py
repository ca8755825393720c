"""Inputs that the supplied tables do not contain."""

import math

import pytest
from pyspark.sql import functions as F

from loanloom.functions import student_t
from loanloom.functions.irr import irr
from loanloom.operators import cohorts, decision, evaluation, joins, rules
from loanloom.sources import readers, sinks, validation

NAN = float("nan")


def texts(spark):
    return spark.createDataFrame([(1, 'He said "hi", ok'), (2, "a\\b,c\\"), (3, " blank "), (4, "é")], "id int, t string")


@pytest.mark.parametrize("encoding", ["UTF-8", readers.LATIN_1])
def test_csv_with_doubled_quotes(spark, tmp_path, encoding):
    (tmp_path / "m_1.csv").write_text('id,t\n1,"He said ""hi"", ok"\n2,"a\\b,c\\"\n3," blank "\n4,é\n', encoding=encoding)
    want = texts(spark).collect()
    schema = texts(spark).schema
    assert readers.read_table(spark, str(tmp_path / "m_1.csv"), schema, encoding=encoding).collect() == want
    monthly = readers.read_monthly(spark, [str(tmp_path / "m_1.csv")], schema, encoding)
    assert monthly.select("id", "t").collect() == want and monthly.first().source_file == "m_1.csv"


def test_csv_line_breaks(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'a\n"b", c'), (2, "d")], "id int, t string")
    sinks.write_table(rows.coalesce(1), str(tmp_path / "t"), "csv")
    assert readers.read_table(spark, str(tmp_path / "t"), rows.schema, multi_line=True).collect() == rows.collect()
    for use in (lambda df: df.collect(), lambda df: df.count(), lambda df: df.select("t").collect()):
        with pytest.raises(Exception, match="multi_line"):
            use(readers.read_table(spark, str(tmp_path / "t"), rows.schema))


def test_csv_quarantine(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,t\n1,a\nx,b\n3,c,d\n")
    good, bad = readers.quarantine(readers.read_table(spark, str(tmp_path / "t.csv"), texts(spark).schema, keep_corrupt=True))
    assert [r.id for r in good.collect()] == [1] and sorted(r[0] for r in bad.collect()) == ["3,c,d", "x,b"]


def test_stream_of_a_folder(spark, tmp_path):
    from loanloom.plans.queries_io import _stream

    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    source.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for sf in (str(tmp_path), "/root/testdata/sf0.001"):
        name = f"stream_{abs(hash(sf))}"
        _stream(spark, sf, "events").writeStream.format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
        assert spark.table(name).count() == source.count()


def test_flags_read_only_the_window_and_the_requests(spark):
    requests = spark.createDataFrame([(1, "2024-05-01")], "request_id long, request_date string").withColumn("request_date", F.to_date("request_date"))
    trx = spark.createDataFrame([(1, "NSF fee", "2024-04-20"), (1, "NSF fee", "2023-01-01"), (2, "NSF fee", "2024-04-20")], "request_id long, description string, d string")
    flags = rules.transaction_flags(requests, trx.withColumn("trx_date", F.to_date("d")))
    plan = flags._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "trx_date" in plan and "scalar-subquery" in plan
    assert [(r.request_id, r.nsf_long) for r in flags.collect()] == [(1, 1)]


@pytest.mark.parametrize(
    "flows,rate", [([-100, 5], -0.95), ([-1e6, 0, 0, 900], (900 / 1e6) ** (1 / 3) - 1), ([-100, 230, -132], 0.1), ([-1, 0, 30], 30**0.5 - 1), ([1, 2], None), ([0, 0], None)]
)
def test_returns_anywhere(spark, flows, rate):
    df = spark.createDataFrame([([(i, float(a)) for i, a in enumerate(flows)],)], "f array<struct<week:int,amount:double>>")
    got = df.select(irr(F.col("f"))).first()[0]
    assert got is None if rate is None else got == pytest.approx(rate, abs=1e-9)


def test_whole_number_out_of_range(spark):
    rule = [validation.Rule("n", "int")]
    valid, wrong = validation.validate_applications(spark.createDataFrame([("3000000000",), ("12",), ("-2147483648",)], "n string"), rule)
    assert sorted(r.n for r in valid.collect()) == [-2147483648, 12]
    assert wrong.collect()[0].errors == ["n: out of range"]


def test_missing_scores_are_not_above(spark):
    df = spark.createDataFrame([(NAN, 1, 10.0), (0.9, 1, 10.0), (None, 0, 90.0)], "p double, y int, profit double").withColumn("q", F.col("p"))
    assert [r.y_pred for r in decision.classify(df, "p", threshold=0.5).collect()] == [0, 1, 0]
    assert [r.y_pred for r in evaluation.above(df, "p", 0.5).collect()] == [0, 1, 0]
    assert [r.uw_decision for r in decision.combined_decision(df, 0.5, 0.5, "p", "q").collect()] == ["accept", "refuse", "accept"]
    assert evaluation.acceptance(df, "p", 0.5).first().mean_score == 0.9
    summary, _ = evaluation.backtest(df, "p", 0.5)
    assert summary.first().predicted_positives == 1
    assert decision.with_threshold_key(spark.createDataFrame([(NAN,), (0.75,)], "t double"), "t", "k").select("k").collect()[0].k is None


def test_thresholds_by_time(spark):
    records = spark.createDataFrame([("2024-01-01 10:00", 0.1, 1), ("2024-01-01 12:00", 0.2, 2), ("2024-01-03 09:00", 0.3, 3)], "c string, t double, id int")
    records = records.withColumn("created_at", F.to_timestamp("c")).drop("c")
    asked = spark.createDataFrame([(x,) for x in ("2024-01-01 09:00", "2024-01-01 10:00", "2024-01-01 23:00", "2024-01-02 05:00", "2024-01-03 08:59", "2024-01-09 00:00")], "a string")
    got = joins.with_thresholds(asked.withColumn("at", F.to_timestamp("a")), records, as_of="at", tie="id").orderBy("a").collect()
    assert [r.t for r in got] == [None, 0.1, 0.2, 0.2, 0.2, 0.3]


def test_branch_called_all(spark):
    months = "branch string, release_year int, release_month int, "
    paid = spark.createDataFrame([("all", 2020, 1, 2020, 1, 10.0), ("b", 2020, 1, 2020, 1, 30.0)], months + "collection_year int, collection_month int, amount double")
    lent = spark.createDataFrame([("all", 2020, 1, 100.0), ("b", 2020, 1, 100.0)], months + "principal double")
    got = sorted((r.branch, r.amount, r.collected_pct) for r in cohorts.quarterly_collected_pct(paid, lent).collect())
    assert got == [("all", 10.0, 0.1), ("all", 40.0, 0.2), ("b", 30.0, 0.3)]


def test_comparable_weeks_needs_no_single_task(spark):
    weekly = spark.createDataFrame([(2020, 1, 5), (2021, 1, 3), (2020, 4, 1)], "release_year int, release_month int, weeks_since_release int")
    kept = cohorts.comparable_weeks(weekly, "release_year", 2021)
    assert "Window" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in kept.collect()] == [(2021, 1, 3)]


@pytest.mark.parametrize("t", [0.5, 3.29, 6.0])
def test_p_value_on_many_rows(t):
    normal = math.erfc(t / math.sqrt(2))
    for df in (1e8, 1e10, 1e12, 1e14):
        step = 2 * math.exp(-t * t / 2) / math.sqrt(2 * math.pi) * t * (t * t + 1) / (4 * df)
        assert student_t.two_sided(t, df) == pytest.approx(normal + step, rel=1e-10)
    assert student_t.two_sided(t, 9.99e6) == pytest.approx(student_t.two_sided(t, 1.001e7), rel=1e-5)
