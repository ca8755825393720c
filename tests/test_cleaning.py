import datetime as dt

import pytest
from pyspark.sql import functions as F

from loanloom.operators import cleaning, joins, profile, splits
from loanloom.plans import training
from loanloom.sources import sinks, validation
from loanloom.sources.feature_spec import DEFAULT_SPEC, REFUSAL_SPEC, FeatureSpec

NAN = float("nan")


def ids(df, key="id"):
    return sorted(r[key] for r in df.select(key).collect())


def test_thresholds_keep_unknown_values(spark):
    df = spark.createDataFrame([(1, -5000.0), (2, -5000.01), (3, None), (4, NAN), (5, 7.0)], "id int, balance_min double")
    assert ids(cleaning.filter_thresholds(df, DEFAULT_SPEC)) == [1, 3, 4, 5]
    capped = FeatureSpec("y", ["balance_min"], maxima={"balance_min": 0.0})
    assert ids(cleaning.filter_thresholds(df, capped)) == [1, 2, 3, 4]


def test_quality_rules_follow_the_columns(spark):
    df = spark.createDataFrame(
        [(1, None, 5.0), (2, "x", 5.0), (3, None, 0.0), (4, None, None), (5, None, NAN)], "id int, error string, account_age_days double"
    )
    assert ids(cleaning.filter_quality(df)) == [1]
    assert ids(cleaning.filter_quality(df.drop("account_age_days"))) == [1, 3, 4, 5]
    audit = {r.rule: r.row_count for r in cleaning.filter_audit(df, cleaning.quality_rules(df)).collect()}
    assert audit == {"kept": 1, "error present": 1, "account_age_days not positive": 3}


HISTORY = "id int, account_age_days double, count_nsf_90_days double, count_nsf_30_days double, count_stop_payment_90_days double"


def test_basic_refusal_limits(spark):
    df = spark.createDataFrame(
        [(1, 85.0, 8.0, 6.0, 4.0), (2, 84.0, 0.0, 0.0, 0.0), (3, 90.0, 9.0, 0.0, 0.0), (4, None, None, None, None), (5, None, 0.0, 0.0, 5.0), (6, NAN, NAN, NAN, NAN), (7, NAN, 0.0, 0.0, 0.0)], HISTORY
    )
    flags = {r.id: r.auto_refuse_basic for r in cleaning.with_auto_refuse_basic(df).collect()}
    assert flags == {1: False, 2: True, 3: True, 4: False, 5: True, 6: False, 7: False}
    assert ids(cleaning.prescreen(df)) == [1]


def test_label_weight_and_month(spark):
    df = spark.createDataFrame(
        [(1, "2022-03-09", 100.0, 149.99), (2, "2022-12-01", 100.0, 150.0), (3, "2023-01-01", 100.0, None), (4, None, 1.0, 1.0)],
        "id int, request_date string, principal double, total_paid double",
    )
    out = cleaning.with_recency_weight(cleaning.with_month_key(cleaning.with_default_label(cleaning.with_profit(df))))
    rows = {r.id: (r.status, r.request_month, round(r.weight, 6)) for r in out.collect()}
    assert rows == {1: (1, 3, 0.25), 2: (0, 12, 1.0), 3: (0, 1, 1.0), 4: (1, None, 1.0)}


def test_for_month_on_text_and_dates(spark):
    df = spark.createDataFrame([(1, "2022-12-31"), (2, "2023-01-01T00:00"), (3, None)], "id int, request_date string")
    assert ids(cleaning.for_month(df, "2022-12")) == [1]
    dated = df.withColumn("request_date", F.try_to_date(F.substring("request_date", 1, 10), "yyyy-MM-dd"))
    assert ids(cleaning.for_month(dated, "2023-01")) == [2]


def test_features_follow_the_spec(spark):
    columns = ", ".join(f"{c} double" for c in DEFAULT_SPEC.numeric)
    row = (7, "2020-01-01", "1990-06-01", "Monthly", "male", 3.0, *[float(i) for i in range(len(DEFAULT_SPEC.numeric))])
    df = spark.createDataFrame([row], f"key int, request_date string, dob string, employer_income_frequency string, gender string, unknown double, {columns}")
    out = cleaning.feature_engineer(df, DEFAULT_SPEC, cleaning.MODEL_STEPS["default"], ["key"])
    assert len(out.columns) == 1 + 35 + 6
    assert out.first()["age"] == 29
    extended = cleaning.feature_engineer(
        df, DEFAULT_SPEC, [*cleaning.MODEL_STEPS["default"], lambda d: d.withColumn("own", F.col("age") * 2)], ["key"]
    )
    assert extended.first()["own"] == 58
    assert "unknown" not in extended.columns


def test_spec_round_trip(spark):
    assert FeatureSpec.from_table(DEFAULT_SPEC.to_table(spark)) == DEFAULT_SPEC
    assert DEFAULT_SPEC.minima == {"balance_min": -5000.0}
    assert (len(DEFAULT_SPEC.variables), len(REFUSAL_SPEC.variables)) == (41, 39)
    assert len(cleaning.combined_inputs(DEFAULT_SPEC, REFUSAL_SPEC)) == len(set(DEFAULT_SPEC.inputs) | set(REFUSAL_SPEC.inputs))


def test_encode_and_drop(spark):
    df = spark.createDataFrame([("b", "u1", 1.0), (None, "u2", 2.0), ("a", "u3", 3.0)], "g string, u string, n double")
    coded = cleaning.encode_categories(df, ["g"]).orderBy("n")
    assert [r.g for r in coded.collect()] == [1, -1, 0]
    assert cleaning.encode_categories(df, ["u"], max_distinct=3).schema["u"].dataType.simpleString() == "string"
    assert cleaning.drop_unusable(df, ["n"], max_distinct=3).columns == ["g"]


def test_fill_missing_covers_nan(spark):
    df = spark.createDataFrame([(None, NAN, None)], "i int, d double, s string")
    assert tuple(cleaning.fill_missing(df).first()) == (-1, -1.0, "-1")


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (NAN, None), (None, "b")], "d double, s string")
    assert {r.column_name: r.nulls for r in profile.null_profile(df).collect()} == {"d": 2, "s": 1}
    assert profile.total_nulls(df).first()["nulls"] == 3


def test_value_counts_leave_out_unknown(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "s string")
    assert {r.s: r.share for r in profile.value_counts(df, ["s"], True).collect()} == {"a": 2 / 3, "b": 1 / 3}


def test_one_to_one_join(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    assert joins.join_one_to_one(a, a.withColumnRenamed("a", "b"), ["k"]).count() == 2
    with pytest.raises(joins.DuplicateKeyError):
        joins.join_one_to_one(a, a.union(a).withColumnRenamed("a", "b"), ["k"])


def test_left_join_to_many(spark):
    one = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, a string")
    many = spark.createDataFrame([(1, 10)] * 50 + [(9, 1), (None, 3)], "k int, v int")
    got = joins.left_join_to_many(one, many, ["k"])
    expected = one.join(many, "k", "left")
    assert sorted(map(str, got.select("k", "a", "v").collect())) == sorted(map(str, expected.select("k", "a", "v").collect()))


def test_loan_cashflows_renames_clashes(spark):
    loans = spark.createDataFrame([(1, "L1")], "loan_id int, loan_no string")
    paid = spark.createDataFrame([(1, "R1")], "loan_id int, loan_no string")
    row = joins.loan_cashflows(loans, paid).first()
    assert (row.loan_no, row.loan_no_repayment) == ("L1", "R1")


def test_null_safe_join(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "k int, a string")
    b = spark.createDataFrame([(None, 5)], "k int, b int")
    assert [tuple(r) for r in joins.null_safe_join(a, b, ["k"]).collect()] == [(None, "y", 5)]


def test_union_with_drift(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([(2.5, 7)], "k double, extra int")
    c = spark.createDataFrame([("t",)], "k string")
    rows = [tuple(r) for r in joins.union_tables(a, b).collect()]
    assert rows == [(1.0, "x", None), (2.5, None, 7)]
    assert [r.k for r in joins.union_tables(a, b, c).collect()] == ["1", "2.5", "t"]


def test_thresholds_as_of(spark):
    day = lambda d, h: dt.datetime(2024, 1, d, h)
    records = spark.createDataFrame([(day(3, 1), 0.5), (day(3, 9), 0.6), (day(6, 0), 0.7)], "created_at timestamp, t double")
    asked = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 3, 5, 6, 20)] + [(None,)], "request_date date")
    rows = joins.with_thresholds(asked, records, as_of="request_date").collect()
    got = {r.request_date and r.request_date.day: r.t for r in rows}
    assert got == {1: None, 3: 0.6, 5: 0.6, 6: 0.7, 20: 0.7, None: None}
    assert joins.with_thresholds(asked, records).select("t").distinct().collect()[0].t == 0.7
    assert joins.with_thresholds(asked, records.limit(0)).select("t").distinct().collect()[0].t is None


def test_splits_repeat_and_cover(spark):
    df = spark.range(20_000)
    first = splits.split_random(df, 0.15, "id", seed=1)
    again = splits.split_random(df.repartition(7), 0.15, "id", seed=1)
    assert first.join(again, ["id", "split"]).count() == 20_000
    assert first.filter("split = 'test'").count() == pytest.approx(3000, rel=0.08)
    with pytest.raises(joins.LostRowsError):
        joins.reassemble([first.filter("split = 'test'")], expected=df)


def test_split_by_unknown_is_train(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    assert [r.split for r in splits.split_by_flag(df, "f").collect()] == ["test", "train", "train"]


def test_sample_by_status_repeats(spark):
    df = spark.range(1000).withColumn("status", F.col("id") % 3)
    one = cleaning.sample_by_status(df, "status", "id", n=2, seed=4)
    two = cleaning.sample_by_status(df.repartition(5), "status", "id", n=2, seed=4)
    assert ids(one) == ids(two) and len(ids(one)) == 6


def test_monthly_training_rejects_repeated_loans(spark):
    apps = spark.createDataFrame([(1, "2023-04-02", 5.0), (1, "2023-04-02", 5.0), (2, "2023-05-02", 1.0)], "loan_id int, request_date string, x double")
    outcomes = spark.createDataFrame([(1, 100.0, 130.0, "Fully Paid")], "`Loan Id` int, `Principal Amount` double, `Paid Amount` double, `Loan Status Name` string")
    built = training.build_monthly_training(apps, outcomes, "2023-04", "loan_id")
    assert [(r.loan_id, r.profit, r.loan_status) for r in built.collect()] == [(1, 30.0, "Fully Paid")]
    with pytest.raises(joins.DuplicateKeyError):
        training.build_monthly_training(apps, outcomes.union(outcomes), "2023-04", "loan_id")


def test_validation_splits_and_types(spark):
    rules = [validation.Rule("gender", "enum", ("male", "female")), validation.Rule("n", "int"), validation.Rule("dob", "date")]
    df = spark.createDataFrame(
        [(1, "male", "3", "2000-01-01"), (2, "x", "3.5", "2000-13-01"), (3, None, "a", None), (4, "female", "4.0", "1999-02-28")],
        "id int, gender string, n string, dob string",
    )
    valid, rejected = validation.validate_applications(df, rules)
    assert [(r.id, r.n, r.dob) for r in valid.orderBy("id").collect()] == [(1, 3, dt.date(2000, 1, 1)), (4, 4, dt.date(1999, 2, 28))]
    assert {r.id: list(r.errors) for r in rejected.collect()} == {
        2: ["gender: not allowed", "n: not an integer", "dob: not a date"],
        3: ["gender: missing", "n: not an integer", "dob: missing"],
    }
    assert validation.with_errors(df.drop("n"), rules).first()["errors"] == ["n: missing"]


def test_for_month_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "apps")
    df = spark.createDataFrame([(1, "2023-01-05"), (2, "2023-02-01"), (3, None)], "id int, request_date string")
    keyed = cleaning.with_month_key(df).select("id", "request_date", "request_month_key")
    sinks.write_table(keyed, path, partition_by=["request_month_key"])
    month = cleaning.for_month(spark.read.parquet(path), "2023-02")
    assert ids(month) == [2]
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(request_month_key" in plan and "GreaterThanOrEqual(request_date,2023-02)" in plan
