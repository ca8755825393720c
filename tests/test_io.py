import json

import pytest
from pyspark.sql import functions as F, types as T

from loanloom.operators import models
from loanloom.plans import model_runs
from loanloom.sources import artefacts, documents, readers, sinks, views
from loanloom.sources.feature_spec import DEFAULT_SPEC, read_feature_spec

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("amount", T.DoubleType()), T.StructField("note", T.StringType())])


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_csv_missing_and_corrupt(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,amount,note\n1,2.5,x\n2,NaN,NA\n3,,\nbad,4,y\n5,abc,z\n")
    rows = readers.read_table(spark, path, SCHEMA, keep_corrupt=True).collect()
    assert [(r.id, r.amount, r.note) for r in rows] == [(1, 2.5, "x"), (2, None, None), (3, None, None), (None, 4.0, "y"), (5, None, "z")]
    assert [r["_corrupt_record"] for r in rows] == [None, None, None, "bad,4,y", "5,abc,z"]


def test_csv_latin1(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,amount,note\n1,1,REFUSÉ\n", "latin-1")
    assert readers.read_table(spark, path, SCHEMA, encoding=readers.LATIN_1).first().note == "REFUSÉ"


def test_csv_header_must_match(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,note,amount\n1,x,2\n")
    with pytest.raises(Exception, match="header"):
        readers.read_table(spark, path, SCHEMA).collect()


def test_monthly_files_keep_their_name(spark, tmp_path):
    paths = [write(tmp_path / f"m{i}.csv", f"id,amount,note\n{i},1,a\n") for i in (1, 2)]
    rows = readers.read_monthly(spark, paths, SCHEMA).orderBy("id").collect()
    assert [(r.id, r.source_file) for r in rows] == [(1, "m1.csv"), (2, "m2.csv")]


def test_expand_json_ignores_unknown_and_bad(spark):
    df = spark.createDataFrame([(1, '{"a": 2, "zozo": 0}'), (2, "no json"), (3, None)], "id int, j string")
    out = readers.expand_json(df, "j", T.StructType([T.StructField("a", T.IntegerType())]))
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 2), (2, None), (3, None)]


def test_trial_log(spark, tmp_path):
    line = {
        "record_id": 0, "iter_per_learner": 1, "logged_metric": {"pred_time": 1e-5}, "trial_time": 0.3, "wall_clock_time": 0.4,
        "validation_loss": 0.29, "config": {"n_estimators": 10, "max_depth": 6, "learning_rate": 0.3}, "learner": "x", "sample_size": 12,
    }
    path = write(tmp_path / "log", json.dumps(line) + "\n" + json.dumps({"curr_best_record_id": 0}) + "\n")
    [row] = readers.read_trials(spark, path).collect()
    assert (row.record_id, row.config["learning_rate"], row.logged_metric.pred_time) == (0, 0.3, 1e-5)


def test_feature_config_file(spark, tmp_path):
    path = str(tmp_path / "config")
    sinks.write_table(DEFAULT_SPEC.to_table(spark).coalesce(1), path, "csv")
    assert read_feature_spec(spark, path) == DEFAULT_SPEC


def document(status, *accounts):
    holder = ("Ann", {"City": "X"}, "a@example.org", "1")
    full = [(a, None, None, None, None, None, {}, "c", "t", "CAD", holder, f"acc{i}") for i, a in enumerate(accounts)]
    return (status, full)


def test_documents(spark):
    import datetime as dt

    t = (dt.date(2024, 1, 1), None, "NSF", 5.0, None, None, "t1")
    rows = [("a", document(200, [t, t], [t])), ("b", document(200)), ("c", document(500, [t])), ("d", document(200, [])), ("e", None)]
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("document", documents.DOCUMENT)])
    df = spark.createDataFrame(rows, schema)
    count = lambda d: {r.k: r["count"] for r in d.groupBy("k").count().collect()}
    assert count(documents.flatten_transactions(df, ["k"])) == {"a": 3, "c": 1}
    assert count(documents.flatten_transactions(df, ["k"], keep_empty=True)) == {"a": 3, "b": 1, "c": 1, "d": 1, "e": 1}
    assert sorted(r.k for r in documents.account_holders(df, ["k"]).collect()) == ["a", "d"]


def test_decision_log_can_be_written_twice(spark, tmp_path):
    base = str(tmp_path)
    decisions = spark.createDataFrame(
        [(1, "2024-01-01", "accept", None, "o", 0.1, 5, 0.2, 10), (2, "2024-01-02", "n/a", "empty", "o", None, None, None, None)],
        "application_id int, request_date string, uw_decision string, info string, organization string, refusal_score double, "
        "refusal_percentile int, default_score double, default_percentile int",
    ).withColumn("request_date", F.to_date("request_date"))
    for _ in range(2):
        sinks.write_decisions(decisions, base, ["application_id", "request_date"], batch_id=4)
    sinks.write_decisions(decisions, base, ["application_id", "request_date"], batch_id=5)
    logs, attributes = spark.read.parquet(f"{base}/logs"), spark.read.parquet(f"{base}/attributes")
    assert logs.groupBy("batch_id").count().orderBy("batch_id").collect() == [(4, 2), (5, 2)]
    assert logs.select("id").distinct().count() == 2
    assert json.loads(attributes.first().attributes_json) == {"application_id": 1, "request_date": "2024-01-01"}


def profiles(spark):
    return views.view(spark, "/root/testdata/sf0.001", "profiles")


def test_train_save_load_score(spark, tmp_path):
    run = model_runs.train_default(profiles(spark), ["2000-12"], ["2001-01"], "application_id", 1995, [{"maxIter": 3, "maxDepth": 3}])
    table, features = model_runs.default_frame(profiles(spark), [], [], 1995, "application_id")
    fitted = models.refit_full(table, DEFAULT_SPEC, "default", features, models.best_params(run.trials), "weight")
    artefacts.save_model(spark, fitted, str(tmp_path / "m"))
    loaded = artefacts.load_model(spark, str(tmp_path / "m"))
    assert (loaded.features, loaded.percentiles, loaded.spec) == (fitted.features, fitted.percentiles, fitted.spec)
    key = ["application_id"]
    once, again = (models.score(profiles(spark), m, key).orderBy(*key).collect() for m in (fitted, loaded))
    assert once == again and len(once) > 0
    assert list(fitted.percentiles) == list(range(5, 100, 5))
    assert models.score(profiles(spark).limit(0), fitted, key).count() == 0
    unseen = profiles(spark).limit(5).withColumn("employer_income_frequency", F.lit("never seen"))
    unseen = unseen.withColumn("balance_current", F.lit(None).cast("double")).withColumn("error", F.lit(None).cast("string"))
    assert models.score(unseen, fitted, key, filtered=False).filter("pred_proba is null").count() == 0
    importance = models.feature_importance(spark, fitted)
    assert importance.first().importance > 0 and importance.agg(F.sum("importance")).first()[0] == pytest.approx(1)


def test_model_learns_and_metrics_plug_in(spark):
    df = views.view(spark, "/root/testdata/sf0.01", "profiles")
    for metric in (models.auc_loss, models.p90_loss, models.pr_loss(0.5), models.profit_loss(0.5)):
        run = model_runs.train_default(df, ["2000-12"], ["2001-01"], "application_id", 1995, [{"maxIter": 3, "maxDepth": 3}], metric)
        assert len(run.trials) == 1
    assert models.auc_loss(run.test, models.SCORE, "status") < 0.4
    table = models.trials_table(spark, run.trials, "r1")
    assert table.first().config == {"maxIter": 3.0, "maxDepth": 3.0}


def test_metrics_sink_replaces_its_run(spark, tmp_path):
    df = spark.createDataFrame([(0.5, 3)], "auc double, n int")
    for value in ("a", "b", "a"):
        sinks.write_metrics(df, str(tmp_path), value)
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path)).select("run_id", "metric", "value").collect()) == [
        ("a", "auc", 0.5), ("a", "n", 3.0), ("b", "auc", 0.5), ("b", "n", 3.0)
    ]


def test_validate_documents(spark):
    import datetime as dt

    from loanloom.sources import validation

    good = (dt.date(2024, 1, 1), None, "NSF", 5.0, None, None, "t1")
    bad = (None, None, "NSF", 5.0, None, None, "t1")
    rows = [("a", document(200, [good])), ("b", None), ("c", document(None, [good], [bad])), ("d", (200, None)), ("e", (200, []))]
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("document", documents.DOCUMENT)])
    valid, broken = validation.validate_documents(spark.createDataFrame(rows, schema))
    assert sorted(r.k for r in valid.collect()) == ["a", "b", "e"]
    assert {r.k: list(r.errors) for r in broken.collect()} == {
        "c": ["HttpStatusCode: missing", "transaction: field missing"], "d": ["Accounts: missing"]
    }


def test_bucketed_tables_join_without_a_shuffle(spark):
    loans = spark.range(100).withColumnRenamed("id", "loan_id").withColumn("principal", F.lit(5.0))
    paid = spark.range(1000).select((F.col("id") % 100).alias("loan_id"), F.lit(1.0).alias("amount"))
    for name, df in (("bucketed_loans", loans), ("bucketed_paid", paid)):
        sinks.save_bucketed(df, name, ["loan_id"], 4)
    joined = spark.table("bucketed_loans").hint("merge").join(spark.table("bucketed_paid"), "loan_id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 1000


def test_many_categories(spark):
    df = spark.range(600).select(
        F.concat(F.lit("c"), F.col("id") % 60).alias("g"), (F.col("id") % 60 > 30).cast("int").alias("y"), "id"
    )
    loss = models.forest_loss(df, "y", "id", trees=2, depth=2)
    assert loss(["g"]) < 0.2
