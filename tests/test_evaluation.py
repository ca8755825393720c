import pytest

from loanloom.operators import evaluation


def predictions(spark, tn, fp, fn, tp):
    rows = [(0, 0)] * tn + [(0, 1)] * fp + [(1, 0)] * fn + [(1, 1)] * tp
    return spark.createDataFrame(rows, "y int, y_pred int")


def test_known_report(spark):
    """A confusion matrix with a published report."""
    df = predictions(spark, 612, 94, 137, 94)
    rows = {r["class"]: r for r in evaluation.classification_report(df).collect()}
    shown = {k: tuple(None if v is None else round(v, 2) for v in (r.precision, r.recall, r.f1_score)) for k, r in rows.items()}
    assert shown == {
        "0": (0.82, 0.87, 0.84),
        "1": (0.50, 0.41, 0.45),
        "accuracy": (None, None, 0.75),
        "macro avg": (0.66, 0.64, 0.64),
        "weighted avg": (0.74, 0.75, 0.74),
    }
    assert [rows[k].support for k in ("0", "1", "accuracy")] == [706, 231, 937]
    rates = evaluation.positive_rates(df).first()
    assert (rates.actual, rates.actual_pct, rates.predicted, rates.predicted_pct) == (231, 24.7, 188, 20.1)


def test_confusion_has_all_cells(spark):
    cells = evaluation.confusion(predictions(spark, 3, 0, 0, 1), normalize="pred").collect()
    assert {(c.actual, c.predicted): (c.n, c.share) for c in cells} == {
        (0, 0): (3, 1.0), (0, 1): (0, 0.0), (1, 0): (0, 0.0), (1, 1): (1, 1.0)
    }


@pytest.mark.parametrize("cells, expected", [((5, 0, 3, 0), (0.0, 0.0, 0.0)), ((5, 2, 0, 0), (0.0, 0.0, 0.0)), ((0, 1, 1, 1), (0.5, 0.5, 0.5))])
def test_zero_guards(spark, cells, expected):
    row = evaluation.precision_recall_f(predictions(spark, *cells)).first()
    assert (row.precision_1, row.recall_1, row.fscore) == expected


def test_metrics_on_no_rows(spark):
    df = spark.createDataFrame([], "p double, y int, y_pred int, profit double")
    assert evaluation.pr_metric(df, "p", "y", 0.5).first()["metric"] == 0
    assert evaluation.profitability(df).first()["anti_profit_per_loan"] is None
    assert evaluation.backtest_summary(df).first()["loans"] == 0
    assert {r.support for r in evaluation.classification_report(df).collect()} == {0}


def test_profit_metric(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 1), (0.9, 1), (0.8, 0)], "p double, y int")
    row = evaluation.profit_metric(df, "p", "y", 0.5).first()
    assert (row.profit_pred, row.profit_actual, row.metric) == (385 - 120, 2 * 385 - 240, 265)
    assert evaluation.profit_metric(df, "p", "y", 0.95).first()["metric"] == 99_999_999
    assert evaluation.profit_metric(df, "p", "y", 0.9).first()["metric"] == 99_999_999  # strictly above only


def test_profitability_ratios(spark):
    df = spark.createDataFrame([(1, -10.0), (1, -30.0), (0, 50.0), (0, 5.0)], "y_pred int, profit double")
    row = evaluation.profitability(df).first()
    assert (row.predicted_profit, row.anti_profit, row.actual_profit) == (55.0, -40.0, 15.0)
    assert (row.anti_profit_per_loan, row.anti_profit_per_denied) == (-10.0, -20.0)


def test_backtest_labels_unknown_profit_as_repaid(spark):
    df = spark.createDataFrame([(0.9, None), (0.8, 10.0), (0.1, 100.0)], "p double, profit double")
    summary, _ = evaluation.backtest(df, "p", 0.5)
    row = summary.first()
    assert (row.loans, row.actual_positives, row.predicted_positives) == (3, 1, 2)


def test_learning_curve_crosses_chunks(spark):
    rows = [("r", 10.0, 0.5), ("r", 70.0, 0.6), ("r", 130.0, 0.4), ("r", 131.0, 0.45), ("s", 5.0, 0.9)]
    trials = spark.createDataFrame(rows, "run_id string, wall_clock_time double, validation_loss double")
    got = evaluation.learning_curve(trials).orderBy("run_id", "wall_clock_time").collect()
    assert [round(r.best_accuracy, 6) for r in got] == [0.5, 0.5, 0.6, 0.6, 0.1]


def test_registered_subset_search_is_whole(monkeypatch, spark):
    """A hundred subsets, every numeric column in some, each on the library's own forest."""
    from loanloom.operators import selection, trees
    from loanloom.plans import queries_models

    seen = {}

    def losses(df, subsets, *names, **given):
        seen.update(columns=set(df.columns) - {"application_id", "status"}, drawn=subsets, given=given)
        return [0.5] * len(subsets)

    monkeypatch.setattr(trees, "forest_losses", losses)
    queries_models.a29_subset_search(spark, "/root/testdata/sf0.001")
    assert len(seen["drawn"]) == 100 and set().union(*seen["drawn"]) == seen["columns"] and seen["given"] == {}
    assert {len(s) for s in seen["drawn"]} == {int(len(seen["columns"]) ** 0.5)}
