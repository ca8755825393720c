"""How good are predictions: confusion, precision and recall, profit, ranking quality.

Everything here is one or two combining aggregates over the scored table, whatever its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanloom.functions import dates, numbers
from loanloom.operators import distribution, ordered

# Fixed values of the profit rule: a good loan accepted, a bad loan accepted, and "nothing refused".
GOOD_LOAN, BAD_LOAN, NOTHING_REFUSED = 385, -120, 99_999_999

ratio0 = numbers.ratio_or_zero


def cell_counts(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """One row: tn, fp, fn, tp."""
    y, yhat = F.col(label), F.col(predicted)
    return df.agg(
        F.count_if((y == 0) & (yhat == 0)).alias("tn"),
        F.count_if((y == 0) & (yhat == 1)).alias("fp"),
        F.count_if((y == 1) & (yhat == 0)).alias("fn"),
        F.count_if((y == 1) & (yhat == 1)).alias("tp"),
    )


def confusion(df: DataFrame, label: str = "y", predicted: str = "y_pred", normalize: str | None = None) -> DataFrame:
    """All four cells, with their share of the true class, the predicted class or of all rows."""
    c = F.col
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    by_true = {0: c("tn") + c("fp"), 1: c("fn") + c("tp")}
    by_pred = {0: c("tn") + c("fn"), 1: c("fp") + c("tp")}
    everything = c("tn") + c("fp") + c("fn") + c("tp")
    rows = []
    for actual, guess, name in cells:
        entry = [F.lit(actual).alias("actual"), F.lit(guess).alias("predicted"), c(name).alias("n")]
        if normalize:
            base = {"true": by_true[actual], "pred": by_pred[guess], "all": everything}[normalize]
            entry.append(ratio0(c(name), base).alias("share"))
        rows.append(F.struct(*entry))
    return cell_counts(df, label, predicted).select(F.inline(F.array(*rows)))


def fscore(precision: Column, recall: Column, beta: float = 1.0) -> Column:
    return ratio0((1 + beta**2) * precision * recall, beta**2 * precision + recall)


def _precision_recall(tp: Column, guessed: Column, actual: Column) -> tuple[Column, Column]:
    return ratio0(tp, guessed), ratio0(tp, actual)


def classification_report(df: DataFrame, label: str = "y", predicted: str = "y_pred") -> DataFrame:
    """Rows '0', '1', 'accuracy', 'macro avg', 'weighted avg'; a division by zero counts as 0."""
    c = F.col
    counts = cell_counts(df, label, predicted)
    n0, n1 = c("tn") + c("fp"), c("fn") + c("tp")
    p0, r0 = _precision_recall(c("tn"), c("tn") + c("fn"), n0)
    p1, r1 = _precision_recall(c("tp"), c("tp") + c("fp"), n1)
    f0, f1 = fscore(p0, r0), fscore(p1, r1)
    total = n0 + n1

    def row(name: str, precision, recall, f, support) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.cast("double").alias("precision"),
            recall.cast("double").alias("recall"),
            f.cast("double").alias("f1_score"),
            support.cast("bigint").alias("support"),
        )

    def macro(a: Column, b: Column) -> Column:
        return (a + b) / 2

    def weighted(a: Column, b: Column) -> Column:
        return ratio0(a * n0 + b * n1, total)

    accuracy = ratio0(c("tn") + c("tp"), total)
    none = F.lit(None)
    rows = [
        row("0", p0, r0, f0, n0),
        row("1", p1, r1, f1, n1),
        row("accuracy", none, none, accuracy, total),
        row("macro avg", macro(p0, p1), macro(r0, r1), macro(f0, f1), total),
        row("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), total),
    ]
    return counts.select(F.inline(F.array(*rows)))


def precision1(label: str, predicted: str) -> Column:
    hit = F.count_if((F.col(predicted) == 1) & (F.col(label) == 1))
    return ratio0(hit, F.count_if(F.col(predicted) == 1))


def recall1(label: str, predicted: str) -> Column:
    hit = F.count_if((F.col(predicted) == 1) & (F.col(label) == 1))
    return ratio0(hit, F.count_if(F.col(label) == 1))


def precision_recall_f(df: DataFrame, label: str = "y", predicted: str = "y_pred", beta: float = 1.0) -> DataFrame:
    one = df.agg(precision1(label, predicted).alias("precision_1"), recall1(label, predicted).alias("recall_1"))
    return one.withColumn("fscore", fscore(F.col("precision_1"), F.col("recall_1"), beta))


def above(df: DataFrame, score: str, threshold: float, name: str = "y_pred") -> DataFrame:
    """1 strictly above the threshold, as the selection metrics have it."""
    return df.withColumn(name, F.when(numbers.missing_if_nan(F.col(score)) > threshold, 1).otherwise(0))


def pr_metric(df: DataFrame, score: str, label: str, threshold: float, beta: float = 1.0) -> DataFrame:
    """Negative F-beta at a threshold, so that smaller is better."""
    f = precision_recall_f(above(df, score, threshold), label, "y_pred", beta)
    return f.select(F.when(F.col("fscore") == 0, 0.0).otherwise(-F.col("fscore")).alias("metric"))


def _fixed_profit(label: Column, refused: Column) -> Column:
    return F.when(refused, 0).when(label == 0, GOOD_LOAN).otherwise(BAD_LOAN)


def profit_metric(df: DataFrame, score: str, label: str, threshold: float) -> DataFrame:
    """Profit of accepting all minus profit of accepting up to the threshold."""
    y, refused = F.col(label), numbers.false_if_null(numbers.missing_if_nan(F.col(score)) > threshold)
    sums = df.agg(
        F.coalesce(F.sum(_fixed_profit(y, refused)), F.lit(0)).alias("profit_pred"),
        F.coalesce(F.sum(_fixed_profit(y, F.lit(False))), F.lit(0)).alias("profit_actual"),
        F.count_if(refused).alias("refused"),
    )
    metric = F.when(F.col("refused") == 0, NOTHING_REFUSED).otherwise(F.col("profit_actual") - F.col("profit_pred"))
    return sums.select("profit_pred", "profit_actual", metric.cast("bigint").alias("metric"))


def profitability(df: DataFrame, predicted: str = "y_pred", profit: str = "profit") -> DataFrame:
    """Profit of the accepted, of the denied ("anti-profit", per row and per denied loan) and of all."""
    denied = F.col(predicted) == 1
    sums = df.agg(
        numbers.sum_if(~denied, F.col(profit)).cast("double").alias("predicted_profit"),
        numbers.sum_if(denied, F.col(profit)).cast("double").alias("anti_profit"),
        numbers.sum_or_zero(F.col(profit)).alias("actual_profit"),
        F.count(F.lit(1)).alias("loans"),
        F.count_if(denied).alias("denied"),
    )
    return sums.withColumns(
        {
            "anti_profit_per_loan": numbers.ratio(F.col("anti_profit"), F.col("loans")),
            "anti_profit_per_denied": numbers.ratio(F.col("anti_profit"), F.col("denied")),
        }
    )


def p90_accuracy(df: DataFrame, score: str = "p", label: str = "y") -> DataFrame:
    """Positives in the top tenth minus positives in the bottom tenth, edges included."""
    low, high = distribution.percentile_values(df, score, [10, 90])
    top = numbers.sum_if(F.col(score) >= F.lit(high), F.col(label))
    bottom = numbers.sum_if(F.col(score) <= F.lit(low), F.col(label))
    return df.agg((top - bottom).cast("bigint").alias("delta"))


def roc_auc(df: DataFrame, score: str = "p", label: str = "y", weight: str | None = None) -> DataFrame:
    """Area under the ROC curve: share of (positive, negative) pairs in the right order, ties half.

    The rows are first summed per distinct score; no pair is ever formed.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    spread = ordered.spread_of(df, score)[score]
    groups = (
        df.filter(ordered.present(F.col(score).cast("double")))
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(
            numbers.sum_if(F.col(label) == 1, w).cast("double").alias("positive"),
            numbers.sum_if(F.col(label) == 0, w).cast("double").alias("negative"),
        )
    )
    # Counted from both sides, so that both uses of the groups need the same columns and share one shuffle.
    ranked = ordered.running_totals(groups, "score", ["positive", "negative"], spread.cuts)
    right = F.sum(F.col("positive") * (F.col("negative_before") + F.col("negative") / 2))
    wrong = F.sum(F.col("negative") * (F.col("positive_before") + F.col("positive") / 2))
    return ranked.agg(right.alias("right"), wrong.alias("wrong")).select(
        numbers.ratio(F.col("right"), F.col("right") + F.col("wrong")).alias("auc")
    )


def positive_rates(df: DataFrame, label: str = "y", predicted: str = "y_pred") -> DataFrame:
    """Actual and predicted positives, as numbers and in percent with one digit."""
    rate = lambda c: F.bround(F.avg(c) * 100, 1)
    return df.agg(
        F.count_if(F.col(label) == 1).alias("actual"),
        rate(label).alias("actual_pct"),
        F.count_if(F.col(predicted) == 1).alias("predicted"),
        rate(predicted).alias("predicted_pct"),
    )


def anti_profit_by_month(
    df: DataFrame, score: str, cut: float, month: Column | None = None, profit: str = "profit"
) -> DataFrame:
    """Average profit of flagged loans per month, rounded half to even."""
    month = dates.month_key(F.col("request_date")) if month is None else month
    flagged = df.filter(F.col(score) >= F.lit(cut)).withColumn("month", month).filter(F.col("month").isNotNull())
    return flagged.groupBy("month").agg(F.bround(F.avg(profit), 0).alias("anti_profit_per_loan"))


def mean_anti_profit(by_month: DataFrame) -> DataFrame:
    return by_month.agg(F.avg("anti_profit_per_loan").alias("mean_anti_profit"))


def backtest_summary(df: DataFrame, label: str = "y", predicted: str = "y_pred", profit: str | None = "profit") -> DataFrame:
    """One row: sizes, predicted and actual positives, accuracy, class-1 quality, and anti-profit."""
    y, yhat = F.col(label), F.col(predicted)
    aggregates = [
        F.count(F.lit(1)).alias("loans"),
        F.count_if(yhat == 1).alias("predicted_positives"),
        F.count_if(y == 1).alias("actual_positives"),
        numbers.ratio(F.count_if(yhat == 1), F.count(F.lit(1))).alias("predicted_share"),
        numbers.ratio(F.count_if(y == yhat), F.count(F.lit(1))).alias("accuracy"),
        precision1(label, predicted).alias("precision_1"),
        recall1(label, predicted).alias("recall_1"),
    ]
    if profit:
        denied_profit = numbers.sum_if(yhat == 1, F.col(profit)).cast("double")
        aggregates += [
            denied_profit.alias("total_anti_profit"),
            numbers.ratio(denied_profit, F.count_if(yhat == 1)).alias("avg_anti_profit"),
        ]
    return df.agg(*aggregates).withColumn("f1_1", fscore(F.col("precision_1"), F.col("recall_1")))


def acceptance(df: DataFrame, score: str, cut: float) -> DataFrame:
    """Share accepted, and the mean score, of logged applications."""
    value = numbers.missing_if_nan(F.col(score))
    accepted = F.when(value >= F.lit(cut), 0.0).otherwise(1.0)
    return df.filter(value.isNotNull()).agg(
        F.count(F.lit(1)).alias("scored"), F.avg(accepted).alias("acceptance_rate"), F.avg(value).alias("mean_score")
    )


def backtest(
    df: DataFrame, score: str, cut: float, cutoff: float = 50.0, profit: str = "profit", label: str = "y_test", predicted: str = "y_pred"
) -> tuple[DataFrame, DataFrame]:
    """Label by profit, flag by score, and sum up: the labelled rows' summary and class report."""
    flagged = df.withColumns(
        {
            label: F.when(F.col(profit) < cutoff, 1).otherwise(0),
            predicted: F.when(numbers.missing_if_nan(F.col(score)) >= F.lit(cut), 1).otherwise(0),
        }
    )
    return backtest_summary(flagged, label, predicted, profit), classification_report(flagged, label, predicted)


def learning_curve(trials: DataFrame, run: str = "run_id", chunk: float = 60.0) -> DataFrame:
    """Best accuracy so far (1 − smallest loss) along the wall clock of each run.

    Trials are first cut to the best per run and moment, then the running minimum is taken inside
    minutes and carried over from the minutes before, so a long run is spread over many tasks.
    """
    best = trials.groupBy(run, "wall_clock_time").agg(F.min("validation_loss").alias("loss"))
    # The test for null is what the join below implies; stated here it lets both uses share one shuffle.
    minutes = best.withColumn("_chunk", F.floor(F.col("wall_clock_time") / chunk)).filter(
        F.col(run).isNotNull() & F.col("_chunk").isNotNull()
    )
    inside = Window.partitionBy(run, "_chunk").orderBy("wall_clock_time").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(run).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    earlier = minutes.groupBy(run, "_chunk").agg(F.min("loss").alias("_least")).select(
        run, "_chunk", F.min("_least").over(before).alias("_earlier")
    )
    local = minutes.withColumn("_so_far", F.min("loss").over(inside))
    return local.join(earlier, [run, "_chunk"]).select(
        run, "wall_clock_time", (1 - F.least("_so_far", "_earlier")).alias("best_accuracy")
    )
