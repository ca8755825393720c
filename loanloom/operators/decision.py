"""From scores and thresholds to accept / refuse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loanloom.functions import numbers
from loanloom.operators import cleaning, distribution, joins, rules
from loanloom.sources.feature_spec import DEFAULT_SPEC, REFUSAL_SPEC

ACCEPT, REFUSE, NOT_SCORED, ERROR = "accept", "refuse", "n/a", "error"
FILTERED = "Empty dataframe after filtering"
BAD_THRESHOLD = "threshold is not one of the percentiles 5, 10, ... 95"


def classify(
    df: DataFrame, score: str, threshold: float | None = None, percentile: float | None = None, name: str = "y_pred"
) -> DataFrame:
    """1 where the score reaches the threshold, given as a value or as a percentile of the scores."""
    if (threshold is None) == (percentile is None):
        raise ValueError("give either threshold or percentile")
    if threshold is None:
        [threshold] = distribution.percentile_values(df, score, [percentile])
    return df.withColumn(name, F.when(numbers.missing_if_nan(F.col(score)) >= F.lit(threshold), 1).otherwise(0))


def threshold_key(threshold: Column) -> Column:
    """0.75 → 75. Null where that is not a stored percentile."""
    key = F.round(numbers.missing_if_nan(threshold) * 100).try_cast("int")
    return F.when(key.between(5, 95) & (key % 5 == 0), key)


def with_threshold_key(df: DataFrame, col: str, name: str) -> DataFrame:
    """The percentile step of a threshold, and an error text where there is none."""
    key = threshold_key(F.col(col))
    return df.withColumns({name: key, f"{name}_error": F.when(key.isNull(), BAD_THRESHOLD)})


def score_at(key: Column, values: list[float]) -> Column:
    """The score that belongs to a percentile step; ``values`` are those of 5, 10, … 95."""
    return numbers.pick(values, (key / 5).cast("int"))


def combined_decision(
    df: DataFrame, refusal_cut: float, default_cut: float, refusal: str = "refusal_score", default: str = "default_score"
) -> DataFrame:
    """Refuse when either model's score reaches its cut."""
    refuse = (numbers.missing_if_nan(F.col(refusal)) >= refusal_cut) | (numbers.missing_if_nan(F.col(default)) >= default_cut)
    return df.withColumn("uw_decision", F.when(refuse, REFUSE).otherwise(ACCEPT))


def passes_filters(df: DataFrame) -> Column:
    """Would both models' filters keep the row?"""
    conditions = [c for spec in (REFUSAL_SPEC, DEFAULT_SPEC) for _, c in cleaning.threshold_rules_present(df, spec)]
    conditions += [c for _, c in cleaning.quality_rules(df)]
    passed = F.lit(True)
    for c in conditions:
        passed = passed & numbers.false_if_null(c)
    return passed


def decide(scored: DataFrame, refusal_values: list[float], default_values: list[float]) -> DataFrame:
    """Decision columns for rows that carry auto_refuse, both scores and both thresholds.

    Order: automatic refusal, then rows the filter takes out, then a bad threshold, then the scores.
    Score and percentile are the means over the two models; an automatic refusal has 1 and 100 and no
    model scores.
    """
    c = F.col
    scored = scored.withColumns({x: numbers.missing_if_nan(c(x)) for x in ("refusal_score", "default_score")})
    table = scored.withColumns(
        {
            "_passes": passes_filters(scored) & c("refusal_score").isNotNull() & c("default_score").isNotNull(),
            "_refusal_key": threshold_key(c("refusal_threshold")),
            "_default_key": threshold_key(c("default_threshold")),
            "_refusal_pct": distribution.bucket_of(c("refusal_score"), refusal_values),
            "_default_pct": distribution.bucket_of(c("default_score"), default_values),
        }
    )
    bad = c("_refusal_key").isNull() | c("_default_key").isNull()
    over = (c("refusal_score") >= score_at(c("_refusal_key"), refusal_values)) | (
        c("default_score") >= score_at(c("_default_key"), default_values)
    )

    def by_case(auto, filtered, broken, rest) -> Column:
        return F.when(c("auto_refuse"), auto).when(~c("_passes"), filtered).when(bad, broken).otherwise(rest)

    none = F.lit(None)
    outcome = {
        "uw_decision": by_case(REFUSE, NOT_SCORED, ERROR, F.when(over, REFUSE).otherwise(ACCEPT)),
        "score": by_case(1.0, 0.0, none, (c("refusal_score") + c("default_score")) / 2),
        "percentile": by_case(100.0, 0.0, none, (c("_refusal_pct") + c("_default_pct")) / 2),
        "info": by_case("auto_refuse", FILTERED, BAD_THRESHOLD, none),
        "refusal_percentile": by_case(none, none, none, c("_refusal_pct")),
        "default_percentile": by_case(none, none, none, c("_default_pct")),
        "refusal_score": by_case(none, none, none, c("refusal_score")),
        "default_score": by_case(none, none, none, c("default_score")),
    }
    kept = [x for x in table.columns if not x.startswith("_") and x not in outcome]
    return table.select(*kept, *[value.alias(name) for name, value in outcome.items()])


def underwrite(
    applications: DataFrame,
    transactions: DataFrame,
    scores: DataFrame,
    thresholds: DataFrame,
    refusal_values: list[float],
    default_values: list[float],
    key: str = "application_id",
    as_of: str | None = None,
    tie: str | None = None,
) -> DataFrame:
    """One decision per application; no input row is lost.

    ``transactions`` and ``scores`` are keyed like the applications. Thresholds are the newest record, or
    with ``as_of`` the version in force on that day.
    """
    flagged = rules.auto_refuse(applications, transactions, key)
    scored = flagged.join(scores.select(key, "refusal_score", "default_score"), key, "left")
    return decide(joins.with_thresholds(scored, thresholds, as_of, tie=tie), refusal_values, default_values)


def underwrite_flagged(
    applications: DataFrame, scores: DataFrame, thresholds: DataFrame, refusal_values: list[float], default_values: list[float],
    key: str = "application_id", as_of: str | None = None, tie: str | None = None,
) -> DataFrame:
    """``underwrite`` for applications that carry the counts of ``rules.FLAGS``, such as those of a stream; the counts are used up."""
    basic = cleaning.with_auto_refuse_basic(applications).withColumn("auto_refuse_computed", rules.refused_by_flags()).drop(*rules.FLAGS)
    flagged = basic.withColumn("auto_refuse", F.col("auto_refuse_basic") | F.col("auto_refuse_computed"))
    scored = flagged.join(scores.select(key, "refusal_score", "default_score"), key, "left")
    return decide(joins.with_thresholds(scored, thresholds, as_of, tie=tie), refusal_values, default_values)


def false_negatives(df: DataFrame, label: str = "y", predicted: str = "y_pred") -> DataFrame:
    """Actual refusals that the model would have let through: the cases to look into."""
    return df.filter((F.col(label) == 1) & (F.col(predicted) == 0))
