"""Training runs from raw profiles to a stored model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from loanloom.operators import cleaning, evaluation, models, splits, stacking
from loanloom.plans import training
from loanloom.sources.feature_spec import DEFAULT_SPEC, REFUSAL_SPEC

@dataclass(frozen=True)
class Run:
    model: models.RiskModel
    trials: list[models.Trial]
    test: DataFrame


def default_frame(accepted: DataFrame, validation: list[str], test: list[str], ramp_year: int, key: str) -> tuple[DataFrame, list[str]]:
    """Labelled, filtered and engineered rows with weight and split, and the list of features."""
    labelled = cleaning.with_default_label(cleaning.with_profit(cleaning.harmonise(accepted)))
    weighted = cleaning.with_recency_weight(cleaning.with_month_key(labelled), ramp_year)
    split = splits.split_by_month(cleaning.base_filter(weighted, DEFAULT_SPEC), validation, test)
    carry = list(dict.fromkeys([key, "status", "profit", "weight", "split", "request_date"]))
    table = cleaning.feature_engineer(split, DEFAULT_SPEC, cleaning.MODEL_STEPS["default"], carry)
    return table, [c for c in table.columns if c not in carry]


def train_default(
    accepted: DataFrame,
    validation: list[str],
    test: list[str],
    key: str,
    ramp_year: int,
    grid: list[models.Params],
    metric: models.Metric = models.auc_loss,
) -> Run:
    """Weighted booster chosen on the validation months; the result carries the scored test months."""
    table, features = default_frame(accepted, validation, test, ramp_year, key)
    part = lambda name: table.filter(F.col("split") == name)
    model, trials = models.train_with_validation(
        part("train"), part("validation"), DEFAULT_SPEC, "default", features, grid, "weight", metric
    )
    return Run(model, trials, _scored(part("test"), model, [key, "status", "profit"]))


def train_stacked_default(
    accepted: DataFrame, trials: list[models.Trial], key: str, ramp_year: int, members: int = 3, folds: int = 5
) -> tuple[models.RiskModel, DataFrame]:
    """The best settings of a search stacked over all labelled rows, and the out-of-fold table."""
    table, features = default_frame(accepted, [], [], ramp_year, key)
    settings = stacking.best_settings(trials, members)
    return stacking.train_stacked(table, DEFAULT_SPEC, "default", features, key, settings, "weight", folds)


def refusal_frame(accepted: DataFrame, refused: DataFrame, key: str, share: float, seed: int) -> tuple[DataFrame, list[str]]:
    """Accepted ∪ refused rows with a known age, engineered, with a hashed split."""
    union = training.build_refusal_training(accepted, refused, DEFAULT_SPEC)
    split = splits.split_random(union, share, key, seed)
    carry = list(dict.fromkeys([key, "refused", "split", "request_date"]))
    table = cleaning.feature_engineer(split, REFUSAL_SPEC, cleaning.MODEL_STEPS["refusal"], carry)
    return cleaning.drop_missing(table, ["age"]), [c for c in table.columns if c not in carry]


def train_refusal(
    accepted: DataFrame,
    refused: DataFrame,
    key: str,
    grid: list[models.Params],
    share: float = 0.15,
    folds: int = 5,
    seed: int = 123,
) -> Run:
    """Booster chosen by cross-validation; the result carries the scored test share."""
    table, features = refusal_frame(accepted, refused, key, share, seed)
    part = lambda name: table.filter(F.col("split") == name)
    model, trials = models.train_cross_validated(part("train"), REFUSAL_SPEC, "refusal", features, key, grid, folds, seed=seed)
    return Run(model, trials, _scored(part("test"), model, [key, "refused"]))


def backtest_month(
    accepted: DataFrame, model: models.RiskModel, month: str, key: str, percentile: int = 80, cutoff: float = 50.0
) -> tuple[DataFrame, DataFrame]:
    """A month's loans filtered, engineered and scored by a model, either of the two, and refused from the model's own
    percentile on: summary and class report of the loans that the filter kept, labelled by profit."""
    rows = cleaning.for_month(cleaning.with_profit(cleaning.harmonise(accepted)), month)
    scored = models.score(rows, model, [key, "profit"])
    return evaluation.backtest(scored, models.SCORE, model.percentiles[percentile], cutoff)


def _scored(df: DataFrame, model: models.RiskModel, carry: list[str]) -> DataFrame:
    return models.with_score(df, model, models.SCORE).select(*carry, models.SCORE)
