"""Training, scoring and explaining the two binary models: boosted trees that send missing values to a learned side of every split."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loanloom.operators import cleaning, distribution, evaluation, shapley, trees
from loanloom.operators.trees import forest_losses
from loanloom.session import shared_dir
from loanloom.sources.feature_spec import FeatureSpec

SCORE = "pred_proba"
Params = dict[str, float | int]
Metric = Callable[[DataFrame, str, str], float]


def auc_loss(df: DataFrame, score: str, label: str) -> float:
    """1 − AUC; 0.5 when the table lacks one of the classes."""
    auc = evaluation.roc_auc(df, score, label).first()["auc"]
    return 0.5 if auc is None else 1 - auc


def p90_loss(df: DataFrame, score: str, label: str) -> float:
    return -float(evaluation.p90_accuracy(df, score, label).first()["delta"])


def pr_loss(threshold: float, beta: float = 1.0) -> Metric:
    return lambda df, score, label: float(evaluation.pr_metric(df, score, label, threshold, beta).first()["metric"])


def profit_loss(threshold: float) -> Metric:
    return lambda df, score, label: float(evaluation.profit_metric(df, score, label, threshold).first()["metric"])


@dataclass(frozen=True)
class Trial:
    record_id: int
    config: Params
    validation_loss: float
    trial_time: float
    wall_clock_time: float
    share: float = 1.0


@dataclass(frozen=True)
class RiskModel:
    """A fitted booster with what is needed to apply it."""

    name: str
    spec: FeatureSpec
    booster: trees.Booster
    features: list[str]
    percentiles: dict[int, float] = field(default_factory=dict)

    @property
    def steps(self) -> tuple[cleaning.Step, ...]:
        return cleaning.MODEL_STEPS[self.name]

    def score_at(self, percentile: int) -> float:
        return self.percentiles[percentile]


# --- training --------------------------------------------------------------------------------------

#: What a grid entry may set, and the booster's own names.
SETTINGS = {"maxIter": "rounds", "maxDepth": "depth", "stepSize": "rate", "l2": "l2", "minWeight": "least"}
#: One of so many candidates goes on to the next, so many times larger sample.
HALVING = 3
#: Samples are no smaller than this share of the rows.
LEAST_SHARE = 1 / 9


def candidate(params: Params, **more) -> trees.Candidate:
    return trees.Candidate(**{SETTINGS[k]: type(getattr(trees.Candidate, SETTINGS[k]))(v) for k, v in params.items()}, **more)


def shares(candidates: int) -> list[float]:
    """Shares of the rows for each step of a search that keeps one candidate in ``HALVING``, the last step over all rows."""
    steps = [1.0]
    while HALVING ** len(steps) < candidates and steps[0] / HALVING >= LEAST_SHARE - 1e-9:
        steps.insert(0, steps[0] / HALVING)
    return steps


def _written(df: DataFrame) -> DataFrame:
    path = shared_dir(df.sparkSession, "margins")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _search(grid: list[Params], judge: Callable[[list[Params], float], tuple[list, list[float]]]) -> tuple[object, list[Trial]]:
    """Successive halving: ``judge`` fits a list of settings on a share of the rows and gives back models and losses; the rest drop out."""
    started, trials, left = time.time(), [], list(grid)
    for share in shares(len(grid)):
        begun = time.time()
        fitted, found = judge(left, share)
        now = time.time()
        trials += [Trial(len(trials) + i, p, loss, (now - begun) / len(left), now - started, share) for i, (p, loss) in enumerate(zip(left, found, strict=True))]
        order = sorted(range(len(left)), key=lambda i: found[i])
        best = fitted[order[0]]
        left = [left[i] for i in order[: max(1, math.ceil(len(left) / HALVING))]]
    return best, trials


def _part(df: DataFrame, key: str | None, seed: int) -> Column:
    """The hash that folds and samples of rows are made from: of the key, or of the whole row."""
    return F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in ([key] if key else df.columns)])


def search_samples(train: DataFrame, key: str, steps: list[float], seed: int = 123) -> DataFrame:
    """key and members: for each share in ``steps``, whether a search over ``train`` fits the row in that step."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column("_part").to_numpy()
            inside = np.stack([trees.sampled(part, s) if s < 1 else np.ones(len(part), dtype=bool) for s in steps], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(inside.tolist(), pa.list_(pa.bool_()))], [key, "members"])

    rows = train.select(key, _part(train, None, seed).alias("_part"))
    return rows.mapInArrow(members, rows.select(key, F.array().cast("array<boolean>").alias("members")).schema)


def train_with_validation(
    train: DataFrame,
    validation: DataFrame,
    spec: FeatureSpec,
    name: str,
    features: list[str],
    grid: list[Params],
    weight: str | None = None,
    metric: Metric = auc_loss,
    seed: int = 123,
) -> tuple[RiskModel, list[Trial]]:
    """The booster of the grid entry with the smallest loss on ``validation``, among those fitted on all of ``train``.

    Bins are fitted once. All candidates of a step grow together; 1 − AUC is computed for all of them in one aggregate, other metrics one by one.
    """
    label = spec.target
    bins = trees.fit_bins(train, features, label)
    table = _written(trees.compact(trees.binned(train, bins, label, F.col(weight) if weight else None, _part(train, None, seed)))).persist()
    judged = trees.binned(validation, bins, label).persist()

    def judge(settings: list[Params], share: float) -> tuple[list[trees.Booster], list[float]]:
        candidates = [candidate(p, share=share) for p in settings]
        own, base = trees.boost(table, len(features), bins.count, candidates, _written)
        boosters = [trees.Booster.of(bins, base, t) for t in own]
        if metric is auc_loss:
            return boosters, trees.candidate_losses(judged, len(features), candidates, own, base)
        return boosters, [metric(b.with_probability(validation, SCORE).select(label, SCORE), SCORE, label) for b in boosters]

    try:
        best, trials = _search(grid, judge)
    finally:
        table.unpersist()
        judged.unpersist()
    return RiskModel(name, spec, best, features), trials


def train_cross_validated(
    train: DataFrame, spec: FeatureSpec, name: str, features: list[str], key: str, grid: list[Params], folds: int = 5, seed: int = 123
) -> tuple[RiskModel, list[Trial]]:
    """The booster of the grid entry with the best cross-validated AUC, fitted on all rows; folds come from a hash of the key, so they repeat.

    The boosters of all entries and folds grow together.
    """
    label = spec.target
    bins = trees.fit_bins(train, features, label)
    table = _written(trees.compact(trees.binned(train, bins, label, part=_part(train, key, seed)))).persist()

    def judge(settings: list[Params], share: float) -> tuple[list[Params], list[float]]:
        candidates = [candidate(p, share=share, fold=f) for p in settings for f in range(folds)]
        own, base = trees.boost(table, len(features), bins.count, candidates, _written, folds)
        found = trees.candidate_losses(table, len(features), candidates, own, base, folds)
        return settings, [sum(found[i * folds : (i + 1) * folds]) / folds for i in range(len(settings))]

    try:
        best, trials = _search(grid, judge)
        own, base = trees.boost(table, len(features), bins.count, [candidate(best)], _written)
    finally:
        table.unpersist()
    return RiskModel(name, spec, trees.Booster.of(bins, base, own[0]), features), trials


def best_params(trials: list[Trial]) -> Params:
    """The settings with the smallest loss among those fitted on the most rows."""
    return min(trials, key=lambda t: (-t.share, t.validation_loss)).config


def refit_full(
    df: DataFrame, spec: FeatureSpec, name: str, features: list[str], params: Params, weight: str | None = None, seed: int = 123
) -> RiskModel:
    """Fit the chosen parameters on all rows and store the score percentiles of those rows."""
    bins = trees.fit_bins(df, features, spec.target)
    table = _written(trees.compact(trees.binned(df, bins, spec.target, F.col(weight) if weight else None, _part(df, None, seed)))).persist()
    try:
        own, base = trees.boost(table, len(features), bins.count, [candidate(params)], _written)
    finally:
        table.unpersist()
    booster = trees.Booster.of(bins, base, own[0])
    scores = booster.with_probability(df.select(*features), SCORE).select(SCORE).persist()
    try:
        values = distribution.percentile_values(scores, SCORE)
    finally:
        scores.unpersist()
    return RiskModel(name, spec, booster, features, dict(zip(distribution.PERCENTILES, values)))


# --- application -----------------------------------------------------------------------------------


def _model_input(df: DataFrame, model: RiskModel, keys: list[str], filtered: bool, engineer: bool) -> DataFrame:
    if filtered:
        df = cleaning.base_filter(df, model.spec)
    if engineer:
        df = cleaning.feature_engineer(df, model.spec, model.steps, keys)
    return df.select(*dict.fromkeys([*keys, *model.features]))


def score(df: DataFrame, model: RiskModel, keys: list[str], filtered: bool = True, engineer: bool = True) -> DataFrame:
    """Probability of class 1 for every row the filter keeps; no rows in, no rows out."""
    return model.booster.with_probability(_model_input(df, model, keys, filtered, engineer), SCORE).select(*keys, SCORE)


def with_score(df: DataFrame, model: RiskModel, name: str) -> DataFrame:
    """Add one model's score to a table that has its engineered features. No row is filtered and nothing
    is shuffled, so several models can score one table in a row."""
    return model.booster.with_probability(df, name)


def predict(df: DataFrame, model: RiskModel, keys: list[str]) -> DataFrame:
    """The model's own class, cut at one half."""
    return score(df, model, keys).select(*keys, (F.col(SCORE) > 0.5).cast("int").alias("pred"))


def feature_importance(spark: SparkSession, *models: RiskModel) -> DataFrame:
    """Importance per model and input, largest first: its share of the gain of all splits. One row per input of a model."""
    rows = [(m.name, variable, importance) for m in models for variable, importance in m.booster.importance().items()]
    return spark.createDataFrame(rows, "model string, variable string, importance double").orderBy(
        "model", F.desc("importance"), "variable"
    )


def trials_table(spark: SparkSession, trials: list[Trial], run_id: str, learner: str = "gbt") -> DataFrame:
    rows = [
        (run_id, t.record_id, {k: float(v) for k, v in t.config.items()}, t.validation_loss, t.trial_time, t.wall_clock_time, learner, t.share)
        for t in trials
    ]
    schema = (
        "run_id string, record_id int, config map<string,double>, validation_loss double, trial_time double, "
        "wall_clock_time double, learner string, share double"
    )
    return spark.createDataFrame(rows, schema)


def attribute_scores(df: DataFrame, model: RiskModel, features: list[str], keys: list[str]) -> DataFrame:
    """How much each row's score changes with each feature alone at its background mean: the score minus the score so changed.

    Each row's inputs are repeated once per feature with that one entry replaced, and scored in place:
    nothing is shuffled. Numeric features only; the means are one row.
    """
    base = _model_input(df, model, keys, True, True)
    means = base.agg(*[F.avg(c).alias(c) for c in features]).first().asDict()
    booster, positions = model.booster, {c: i for i, c in enumerate(model.booster.bins.features)}
    own = base.select(*keys, F.array(*booster.bins.inputs()).alias("_inputs"))
    own = own.withColumn(SCORE, 1 / (1 + F.exp(-booster.margin("_inputs"))))
    changes = F.array(*[
        F.struct(F.lit(c).alias("variable"), F.lit(positions[c]).alias("position"), F.lit(float(means[c])).alias("mean"))
        for c in features
    ])
    repeated = own.select(*keys, SCORE, "_inputs", F.inline(changes))
    values = F.transform("_inputs", lambda v, i: F.when(i == F.col("position"), F.col("mean")).otherwise(v))
    swapped = repeated.select(*keys, "variable", SCORE, values.alias("_changed"))
    return swapped.select(*keys, "variable", SCORE, (F.col(SCORE) - 1 / (1 + F.exp(-booster.margin("_changed")))).alias("attribution"))


def shapley_scores(df: DataFrame, model: RiskModel, keys: list[str]) -> DataFrame:
    """Shapley values of every scored row and feature: keys, variable, value, and the row's margin and the model's mean margin.

    A row's values add up to its margin (log odds) minus the mean margin over the rows the trees were fitted on.
    """
    base = _model_input(df, model, keys, True, True)
    booster = model.booster
    paths, mean = shapley.paths(booster), shapley.expected_margin(booster)
    inputs = base.select(*keys, F.array(*booster.bins.inputs()).alias("_inputs")).withColumn("margin", booster.margin("_inputs"))

    def attribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for b in batches if b.num_rows):
            flat = batch.column("_inputs").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            values = shapley.attributions(paths, booster.bins.encode(list(flat.T.astype(float))))
            kept = [batch.column(c) for c in [*keys, "margin"]]
            offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1])
            yield pa.RecordBatch.from_arrays([*kept, pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))], [*keys, "margin", "_values"])

    schema = inputs.select(*keys, "margin", F.array().cast("array<double>").alias("_values")).schema
    names = F.array(*(F.lit(c) for c in booster.bins.features))
    pairs = F.arrays_zip(names.alias("variable"), F.col("_values").alias("value"))
    return inputs.mapInArrow(attribute, schema).select(*keys, "margin", F.lit(mean).alias("mean_margin"), F.inline(pairs))


def forest_loss(
    df: DataFrame, label: str, key: str, seed: int = 123, trees: int = 20, depth: int = 5, folds: int = 5
) -> Callable[[list[str]], float]:
    """Loss of a random forest on any list of columns: 1 − AUC, the mean over ``folds`` hashed parts, each judged by trees that were grown
    on the others. For many lists use ``trees.forest_losses``, which grows them together."""
    return lambda features: forest_losses(df, [features], label, key, seed, trees, depth, folds)[0]
