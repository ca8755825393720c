"""From applications and transactions to decisions, with fitted models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from loanloom.functions import dates
from loanloom.operators import cleaning, decision, distribution, joins, models, rules


def _request_date(df: DataFrame) -> Column:
    if isinstance(df.schema["request_date"].dataType, T.StringType):
        return dates.parse_date(F.col("request_date"))
    return F.to_date("request_date")


def percentiles_of(model: models.RiskModel) -> list[float]:
    return [model.score_at(p) for p in distribution.PERCENTILES]


def underwrite_with_models(
    applications: DataFrame,
    transactions: DataFrame | None,
    thresholds: DataFrame,
    refusal_model: models.RiskModel,
    default_model: models.RiskModel,
    key: str = "application_id",
    as_of: str | None = None,
    tie: str | None = None,
    document: str | None = None,
) -> DataFrame:
    """One decision per application in a single lazy plan.

    Transactions are a table keyed like the applications, or with ``document`` a column of the applications,
    in which case nothing is shuffled at all. Both models score the same engineered rows one after the
    other, so scores need no join. Rows that the models' filter would drop are scored too and
    then decided as not scored.
    """
    dated = cleaning.harmonise(applications).withColumn("request_date", _request_date(applications))
    engineered = cleaning.engineered(dated, cleaning.MODEL_STEPS["default"])
    scored = models.with_score(engineered, refusal_model, "refusal_score")
    scored = models.with_score(scored, default_model, "default_score")
    needed = [
        c
        for c in dict.fromkeys(
            [key, "Id", "error", "request_date", "account_age_days", "count_nsf_90_days", "count_nsf_30_days",
             "count_stop_payment_90_days", *default_model.spec.minima, *default_model.spec.maxima,
             *refusal_model.spec.minima, *refusal_model.spec.maxima, *([document] if document else [])]
        )
        if c in scored.columns
    ]
    narrow = scored.select(*needed, "refusal_score", "default_score")
    flagged = rules.auto_refuse_documents(narrow, document) if document else rules.auto_refuse(narrow, transactions, key)
    ready = joins.with_thresholds(flagged, thresholds, as_of, tie=tie)
    return decision.decide(ready, percentiles_of(refusal_model), percentiles_of(default_model))
