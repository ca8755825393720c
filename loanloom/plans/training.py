"""Training tables: monthly outcomes and accepted ∪ refused applications."""

from __future__ import annotations

from pyspark.sql import DataFrame

from loanloom.operators import cleaning, joins
from loanloom.sources.feature_spec import FeatureSpec

# Outcome-file headings and the names used from here on.
OUTCOME_NAMES = {
    "Loan Id": "loan_id",
    "Released Date": "release_date",
    "Principal Amount": "principal",
    "Paid Amount": "total_paid",
    "Loan Status Name": "loan_status",
}


def build_monthly_training(
    applications: DataFrame, outcomes: DataFrame, month: str, key: str, names: dict[str, str] | None = None
) -> DataFrame:
    """One month's applications without exact duplicates, with their loan outcome and profit.

    Raises when a key occurs twice on either side after de-duplication.
    """
    monthly = joins.dedupe(cleaning.for_month(applications, month))
    renamed = cleaning.with_profit(cleaning.rename(outcomes, names or OUTCOME_NAMES))
    return joins.join_one_to_one(monthly, renamed, [key])


def build_refusal_training(
    accepted: DataFrame, refused: DataFrame, spec: FeatureSpec, accepted_id: str | None = None, refused_id: str | None = None
) -> DataFrame:
    """Accepted applications that pass the base filter (0) and refused ones that pass the pre-screen (1)."""
    passed = cleaning.base_filter(cleaning.harmonise(accepted, accepted_id), spec)
    screened = cleaning.prescreen(cleaning.rolling_sums(cleaning.harmonise(refused, refused_id)))
    return joins.union_tables(cleaning.tag(passed, "refused", 0), cleaning.tag(screened, "refused", 1))
