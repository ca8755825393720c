"""Vintage report over all branches: monthly tables, curves, returns and quarterly shares."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from loanloom.functions import dates
from loanloom.operators import cohorts
from loanloom.sources import sinks

# Fixed value: the branch whose files carry day-first dates.
DAY_FIRST_BRANCHES = ("b",)


def with_branch_date(df: DataFrame, text: str, name: str, day_first: tuple[str, ...] = DAY_FIRST_BRANCHES) -> DataFrame:
    """Parse a text date by the format of the row's branch."""
    parsed = F.when(F.col("branch").isin(*day_first), dates.parse_date(F.col(text), dayfirst=True)).otherwise(
        dates.parse_date(F.col(text))
    )
    return df.withColumn(name, parsed)


def aged_repayments(loans: DataFrame, repayments: DataFrame, key: str = "loan_id") -> DataFrame:
    """Repayments of disbursed loans with release cohort, collection month and loan age, none of them null.

    An inner join: loans without a repayment, and rows without a date, have no loan age and would drop out
    of every curve.
    """
    paid_out = cohorts.disbursed(loans).filter(F.col("release_date").isNotNull() & F.col("branch").isNotNull())
    released = cohorts.with_date_parts(paid_out, "release_date", "release").select(
        key, "branch", "release_date", "release_year", "release_month", "principal"
    )
    paid = repayments.filter(F.col("collection_date").isNotNull()).select(key, "collection_date", "amount")
    joined = released.join(paid, key, "inner")
    return cohorts.with_loan_age(cohorts.with_date_parts(joined, "collection_date", "collection"))


def cashflow_curve(weekly: DataFrame, cohort: list[str]) -> DataFrame:
    return cohorts.normalised_curve(cohorts.cumulative_cashflow(weekly, cohort), cohort)


RELEASE_MONTH = ["branch", "release_year", "release_month"]
COLLECTION_MONTH = ["collection_year", "collection_month"]


def base_tables(loans: DataFrame, repayments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All that the report needs of the rows: amounts by release month, collection month and week of age,
    and principal by release month. The loans and repayments are joined once, for the first of them, and
    both tables are bounded by the calendar."""
    aged = aged_repayments(loans, repayments)
    collected = cohorts.collected_by(aged, [*RELEASE_MONTH, *COLLECTION_MONTH, "weeks_since_release"], known=True)
    released = cohorts.with_date_parts(cohorts.disbursed(loans), "release_date", "release")
    return collected, cohorts.disbursed_by(released, RELEASE_MONTH)


class VintageReport:
    """The parts of the report, each a lazy DataFrame planned when it is first asked for.

    ``origination`` counts the principal as an outflow on the release date and ``dense`` fills missing
    weeks with 0; with both off, curves and returns follow the repayments alone, by position.
    """

    def __init__(
        self,
        collected: DataFrame,
        disbursed_monthly: DataFrame,
        newest_year: int,
        cohort: list[str],
        origination: bool,
        dense: bool,
    ):
        self.collected, self.disbursed_monthly = collected, disbursed_monthly
        self.newest_year, self.cohort = newest_year, cohort
        self.origination, self.dense = origination, dense

    @cached_property
    def collected_monthly(self) -> DataFrame:
        return cohorts.collected_by(self.collected, [*RELEASE_MONTH, *COLLECTION_MONTH], known=True)

    @cached_property
    def monthly_weeks(self) -> DataFrame:
        """Flows by release month and week of age."""
        weeks = cohorts.weekly_cashflows(self.collected, RELEASE_MONTH, known=True)
        if self.origination:
            return cohorts.weekly_with_origination(weeks, self.disbursed_monthly, RELEASE_MONTH)
        return weeks

    @cached_property
    def weekly(self) -> DataFrame:
        weekly = cohorts.collected_by(self.monthly_weeks, [*self.cohort, "weeks_since_release"], known=True)
        return cohorts.densify_weeks(weekly, self.cohort) if self.dense else weekly

    @cached_property
    def curve(self) -> DataFrame:
        return cashflow_curve(self.weekly, self.cohort)

    @cached_property
    def comparable_curve(self) -> DataFrame:
        """Curves over the weeks and release months that the newest year has, too."""
        weeks = cohorts.comparable_weeks(self.monthly_weeks, "release_year", self.newest_year)
        return cashflow_curve(cohorts.collected_by(weeks, [*self.cohort, "weeks_since_release"], known=True), self.cohort)

    @cached_property
    def returns(self) -> DataFrame:
        return cohorts.with_yearly_irr(cohorts.weekly_irr(self.weekly, self.cohort, positional=not self.dense))

    @cached_property
    def quarterly(self) -> DataFrame:
        return cohorts.quarterly_collected_pct(self.collected_monthly, self.disbursed_monthly)


def vintage_report(
    loans: DataFrame,
    repayments: DataFrame,
    newest_year: int,
    cohort: list[str] | None = None,
    origination: bool = True,
    dense: bool = True,
    work_dir: str | None = None,
) -> VintageReport:
    """The report over loans and repayments with parsed dates.

    With ``work_dir`` the two base tables are written there first, and no part reads the rows again.
    """
    collected, disbursed_monthly = base_tables(loans, repayments)
    if work_dir:
        spark = loans.sparkSession
        for name, table in (("collected", collected), ("disbursed", disbursed_monthly)):
            sinks.write_table(table, f"{work_dir}/{name}")
        collected, disbursed_monthly = (spark.read.parquet(f"{work_dir}/{n}") for n in ("collected", "disbursed"))
    return VintageReport(
        collected, disbursed_monthly, newest_year, cohort or ["branch", "release_year"], origination, dense
    )
