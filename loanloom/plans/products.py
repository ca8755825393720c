"""Repayment report by product group."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loanloom.functions import numbers
from loanloom.operators import cohorts, joins


def with_product_flag(loans: DataFrame, products: list[str], name: str) -> DataFrame:
    return loans.withColumn(name, numbers.false_if_null(F.col("product").isin(products)))


def product_repayment_report(loans: DataFrame, repayments: DataFrame, products: list[str], max_week: int | None = None) -> DataFrame:
    """Share of principal collected by week of loan age, for the product group and for the rest.

    Keeps every repayment whose loan is known; principal and loan count are those of the group.
    """
    group = "in_group"
    paid_out = with_product_flag(cohorts.disbursed(loans, cohorts.NOT_DISBURSED_OR_PENDING), products, group)
    aged = cohorts.with_loan_age(
        joins.repayments_with_loans(paid_out.select("loan_id", group, "release_date"), repayments)
    )
    weekly = cohorts.collected_by(aged, [group, "weeks_since_release"])
    totals = cohorts.group_totals(paid_out, [group], "principal", "loan_id", count_name="loans_released")
    report = cohorts.principal_collected_pct(weekly, totals, [group])
    return cohorts.week_window(report, None, max_week)
