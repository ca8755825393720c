"""Vintage analysis: loan age, disbursed and collected amounts, cash-flow curves and returns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanloom.functions import dates, irr as irr_functions, numbers

# Loans in these states never paid out.
NOT_DISBURSED = ["Not Taken Up", "Denied"]
NOT_DISBURSED_OR_PENDING = ["Denied", "Not Taken Up", "Processing"]


def with_quarter(df: DataFrame, month_col: str, name: str) -> DataFrame:
    return df.withColumn(name, dates.quarter_name(F.col(month_col)))


def with_date_parts(df: DataFrame, col: str, prefix: str) -> DataFrame:
    return df.withColumns(
        {f"{prefix}_year": F.year(col), f"{prefix}_month": F.month(col), f"{prefix}_day": F.dayofmonth(col)}
    )


def with_loan_age(df: DataFrame, release: str = "release_date", collection: str = "collection_date") -> DataFrame:
    days = dates.days_between(F.col(release), F.col(collection))
    return df.withColumns({"days_since_release": days, "weeks_since_release": dates.weeks_from_days(days)})


def disbursed(df: DataFrame, excluded: list[str] = NOT_DISBURSED, status: str = "status") -> DataFrame:
    """Drop loans that never paid out; an unknown status stays."""
    return df.filter(F.col(status).isNull() | ~F.col(status).isin(excluded))


def week_window(df: DataFrame, low: int | None = 0, high: int | None = None, week: str = "weeks_since_release") -> DataFrame:
    if low is not None:
        df = df.filter(F.col(week) >= low)
    if high is not None:
        df = df.filter(F.col(week) <= high)
    return df


def comparable_cutoff(
    df: DataFrame, cohort: str, newest: int, max_month: int = 3, month: str = "release_month", week: str = "weeks_since_release"
) -> DataFrame:
    """Keep what the newest cohort could have shown too: its weeks so far and its release months."""
    limit = df.filter(F.col(cohort) == newest).agg(F.max(week)).scalar()
    return df.filter((F.col(week) <= limit) & (F.col(month) <= max_month))


def with_known_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """One test per key, so that each can be pushed to its side of a join and to the scan."""
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df


def disbursed_by(df: DataFrame, keys: list[str], principal: str = "principal") -> DataFrame:
    return with_known_keys(df, keys).groupBy(*keys).agg(numbers.sum_or_zero(F.col(principal)).alias("principal"))


def collected_by(df: DataFrame, keys: list[str], amount: str = "amount", known: bool = False) -> DataFrame:
    """Collected amount by any set of keys; groups with an unknown key are left out.

    ``known`` says that no key is null. The test is then skipped: pushed down to the scan it would work
    out a derived key, such as a parsed date, once more per row.
    """
    rows = df if known else with_known_keys(df, keys)
    return rows.groupBy(*keys).agg(numbers.sum_or_zero(F.col(amount)).alias("amount"))


def group_totals(
    df: DataFrame, keys: list[str], amount: str, entity: str, approximate: bool = False, count_name: str = "loans"
) -> DataFrame:
    """Sum of an amount and number of distinct entities per group."""
    count = F.approx_count_distinct(entity) if approximate else F.count_distinct(entity)
    return (
        with_known_keys(df, keys)
        .groupBy(*keys)
        .agg(numbers.sum_or_zero(F.col(amount)).alias(amount), count.alias(count_name))
    )


def disbursed_from_merged(df: DataFrame, keys: list[str], loan: str = "loan_id", principal: str = "principal") -> DataFrame:
    """Disbursed principal from the loan × repayment table, where each loan's principal is repeated."""
    per_loan = with_known_keys(df, [*keys, loan]).groupBy(*keys, loan).agg(F.max(principal).alias("principal"))
    return per_loan.groupBy(*keys).agg(numbers.sum_or_zero(F.col("principal")).alias("principal"))


def balance_gaps(loans: DataFrame, repayments: DataFrame, on: str = "loan_id") -> DataFrame:
    """Per loan: stated pending amount, the same computed from payments, and the gap.

    Repayments are summed per loan before the join, so a loan with very many payments is one row in it.
    """
    paid = repayments.groupBy(on).agg(numbers.sum_or_zero(F.col("amount")).alias("paid"))
    per_loan = loans.groupBy(on).agg(
        F.max("principal").alias("principal"), F.max("total_due").alias("total_due"), F.max("pending_due").alias("pending_due")
    )
    computed = F.col("total_due") - (F.col("paid") + F.col("principal"))
    return (
        per_loan.join(paid, on, "left")
        .withColumn("paid", F.coalesce("paid", F.lit(0.0)))
        .withColumn("pending_computed", computed)
        .withColumn("gap", F.col("pending_computed") - F.col("pending_due"))
    )


def reconcile_balances(loans: DataFrame, repayments: DataFrame, tolerance: float = 1.0, on: str = "loan_id") -> DataFrame:
    """Loans whose stated pending amount is off by more than the tolerance."""
    return balance_gaps(loans, repayments, on).filter(F.abs("gap") > tolerance)


def mean_gap(unbalanced: DataFrame) -> DataFrame:
    return unbalanced.agg(F.count(F.lit(1)).alias("loans"), F.avg("gap").alias("mean_gap"))


RELEASE_QUARTER = ["release_year", "release_quarter"]
COLLECTION_QUARTER = ["collection_year", "collection_quarter"]


def with_quarters(df: DataFrame) -> DataFrame:
    return with_quarter(with_quarter(df, "release_month", "release_quarter"), "collection_month", "collection_quarter")


def _by_branch_and_overall(df: DataFrame, keys: list[str], by_branch: bool | None, *aggregates: Column) -> DataFrame:
    sets = {True: [["branch", *keys]], False: [keys], None: [["branch", *keys], keys]}[by_branch]
    columns = ["branch", *keys] if by_branch is not False else keys
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        *aggregates, *([F.grouping("branch").cast("int").alias("_overall")] if by_branch is not False else [])
    )
    if by_branch is False:
        return grouped.select(F.lit("all").alias("branch"), *grouped.columns, F.lit(1).alias("_overall"))
    branch = F.when(F.col("_overall") == 1, "all").otherwise(F.col("branch"))
    return grouped.withColumn("branch", branch)


def quarterly_collected_pct(
    collected_monthly: DataFrame, disbursed_monthly: DataFrame, by_branch: bool | None = None, repeat_principal: bool = False
) -> DataFrame:
    """Share of a release quarter's principal collected per collection quarter.

    Inputs are the monthly tables with branch. ``by_branch`` None gives both the branches and branch 'all'
    in one pass. By default a quarter's principal is counted once; ``repeat_principal`` adds it up once per
    collection month, as the monthly table repeats it.
    """
    keys = [*RELEASE_QUARTER, *COLLECTION_QUARTER]
    amount = F.sum("amount").alias("amount")
    if repeat_principal:
        monthly = collected_monthly.join(disbursed_monthly, ["branch", "release_year", "release_month"], "left")
        result = _by_branch_and_overall(
            with_quarters(monthly), keys, by_branch, amount, numbers.sum_or_zero(F.col("principal")).alias("principal")
        )
    else:
        quarters = with_quarter(disbursed_monthly, "release_month", "release_quarter")
        principal = _by_branch_and_overall(quarters, RELEASE_QUARTER, by_branch, F.sum("principal").alias("principal"))
        collected = _by_branch_and_overall(with_quarters(collected_monthly), keys, by_branch, amount)
        # A branch may be called "all" itself, so the flag of the total is part of the key.
        result = collected.join(principal, ["_overall", "branch", *RELEASE_QUARTER], "left")
    return result.select(
        "branch", *keys, "amount", "principal", numbers.ratio(F.col("amount"), F.col("principal")).alias("collected_pct")
    )


def same_quarter(df: DataFrame, quarter: str = "Q1") -> DataFrame:
    return df.filter(
        (F.col("release_year") == F.col("collection_year"))
        & (F.col("release_quarter") == quarter)
        & (F.col("collection_quarter") == quarter)
    )


def weekly_cashflows(df: DataFrame, cohort: list[str], known: bool = False) -> DataFrame:
    """Cash flow per cohort and week of loan age, from week 0 on."""
    return week_window(collected_by(df, [*cohort, "weeks_since_release"], known=known), 0)


def origination_flows(loans: DataFrame, key: str = "loan_id") -> DataFrame:
    """Each loan's principal as a negative flow on its release date, in the shape of a repayment."""
    return loans.select(key, F.col("release_date").alias("collection_date"), (-F.col("principal")).alias("amount"))


def with_origination(loans: DataFrame, repayments: DataFrame, key: str = "loan_id") -> DataFrame:
    return repayments.select(key, "collection_date", "amount").unionByName(origination_flows(loans, key))


def weekly_with_origination(weekly: DataFrame, disbursed_amounts: DataFrame, cohort: list[str]) -> DataFrame:
    """The weekly table with each cohort's principal as an outflow in week 0.

    The same as ``with_origination`` before the weekly sums, but on the small tables: all of a cohort's
    principal leaves in its week 0, so its sum is enough.
    """
    outflow = disbursed_amounts.select(
        *cohort, F.lit(0).alias("weeks_since_release"), (-F.col("principal")).alias("amount")
    )
    return collected_by(weekly.select(*outflow.columns).unionByName(outflow), [*cohort, "weeks_since_release"])


def comparable_weeks(
    weekly: DataFrame, cohort: str, newest: int, max_month: int = 3, month: str = "release_month", week: str = "weeks_since_release"
) -> DataFrame:
    """``comparable_cutoff`` on the weekly table by release month.

    The newest cohort's last week is an aggregate that combines in every task and enters as a scalar.
    """
    limit = weekly.filter(F.col(cohort) == newest).agg(F.max(week)).scalar()
    return weekly.filter((F.col(week) <= limit) & (F.col(month) <= max_month))


def densify_weeks(df: DataFrame, cohort: list[str], week: str = "weeks_since_release", amount: str = "amount") -> DataFrame:
    """Add the missing weeks of every cohort, from 0 to its last, with amount 0.

    Works on the weekly table, one row per cohort and week from 0 on: each row also makes the empty weeks
    up to the next one, and the first row those before it. The table is read once.
    """
    order = Window.partitionBy(*cohort).orderBy(week)
    start = F.when(F.lag(week).over(order).isNull(), 0).otherwise(F.col(week))
    end = F.coalesce(F.lead(week).over(order) - 1, F.col(week))
    filled = df.select(*cohort, F.col(week).alias("_own"), amount, start.alias("_start"), end.alias("_end")).select(
        *cohort, "_own", amount, F.explode(F.sequence("_start", "_end")).alias(week)
    )
    return filled.select(*cohort, week, F.when(F.col(week) == F.col("_own"), F.col(amount)).otherwise(0.0).alias(amount))


def _by_week(cohort: list[str]):
    return Window.partitionBy(*cohort).orderBy("weeks_since_release").rowsBetween(Window.unboundedPreceding, 0)


def cumulative_cashflow(df: DataFrame, cohort: list[str], amount: str = "amount") -> DataFrame:
    """Running cash flow by week. The input is the weekly table, so a window holds a cohort's weeks only."""
    return df.withColumn("cumul_cashflow", F.sum(amount).over(_by_week(cohort)))


def normalised_curve(df: DataFrame, cohort: list[str], scale: float = 1_000_000.0) -> DataFrame:
    """The running cash flow scaled so that the cohort's first week moves ``scale``."""
    first = F.abs(F.first("cumul_cashflow").over(_by_week(cohort)))
    return df.withColumn("cumul_normalised", F.col("cumul_cashflow") / F.when(first != 0, first) * scale)


def principal_collected_pct(weekly: DataFrame, totals: DataFrame, cohort: list[str]) -> DataFrame:
    """Share of the principal collected up to each week; ``totals`` has the cohort's principal."""
    running = cumulative_cashflow(weekly, cohort)
    share = numbers.ratio(F.col("cumul_cashflow"), F.col("principal"))
    return running.join(totals, cohort, "inner").withColumn("principal_collected_pct", share)


def weekly_irr(weekly: DataFrame, cohort: list[str], positional: bool = False, amount: str = "amount") -> DataFrame:
    """Weekly rate of return per cohort from its weekly table.

    A cohort's flows are gathered into one array, at most one entry per week of loan age. Flows are
    discounted by week number; ``positional`` discounts the n-th row by n, ignoring gaps.
    """
    flow = F.struct(F.col("weeks_since_release").alias("week"), F.col(amount).cast("double").alias("amount"))
    flows = F.array_sort(F.collect_list(flow))
    if positional:
        flows = F.transform(flows, lambda f, i: F.struct(i.alias("week"), f["amount"].alias("amount")))
    rates = with_known_keys(weekly, cohort).groupBy(*cohort).agg(flows.alias("_flows"))
    return rates.select(*cohort, irr_functions.irr(F.col("_flows")).alias("weekly_irr"))


def with_yearly_irr(df: DataFrame) -> DataFrame:
    return df.withColumn("yearly_irr", irr_functions.annualised(F.col("weekly_irr")))
