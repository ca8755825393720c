"""Exact order statistics over a whole table without sorting it in one task.

Rows are first counted per distinct value, which combines on the map side, so a value that fills a third
of the table is one row from then on. The distinct values are cut into ranges of about equal size; running
sums are taken inside each range and shifted by the totals of the ranges before it. The cuts come from a
small hashed choice of the distinct values. They only decide which task counts a value: every row counts,
and every result is exact.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from loanloom.functions import numbers

VALUES_PER_RANGE = 50_000
MAX_RANGES = 1024
CHOSEN_PER_RANGE = 16
RANGE = "_range"


@dataclass(frozen=True)
class Spread:
    """What one pass tells about a column: the table's rows, the rows with a number, about how many numbers
    are distinct, and the cuts for further passes."""

    total: int
    rows: int
    distinct: int
    cuts: list[float]

    @property
    def complete(self) -> bool:
        return self.rows == self.total


def present(column: Column) -> Column:
    """True for a number, false for null and NaN."""
    return column.isNotNull() & ~F.isnan(column)


def spread_of(df: DataFrame, *columns: str) -> dict[str, Spread]:
    """One pass for the sizes of the named columns, and a second over those with many distinct values.

    The second keeps the distinct values whose hash falls into a share of about ``CHOSEN_PER_RANGE`` values
    per range, so a frequent value weighs no more than a rare one, and the driver receives at most some
    ``MAX_RANGES * CHOSEN_PER_RANGE`` numbers per column.
    """
    values = {c: F.when(present(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    aggregates = [F.count(F.lit(1)).alias("_total")]
    for c, value in values.items():
        aggregates += [F.count(value).alias(f"{c}_rows"), F.approx_count_distinct(value).alias(f"{c}_distinct")]
    sizes = df.agg(*aggregates).first()
    ranges = {c: min(MAX_RANGES, sizes[f"{c}_distinct"] // VALUES_PER_RANGE + 1) for c in columns}
    wide = [c for c in columns if ranges[c] > 1]
    chosen = {}
    if wide:
        share = {c: max(1, sizes[f"{c}_distinct"] // (ranges[c] * CHOSEN_PER_RANGE)) for c in wide}
        picked = [
            F.collect_set(F.when(F.pmod(F.xxhash64(values[c]), F.lit(share[c])) == 0, values[c])).alias(c) for c in wide
        ]
        chosen = df.agg(*picked).first().asDict()
    spreads = {}
    for c in columns:
        ordered_values = sorted(chosen.get(c, []))
        at = [i * len(ordered_values) // ranges[c] for i in range(1, ranges[c])]
        cuts = sorted({ordered_values[i] for i in at if i < len(ordered_values)})
        spreads[c] = Spread(sizes["_total"], sizes[f"{c}_rows"], sizes[f"{c}_distinct"], cuts)
    return spreads


def running_totals(groups: DataFrame, value: str, measures: list[str], cuts: list[float]) -> DataFrame:
    """Add ``<measure>_before``: the sum of the measure over all smaller values.

    ``groups`` has one row per distinct ``value``.
    """
    def exclusive(measure: str, window) -> Column:
        return F.coalesce(F.sum(measure).over(window), F.lit(0))

    if not cuts:
        window = Window.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
        return groups.select("*", *[exclusive(m, window).alias(f"{m}_before") for m in measures])

    splits = [float("-inf"), *cuts, float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="_value", outputCol=RANGE).transform(
        groups.withColumn("_value", F.col(value).cast("double"))
    ).drop("_value")
    inside = Window.partitionBy(RANGE).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select("*", *[exclusive(m, inside).alias(f"_{m}_inside") for m in measures])
    totals = ranged.groupBy(RANGE).agg(*[F.sum(m).alias(m) for m in measures])
    # At most MAX_RANGES rows: one per range.
    across = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(RANGE, *[exclusive(m, across).alias(f"_{m}_offset") for m in measures])
    joined = local.join(F.broadcast(offsets), RANGE)
    keep = groups.columns
    return joined.select(
        *keep, *[(F.col(f"_{m}_inside") + F.col(f"_{m}_offset")).alias(f"{m}_before") for m in measures]
    )


def ranked_values(df: DataFrame, column: str, spread: Spread | None = None) -> DataFrame:
    """Each distinct value with its count ``n``, the rows below it and its average rank (from 1)."""
    spread = spread or spread_of(df, column)[column]
    groups = (
        df.select(F.col(column).cast("double").alias(column))
        .filter(present(F.col(column)))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_totals(groups, column, ["n"], spread.cuts)
    return ranked.withColumn("average_rank", F.col("n_before") + (F.col("n") + 1) / 2)


def ranked_among(df: DataFrame, column: str, others: list[str], spread: Spread) -> DataFrame:
    """Each distinct value with its count ``n`` and ``average_rank``, an array: for each of ``others`` the rank among the rows that have both."""
    value = F.col(column).cast("double")
    flags = [F.when(present(F.col(c).cast("double")), 1).otherwise(0).alias(f"_n{i}") for i, c in enumerate(others)]
    counts = [f"_n{i}" for i in range(len(others))]
    groups = df.select(value.alias(column), *flags).filter(present(F.col(column))).groupBy(column).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in counts]
    )
    ranks = [F.col(f"{c}_before") + (F.col(c) + 1) / 2 for c in counts]
    return running_totals(groups, column, counts, spread.cuts).select(column, "n", F.array(*ranks).alias("average_rank"))


def exact_quantiles_of(
    df: DataFrame, columns: list[str], probabilities: list[float], spreads: dict[str, Spread] | None = None
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation between neighbours, as numbers on the driver.

    Only the neighbours of the asked quantiles leave the cluster, two per probability, and one job fetches
    those of all columns.
    """
    spreads = spreads or spread_of(df, *columns)
    wanted: dict[str, list[int]] = {}
    parts = []
    for c in columns:
        last_row = spreads[c].rows - 1
        if last_row < 0:
            continue
        positions = [int(p * last_row) for p in probabilities]
        wanted[c] = sorted({*positions, *[min(x + 1, last_row) for x in positions]})
        # Positions in front of a value, and up to its last copy: the difference lies on the value itself.
        counts = list(range(len(wanted[c]) + 1))
        first = numbers.step(F.col("n_before"), wanted[c], counts, "right")
        last = numbers.step(F.col("n_before") + F.col("n"), wanted[c], counts, "right")
        hits = ranked_values(df, c, spreads[c]).select(
            F.lit(c).alias("column"), F.col(c).alias("value"), first.alias("first"), last.alias("last")
        )
        parts.append(hits.filter(F.col("last") > F.col("first")))
    value_at: dict[tuple[str, int], float] = {}
    if parts:
        for row in reduce(DataFrame.unionAll, parts).collect():
            for position in wanted[row["column"]][row["first"] : row["last"]]:
                value_at[row["column"], position] = row["value"]

    def quantile(c: str, p: float) -> float | None:
        last_row = spreads[c].rows - 1
        if last_row < 0:
            return None
        x = p * last_row
        low = value_at[c, int(x)]
        high = value_at[c, min(int(x) + 1, last_row)]
        return low + (high - low) * (x - int(x))

    return {c: [quantile(c, p) for p in probabilities] for c in columns}


def exact_quantiles(df: DataFrame, column: str, probabilities: list[float]) -> list[float | None]:
    return exact_quantiles_of(df, [column], probabilities)[column]
