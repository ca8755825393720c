"""Table profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loanloom.operators import cleaning


def value_counts(df: DataFrame, cols: list[str], normalize: bool = False) -> DataFrame:
    """Rows per combination of values, unknown values left out; with ``normalize`` also the share."""
    counts = df.dropna(subset=cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    if not normalize:
        return counts
    # The total comes from the counts, whose shuffle both uses can share.
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def status_matrix(df: DataFrame, rows: str, columns: str, values: list[str]) -> DataFrame:
    """One row per ``rows`` value, one column per listed value; a combination that never occurs is null."""
    counted = df.filter(F.col(rows).isNotNull())
    cells = [F.count_if(F.col(columns) == v) for v in values]
    return counted.groupBy(rows).agg(*[F.when(c > 0, c).alias(v) for c, v in zip(cells, values)])


def null_profile(df: DataFrame, only_with_nulls: bool = True) -> DataFrame:
    """Missing values (null or NaN) per column, in one pass."""
    counts = df.agg(*[F.count_if(cleaning.missing(c, df)).alias(c) for c in df.columns])
    long = counts.unpivot([], df.columns, "column_name", "nulls")
    return long.filter(F.col("nulls") > 0) if only_with_nulls else long


def total_nulls(df: DataFrame) -> DataFrame:
    return null_profile(df, only_with_nulls=False).agg(F.sum("nulls").alias("nulls"))


def table_profile(df: DataFrame, key: str, date: str, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct(key) if approximate else F.count_distinct(key)
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        distinct.alias("distinct_keys"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
    )
