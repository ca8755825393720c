"""Score percentiles, histograms, quantile bins and lift tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from loanloom.functions import numbers
from loanloom.operators import ordered

# The percentiles a model is stored with.
PERCENTILES = list(range(5, 100, 5))
ABOVE_ALL = 100


def percentile_values(df: DataFrame, col: str, percentiles: list[float] = PERCENTILES, approximate: bool = False) -> list[float]:
    """Percentiles with linear interpolation. ``approximate`` trades exactness for a single pass."""
    shares = [p / 100 for p in percentiles]
    if approximate:
        return df.agg(F.percentile_approx(F.col(col).cast("double"), shares, 100_000).alias("v")).first()["v"]
    return ordered.exact_quantiles(df, col, shares)


def percentile_values_of(df: DataFrame, cols: list[str], percentiles: list[float] = PERCENTILES) -> list[list[float]]:
    """The same for several columns, which share the passes over the data."""
    quantiles = ordered.exact_quantiles_of(df, cols, [p / 100 for p in percentiles])
    return [quantiles[c] for c in cols]


def percentile_table(spark: SparkSession, values: list[float], percentiles: list[int] = PERCENTILES) -> DataFrame:
    return spark.createDataFrame(list(zip(percentiles, values)), "percentile int, score double")


def score_percentiles(df: DataFrame, col: str, percentiles: list[int] = PERCENTILES, approximate: bool = False) -> DataFrame:
    return percentile_table(df.sparkSession, percentile_values(df, col, percentiles, approximate), percentiles)


def equal_width_edges(low: float, high: float, bins: int) -> list[float]:
    """Edges of ``bins`` equal ranges; the outer ones are moved so that every value lies inside."""
    if low == high:
        margin = 0.001 * abs(low) if low != 0 else 0.001
        low, high = low - margin, high + margin
        return [low + i * ((high - low) / bins) for i in range(bins)] + [high]
    step = (high - low) / bins
    inner = [i * step + low for i in range(1, bins)]
    return [low - (high - low) * 0.001, *inner, high]


def histogram_edges(df: DataFrame, col: str, bins: int = 10) -> list[float]:
    value = F.when(ordered.present(F.col(col).cast("double")), F.col(col).cast("double"))
    row = df.agg(F.min(value).alias("low"), F.max(value).alias("high")).first()
    return [] if row.low is None else equal_width_edges(row.low, row.high, bins)


def quantile_edges(df: DataFrame, col: str, q: int) -> list[float]:
    """Edges of ``q`` equally filled ranges; equal edges are merged, so there may be fewer ranges."""
    edges = ordered.exact_quantiles(df, col, [i / q for i in range(q + 1)])
    return sorted({e for e in edges if e is not None})


def assign_bins(df: DataFrame, col: str, edges: list[float], name: str = "bin") -> DataFrame:
    """Number of the range, from 1. Ranges include their right edge; the lowest value is in the first."""
    value, inner = F.col(col).cast("double"), edges[1:-1]
    bins = list(range(1, len(inner) + 2))
    return df.withColumn(name, F.when(ordered.present(value), numbers.step(value, inner, bins, "right")))


def quantile_bins(df: DataFrame, col: str, q: int, name: str = "bin") -> DataFrame:
    return assign_bins(df, col, quantile_edges(df, col, q), name)


BIN_SCHEMA = T.StructType(
    [T.StructField("bin", T.IntegerType()), T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType())]
)


def bin_table(spark: SparkSession, edges: list[float]) -> DataFrame:
    rows = [(i + 1, edges[i], edges[i + 1]) for i in range(len(edges) - 1)]
    return spark.createDataFrame(rows, BIN_SCHEMA)


def counted_bins(df: DataFrame, col: str, edges: list[float], *more: Column) -> DataFrame:
    """Every bin, also the empty ones, with its count and further aggregates."""
    counts = (
        assign_bins(df, col, edges).filter(F.col("bin").isNotNull()).groupBy("bin").agg(F.count(F.lit(1)).alias("n"), *more)
    )
    table = bin_table(df.sparkSession, edges).join(counts, "bin", "left")
    return table.withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    return counted_bins(df, col, histogram_edges(df, col, bins))


def lift_table(df: DataFrame, x: str, y: str, bins: int | None = None, q: int | None = None) -> DataFrame:
    """Count and mean outcome per range of ``x``, or per value when ``x`` is a category or no ranges are asked."""
    mean = F.avg(y).alias("mean_outcome")
    numeric = isinstance(df.schema[x].dataType, T.NumericType)
    if numeric and bins is not None:
        return counted_bins(df, x, histogram_edges(df, x, bins), mean)
    if numeric and q is not None:
        return counted_bins(df, x, quantile_edges(df, x, q), mean)
    return df.filter(F.col(x).isNotNull()).groupBy(x).agg(F.count(F.lit(1)).alias("n"), mean)


def bucket_of(score: Column, values: list[float], percentiles: list[int] = PERCENTILES) -> Column:
    """Percentile bucket of a score: below the first value → first percentile, at or above the last → 100.
    A score equal to a value belongs to the bucket above it."""
    return numbers.step(score, values, [*percentiles, ABOVE_ALL])


def percentile_bucket(df: DataFrame, score: str, values: list[float], name: str = "percentile") -> DataFrame:
    return df.withColumn(name, bucket_of(F.col(score), values))
