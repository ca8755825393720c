"""Train / validation / test splits as one column; every other column stays on its row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loanloom.functions import dates, numbers

HASH_BUCKETS = 1_000_000


def split_by(df: DataFrame, is_test: Column, name: str = "split") -> DataFrame:
    """Any predicate; a null answer means train."""
    return df.withColumn(name, F.when(numbers.false_if_null(is_test), "test").otherwise("train"))


def split_by_flag(df: DataFrame, flag: str, name: str = "split") -> DataFrame:
    return split_by(df, F.col(flag), name)


def split_random(df: DataFrame, share: float, key: str | list[str], seed: int = 0, name: str = "split") -> DataFrame:
    """About ``share`` of the rows go to test, by a seeded hash of the key: the same row always lands alike,
    however the table is partitioned."""
    keys = [key] if isinstance(key, str) else key
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(HASH_BUCKETS))
    return split_by(df, bucket < int(share * HASH_BUCKETS), name)


def split_by_month(
    df: DataFrame, validation: list[str], test: list[str], col: str = "request_date", name: str = "split"
) -> DataFrame:
    """By ``yyyy-MM`` of the request; months in neither list, and unknown ones, are train."""
    month = dates.month_key(F.col(col))
    return df.withColumn(
        name, F.when(month.isin(test), "test").when(month.isin(validation), "validation").otherwise("train")
    )


def fold_of(key: str, folds: int, seed: int = 0) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(folds)).cast("int")
