"""Counts per account and day kept as running totals, so that a look-back is the difference of two look-ups and no raw row is joined.

Days lie in blocks of ``BLOCK_DAYS``. A row holds one account's block: the days on which something was counted. What an account had
before a block is a running sum over its blocks, so an account with a third of all rows is a row a block, bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK_DAYS = 32


def _block(day: Column) -> Column:
    return F.floor(F.unix_date(day) / BLOCK_DAYS)


def blocks(daily: DataFrame, key: str, counts: list[str], day: str = "trx_date") -> DataFrame:
    """key, block and days: each block's days with their counts, in order. Several rows of one account and day add up.

    Rows without an account or a day are left out, since no look-back can reach them; missing counts are 0.
    """
    placed = daily.filter(F.col(key).isNotNull() & F.col(day).isNotNull())
    per_day = placed.groupBy(key, F.col(day).alias("day")).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in counts])
    return per_day.groupBy(key, _block(F.col("day")).alias("block")).agg(F.sort_array(F.collect_list(F.struct("day", *counts))).alias("days"))


def days_of(history: DataFrame, key: str) -> DataFrame:
    """The rows that ``blocks`` was made from, one per account and day."""
    return history.select(key, F.inline("days"))


def merged(history: DataFrame, daily: DataFrame, key: str, counts: list[str], day: str = "trx_date") -> DataFrame:
    """A stored history and new daily counts, which may be late, or negative to take something back, as one history."""
    return blocks(days_of(history, key).unionByName(daily.select(key, F.col(day).alias("day"), *counts)), key, counts, "day")


def look_back(
    asked: DataFrame, history: DataFrame, key: str, day: str, spans: Mapping[str, tuple[str, int]], until_day: bool = False
) -> DataFrame:
    """``asked`` and a column for each of ``spans``: a count over so many days before ``day``, the first and ``day`` itself included.

    Days after ``day`` count too unless ``until_day``. Any number of rows may ask about one account. A row without an account or a day,
    or of an unknown account, gets zeros; a span named as a column of ``asked`` replaces it.
    """
    counts = list(dict.fromkeys(c for c, _ in spans.values()))
    edges = sorted({d for _, d in spans.values()})
    pairs = asked.select(F.col(key).alias("_key"), F.col(day).alias("_day")).filter(F.col("_key").isNotNull() & F.col("_day").isNotNull()).distinct()
    # What was counted until each point: the day before each window, and the last day of all windows.
    last = F.col("_day") if until_day else F.lit("9999-12-31").cast("date")
    points = [F.struct(F.lit(d).alias("edge"), F.date_sub("_day", d + 1).alias("point")) for d in edges]
    points.append(F.struct(F.lit(-1).alias("edge"), last.alias("point")))
    asks = pairs.select("_key", "_day", F.inline(F.array(*points))).withColumn("block", _block(F.col("point")))

    # Every block that is asked about has a row, so a look-up is an equal join.
    own = history.select(F.col(key).alias("_key"), "block", "days")
    wanted = asks.select("_key", "block").distinct().select("*", F.lit(None).cast(own.schema["days"].dataType).alias("days"))
    rows = own.unionByName(wanted).groupBy("_key", "block").agg(F.max("days").alias("days"))
    held = lambda c: F.coalesce(F.aggregate(F.col("days")[c], F.lit(0).cast("bigint"), lambda a, v: a + v), F.lit(0))
    earlier = Window.partitionBy("_key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    running = rows.select("*", *[F.coalesce(F.sum(held(c)).over(earlier), F.lit(0)).alias(f"before_{i}") for i, c in enumerate(counts)])

    def until_point(i: int, c: str) -> Column:
        inside = F.filter("days", lambda d: d["day"] <= F.col("point"))
        return F.col(f"before_{i}") + F.coalesce(F.aggregate(inside, F.lit(0).cast("bigint"), lambda a, d: a + d[c]), F.lit(0))

    found = asks.join(running, ["_key", "block"]).select("_key", "_day", "edge", *[until_point(i, c).alias(f"until_{i}") for i, c in enumerate(counts)])
    at = lambda edge, i: F.sum(F.when(F.col("edge") == edge, F.col(f"until_{i}")))
    answers = found.groupBy("_key", "_day").agg(
        *[(at(-1, counts.index(c)) - at(d, counts.index(c))).alias(f"_span_{i}") for i, (c, d) in enumerate(spans.values())]
    )
    names = [f"_asked_{i}" for i in range(len(asked.columns))]
    plain = asked.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(asked.columns, names, strict=True)])
    own_key, own_day = (F.col(names[asked.columns.index(c)]) for c in (key, day))
    joined = plain.join(answers, (own_key == F.col("_key")) & (own_day == F.col("_day")), "left")
    kept = [F.col(n).alias(c) for c, n in zip(asked.columns, names, strict=True) if c not in spans]
    return joined.select(*kept, *[F.coalesce(F.col(f"_span_{i}"), F.lit(0)).cast("bigint").alias(s) for i, s in enumerate(spans)])
