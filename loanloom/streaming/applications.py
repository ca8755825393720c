"""Applications and transactions as two streams, met by account within the look-back windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loanloom.functions import text
from loanloom.operators import rules
from loanloom.streaming import flags


def flagged_applications(
    applications: DataFrame, transactions: DataFrame, delay: str, long_days: int = rules.LONG_DAYS, short_days: int = rules.SHORT_DAYS,
    key: str = "request_id", application: str = "application_id", asked: str = "asked_at", time: str = "ts", trx: str = "trx_id",
) -> DataFrame:
    """Each application once, with the counts of ``rules.FLAGS`` over its account's transactions up to the day it was asked.

    On streams, an application is given out when the watermark of both has passed its day, so transactions that come after it, within
    the delay, still count; later ones are dropped. A transaction is kept until no application to come can look back to it. An
    application without transactions or without an account gets zeros; one without a time or an id cannot be placed and is left out. Batch tables give the
    same rows at once. Columns of ``applications`` named like a flag are replaced.
    """
    kept = [c for c in applications.columns if c not in rules.FLAGS]
    apps = applications.select(*[F.col(f"`{c}`") for c in kept]).withColumn(asked, F.col(asked).cast("timestamp"))
    apps = apps.filter(F.col(asked).isNotNull() & F.col(application).isNotNull())
    if apps.isStreaming:
        apps = apps.withWatermark(asked, delay).dropDuplicatesWithinWatermark([application])
    else:
        apps = apps.dropDuplicates([application])
    # Several applications of one account meet its transactions under names that are not theirs.
    held = apps.select(F.col(key).alias("_key"), F.col(application).alias("_id"), F.col(asked).alias("_asked"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_own"))
    own = flags.flagged_once(transactions.filter(F.col(key).isNotNull() & F.col(time).isNotNull()), delay, time, trx)
    own = own.select(F.col(key).alias("_account"), F.col(time).alias("_at"), "trx_class")
    longest = max(long_days, short_days)
    # The first two conditions bound the state by event time; the others are the windows, in days.
    met = (
        (F.col("_key") == F.col("_account"))
        & (F.col("_at") >= F.col("_asked") - F.expr(f"INTERVAL {longest + 1} DAYS"))
        & (F.col("_at") <= F.col("_asked") + F.expr("INTERVAL 1 DAYS"))
        & (F.to_date("_at") >= F.date_sub(F.to_date("_asked"), longest))
        & (F.to_date("_at") <= F.to_date("_asked"))
    )
    days = F.datediff(F.to_date("_asked"), F.to_date("_at"))
    count = lambda name, most: F.count_if((F.col("trx_class") == name) & (days <= most))
    counted = held.join(own, met, "left_outer").groupBy("_id", "_asked", "_own").agg(
        count(text.STOP_PAYMENT, long_days).alias("_f0"), count(text.NSF, long_days).alias("_f1"),
        count(text.NSF, min(short_days, long_days)).alias("_f2"), count(text.LAWYER, long_days).alias("_f3"),
    )
    return counted.select(*[F.col("_own")[c].alias(c) for c in kept], *[F.col(f"_f{i}").alias(f) for i, f in enumerate(rules.FLAGS)])
