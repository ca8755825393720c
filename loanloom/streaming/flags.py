"""Counts of flagged transactions per account, kept up to date as transactions arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from loanloom.functions import text
from loanloom.operators import rules
from loanloom.sources import sinks

CLASSES = [text.STOP_PAYMENT, text.NSF, text.LAWYER]


def flagged_once(transactions: DataFrame, delay: str, time: str = "ts", trx: str = "trx_id") -> DataFrame:
    """Classified transactions, each id once. On a stream that is within the watermark, and rows older than
    it are dropped as late; a batch table gives the same counts with nothing late."""
    timed = rules.classified_only(transactions).withColumn(time, F.col(time).cast("timestamp"))
    if not timed.isStreaming:
        return timed.dropDuplicates([trx])
    return timed.withWatermark(time, delay).dropDuplicatesWithinWatermark([trx])


def _counts(grouped) -> DataFrame:
    return grouped.agg(*[F.count_if(F.col("trx_class") == name).alias(name) for name in CLASSES])


def stream_transaction_flags(
    transactions: DataFrame, delay: str, size: str = "90 days", slide: str = "1 day", key: str = "request_id",
    time: str = "ts", trx: str = "trx_id",
) -> DataFrame:
    """Counts per account and sliding window. Only classified transactions are spread over windows."""
    flagged = flagged_once(transactions, delay, time, trx)
    counts = _counts(flagged.groupBy(key, F.window(time, size, slide).alias("window")))
    return counts.select(
        key, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *CLASSES
    )


def stream_daily_classes(
    transactions: DataFrame, delay: str, key: str = "request_id", time: str = "ts", trx: str = "trx_id"
) -> DataFrame:
    """Counts per account and day: one state row per account and day instead of one per sliding window.
    Any look-back is then a sum over days."""
    flagged = flagged_once(transactions, delay, time, trx)
    counts = _counts(flagged.groupBy(key, F.window(time, "1 day").alias("window")))
    return counts.select(key, F.to_date(F.col("window.start")).alias("trx_date"), *CLASSES)


def write_updates(counts: DataFrame, out: str, checkpoint: str, once: bool = True, mode: str = "update") -> StreamingQuery:
    """Write each micro-batch's changed counts under its batch number, replacing a repeated batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.write_table(batch, f"{out}/batch_id={batch_id}")

    writer = counts.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def latest_updates(updates: DataFrame, keys: list[str], order: str = "batch_id") -> DataFrame:
    """The current count per key from the written updates: the one of the last batch that changed it."""
    values = [c for c in updates.columns if c not in (*keys, "batch_id", order)]
    newest = updates.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("_v"))
    return newest.select(*keys, "_v.*")
