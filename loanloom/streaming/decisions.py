"""Decisions on applications as they arrive, by the batch logic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from loanloom.sources import sinks


def stream_decisions(
    applications: DataFrame,
    decide_batch: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    attributes: list[str],
    document: str | None = None,
    organization: str = "default",
    once: bool = True,
    write_batch: Callable[..., object] = sinks.write_decisions,
) -> StreamingQuery:
    """Run ``decide_batch`` on every micro-batch and write its decision log.

    ``decide_batch`` is a batch function, such as ``underwrite`` with its tables bound, so stream and
    batch cannot drift apart. Tables that change while the stream runs, such as the thresholds, are best
    read inside it. A batch is written under its number: when Spark repeats a batch after a
    failure, the repeat replaces the first attempt. With ``decision_log.write_decisions`` as ``write_batch`` the tables of a batch
    become visible together.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        decided = decide_batch(batch).withColumn("organization", F.lit(organization))
        write_batch(decided, out, attributes, document, batch_id)

    writer = applications.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
