"""Look-back counts of an account as a stream, from a ring of daily counts that each account keeps as its state.

A transaction changes one entry of the ring and gives one row; a sliding window of the same length would keep and change a row for each
of its days. The state of an account is ``long_days + 1`` entries a class, whatever its transactions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loanloom.functions import text
from loanloom.operators import rules
from loanloom.streaming import flags

CLASSES = [text.STOP_PAYMENT, text.NSF, text.LAWYER]
_EPOCH = dt.date(1970, 1, 1)
_DAY_MS = 86_400_000


class Ring:
    """Counts per class of the ``size`` days up to the newest one; a day lies at its number modulo ``size``."""

    def __init__(self, size: int, newest: int | None = None, counts: np.ndarray | None = None):
        self.size, self.newest = size, newest
        self.counts = np.zeros((len(CLASSES), size), dtype=np.int64) if counts is None else counts

    def add(self, days: np.ndarray, classes: np.ndarray) -> None:
        """Transactions in any order; those older than the ring are outside every window to come."""
        if not len(days):
            return
        last = int(days.max())
        if self.newest is None:
            self.newest = last
        for day in range(max(self.newest, last - self.size) + 1, last + 1):
            self.counts[:, day % self.size] = 0
        self.newest = max(self.newest, last)
        inside = days > self.newest - self.size
        np.add.at(self.counts, (classes[inside], days[inside] % self.size), 1)

    def over(self, kind: int, days: int) -> int:
        """The count of a class from so many days before the newest one until it."""
        return int(self.counts[kind, np.arange(self.newest - days, self.newest + 1) % self.size].sum())


def recent_counts(key: str, long_days: int, short_days: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """What is done for an account: its new rows go into its ring, or its time is over and it is forgotten."""
    size, short_days = long_days + 1, min(short_days, long_days)
    stop, nsf, lawyer = range(len(CLASSES))

    def row(account: tuple, day: int, counts: list[int], expired: bool) -> pd.DataFrame:
        values = dict(zip(rules.FLAGS, counts, strict=True))
        return pd.DataFrame([{key: account[0], "as_of": _EPOCH + dt.timedelta(days=day), **values, "expired": expired}])

    def update(account: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        newest, counts = state.get if state.exists else (None, None)
        if state.hasTimedOut:
            state.remove()
            yield row(account, newest + size, [0] * len(rules.FLAGS), True)
            return
        ring = Ring(size, newest, None if counts is None else np.array(counts, dtype=np.int64).reshape(len(CLASSES), size))
        for batch in batches:
            ring.add(batch["_day"].to_numpy(dtype=np.int64), batch["_class"].to_numpy(dtype=np.int64))
        state.update((ring.newest, ring.counts.ravel().tolist()))
        # The first moment at which no window of a row to come reaches back to the newest day.
        state.setTimeoutTimestamp((ring.newest + size) * _DAY_MS)
        over = [ring.over(stop, long_days), ring.over(nsf, long_days), ring.over(nsf, short_days), ring.over(lawyer, long_days)]
        yield row(account, ring.newest, over, False)

    return update


def stream_recent_flags(
    transactions: DataFrame, delay: str, long_days: int = rules.LONG_DAYS, short_days: int = rules.SHORT_DAYS, key: str = "request_id",
    time: str = "ts", trx: str = "trx_id",
) -> DataFrame:
    """key, as_of, the counts of ``rules.FLAGS`` and expired: a row for each account that a micro-batch changes.

    Windows end with the account's newest classified transaction (``as_of``) and include their first day. Each transaction id counts once;
    rows older than the watermark are dropped, rows without a time or an account as well. When the watermark passes the last window of an
    account, it gives a row of zeros with ``expired`` and is forgotten.
    """
    timed = flags.flagged_once(transactions.filter(F.col(key).isNotNull() & F.col(time).isNotNull()), delay, time, trx)
    kinds = F.array_position(F.array(*map(F.lit, CLASSES)), F.col("trx_class")) - 1
    rows = timed.select(key, time, F.unix_date(F.to_date(time)).cast("bigint").alias("_day"), kinds.alias("_class"))
    fields = [T.StructField("as_of", T.DateType()), *[T.StructField(c, T.LongType()) for c in rules.FLAGS], T.StructField("expired", T.BooleanType())]
    schema = T.StructType([transactions.schema[key], *fields])
    update = recent_counts(key, long_days, short_days)
    return rows.groupBy(key).applyInPandasWithState(update, schema, "newest int, counts array<bigint>", "append", GroupStateTimeout.EventTimeTimeout)


def write_recent(counts: DataFrame, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Write each micro-batch's changed accounts under its batch number, replacing a repeated batch."""
    return flags.write_updates(counts, out, checkpoint, once, mode="append")


def latest(updates: DataFrame, key: str = "request_id") -> DataFrame:
    """What each account was last told, forgotten ones left out: key, as_of and the counts."""
    newest = flags.latest_updates(updates.withColumn("_last", F.struct("batch_id", F.col("as_of"))), [key], "_last")
    return newest.filter(~F.col("expired")).drop("expired")
