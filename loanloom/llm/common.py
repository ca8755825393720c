"""What several operators of this subpackage need."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from loanloom.session import shared_dir

# Fixed value: the contracts' pattern of a word.
WORD = r"[^\x20\x09-\x0D]+"


def materialized(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: it is computed once, and a lost executor costs no lineage."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column | str, folds: int = 4, fold: int = 2) -> Column:
    """Whether a document is kept from every fit: crc32 of its number as text, modulo ``folds``."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % folds == fold, F.lit(False))


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about ``size`` bytes of ``column``."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at, done = 0, 0
    while at < batch.num_rows:
        stop = max(int(np.searchsorted(sizes, done + size, side="right")), at + 1)
        yield batch.slice(at, stop - at)
        at, done = stop, int(sizes[stop - 1])


def release() -> None:
    """Gives freed memory back to the system: Python workers live on after a task, and an executor has several."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over the batches of a partition that leaves no freed memory behind at its end."""

    @functools.wraps(run)
    def of_partition(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return of_partition
