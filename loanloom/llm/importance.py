"""Resampling documents towards a target distribution by hashed n-gram importance weights.

Cases, for every function here: a null text has no words; a null id counts as an empty one in the seeded draw and sorts first; repeated rows are
documents of their own, each ranked; other columns are not read and cannot clash; an empty target leaves every count at its prior. Texts of
any length are read whole: features are gathered in blocks of ``BLOCK`` bytes.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from loanloom.llm.common import materialized, releasing, slices

#: Bytes of text taken up at a time, of features gathered at a time, and of one matrix of equally long features.
SLICE = BLOCK = 4 << 20
#: Features of more bytes than this go to zlib one by one: a matrix with a column a byte would hold a single row.
LONG = 512
#: Partial counts are added up in so many tasks before one task adds theirs.
MERGERS = 32

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def _crc_table() -> np.ndarray:
    """The 256 remainders of the usual reflected polynomial (IEEE 802.3)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def crc32s(values: pa.BinaryArray) -> np.ndarray:
    """Unsigned crc32 of each value. Values of one length form a matrix of bytes, and all its checksums advance one column at a time."""
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    data = np.frombuffer(values.buffers()[2] or b"", dtype=np.uint8)
    lengths = np.diff(offsets)
    order = np.argsort(lengths, kind="stable")
    out = np.zeros(len(values), dtype=np.uint32)
    distinct, first = np.unique(lengths[order], return_index=True)
    for length, start, stop in zip(distinct.tolist(), first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
        bucket = order[start:stop]
        if length > LONG:
            out[bucket] = [zlib.crc32(data[offsets[i] : offsets[i] + length]) for i in bucket]
            continue
        step = max(1, BLOCK // max(length, 1))
        for rows in (bucket[i : i + step] for i in range(0, len(bucket), step)):
            matrix = data[offsets[rows][:, None] + np.arange(length)]
            crc = np.full(len(rows), 0xFFFFFFFF, dtype=np.uint32)
            for column in range(length):
                crc = _CRC[(crc ^ matrix[:, column]) & 0xFF] ^ (crc >> 8)
            out[rows] = ~crc
    return out


def _feature_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Crc32 of each slice of ``data``; every distinct content of a block is computed once."""
    out = np.empty(len(starts), dtype=np.uint32)
    total = np.cumsum(ends - starts)
    cuts, done = [0], 0
    while cuts[-1] < len(starts):
        cut = max(int(np.searchsorted(total, done + BLOCK, side="right")), cuts[-1] + 1)
        cuts.append(cut)
        done = int(total[cut - 1])
    for a, b in zip(cuts, cuts[1:], strict=False):
        lengths = ends[a:b] - starts[a:b]
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        places = np.arange(offsets[-1]) + np.repeat(starts[a:b] - offsets[:-1], lengths)
        block = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[places])])
        coded = block.dictionary_encode()
        out[a:b] = crc32s(coded.dictionary)[coded.indices.to_numpy()]
    return out


def buckets_of(texts: pa.Array, ngram: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words a text, features a text, and the features' buckets, text after text."""
    empty, line_feed = (pa.scalar(x, pa.large_string()) for x in ("", "\n"))
    texts = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), empty), empty, line_feed)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = _LOWER[np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]]
    inside = _IN_WORD[data]
    after = np.zeros_like(inside)  # the first byte after each word; every text ends with a line feed
    after[1:] = inside[:-1] & ~inside[1:]
    words = np.diff(np.searchsorted(np.flatnonzero(after), offsets - offsets[0]))
    compact = np.where(after, np.uint8(32), data)[inside | after]
    ends = np.flatnonzero(compact == 32)
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    doc = np.repeat(np.arange(len(words)), words)
    runs = []
    for n in range(1, ngram + 1):
        first = np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1 :]) if len(doc) >= n else np.empty(0, dtype=np.int64)
        runs.append((doc[first], starts[first], ends[first + n - 1]))
    of, starts, ends = (np.concatenate(c) for c in zip(*runs, strict=True))
    order = np.argsort(of, kind="stable") if ngram > 1 else slice(None)
    hashed = _feature_crcs(compact, starts[order], ends[order]) % np.uint32(buckets)
    return words, np.bincount(of, minlength=len(words)), hashed


def hashed_features(docs: DataFrame, ngram: int = 1, buckets: int = 10_000, doc_id: str | None = "doc_id", text: str = "text") -> DataFrame:
    """id, n_words, n_features and the buckets of all features (32-bit little-endian numbers in one binary) of every row, written down."""

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", SLICE):
                words, features, hashed = buckets_of(rows.column("text"), ngram, buckets)
                ends = np.cumsum(features)
                packed = [hashed[e - n : e].astype("<u4").tobytes() for e, n in zip(ends.tolist(), features.tolist(), strict=True)]
                columns = [rows.column("id"), pa.array(words, pa.int64()), pa.array(features, pa.int64()), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_features", "buckets"])

    ids = F.col(doc_id).cast("long") if doc_id else F.lit(None).cast("long")
    rows = docs.select(ids.alias("id"), F.col(text).alias("text"))
    return materialized(rows.mapInArrow(releasing(hash_rows), "id long, n_words long, n_features long, buckets binary"), "features")


def _added(batches: Iterator[pa.RecordBatch], column: str, dtype: str, buckets: int, bins: bool) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, dtype=np.int64)
    for batch in batches:
        for value in batch.column(column):
            found = np.frombuffer(value.as_py(), dtype=dtype)
            total += np.bincount(found, minlength=buckets) if bins else found
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """Occurrences of each bucket over all rows: one array a task, added up in ``MERGERS`` tasks, and those in one."""
    partial = features.select("buckets").mapInArrow(lambda it: _added(it, "buckets", "<u4", buckets, True), "counts binary")
    for tasks in (MERGERS, 1):
        partial = partial.repartition(tasks).mapInArrow(lambda it: _added(it, "counts", "<i8", buckets, False), "counts binary")
    return np.frombuffer(partial.first()["counts"], dtype="<i8")


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of target share over source share) for each bucket, one occurrence more in every bucket of both."""
    s_all, t_all = int(source.sum()) + len(source), int(target.sum()) + len(target)
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(source.tolist(), target.tolist(), strict=True)])


def weighted(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """id, n_words, n_features and weight: the floored mean gain of a document's features, 0 without any. ``gain`` has one number a bucket."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = [
                int(gain[np.frombuffer(b.as_py(), dtype="<u4")].sum()) // n if n else 0
                for b, n in zip(batch.column("buckets"), batch.column("n_features").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weight, pa.int64())], ["id", "n_words", "n_features", "weight"])

    return features.select("id", "n_words", "n_features", "buckets").mapInArrow(weigh, "id long, n_words long, n_features long, weight long")


def drawn(scored: DataFrame, eligible, per_cent: int) -> DataFrame:
    """``scored`` with rank: the floor(per_cent * N / 100) highest ``score`` of the N eligible rows, ties to the smaller id.

    Scores are whole thousandths of logarithms, so the table of their counts is bounded by their range; it says where each score's ranks begin.
    Only rows whose score can be drawn move, and equal rows move as one with a count.
    """
    scored = scored.withColumn("_in", F.coalesce(eligible, F.lit(False)))
    below = Window.orderBy(F.col("_score").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = scored.filter("_in").groupBy(F.col("score").alias("_score")).agg(F.count("*").alias("_n"))
    starts = counts.select("_score", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("_all"))
    starts = starts.withColumn("_draw", F.floor(F.col("_all") * per_cent / 100)).filter("_before < _draw").drop("_all")
    placed = scored.join(starts, F.col("_in") & (F.col("score") == F.col("_score")), "left")

    columns = [c for c in scored.columns if c != "_in"]
    rest = placed.filter("_draw IS NULL").select(*columns, F.lit(None).cast("long").alias("rank"))
    near = placed.filter("_draw IS NOT NULL").groupBy(*columns, "_before", "_draw").agg(F.count("*").alias("_copies"))
    order = Window.partitionBy("score").orderBy(F.col("id").asc_nulls_first(), "n_features", "weight").rowsBetween(Window.unboundedPreceding, -1)
    near = near.withColumn("_first", F.col("_before") + F.coalesce(F.sum("_copies").over(order), F.lit(0)) + 1)
    near = near.withColumn("_rank", F.explode(F.sequence("_first", F.col("_first") + F.col("_copies") - 1)))
    return rest.unionByName(near.select(*columns, F.when(F.col("_rank") <= F.col("_draw"), F.col("_rank")).cast("long").alias("rank")))


def resample(
    docs: DataFrame, target: DataFrame, ngram: int = 1, buckets: int = 10_000, least_words: int = 20, per_cent: int = 10, seed: int = 2024
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document: a draw without replacement, in proportion to exp(weight / 1000), of
    ``per_cent`` of the documents with ``least_words`` words, by adding Gumbel noise that is a hash of seed and id."""
    features = hashed_features(docs, ngram, buckets)
    aims = hashed_features(target, ngram, buckets, doc_id=None)
    gain = gains(bucket_counts(features, buckets), bucket_counts(aims, buckets))
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = materialized(weighted(features, gain).withColumn("score", F.col("weight") + noise), "weights")
    return drawn(scored, F.col("n_words") >= least_words, per_cent).select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")
