"""Repeated passages of words, wherever they begin and end, found by winnowing over word shingles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loanloom.llm import line_dedup
from loanloom.llm.common import materialized, release, releasing, slices

#: Words of the shortest passage.
PASSAGE = 50
#: Words of a shingle; each passage holds PASSAGE - SHINGLE + 1 of them, of which the least is its fingerprint.
SHINGLE = 20
CHUNK = 1 << 20
#: Bytes of text taken up at a time.
SLICE = 1 << 20
#: In place of a first word: all of a text.
WHOLE = -1
_M1, _M2, _BASE = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    """Powers of a base from 0; those of the usual lengths are kept, 8 MB a base at most."""
    return (_table(base, 1 << 14) if n <= 1 << 14 else _table(base, CHUNK + 1) if n <= CHUNK + 1 else _table.__wrapped__(base, n))[:n]


@cache
def _table(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Splitmix64: sums of what it gives do not cancel as sums of products do."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash, mod 2^64, of ``values`` from each start to each end."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(_BASE, len(values)), dtype=np.uint64)])
    return (total[ends] - total[starts]) * _powers(_INVERSE, len(values) + 1)[starts]


def _words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends in bytes, hashes, and whether a line ends before each word."""
    raw = np.frombuffer(text, dtype=np.uint8)
    solid = (raw != 0x20) & ((raw < 0x09) | (raw > 0x0D))
    edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # words of so many bytes at a time
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK, "right")))
        low = starts[at]
        hashes[at:to] = _sums(raw[low : ends[to - 1]].astype(np.uint64) + np.uint64(1), starts[at:to] - low, ends[at:to] - low)
        at = to
    breaks = np.concatenate([[0], np.cumsum(raw == 0x0A)])
    return starts, ends, _mixed(hashes + (ends - starts).astype(np.uint64)), breaks[starts] > np.concatenate([[0], breaks[ends[:-1]]])[: len(starts)]


def windows(text: bytes, passage: int = PASSAGE, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint and content hash of the passage that begins at each word, and the hashes of all shingles.

    Equal passages have equal words and line ends at the same places; how many blanks lie between words does not count. The fingerprint is
    the least shingle hash of a passage, so it depends on the passage alone, and neighbours mostly share it.
    """
    _, _, words, broken = _words(text)
    if len(words) < passage:
        return (np.zeros(0, np.int64),) * 3
    units = _mixed(words + broken.astype(np.uint64) * _M1)

    def runs(length: int) -> np.ndarray:
        """Hash of each run of words; the line end before its first word is no part of it."""
        i = np.arange(len(words) - length + 1)
        return _mixed(_sums(units, i + 1, i + length) * np.uint64(_BASE) + words[i])

    shingles = least = runs(shingle)
    width = 1
    while width < passage - shingle + 1:
        step = min(width, passage - shingle + 1 - width)
        least, width = np.minimum(least[:-step], least[step:]), width + step
    return least.view(np.int64), runs(passage).view(np.int64), shingles.view(np.int64)


def fingerprints(text: str) -> np.ndarray:
    """Distinct fingerprints of a text; those whose shingle stands in it more than once are given twice."""
    least, _, shingles = windows(text.encode())
    own = np.unique(least)
    found, counts = np.unique(shingles, return_counts=True)
    return np.concatenate([own, own[counts[np.searchsorted(found, own)] > 1]])


def _cut(line: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A line without its spans; what is left is joined by single blanks."""
    parts, at = [], 0
    for low, high in [*spans, (len(line), len(line))]:
        parts.append(line[at:low])
        at = high
    last = len(parts) - 1
    parts = [(p if i == 0 else p.lstrip()) if i == last else (p.rstrip() if i == 0 else p.strip()) for i, p in enumerate(parts)]
    return b" ".join(p for p in parts if p.strip())


def cleaned(text: str, runs: list[tuple[int, int]], at: np.ndarray, passage: int = PASSAGE) -> tuple[str, int]:
    """A text without the lines of ``runs`` and the passages that begin at the words ``at``, and how many lines that touched.

    A line of which no word is left goes, and so do blank lines inside a passage.
    """
    raw = text.encode()
    gone: set[int] = set()
    for first, last in runs:
        gone.update(range(first, last + 1))
    spans: list[tuple[int, int]] = []
    if len(at):
        starts, ends, _, _ = _words(raw)
        at = np.sort(at) if at.min() != WHOLE else np.arange(max(0, len(starts) - passage + 1))
    if len(at):
        new = np.flatnonzero(np.diff(at, prepend=at[0] - passage - 1) > passage)
        for a, z in zip(at[new], at[np.concatenate([new[1:] - 1, [len(at) - 1]])] + passage - 1):
            spans.append((int(starts[a]), int(ends[z])))
    out, touched, low, k = [], 0, 0, 0
    for i, line in enumerate(raw.split(b"\n")):
        high = low + len(line)
        while k < len(spans) and spans[k][1] <= low:
            k += 1
        mine, j = [], k
        while j < len(spans) and spans[j][0] <= high:
            if spans[j][1] > low:
                mine.append((max(spans[j][0], low) - low, min(spans[j][1], high) - low))
            j += 1
        mine = [] if mine == [(len(line), len(line))] else mine
        left = line if i not in gone and not mine else b"" if i in gone else _cut(line, mine)
        if i in gone or mine:
            touched += 1
        if i not in gone and not (mine and not left.strip()):
            out.append(left)
        low = high + 1
    return b"\n".join(out).decode(), touched


def _rows(batch: pa.RecordBatch, counts: list[int], **columns: np.ndarray) -> pa.RecordBatch:
    """``columns`` beside the keys of the texts that they come from, so many rows from each."""
    of = pa.array(np.repeat(np.arange(len(counts)), counts))
    arrays = [batch[c].take(of) for c in ("doc_id", "text_hash")] + [pa.array(x) for x in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_hash", *columns])


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash``, ``at``: first words (from 0) of all passages of ``PASSAGE`` words that stand earlier in the corpus; ``WHOLE`` for
    texts that stand earlier as they are, which need no more comparing.

    A longer repeated passage is the union of its parts of that length, so nothing has to be extended. "Earlier" goes by id, text, then word,
    and within a text only what ends before counts; null ids come last. Passages whose fingerprint stands once are dropped before their
    contents are made; each of the others is compared with its earliest occurrence only.
    """
    texts = docs.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("_text")
    )

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                found = [fingerprints(t.as_py()) for t in part["_text"]]
                yield _rows(part, [len(x) for x in found], mark=np.concatenate(found))

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                at, content = [], []
                for text, marks in zip(part["_text"], part["_marks"]):
                    least, all_of, _ = windows(text.as_py().encode())
                    at.append(np.flatnonzero(np.isin(least, marks.values.to_numpy(zero_copy_only=False))))
                    content.append(all_of[at[-1]])
                yield _rows(part, [len(x) for x in at], at=np.concatenate(at).astype(np.int32), content=np.concatenate(content))

    whole = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    equal = texts.groupBy("text_hash").agg(F.min(whole).alias("first"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    copies = materialized(texts.drop("_text").join(equal, "text_hash").filter(whole > F.col("first")).select("doc_id", "text_hash").distinct(), "copies")
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.drop("_text").schema)
    marks = materialized(texts.mapInArrow(releasing(marked), f"{kind}, mark long"), "marks")
    named = copies.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    mine = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    marks = marks.join(named, mine, "left_anti")
    shared = marks.groupBy("mark").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("mark")
    own = marks.join(shared, "mark", "left_semi").groupBy("doc_id", "text_hash").agg(F.collect_set("mark").alias("_marks"))
    own = own.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    near = texts.join(own, mine).select("doc_id", "text_hash", "_text", "_marks")
    again = materialized(near.mapInArrow(releasing(contents), f"{kind}, at int, content long"), "passages")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), F.col("at").alias("at"))
    earliest = again.groupBy("content").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    same = F.col("doc_id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.hash"))
    later = again.join(earliest, "content").filter((place > F.col("first")) & ~(same & (F.col("at") < F.col("first.at") + PASSAGE)))
    return later.select("doc_id", "text_hash", "at").distinct().unionByName(copies.withColumn("at", F.lit(WHOLE)))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without later repeated runs of lines (see ``line_dedup``) and later repeated passages, and ``n_touched``, the lines cut or shortened.

    Both are looked for in the whole texts, so neither hides a part of the other. Null texts stay null; repeated rows of one id get the same
    text; an empty table stays empty.
    """
    kept = [c for c in docs.columns if c not in ("n_touched", "_runs", "_at", "_id", "_hash", "_id2", "_hash2", "_clean")]
    lines = line_dedup.merged(line_dedup.repeated_runs(docs, id_col=id_col, text_col=text_col)).withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    at = repeated(docs, id_col, text_col).groupBy("doc_id", "text_hash").agg(F.collect_list("at").alias("_at"))
    at = at.withColumnsRenamed({"doc_id": "_id2", "text_hash": "_hash2"})
    text_hash = F.xxhash64(F.col(text_col))
    joined = (
        docs.select(*[F.col(f"`{c}`") for c in kept])
        .join(lines, F.col(id_col).eqNullSafe(F.col("_id")) & (text_hash == F.col("_hash")), "left")
        .join(at, F.col(id_col).eqNullSafe(F.col("_id2")) & (text_hash == F.col("_hash2")), "left")
    )
    touched = F.col("_runs").isNotNull() | F.col("_at").isNotNull()

    def clean(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, first, last, words in batches:
            rows = []
            for t, a, z, w in zip(texts, first, last, words):
                rows.append((None, 0) if t is None else cleaned(t, [] if a is None else list(zip(a, z)), np.array([] if w is None else w, dtype=np.int64)))
            yield pd.DataFrame(rows, columns=["text", "n"])
        release()

    done = F.pandas_udf(clean, "text string, n long")(
        F.when(touched & F.col(text_col).isNotNull(), F.col(text_col)), F.col("_runs.first"), F.col("_runs.last"), F.col("_at")
    )
    rows = joined.withColumn("_touched", touched).withColumn("_clean", done)
    return rows.select(
        *[F.when(F.col("_touched"), F.col("_clean.text")).otherwise(F.col(c)).alias(c) if c == text_col else F.col(f"`{c}`") for c in kept],
        F.coalesce("_clean.n", F.lit(0).cast("long")).alias("n_touched"),
    )
