"""Bounded-space online packing of tokenized documents into windows of a fixed length."""

from __future__ import annotations

import bisect
import itertools
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from loanloom.llm.common import materialized, releasing, slices

#: Ids of documents travel as text: pandas has no long column with nulls.
PIECE = "doc_id string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
#: Leftover windows that one task merges.
MERGE_BLOCK = 1024
#: Bytes of text taken up at a time; nothing is kept from one to the next.
SLICE = 8 << 20
#: Words that the tokenizer gets at a time, and words whose ids are gathered at a time: both bound what a task holds beside a slice.
ENCODED, GATHERED = 16_384, 1 << 18


@cache
def _tokenizer(path: str) -> Tokenizer:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Tokenizer.from_file(path)


@cache
def _word_ends(path: str) -> np.ndarray:
    """Which ids end a word."""
    vocabulary = _tokenizer(path).get_vocab()
    out = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    out[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
    return out


def _word_ids(words: pa.StringArray, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A pool of ids, and for each distinct word where its two segments begin in the pool and how long they are.

    Of a run of letters and a last full stop or comma, the letters are one segment and the mark the other: the vocabulary never joins them. All
    different runs of letters go to the tokenizer ``ENCODED`` to a text, every other word by itself.
    """
    encode = _tokenizer(path).encode_batch_fast
    dot, comma = pc.ends_with(words, "."), pc.ends_with(words, ",")
    stems = pc.if_else(pc.or_(dot, comma), pc.utf8_slice_codeunits(words, 0, -1), words)
    plain = pc.and_(pc.utf8_is_alpha(stems), pc.invert(pc.match_substring(stems, "\u03a3"))).to_numpy(zero_copy_only=False)
    coded = pc.if_else(pc.string_is_ascii(stems), pc.ascii_lower(stems), stems).filter(pa.array(plain)).dictionary_encode()
    runs = coded.dictionary.to_pylist()
    marks = [np.array(e.ids, dtype="<u4") for e in encode([".", ","], add_special_tokens=False)]
    coded_runs = [
        np.array(encode([" ".join(runs[at : at + ENCODED])], add_special_tokens=False)[0].ids, dtype="<u4") for at in range(0, len(runs), ENCODED)
    ]
    pool = [np.concatenate([np.zeros(0, dtype="<u4"), *coded_runs]), *marks]
    ends = np.flatnonzero(_word_ends(path)[pool[0]]) + 1
    if len(ends) != len(runs):  # a run that does not close with one token that ends a word
        plain[:] = False
        pool[0], ends = pool[0][:0], np.zeros(0, np.int64)
    single = words.filter(pa.array(~plain))
    alone = [
        np.array(e.ids, dtype="<u4")
        for at in range(0, len(single), ENCODED)
        for e in encode(single.slice(at, ENCODED).to_pylist(), add_special_tokens=False)
    ]
    first, length = np.zeros((2, len(words), 2), dtype=np.int64)
    if plain.any():
        number = coded.indices.to_numpy()
        starts = np.concatenate(([0], ends[:-1]))
        first[plain, 0], length[plain, 0] = starts[number], (ends - starts)[number]
        for mark, at in ((dot, len(pool[0])), (comma, len(pool[0]) + len(pool[1]))):
            has = plain & mark.to_numpy(zero_copy_only=False)
            first[has, 1], length[has, 1] = at, len(pool[1 if mark is dot else 2])
    sizes = np.array([len(a) for a in alone], dtype=np.int64)
    first[~plain, 0], length[~plain, 0] = sum(map(len, pool)) + np.cumsum(sizes) - sizes, sizes
    return np.concatenate([*pool, *alone]), first, length


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and where each text's begin and end.

    The vocabulary lower-cases, drops white space, and never joins across it. So texts are cut at blanks and line feeds, the distinct words
    of all of them get their ids, and one gather over the words' numbers puts these in order.
    """
    empty, line_feed = (pa.scalar(x, pa.large_string()) for x in ("", "\n"))
    texts = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), empty), empty, line_feed)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    inside = (data != 32) & (data != 10)
    after = np.zeros_like(inside)
    after[1:] = inside[:-1] & ~inside[1:]
    compact = np.where(after, np.uint8(32), data)[inside | after]  # every word with one blank behind it
    per_text = np.searchsorted(np.flatnonzero(after), offsets - offsets[0])
    del inside, after
    bounds = np.concatenate(([0], np.flatnonzero(compact == 32) + 1)).astype(np.int32)
    coded = pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(compact)]).dictionary_encode()
    pool, first, length = _word_ids(pc.utf8_slice_codeunits(coded.dictionary, 0, -1), path)
    number = coded.indices.to_numpy()
    at = np.concatenate(([0], np.cumsum(length.sum(axis=1)[number])))
    ids = np.empty(at[-1], dtype="<u4")
    for low in range(0, len(number), GATHERED):
        some = number[low : low + GATHERED]
        sizes = length[some].ravel()
        to = np.cumsum(sizes)
        ids[at[low] : at[low + len(some)]] = pool[np.repeat(first[some].ravel() - to + sizes, sizes) + np.arange(to[-1])]
    return ids, at[per_text]


class _Windows:
    """At most ``keep`` open windows, by free room; a window's pieces are held until it is emitted."""

    def __init__(self, size: int, keep: int, first: int):
        self.size, self.keep, self.numbers = size, keep, itertools.count(first)
        self.open: list[tuple[int, int, list[tuple]]] = []  # (room, number, pieces), the fullest first

    def put(self, doc, start: int, ids: bytes, total: int) -> list[tuple] | None:
        """Place a piece; gives the pieces of the window that this emits, if any."""
        n = len(ids) // 4
        at = bisect.bisect_left(self.open, n, key=lambda w: w[0])  # the fullest window that still takes it
        out = None
        if at < len(self.open):
            room, number, pieces = self.open.pop(at)
        else:
            if len(self.open) >= self.keep:
                out = self.open.pop(0)[2]
            room, number, pieces = self.size, next(self.numbers), []
        pieces.append((doc, start, n, ids, total, number, self.size - room))
        if room == n:
            return pieces if out is None else out + pieces
        bisect.insort(self.open, (room - n, number, pieces), key=lambda w: w[:2])
        return out


def pack(
    docs: DataFrame, path: str | None = None, window: int = 2048, end_id: int = 1, keep: int = 64, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``window`` tokens: ``doc_id``, ``start`` and ``length`` in the document's
    ids, ``ids`` (little-endian 32-bit), ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence.

    A document is its text's ids and ``end_id``; null and empty texts are ``end_id`` alone. It is cut at multiples of ``window``; whole
    windows stand alone, the rest goes to the fullest open window that takes it. ``keep`` windows are open per partition; when none
    fits, the fullest is emitted. What stays open at the end is merged across partitions, largest first, in hashed groups of
    about 1,024 windows. Repeated rows are packed each on its own, null ids too; an empty table gives no pieces; other columns are
    ignored. The first pass runs once, into the shared folder, since numbering depends on the order of a partition.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")
    end = np.array([end_id], dtype="<u4").tobytes()
    whole = 4 * window

    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def frame(rows: list[tuple], still_open: bool) -> pa.RecordBatch:
        arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([still_open] * len(rows))], [*columns, "still_open"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _Windows(window, keep, TaskContext.get().partitionId() << 40)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                all_ids, bounds = token_ids(part.column("text"), path)
                rows, all_ids = [], all_ids.tobytes()
                for doc, low, high in zip(part.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    ids = all_ids[4 * low : 4 * high] + end
                    total = len(ids) // 4
                    cut = total // window * window
                    for start in range(0, cut, window):
                        rows.append((doc, start, window, ids[4 * start : 4 * start + whole], total, next(windows.numbers), 0))
                    if cut < total:
                        rows += windows.put(doc, cut, ids[4 * cut :], total) or []
                if rows:
                    yield frame(rows, False)
        for _, _, pieces in windows.open:
            yield frame(pieces, True)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        """Largest first into the fullest window that takes it."""
        fill = group.groupby("sequence_id")["length"].sum()
        rooms: list[tuple[int, int]] = []
        target, base = {}, {}
        for number, n in sorted(fill.items(), key=lambda x: (-x[1], x[0])):
            at = bisect.bisect_left(rooms, (n, -1))
            room, into = rooms.pop(at) if at < len(rooms) else (window, number)
            target[number], base[number] = into, window - room
            bisect.insort(rooms, (room - n, into))
        old = group["sequence_id"]
        return group.assign(sequence_id=old.map(target), offset=group["offset"] + old.map(base))[columns]

    columns = [c.split()[0] for c in PIECE.split(", ")]
    plain = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    placed = materialized(plain.mapInArrow(releasing(place), PIECE + ", still_open boolean"), "packed")
    left = placed.filter("still_open")
    groups = -(-left.select("sequence_id").distinct().count() // MERGE_BLOCK) or 1
    merged = left.withColumn("part", F.pmod(F.xxhash64("sequence_id"), F.lit(groups))).groupBy("part").applyInPandas(merge, PIECE)
    pieces = placed.filter("not still_open").select(*columns).unionByName(merged)
    return pieces.withColumn("doc_id", F.col("doc_id").cast("long"))
