"""Repeated runs of lines, found by winnowing over line hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanloom.llm.common import WORD, materialized

#: Runs of at least this many lines are sure to be found.
WINDOW = 2
#: A single line counts as a run if it has at least this many words.
LONG_LINE = 50


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def repeated_runs(docs: DataFrame, window: int = WINDOW, long_line: int = LONG_LINE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash``, ``first_line``, ``last_line``: runs of lines (from 0) that stand earlier in the corpus.

    Lines are compared without blanks at their ends; blank lines do not count, but go with the run around them. A run has ``window``
    or more lines, or is one line of at least ``long_line`` words. "Earlier" goes by id, then line; null ids come last, and rows
    that share an id count as one document.

    From each window of lines the least hash (the rightmost of equals) is selected; runs of ``window`` lines always share
    such a fingerprint. Fingerprints that stand once in the corpus are dropped. Around the others the match is extended both ways to all
    windows that selected them; each is compared with its earliest occurrence only, so that a line in a third of all documents
    makes no pairs.
    """
    at = F.col("at")
    lines = docs.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), _lines(F.col(text_col)).alias("line")
    )
    full = lines.withColumn(
        "full", F.filter(F.transform("line", lambda x, i: F.struct(i.alias("i"), F.trim(x).alias("x"))), lambda s: s["x"] != "")
    ).select(
        "doc_id", "text_hash", F.transform("full", lambda s: s["i"]).alias("pos"), F.transform("full", lambda s: F.xxhash64(s["x"])).alias("h"),
        F.transform("full", lambda s: F.regexp_count(s["x"], F.lit(WORD)) >= long_line).alias("long"),
    )
    starts = F.when(F.size("h") >= window, F.sequence(F.lit(0), F.size("h") - window)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(starts, lambda i: F.struct(i.alias("at"), F.lit(window).alias("n")))
    alone = F.transform(F.filter(F.sequence(F.lit(0), F.size("h")), lambda i: F.get("long", i)), lambda i: F.struct(i.alias("at"), F.lit(1).alias("n")))
    runs = full.select("doc_id", "text_hash", "pos", "h", F.explode(F.concat(windows, alone)).alias("w")).select(
        "doc_id", "text_hash", "pos", "h", "w.at", "w.n"
    )
    part = F.slice("h", at + 1, F.col("n"))
    runs = runs.select(
        "doc_id", "text_hash", F.get("pos", at).alias("first_line"), F.get("pos", at + F.col("n") - 1).alias("last_line"), "n",
        F.array_min(part).alias("least"),
        (at + F.col("n") - F.array_position(F.reverse(part), F.array_min(part))).alias("selected"),
        F.xxhash64(part, F.col("n")).alias("content"),
    )
    marks = runs.select("doc_id", "text_hash", "selected", "least").distinct()
    shared = marks.groupBy("least").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("least")
    again = materialized(runs.join(shared, "least", "left_semi").drop("least", "selected"), "runs")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("first_line").alias("line"))
    earliest = again.groupBy("content").agg(F.min(place).alias("earliest"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    return again.join(earliest, "content").filter(place > F.col("earliest")).select("doc_id", "text_hash", "first_line", "last_line")


def merged(runs: DataFrame) -> DataFrame:
    """Overlapping and touching runs of a document as one array of (``first``, ``last``)."""
    lines = runs.select("doc_id", "text_hash", F.explode(F.sequence("first_line", "last_line")).alias("line")).distinct()
    step = F.col("line") - F.row_number().over(Window.partitionBy("doc_id", "text_hash").orderBy("line"))
    spans = lines.withColumn("step", step).groupBy("doc_id", "text_hash", "step").agg(F.min("line").alias("first"), F.max("line").alias("last"))
    return spans.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("_runs"))


def without_repeats(docs: DataFrame, window: int = WINDOW, long_line: int = LONG_LINE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with later repeated runs of lines deleted from the text, and ``n_lines``, ``n_deleted``, ``deleted_runs``.

    See ``repeated_runs``. Null texts stay null with no lines; an empty text is one line, which is blank and stays; repeated rows of one id
    get the same text; an empty table stays empty; columns of the three names are replaced, others pass through.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_deleted", "deleted_runs", "_runs", "_id", "_hash")]
    found = merged(repeated_runs(docs, window, long_line, id_col, text_col)).withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    joined = docs.select(*[F.col(f"`{c}`") for c in kept]).join(
        found, F.col(id_col).eqNullSafe(F.col("_id")) & (F.xxhash64(F.col(text_col)) == F.col("_hash")), "left"
    )
    lines = _lines(F.col(text_col))
    rest = F.filter(lines, lambda x, i: ~F.exists("_runs", lambda r: (r["first"] <= i) & (i <= r["last"])))
    deleted = F.aggregate(F.coalesce("_runs", F.array().cast("array<struct<first:int,last:int>>")), F.lit(0).cast("long"), lambda a, r: a + r["last"] - r["first"] + 1)
    return joined.select(
        *[F.when(F.col("_runs").isNull(), F.col(c)).otherwise(F.array_join(rest, "\n")).alias(c) if c == text_col else F.col(f"`{c}`") for c in kept],
        F.coalesce(F.size(lines).cast("long") * F.when(F.col(text_col).isNotNull(), 1), F.lit(0).cast("long")).alias("n_lines"),
        deleted.alias("n_deleted"),
        F.coalesce("_runs", F.array().cast("array<struct<first:int,last:int>>")).alias("deleted_runs"),
    )
