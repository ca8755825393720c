"""Regex matches as rows with code point positions, by SQL functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanloom.llm.common import materialized

#: Characters of context that a match keeps on either side.
CONTEXT = 80


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def matches(
    docs: DataFrame, patterns: dict[str, str], id_col: str, text_col: str, keep_group: dict[str, int] | None = None,
    gates: dict[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """``doc_id``, ``text_hash``, ``kind``, ``start``, ``end``, ``value``, ``left``, ``right``, ``part``: every match of every pattern.

    Matches of a kind are leftmost and do not overlap. Positions are running sums of the lengths of matches and of the texts
    between them, taken over exploded rows, so that a text with very many matches costs no more per match. ``left`` and
    ``right`` are up to ``CONTEXT`` characters beside the match, over neighbouring matches. ``part`` is the group that ``keep_group`` names for a kind;
    ``gates`` names a cheap condition on the text without which a kind cannot match. Rows that agree in id and
    text give their matches once.
    """
    text = F.col("_text")
    rows = docs.filter(F.col(text_col).isNotNull() & (F.col(text_col) != "")).select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
        F.col(text_col).alias("_text"),
    )

    def context(all_: Column, i: Column) -> tuple[Column, Column]:
        """Text on either side, over up to two neighbouring matches before and one behind: two words and one are there if the text has them."""
        before = [F.concat(F.coalesce(F.get(all_, i - k)["left"], F.lit("")), F.coalesce(F.get(all_, i - k)["value"], F.lit(""))) for k in (2, 1)]
        behind = F.get(all_, i + 1)
        left = F.concat(*before, F.get(all_, i)["left"])
        right = F.concat(F.get(all_, i)["right"], F.coalesce(behind["value"], F.lit("")), F.coalesce(behind["right"], F.lit("")))
        return F.right(left, F.lit(CONTEXT)), F.left(right, F.lit(CONTEXT))

    def all_of(kind: str, pattern: str) -> Column:
        group = (keep_group or {}).get(kind)

        def zipped(values: Column) -> Column:
            return _let(F.split(text, pattern, -1), lambda gaps: F.transform(values, lambda v, i: F.struct(
                v.alias("value"), F.length(F.get(gaps, i)).cast("long").alias("gap"), F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("left"),
                F.left(F.get(gaps, i + 1), F.lit(CONTEXT)).alias("right"),
            )))

        def row(all_: Column, x: Column, i: Column) -> Column:
            left, right = context(all_, i)
            return F.struct(
                F.lit(kind).alias("kind"), i.alias("n"), x["value"].alias("value"), x["gap"].alias("gap"), left.alias("left"), right.alias("right"),
                (F.regexp_extract(x["value"], pattern, group) if group else F.lit(None).cast("string")).alias("part"),
            )

        rows_of = lambda values: _let(zipped(values), lambda all_: F.transform(all_, lambda x, i: row(all_, x, i)))
        none = F.array().cast("array<struct<kind:string,n:int,value:string,gap:bigint,left:string,right:string,part:string>>")
        # The text is cut at its matches only where there are any, and searched only where it holds what every match does.
        some = lambda values: F.when(F.size(values) > 0, rows_of(values)).otherwise(none)
        searched = _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), some)
        return F.when((gates or {})[kind](text), searched).otherwise(none) if kind in (gates or {}) else searched

    found = [all_of(kind, pattern) for kind, pattern in patterns.items()]
    exploded = materialized(rows.select("_row", "doc_id", "text_hash", F.explode(F.concat(*found)).alias("m")).select("_row", "doc_id", "text_hash", "m.*"), "matches")
    upto = Window.partitionBy("_row", "kind").orderBy("n")
    end = F.sum(F.col("gap") + F.length("value")).over(upto)
    placed = exploded.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))
    return placed.select("doc_id", "text_hash", "kind", "start", "end", "value", "left", "right", "part").distinct()


def listed(spans: Column) -> Column:
    """``kind:start:end`` of an array of (kind, start, end), joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def per_document(docs: DataFrame, spans: DataFrame, kinds: list[str], by_kind_first: bool, id_col: str, text_col: str) -> DataFrame:
    """One row per document: counts of the base kinds, ``base_sha256`` and ``spans``; ``spans`` has ``kind``, ``start``, ``end``, ``base``.

    A document without spans has counts of 0 and the digest of an empty text.
    """
    rank = F.coalesce(F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind")), F.lit(0))
    rank = F.when(rank == 0, len(kinds) + 1).otherwise(rank)
    order = [rank.alias("r"), F.col("start")] if by_kind_first else [F.col("start"), rank.alias("r")]
    item = F.struct(*order, F.col("kind"), F.col("end"), F.col("base"))
    per = spans.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(item)).alias("_all"))
    base = F.filter("_all", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    per = per.select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"),
        *[count(k).alias(f"n_{k}") for k in kinds],
        listed(base).alias("_base"), listed(F.col("_all")).alias("spans"),
    )
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).isNotNull().alias("_some"))
    joined = rows.join(per, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")) & F.col("_some"), "left")
    return joined.select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in kinds],
        F.sha2(F.coalesce("_base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
    )
