"""Mixing sources to target weights: whole copies, then a subset of documents whose lengths add up to the rest of the budget."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from loanloom.llm.common import WORD, materialized

#: Budgets up to this many words are fitted by dynamic programming; what is larger is first taken in proportion.
EXACT_BUDGET = 1 << 16
#: Documents of one source and length that one task puts in order.
ORDER_BLOCK = 1024


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def subset_sum(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take, so that their lengths add up as near below ``budget`` as possible.

    Bounded knapsack: the count of a length is split into powers of two, and for every sum within the budget the item
    that first reached it is kept; since a sum is reached from one that earlier items reached, going back uses no item twice.
    """
    taken = np.zeros(len(lengths), dtype=np.int64)
    first = np.full(budget + 1, -1, dtype=np.int64)
    reached = np.zeros(budget + 1, dtype=bool)
    reached[0] = True
    items: list[tuple[int, int, int]] = []
    for i in np.argsort(-lengths, kind="stable"):
        length, left, size = int(lengths[i]), int(counts[i]), 1
        while left > 0 and length * min(size, left) <= budget and length > 0:
            n = min(size, left)
            new = reached[: budget + 1 - n * length] & ~reached[n * length :]
            first[n * length :][new] = len(items)
            reached[n * length :] |= new
            items.append((i, n, n * length))
            left, size = left - n, size * 2
        if reached[budget]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, n, words = items[first[at]]
        taken[i] += n
        at -= words
    return taken


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Documents to take of each length: the same share of every length, one more of the longest ones while the rest is
    beyond ``EXACT_BUDGET``, then ``subset_sum`` for what remains."""
    total = int(lengths @ counts)
    if budget >= total:
        return counts.copy()
    share = budget / total if total else 0.0
    taken = np.minimum(np.floor(counts * share).astype(np.int64), counts)
    rest = budget - int(lengths @ taken)
    for i in np.argsort(-lengths, kind="stable"):
        while rest > EXACT_BUDGET and taken[i] < counts[i] and 0 < lengths[i] <= rest:
            more = min(int(counts[i] - taken[i]), max(1, (rest - EXACT_BUDGET) // int(lengths[i])))
            taken[i], rest = taken[i] + more, rest - more * int(lengths[i])
    return taken + subset_sum(lengths, counts - taken, min(rest, EXACT_BUDGET))


def _positions(sources: DataFrame) -> DataFrame:
    """``src_id`` 0, 1, …: sources by code point, null last. Counted per sorted part, so that no task sees all sources."""
    by = F.col("source").asc_nulls_last()
    parts = materialized(sources.repartitionByRange(by).withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    starts = parts.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(by))
    return parts.join(starts, "part").withColumn("src_id", F.col("start") + own - 1).drop("part", "start")


def targets(sources: DataFrame, weights: tuple[int, ...], most: float) -> DataFrame:
    """``source_size`` → ``target`` per source: weights share the sum of all sizes; a target stops at ``most`` times its
    source's size and the excess is reshared by weight.

    A source is capped when its cap over its weight is at most the water level; the level rises until it stays.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("src_id") % len(weights) + 1).cast("int"))
    rows = materialized(
        _positions(sources).withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most)), "targets"
    )
    total, level = float(rows.agg(F.sum("source_size")).first()[0] or 0), 0.0
    while True:
        full = F.col("cap") <= level * F.col("weight")
        capped, free = rows.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))
        ).first()
        new = (total - capped) / free if free else level
        if new <= level:
            break
        level = new
    return rows.withColumn("target", F.least("cap", F.col("weight") * level)).drop("weight", "cap")


def measured(docs: DataFrame, keep: list[str], id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 11) -> DataFrame:
    """Columns ``keep`` with ``_source``, ``_size`` in words and ``_order``, a seeded place in [0, 1) that depends on id and text.
    Columns with names that this module adds are left out."""
    order = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), 11) / F.lit(float(1 << 53))
    own = ("_id", "_source", "_size", "_order", "source_size", "target", "copies", "taken", "s", "z", "base", "extra", "n", "cut", "cut_id")
    return docs.select(
        *[F.col(f"`{c}`") for c in keep if c not in own], F.col(id_col).alias("_id"), F.col(source_col).alias("_source"),
        n_words(F.col(text_col)).alias("_size"), order.alias("_order"),
    )


def plan(rows: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """Per source and document length: ``base`` copies of every document, and one more of those whose (``_order``, ``_id``) is
    at most (``cut``, ``cut_id``).

    ``rows`` comes from ``measured`` and should be a stored table, as it is read several times.
    """
    classes = materialized(rows.groupBy("_source", "_size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    sources = classes.groupBy(F.col("_source").alias("source")).agg(F.sum(F.col("_size") * F.col("n")).alias("source_size"))
    wanted = targets(sources, weights, most)
    known = classes.join(wanted, F.col("_source").eqNullSafe(F.col("source"))).drop("source")

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        lengths, counts = group["_size"].to_numpy(), group["n"].to_numpy()
        base = min(int(target // size), int(most)) if size else 0
        extra = fit_budget(lengths, counts, int(round(target - base * size))) if size and base < most else np.zeros_like(counts)
        extra[lengths == 0] = 0
        return pd.DataFrame({"src_id": group["src_id"], "_size": lengths, "base": base, "extra": extra})

    chosen = known.groupBy("src_id").applyInPandas(choose, "src_id long, _size long, base long, extra long")
    budget = materialized(known.join(chosen, ["src_id", "_size"]), "budget")

    # The last document taken of a class: its bucket of order from counts, then its rank in that bucket.
    partly = budget.filter("extra > 0 and extra < n").withColumn("buckets", F.ceil(F.col("n") / ORDER_BLOCK))
    named = F.col("_source").eqNullSafe(F.col("s")) & (F.col("_size") == F.col("z"))
    kinds = partly.select("src_id", F.col("_source").alias("s"), F.col("_size").alias("z"), "extra", "buckets")
    inside = materialized(
        rows.select("_source", "_size", "_order", "_id").join(kinds, named).withColumn("b", F.floor(F.col("_order") * F.col("buckets")))
        .select("src_id", "_size", "b", "_order", "_id", "extra"), "candidates",
    )
    before = Window.partitionBy("src_id", "_size").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    counts = inside.groupBy("src_id", "_size", "b", "extra").agg(F.count(F.lit(1)).alias("c"))
    last = (
        counts.withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0)))
        .filter("before < extra and before + c >= extra").select("src_id", "_size", "b", (F.col("extra") - F.col("before")).alias("place"))
    )
    order = Window.partitionBy("src_id", "_size", "b").orderBy("_order", "_id")
    cuts = (
        inside.drop("extra").join(last, ["src_id", "_size", "b"]).withColumn("rn", F.row_number().over(order)).filter("rn = place")
        .select("src_id", "_size", F.col("_order").alias("cut"), F.col("_id").alias("cut_id"))
    )
    return materialized(
        budget.join(cuts, ["src_id", "_size"], "left").select(
            F.col("_source").alias("s"), F.col("_size").alias("z"), "source_size", "target", "base", "extra", "n", "cut", "cut_id"
        ), "mix",
    )


def mix(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``rows`` of ``measured`` with ``source_size``, ``target``, ``copies`` and ``taken`` (words, copies counted).

    Words are ``[^\\x20\\x09-\\x0D]+``; null and empty texts have none. They and the documents of a source without words are taken once
    per whole copy of their source. Documents that agree in id and text are taken together. Null sources are one source, the last.
    An empty table gives no rows. Reruns agree, since every choice is by seeded hash.
    """
    more = (F.col("extra") > 0) & (
        (F.col("extra") == F.col("n")) | (F.col("_order") < F.col("cut"))
        | ((F.col("_order") == F.col("cut")) & (F.col("_id").eqNullSafe(F.col("cut_id")) | (F.col("_id") <= F.col("cut_id")) | F.col("_id").isNull()))
    )
    copies = F.col("base") + F.when(more, 1).otherwise(0)
    joined = rows.join(planned, F.col("_source").eqNullSafe(F.col("s")) & (F.col("_size") == F.col("z")))
    return joined.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("_size")).drop(
        "s", "z", "base", "extra", "n", "cut", "cut_id"
    )
