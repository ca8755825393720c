"""Vectors as numbered rows, and blocks of queries against blocks of candidates."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from loanloom.llm.common import materialized

#: Vectors and queries that one task holds; a cell's memory is bounded by them, and their number grows with the input.
CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 4096


def usable(vectors: DataFrame, id_col: str, vector_col: str, drop_zero: bool) -> DataFrame:
    """``id``, ``v``: one row per id with a vector that can be compared.

    Left out: null ids, null or empty vectors, vectors with a null or non-finite component, with ``drop_zero``
    zero vectors, and vectors whose length is not the table's commonest (ties to the longer). Repeated rows
    count once; of several vectors under one id the smallest in array order stays.
    """
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = vectors.filter(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite)
    if drop_zero:
        good = good.filter(F.exists(v, lambda x: x != 0))
    good = good.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    one = materialized(good.groupBy("id").agg(F.min("v").alias("v")), "vectors")
    lengths = one.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return one.filter(F.size("v") == (lengths["d"] if lengths else 0))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 0))


Search = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def search_blocks(one: DataFrame, is_query: Column, search: Search, k: int, score_type: str, nearest_first: bool) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k best of what ``search`` finds in each cell of the grid.

    ``search(query_ids, queries, ids, vectors)`` gives rows (query id, id, score) of one block pair, at most k for a query.
    """
    queries = one.filter(is_query)
    blocks, q_blocks = -(-one.count() // CANDIDATE_BLOCK) or 1, -(-queries.count() // QUERY_BLOCK) or 1
    mixed = F.xxhash64("id")

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    left = queries.select(
        "id", "v", F.pmod(mixed, F.lit(q_blocks)).alias("q"), numbers(blocks).alias("b")
    )
    right = one.select(
        "id", "v", numbers(q_blocks).alias("q"), F.pmod(mixed, F.lit(blocks)).alias("b")
    )

    def cell(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        held = held.sort_values("id")
        q, i, s = search(asked["id"].to_numpy(), matrix(asked["v"]), held["id"].to_numpy(), matrix(held["v"]))
        return pd.DataFrame({"query_id": q, "vec_id": i, "score": s})

    found = left.groupBy("b", "q").cogroup(right.groupBy("b", "q")).applyInPandas(cell, f"query_id long, vec_id long, score {score_type}")
    best = F.col("score").asc() if nearest_first else F.col("score").desc()
    order = Window.partitionBy("query_id").orderBy(best, F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
