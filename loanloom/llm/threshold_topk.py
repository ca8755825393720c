"""Exact top-k by inner product with the threshold algorithm over sorted lists, one list per dimension."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from loanloom.llm import vectors

LONG = 2**63 - 1


def _scores(rows: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products: in doubles where every sum fits them exactly, else in unbounded integers, held to a long's range."""
    if exact:
        return (rows @ q).astype(np.int64)
    ints = [sum(int(a) * int(b) for a, b in zip(r, q, strict=True)) for r in rows]
    return np.array([max(-LONG, min(LONG, s)) for s in ints], dtype=np.int64)


def _top(q, lists, values, held, ids, own, k, exact):
    """Sorted access goes down all lists at once, twice as deep each time; every new row is scored in full. The bound is the
    score of a row that stands at the present depth in every list: below the kth score, no unseen row can enter."""
    n, up, down = len(ids), np.flatnonzero(q > 0), np.flatnonzero(q < 0)
    seen, depth, step = own.copy(), 0, 32
    found_s, found_i = np.zeros(0, np.int64), np.zeros(0, np.int64)
    scored = seen.copy()
    while depth < n:
        to = min(n, depth + step)
        seen[lists[depth:to][:, up].ravel()] = True
        seen[lists[n - to : n - depth][:, down].ravel()] = True
        if not len(up) and not len(down):
            seen[:] = True
        new = np.flatnonzero(seen & ~scored)
        scored[new] = True
        found_s, found_i = np.concatenate([found_s, _scores(held[new], q, exact)]), np.concatenate([found_i, ids[new]])
        best = np.lexsort((found_i, -found_s))[:k]
        found_s, found_i = found_s[best], found_i[best]
        if scored.all():
            break
        bound = values[to - 1, up] @ q[up] + values[n - to, down] @ q[down]
        if len(best) == k and found_s[-1] > bound:  # an equal score could still win by its id
            break
        depth, step = to, step * 2
    return found_i, found_s


def top_products(rows: DataFrame, is_query: Column, k: int, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k highest integer inner products of ``floor(scale * x)`` vectors for each query: ``query_id``, ``rank``,
    ``vec_id``, ``score`` (long), ties to the smaller id, the query's own row left out. Exact.

    ``is_query`` is a condition on column ``id``. Every block of rows has its own sorted lists; negative weights walk them from
    below, zero weights not at all. Which rows take part: see ``vectors.usable`` (zero vectors do). Scores beyond a long are held to
    its range. An empty table gives no rows; other columns are ignored.
    """
    one = vectors.usable(rows, id_col, vector_col, drop_zero=False)

    def search(asked_ids, asked, ids, held):
        asked, held = np.floor(scale * asked), np.floor(scale * held)
        with np.errstate(over="ignore"):
            exact = bool(np.abs(asked).max() * np.abs(held).max() * held.shape[1] < 2**53)
        if not exact:
            asked, held = (np.array([[int(x) for x in r] for r in m], dtype=object) for m in (asked, held))
        lists = np.argsort(-held, axis=0, kind="stable")
        values = np.take_along_axis(held, lists, axis=0)
        out = []
        for q_id, q in zip(asked_ids, asked, strict=True):
            i, s = _top(q, lists, values, held, ids, ids == q_id, k, exact)
            out.append((np.full(len(i), q_id), i, s))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    return vectors.search_blocks(one, is_query, search, k, "long", nearest_first=False)
