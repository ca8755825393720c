"""Approximate nearest neighbours by multi-index hashing over learned rotated binary codes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from loanloom.llm import vectors

#: Vectors on which rotation and radius are fitted; the choice is by hash of the id, every vector is indexed.
SAMPLE = 8192
SUBSTRING_BITS = 16
_ONES = np.array([bin(x).count("1") for x in range(1 << SUBSTRING_BITS)], dtype=np.uint8)


@dataclass(frozen=True)
class Codes:
    """Centre, rotation to bits, and the Hamming radius that holds the wanted share of the sample's true neighbours."""

    centre: np.ndarray
    rotation: np.ndarray
    radius: int

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Codes as substrings of 16 bits: shape (rows, substrings)."""
        bits = (x - self.centre) @ self.rotation > 0
        pad = -bits.shape[1] % SUBSTRING_BITS
        bits = np.pad(bits, ((0, 0), (0, pad))).reshape(len(bits), -1, SUBSTRING_BITS)
        return (bits.astype(np.uint16) << np.arange(SUBSTRING_BITS, dtype=np.uint16)).sum(axis=2, dtype=np.uint16)


def fit(sample: np.ndarray, k: int, bits: int = 64, share: float = 0.985, rounds: int = 40, seed: int = 7) -> Codes:
    """Principal axes, then a rotation that brings the sample near the corners of the cube (iterative quantisation)."""
    if len(sample) < 2:
        d = sample.shape[1] if sample.size else 1
        return Codes(np.zeros(d), np.eye(d)[:, : min(bits, d)], 0)
    # Huge components would overflow in the products; a common scale changes no code.
    scale = max(1.0, float(np.abs(sample).max()))
    centre = (sample / scale).mean(axis=0)
    x = sample / scale - centre
    _, axes = np.linalg.eigh(x.T @ x / len(x))
    axes = axes[:, ::-1][:, : min(bits, x.shape[1])]
    p = x @ axes
    r, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(p.shape[1], p.shape[1])))
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.where(p @ r > 0, 1.0, -1.0).T @ p)
        r = w.T @ u.T
    codes = Codes(centre * scale, axes @ r, 0)
    code, asked = codes(sample), np.arange(0, len(sample), max(1, len(sample) // 256))
    far = []
    for i in asked:
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        near = np.argsort(d, kind="stable")[: min(k, len(sample) - 1)]
        far.append(_ONES[code[near] ^ code[i]].sum(axis=1, dtype=np.int64))
    return Codes(codes.centre, codes.rotation, int(np.quantile(np.concatenate(far), share, method="higher")))


def _probe(code: np.ndarray, tables: list[tuple[np.ndarray, np.ndarray]], n: int, radius: int) -> np.ndarray:
    """Rows that some substring table holds within the pigeonhole radius: with r = a*m + b, the first b + 1 tables
    are probed to distance a and the others to a - 1, which misses no code within r."""
    a, b = divmod(radius, len(tables))
    hit = np.zeros(n, dtype=bool)
    for j, (values, bucket) in enumerate(tables):
        reach = a if j <= b else a - 1
        if reach >= 0:
            hit |= (_ONES[values ^ code[j]] <= reach)[bucket]
    return np.flatnonzero(hit)


def nearest(rows: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = SAMPLE) -> DataFrame:
    """The k nearest rows found for each query by Euclidean distance in double precision: ``query_id``, ``rank``,
    ``vec_id``, ``score``; ties go to the smaller id, a query is not its own neighbour.

    ``is_query`` is a condition on column ``id``. Each block of candidates is indexed by 16-bit substrings of its codes; probing
    retrieves every code within the fitted Hamming radius, and the floats of those are compared. While a block gives fewer
    than k, its radius grows, so that every query has min(k, other rows) results. Which rows take part: see
    ``vectors.usable`` (zero vectors do not). An empty table gives no rows; other columns are ignored.
    """
    one = vectors.usable(rows, id_col, vector_col, drop_zero=True)
    drawn = one.orderBy(F.xxhash64("id"), "id").limit(sample).toPandas()
    codes = fit(vectors.matrix(drawn["v"]), k)

    def search(asked_ids, asked, ids, held):
        asked_codes, code = codes(asked), codes(held)
        tables = [np.unique(code[:, j], return_inverse=True) for j in range(code.shape[1])]
        most = code.shape[1] * SUBSTRING_BITS
        out = []
        for q_id, q, q_code in zip(asked_ids, asked, asked_codes, strict=True):
            own, radius = ids == q_id, codes.radius
            while True:
                rows_ = _probe(q_code, tables, len(ids), radius)
                rows_ = rows_[(_ONES[code[rows_] ^ q_code].sum(axis=1, dtype=np.int64) <= radius) & ~own[rows_]]
                if len(rows_) >= k or radius >= most:
                    break
                radius = min(most, radius + code.shape[1])
            with np.errstate(over="ignore"):
                gap = held[rows_] - q
                d = np.sqrt(np.einsum("ij,ij->i", gap, gap))
            best = np.lexsort((ids[rows_], d))[:k]
            out.append((np.full(len(best), q_id), ids[rows_][best], d[best]))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    return vectors.search_blocks(one, is_query, search, k, "double", nearest_first=True)
