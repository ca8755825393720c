import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from loanloom.llm import multi_index, queries, threshold_topk
from loanloom.llm.multi_index import _ONES, _probe

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, rank string, score string, id string, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, "x", "y", "z", "w") for i, e in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd():
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=5)]) for i in range(60)]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (101, rows[3][1])]  # ties, a repeated row
    rows += [(200, None), (201, []), (202, [float("nan")] * 5), (203, [0.0] * 5), (204, [None, 1.0, 1.0, 1.0, 1.0]), (205, [float("inf")] * 5), (None, rows[0][1]), (206, [1.0, 2.0])]
    return rows


def plain(rows, asked, score, k, zero_ok):
    good = {}
    for i, e in rows:
        if i is None or e is None or len(e) != 5 or any(x is None or not np.isfinite(x) for x in e) or (not zero_ok and not any(e)):
            continue
        good[i] = np.array(e, dtype=np.float32).astype(float)
    out = set()
    for q in good:
        if asked(q):
            best = sorted((score(good[q], good[c]), c) for c in good if c != q)[:k]
            out |= {(q, r + 1, c) for r, (_, c) in enumerate(best)}
    return out


def test_nearest_small(spark, odd):
    got = multi_index.nearest(frame(spark, odd), F.col("id") % 20 == 0, 10).collect()
    want = plain(odd, lambda q: q % 20 == 0, lambda a, b: float(np.sqrt(((a - b) ** 2).sum())), 10, False)
    found = {(r.query_id, r.rank, r.vec_id) for r in got}
    assert len(found) == len(got) == len(want)
    assert len({(q, c) for q, _, c in found} & {(q, c) for q, _, c in want}) >= 0.9 * len(want)


def test_nearest_gives_all_when_few(spark):
    got = multi_index.nearest(frame(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0])]), F.col("id") == 0, 10).collect()
    assert sorted((r.rank, r.vec_id, r.score) for r in got) == [(1, 2, 0.0), (2, 1, 2.0**0.5)]


def test_topk_small(spark, odd):
    got = threshold_topk.top_products(frame(spark, odd), F.col("id") % 20 == 0, 5).collect()
    score = lambda a, b: -int(np.floor(256 * a) @ np.floor(256 * b))
    want = plain(odd, lambda q: q % 20 == 0, score, 5, True)
    assert {(r.query_id, r.rank, r.vec_id) for r in got} == want and len(got) == len(want)


def test_topk_beyond_doubles(spark):
    rows = [(0, [1e12, 1e12]), (1, [1e12, 3.0]), (2, [1e5, -1e12])]
    got = threshold_topk.top_products(frame(spark, rows), F.col("id") == 0, 5).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == [1, 2]
    assert all(-(2**63) < r.score < 2**63 for r in got)


@pytest.mark.parametrize("search", [multi_index.nearest, threshold_topk.top_products])
def test_empty(spark, search):
    assert search(frame(spark, []), F.col("id") == 0, 3).collect() == []


def test_probing_misses_no_code_in_the_radius():
    rng = np.random.default_rng(1)
    code = rng.integers(0, 2**16, (4000, 4)).astype(np.uint16)
    tables = [np.unique(code[:, j], return_inverse=True) for j in range(4)]
    for radius in (0, 7, 21, 26):
        far = _ONES[code ^ code[5]].sum(axis=1, dtype=np.int64)
        assert set(np.flatnonzero(far <= radius)) <= set(_probe(code[5], tables, len(code), radius))


def test_recall_on_the_table(spark):
    got = queries.QUERIES["op1_multi_index_hashing"](spark, SF).toPandas()
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    v, ids = np.stack(rows.embedding).astype(float), rows.vec_id.to_numpy()
    hit = n = 0
    for q, found in got.groupby("query_id"):
        d = np.sqrt(((v - v[ids == q][0]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        best = ids[np.lexsort((ids, d))[:10]]
        hit, n = hit + len(set(best) & set(found.vec_id)), n + 10
        assert list(found.sort_values("rank")["score"]) == sorted(found.score)
    assert n and hit / n >= 0.9
    assert got.dtypes.astype(str).to_dict() == {"query_id": "int64", "rank": "int32", "vec_id": "int64", "score": "float64"}


def test_other_columns_do_not_clash(spark):
    assert {f.name for f in T._parse_datatype_string(SCHEMA).fields} & {"rank", "score", "id", "v"}
