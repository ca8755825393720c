"""Counting, routing and scoring of trees at size: the quick forms against plain ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanloom.operators import trees
from loanloom.sources import views
from tests.test_trees import fitted, frame, matrix, rows


@pytest.mark.parametrize("n,places", [(40, 4), (5000, 4), (5000, 1)])
def test_two_features_counted_at_once_equal_one_by_one(n, places):
    rng = np.random.default_rng(n + places)
    x, place = rng.integers(0, 9, (5, n), dtype=np.uint8), rng.integers(0, places, n).astype(np.uint8)
    weights = [rng.integers(-(1 << 24), 1 << 24, n).astype(float), rng.integers(0, 1 << 22, n).astype(float)]
    got = trees.Cells(x, 9).histogram(np.array([3, 0, 4]), place if places > 1 else None, places, weights, False)
    for k, w in enumerate(weights):
        want = np.zeros((places, 3, 9))
        for j, f in enumerate((3, 0, 4)):
            np.add.at(want[:, j], (place if places > 1 else 0, x[f]), w)
        assert np.array_equal(got[k], want)


@pytest.mark.parametrize("depth", [1, 3, 9])
def test_places_equal_a_walk(depth):
    rng = np.random.default_rng(depth)
    t = trees.Trees.empty(1, depth)
    inner = t.feature.shape[1]
    t.feature[0] = np.where(rng.random(inner) < 0.8, rng.integers(0, 3, inner), -1)
    t.cut[0], t.missing_left[0] = rng.integers(1, 255, inner), rng.random(inner) < 0.5
    t.value[0] = rng.normal(size=t.value.shape[1])
    x = rng.integers(0, 256, (3, 500)).astype(np.uint8)
    x[rng.random(x.shape) < 0.2] = 0

    def walk(row):
        node = 0
        while node < inner and t.feature[0, node] >= 0:
            b = row[t.feature[0, node]]
            node = 2 * node + (1 if (t.missing_left[0, node] if b == 0 else b <= t.cut[0, node]) else 2)
        return node

    nodes = t.nodes(0, depth)[t.places(0, x, depth)]
    assert nodes.tolist() == [walk(r) for r in x.T] and np.array_equal(t.values(0, x), t.value[0, nodes])


def test_settings_that_differ_in_rounds_grow_once(spark):
    df, features = frame(spark, rows())
    both = [trees.Candidate(rounds=2, depth=2), trees.Candidate(rounds=18, depth=2)]  # more rounds than are held before margins are written
    bins, own, base = fitted(spark, df, features, both)
    assert [len(o) for o in own] == [2, 18] and all(a[0] is b[0] and a[1] == b[1] for a, b in zip(*own, strict=False))
    _, (alone,), _ = fitted(spark, df, features, both[1:])
    x = matrix(df, bins)
    assert np.array_equal(trees.Booster.of(bins, base, own[1]).margins(x), trees.Booster.of(bins, base, alone).margins(x))


def test_forest_of_all_columns_in_any_order(spark):
    df, _ = frame(spark, rows(600, 3))
    one, other = (trees.forest_losses(df, [names], "status", "id", trees=3, depth=3)[0] for names in (["x0", "x1", "x2"], ["x2", "x0", "x1"]))
    assert one < 0.45 and other < 0.45


def test_scores_are_no_walk_of_expressions(spark):
    df, features = frame(spark, rows())
    bins, own, base = fitted(spark, df, features, [trees.Candidate(rounds=2, depth=2)])
    scored = trees.Booster.of(bins, base, own[0]).with_probability(df, "p")
    plan = scored.filter("p > 0.5")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "CASE WHEN coalesce" not in plan
    assert scored.filter("p IS NULL").count() == 0 and scored.columns == [*df.columns, "p"]


def test_views_are_compiled(spark, tmp_path):
    spark.range(3).select(*[F.col("id").alias(c) for c in ("o_orderkey", "o_custkey")], F.lit("F").alias("o_orderstatus"), F.lit(1.5).alias("o_totalprice"),
        F.lit("1-URGENT").alias("o_orderpriority"), F.current_timestamp().alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    assert views.view(spark, str(tmp_path), "profiles").count() == 3
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
