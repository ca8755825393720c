"""Trees, boosters, forests, the search and Shapley values against plain versions."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanloom.operators import models, selection, shapley, trees
from loanloom.sources.feature_spec import DEFAULT_SPEC

N = 400


def rows(n=N, seed=0, features=4):
    """Numbers with gaps that matter, a category, a label."""
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, features)), 2)
    gone = rng.random((n, features)) < 0.2
    g = rng.choice(["a", "b", "c", "d"], n)
    lean = x[:, 0] + 1.5 * gone[:, 1] - (g == "b") + x[:, 2] * gone[:, 1] + rng.normal(scale=0.5, size=n)
    x[gone] = np.nan
    return [(i, *(None if math.isnan(v) and i % 2 else float(v) for v in x[i]), None if i % 17 == 0 else str(g[i]), int(lean[i] > 0.6)) for i in range(n)]


def frame(spark, data, features=4):
    names = [f"x{k}" for k in range(features)]
    schema = "id long, " + ", ".join(f"{c} double" for c in names) + ", g string, status int"
    return spark.createDataFrame(data, schema), [*names, "g"]


def fitted(spark, df, features, candidates, partitions=3, bins=8):
    held = trees.fit_bins(df, features, "status", bins)
    table = trees.binned(df.repartition(partitions), held, "status", part=F.xxhash64("id")).persist()
    own, base = trees.boost(table, len(features), held.count, candidates, lambda d: d.persist())
    return held, own, base


def matrix(df, bins):
    table = df.orderBy("id").select(*(c.alias(f"_{i}") for i, c in enumerate(bins.inputs()))).toArrow()
    return bins.encode([table.column(i).to_numpy() for i in range(len(bins.features))])


def plain_boost(x, y, base, c, n_bins):
    """Greedy trees, one row set and one cut at a time; margins after all rounds."""
    margin = np.full(len(y), base)
    for _ in range(c.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.round(trees.SCALE * (p - y)) / trees.SCALE, np.round(trees.SCALE * p * (1 - p)) / trees.SCALE
        value = lambda s: -c.rate * g[s].sum() / (h[s].sum() + c.l2)
        worth = lambda s: g[s].sum() ** 2 / (h[s].sum() + c.l2)

        def walk(at, depth):
            best = (1e-9, None)
            if depth < c.depth:
                for missing_left, f, cut in itertools.product((True, False), range(x.shape[1]), range(1, n_bins)):
                    b = x[at, f]
                    left = np.where(b == 0, missing_left, b <= cut)
                    a, z = at[left], at[~left]
                    if h[a].sum() >= c.least and h[z].sum() >= c.least:
                        gain = worth(a) + worth(z) - worth(at)
                        if gain > best[0] + 1e-9:
                            best = (gain, (a, z))
            if best[1] is None:
                margin[at] += value(at)
            else:
                for side in best[1]:
                    walk(side, depth + 1)

        walk(np.arange(len(y)), 0)
    return margin


def test_booster_equals_plain_one(spark):
    df, features = frame(spark, rows())
    c = trees.Candidate(rounds=10, depth=3, rate=0.4, least=2.0)  # more rounds than are held before margins are written
    bins, own, base = fitted(spark, df, features, [c, trees.Candidate(rounds=2, depth=1)])
    booster = trees.Booster.of(bins, base, own[0])
    x, y = matrix(df, bins), np.array([r[-1] for r in rows()])
    want = plain_boost(x, y, base, c, bins.count)
    assert booster.margins(x) == pytest.approx(want, abs=1e-9)
    assert len(own[1]) == 2 and (x == 0).any()
    scored = booster.with_probability(df, "p").orderBy("id").collect()
    assert [r.p for r in scored] == pytest.approx(1 / (1 + np.exp(-want)), abs=1e-12)


def test_trees_do_not_depend_on_partitions(spark):
    df, features = frame(spark, rows())
    c = [trees.Candidate(rounds=3, depth=3)]
    one, many = (fitted(spark, df, features, c, n) for n in (1, 11))
    assert one[0] == many[0]
    for (a, i), (b, j) in zip(one[1][0], many[1][0], strict=True):
        assert np.array_equal(a.feature[i], b.feature[j]) and np.array_equal(a.value[i], b.value[j])


def test_missing_values_are_learned_as_well_as_by_medians_and_markers(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import Imputer, SQLTransformer, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    train, _ = frame(spark, rows(3000, 1))
    test, _ = frame(spark, rows(3000, 2))
    names = [f"x{k}" for k in range(4)]
    marks = ", ".join(f"CAST(x{k} IS NULL OR isnan(x{k}) AS DOUBLE) AS m{k}" for k in range(4))
    old = Pipeline(stages=[
        SQLTransformer(statement=f"SELECT *, {marks} FROM __THIS__"), Imputer(strategy="median", inputCols=names, outputCols=[f"f{k}" for k in range(4)]),
        VectorAssembler(inputCols=[*(f"f{k}" for k in range(4)), *(f"m{k}" for k in range(4))], outputCol="features"),
        GBTClassifier(labelCol="status", maxIter=8, maxDepth=3, stepSize=0.3, seed=1),
    ]).fit(train)
    bins, own, base = fitted(spark, train, names, [trees.Candidate(rounds=8, depth=3, rate=0.3)], bins=32)
    scored = old.transform(trees.Booster.of(bins, base, own[0]).with_probability(test, "new")).withColumn("old", vector_to_array("probability")[1])
    assert models.auc_loss(scored, "new", "status") <= models.auc_loss(scored, "old", "status") + 0.002


def test_grouped_losses_equal_the_rank_metric(spark):
    df, features = frame(spark, rows())
    bins, own, base = fitted(spark, df, features, [trees.Candidate(rounds=2, depth=2), trees.Candidate(rounds=4, depth=3)])
    table = trees.binned(df, bins, "status")
    candidates = [trees.Candidate(rounds=2, depth=2), trees.Candidate(rounds=4, depth=3)]
    got = trees.candidate_losses(table, len(features), candidates, own, base)
    for loss, trees_of in zip(got, own, strict=True):
        assert loss == pytest.approx(models.auc_loss(trees.Booster.of(bins, base, trees_of).with_probability(df, "p"), "p", "status"), abs=1e-4)


def test_folds_do_not_see_themselves(spark):
    """Labels that are pure noise can be learned only from the rows themselves: held-out losses stay near a half."""
    rng = np.random.default_rng(5)
    data = [(i, *map(float, rng.normal(size=4)), "a", int(rng.random() < 0.5)) for i in range(600)]
    df, features = frame(spark, data)
    candidates = [trees.Candidate(rounds=6, depth=4, rate=0.5, fold=f) for f in range(5)]
    bins, own, base = fitted(spark, df, features, candidates, bins=32)
    table = trees.binned(df, bins, "status", part=F.xxhash64("id"))
    held = trees.candidate_losses(table, len(features), candidates, own, base)
    seen = trees.candidate_losses(table, len(features), [trees.Candidate(rounds=6, depth=4)] * 5, own, base)
    assert sum(held) / 5 > 0.42 and sum(seen) / 5 < 0.25


def test_forests_tell_useful_columns(spark):
    df, _ = frame(spark, rows(1500, 3))
    lists = [["x0", "x1"], ["x3"], ["x0"], ["x0", "x1", "g"]]
    both, noise, one, more = first = trees.forest_losses(df, lists, "status", "id", trees=5, depth=3)
    assert both < one < 0.45 < noise and more < one
    assert trees.forest_losses(df.repartition(5), lists, "status", "id", trees=5, depth=3) == first


def test_subset_search(spark):
    df, features = frame(spark, rows(1500, 3))
    names = spark.createDataFrame([(c,) for c in features], "name string")
    drawn = selection.draw_subsets(names, 12)
    assert {len(set(r.features)) for r in drawn.collect()} == {2} and drawn.count() == 12
    assert sorted(map(tuple, drawn.collect())) == sorted(map(tuple, selection.draw_subsets(names.repartition(4).union(names), 12).collect()))
    losses = selection.subset_losses(df, drawn, "status", "id", trees=3, depth=3)
    by_name = {r.feature: r for r in selection.subset_importance(losses).collect()}
    assert sum(r.draws for r in by_name.values()) == 24 and by_name["x0"].average_loss < by_name["x3"].average_loss
    assert selection.subset_losses(df, drawn.limit(0), "status", "id").collect() == []


def worth(booster, x, known):
    """Mean margin of the leaves that agree with row ``x`` in the known features, by training weight."""
    t = booster.trees

    def walk(tree, node):
        if node >= t.feature.shape[1] or t.feature[tree, node] < 0:
            return t.value[tree, node]
        f, left, right = t.feature[tree, node], 2 * node + 1, 2 * node + 2
        if f in known:
            goes_left = t.missing_left[tree, node] if x[f] == 0 else x[f] <= t.cut[tree, node]
            return walk(tree, left if goes_left else right)
        return sum(t.cover[tree, c] / t.cover[tree, node] * walk(tree, c) for c in (left, right))

    return booster.base + sum(walk(tree, 0) for tree in range(len(t.feature)))


def test_shapley_values_equal_enumeration(spark):
    df, features = frame(spark, rows(600, 7, 7), 7)
    bins, own, base = fitted(spark, df, features, [trees.Candidate(rounds=5, depth=4, rate=0.4)])
    booster = trees.Booster.of(bins, base, own[0])
    x = matrix(df, bins)[:12]
    got, n = shapley.attributions(shapley.paths(booster), x), len(features)
    for row, values in zip(x, got, strict=True):
        v = {s: worth(booster, row, s) for k in range(n + 1) for s in map(frozenset, itertools.combinations(range(n), k))}
        for j in range(n):
            others = [s for s in v if j not in s]
            want = sum(math.factorial(len(s)) * math.factorial(n - len(s) - 1) / math.factorial(n) * (v[s | {j}] - v[s]) for s in others)
            assert values[j] == pytest.approx(want, abs=1e-9)
    assert got.sum(axis=1) == pytest.approx(booster.margins(x) - shapley.expected_margin(booster), abs=1e-9)
    table = shapley.path_table(spark, booster)
    assert table.filter("share <= 0 OR share > 1 OR low > high").count() == 0 and table.select("feature").distinct().count() > 3


def test_saved_tables_make_the_same_booster(spark):
    df, features = frame(spark, rows())
    bins, own, base = fitted(spark, df, features, [trees.Candidate(rounds=2, depth=2)])
    booster = trees.Booster.of(bins, base, own[0])
    again = trees.Booster.from_tables(*booster.tables(spark))
    x = matrix(df, bins)
    assert again.bins == bins and np.array_equal(again.margins(x), booster.margins(x)) and again.importance() == booster.importance()


def test_samples_nest():
    part = np.random.default_rng(0).integers(-(2**62), 2**62, 20_000)
    small, large = trees.sampled(part, 0.1), trees.sampled(part, 0.4)
    assert 0.08 < small.mean() < 0.12 and 0.37 < large.mean() < 0.43 and not (small & ~large).any()


def test_search_halves_and_ends_on_all_rows(spark):
    df, features = frame(spark, rows(900, 4))
    grid = [{"maxIter": 1 + i % 4, "maxDepth": 1 + i % 2, "stepSize": 0.1 + 0.1 * (i % 3)} for i in range(12)]
    run = lambda: models.train_with_validation(df.filter("id % 3 > 0"), df.filter("id % 3 = 0"), DEFAULT_SPEC, "default", features, grid)
    (model, trials), (_, again) = run(), run()
    assert [sum(t.share == s for t in trials) for s in models.shares(12)] == [12, 4, 2]
    assert [(t.config, t.validation_loss) for t in trials] == [(t.config, t.validation_loss) for t in again]
    best = min((t for t in trials if t.share == 1), key=lambda t: t.validation_loss)
    assert models.best_params(trials) == best.config
    assert models.auc_loss(model.booster.with_probability(df.filter("id % 3 = 0"), "p"), "p", "status") == pytest.approx(best.validation_loss, abs=1e-4)


def test_bins_of_odd_columns(spark):
    data = [(float(i), None, float("nan") if i % 3 else 1.0, "a" if i % 2 else None, f"c{i % 40}", i % 2) for i in range(120)]
    df = spark.createDataFrame(data, "x double, empty double, gaps double, g string, many string, y int")
    names = ["x", "empty", "gaps", "g", "many"]
    bins = trees.fit_bins(df, names, "y", 8)
    assert bins.cuts[1:4] == ((), (), ("a",)) and len(bins.cuts[0]) == 7 and len(bins.cuts[4]) == 8
    table = trees.binned(df, bins, "y").collect()
    coded = np.array([list(r.bins) for r in table])
    assert (coded[:, 1] == 0).all() and set(coded[:, 2]) == {0, 1} and set(coded[:, 3]) == {0, 1} and coded[:, 0].max() == 8
    nothing = df.limit(0)
    own, base = trees.boost(trees.binned(nothing, bins, "y"), 5, bins.count, [trees.Candidate(rounds=1, depth=2)], lambda d: d)
    scored = trees.Booster.of(trees.fit_bins(nothing, names, "y"), base, own[0]).with_probability(df, "p")
    assert {r.p for r in scored.collect()} == {0.5}
