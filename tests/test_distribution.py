import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanloom.operators import distribution, evaluation, joins, ordered, selection

RNG = np.random.default_rng(5)
SAMPLES = {
    "smooth": RNG.normal(size=3000),
    "ties": RNG.integers(0, 40, 3000).astype(float),
    "hot": np.where(RNG.random(3000) < 0.34, 7.0, RNG.normal(size=3000)),
    "pair": np.array([1.0, 2.0]),
    "constant": np.full(50, 3.0),
    "negative": -RNG.random(777) * 1000,
}


def frame(spark, values, name="x"):
    return spark.createDataFrame(pd.DataFrame({name: values})).repartition(5)


@pytest.fixture(params=["one range", "many ranges"])
def ranges(request, monkeypatch):
    """Once as small data runs, once cut into ranges as large data runs."""
    if request.param == "many ranges":
        monkeypatch.setattr(ordered, "VALUES_PER_RANGE", 20)
    return request.param


@pytest.mark.parametrize("name", SAMPLES)
def test_percentiles(spark, ranges, name):
    got = distribution.percentile_values(frame(spark, SAMPLES[name]), "x")
    np.testing.assert_allclose(got, np.percentile(SAMPLES[name], range(5, 100, 5)), rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("name", ["smooth", "ties", "hot"])
def test_average_ranks(spark, ranges, name):
    rows = ordered.ranked_values(frame(spark, SAMPLES[name]), "x").toPandas().set_index("x")
    expected = pd.Series(SAMPLES[name]).rank().groupby(SAMPLES[name]).first()
    np.testing.assert_allclose(rows["average_rank"].sort_index(), expected.sort_index())


def test_many_ranges_are_used(spark, monkeypatch):
    monkeypatch.setattr(ordered, "VALUES_PER_RANGE", 20)
    assert len(ordered.spread_of(frame(spark, SAMPLES["smooth"]), "x")["x"].cuts) > 50


def test_missing_values_have_no_rank(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    assert distribution.percentile_values(df, "x", [50]) == [2.0]
    assert distribution.percentile_values(df.filter("x > 5"), "x", [50]) == [None]  # only NaN, which Spark holds to be > 5
    assert distribution.percentile_values(df.filter("x < 0"), "x", [50]) == [None]


@pytest.mark.parametrize("name", SAMPLES)
def test_histogram_like_cut(spark, name):
    got = distribution.histogram(frame(spark, SAMPLES[name]), "x").orderBy("bin").toPandas()
    cut, edges = pd.cut(SAMPLES[name], 10, retbins=True)
    assert got["n"].tolist() == pd.Series(cut).value_counts(sort=False).tolist()
    np.testing.assert_allclose([got["low"][0], *got["high"]], edges)


@pytest.mark.parametrize("name", ["smooth", "ties", "hot", "negative"])
def test_quantile_bins_like_qcut(spark, ranges, name):
    df = distribution.quantile_bins(frame(spark, SAMPLES[name]), "x", 10).toPandas()
    expected = pd.qcut(SAMPLES[name], 10, duplicates="drop", labels=False) + 1
    assert df.sort_values("x")["bin"].tolist() == np.sort(expected).tolist()


def test_quantile_bins_drop_equal_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 1, 1, 1, 2, 3, 4, 5, 6, 7]], "x double")
    counts = distribution.quantile_bins(df, "x", 5).groupBy("bin").count().orderBy("bin").collect()
    assert [r["count"] for r in counts] == [4, 2, 2, 2]


def test_lift_keeps_empty_bins(spark):
    df = spark.createDataFrame([(0.0, 1), (0.1, 0), (10.0, 1)], "x double, y int")
    rows = distribution.lift_table(df, "x", "y", bins=5).orderBy("bin").collect()
    assert [(r.n, r.mean_outcome) for r in rows] == [(2, 0.5), (0, None), (0, None), (0, None), (1, 1.0)]


def test_percentile_bucket_edges(spark):
    df = spark.createDataFrame([(0.04,), (0.05,), (0.07,), (0.99,), (None,)], "s double")
    got = df.select(distribution.bucket_of(F.col("s"), [0.05, 0.10], [5, 10]).alias("bucket")).collect()
    assert [r.bucket for r in got] == [5, 10, 10, 100, None]


def test_bucket_like_digitize(spark):
    values = list(np.percentile(SAMPLES["ties"], range(5, 100, 5)))
    got = distribution.percentile_bucket(frame(spark, SAMPLES["ties"]), "x", values).toPandas()
    keys = [*range(5, 100, 5), 100]
    assert got["percentile"].tolist() == [keys[i] for i in np.digitize(got["x"], values)]


def brute_auc(score, label, weight):
    pos, neg = label == 1, label == 0
    wins = (score[pos][:, None] > score[neg][None]) + 0.5 * (score[pos][:, None] == score[neg][None])
    w = weight[pos][:, None] * weight[neg][None]
    return (wins * w).sum() / w.sum()


@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("name", ["smooth", "ties", "hot"])
def test_auc(spark, ranges, name, weighted):
    score = SAMPLES[name]
    label = (score + RNG.normal(size=score.size) > 0.5).astype(int)
    weight = RNG.integers(1, 4, score.size).astype(float) if weighted else np.ones(score.size)
    df = spark.createDataFrame(pd.DataFrame({"p": score, "y": label, "w": weight})).repartition(4)
    got = evaluation.roc_auc(df, weight="w" if weighted else None).first()["auc"]
    assert got == pytest.approx(brute_auc(score, label, weight), abs=1e-12)


def test_auc_of_one_class_is_missing(spark):
    df = spark.createDataFrame([(0.5, 1), (0.6, 1)], "p double, y int")
    assert evaluation.roc_auc(df).first()["auc"] is None


@pytest.fixture(params=["broadcast", "shuffled"])
def rank_join(request, monkeypatch):
    if request.param == "shuffled":
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)


def test_spearman_like_pandas(spark, ranges, rank_join):
    n = 1500
    a = RNG.normal(size=n)
    pdf = pd.DataFrame({"a": a, "b": a + RNG.normal(size=n), "hot": np.where(RNG.random(n) < 0.4, 1.0, a), "gaps": a**3})
    pdf.loc[RNG.random(n) < 0.2, "gaps"] = np.nan
    got = selection.spearman(spark.createDataFrame(pdf).repartition(6), list(pdf)).toPandas().set_index("variable")
    expected = pdf.corr(method="spearman")
    np.testing.assert_allclose(got.loc[list(pdf), list(pdf)].to_numpy(float), expected.to_numpy(), atol=1e-12)


def test_ranks_keep_every_row(spark, rank_join):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([2.0, 2.0, None, float("nan"), 1.0, 2.0])], "id int, v double")
    rows = selection.with_ranks(df, ["v"]).orderBy("id").collect()
    assert [r["v__rank"] for r in rows] == [3.0, 3.0, None, None, 1.0, 3.0]


def test_welch_matches_formula(spark):
    a, b = RNG.normal(size=400), RNG.normal(0.3, 2, size=300)
    pdf = pd.DataFrame({"v": np.concatenate([a, b, [np.nan]]), "y": [1] * 400 + [0] * 301})
    row = selection.with_p_value(selection.welch_t(spark.createDataFrame(pdf), ["v"], "y")).first()
    se = a.var(ddof=1) / 400 + b.var(ddof=1) / 300
    assert row.t == pytest.approx((a.mean() - b.mean()) / np.sqrt(se))
    assert 0 < row.p_value < 1


def test_top_variables_offset(spark):
    rows = [(f"v{i}", float(i), 0.0 if i > 1 else 0.5) for i in range(6)]
    tests = spark.createDataFrame(rows, "variable string, abs_t double, p_value double")
    assert [r.variable for r in selection.top_variables(tests, 2, 1).collect()] == ["v4", "v3"]
    assert [r.variable for r in selection.combine_top(tests.limit(2), tests).limit(1).collect()] == ["v5"]


def test_draw_subsets_is_seeded(spark):
    names = [f"c{i}" for i in range(25)]

    def drawn(order, seed):
        table = spark.createDataFrame([(n,) for n in order], "name string")
        return [list(r.features) for r in selection.draw_subsets(table, 4, seed=seed).orderBy("subset_id").collect()]

    subsets = drawn(names, 3)
    assert len(subsets) == 4 and subsets == drawn(names[::-1], 3) != drawn(names, 4)
    assert all(len(s) == 5 and len(set(s)) == 5 for s in subsets)
