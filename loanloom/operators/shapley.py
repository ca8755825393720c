"""Exact Shapley values of boosted trees, from their paths.

A path leads to one leaf. For each feature it asks about, it has the bins it lets pass and the share of the training weight that passes those splits.
With some of the features known, the leaf counts its value where the known ones pass, times the shares of the others. So a path adds to a feature's
Shapley value what depends on nothing but which of the path's features a row passes: 2^features cases, worked out once per path.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from loanloom.operators.trees import Booster


@dataclass(frozen=True)
class Path:
    """``features``, the bins each lets pass (feature × bin), their shares, the leaf's value, and for each set of passed features (a bit each) what every
    feature receives."""

    tree: int
    leaf: int
    features: np.ndarray
    passes: np.ndarray
    shares: np.ndarray
    value: float
    parts: np.ndarray


def _parts(shares: np.ndarray, value: float) -> np.ndarray:
    """Shapley values of the game in which a set of features is worth ``value`` if all of it passes, times the shares of the features outside."""
    d = len(shares)
    outside = np.array([math.prod(shares[k] for k in range(d) if not s >> k & 1) for s in range(1 << d)])
    weight = [math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d) for k in range(d)]
    out = np.zeros((1 << d, d))
    for passed in range(1 << d):
        worth = [value * outside[s] if s & ~passed == 0 else 0.0 for s in range(1 << d)]
        for j in range(d):
            for s in range(1 << d):
                if not s >> j & 1:
                    out[passed, j] += weight[s.bit_count()] * (worth[s | 1 << j] - worth[s])
    return out


def paths(booster: Booster) -> list[Path]:
    """Every path to a leaf of every tree."""
    t, n_bins, found = booster.trees, booster.bins.count, []

    def walk(tree: int, node: int, conditions: dict[int, tuple[np.ndarray, float]]) -> None:
        if node >= t.feature.shape[1] or t.feature[tree, node] < 0:
            features = np.array(sorted(conditions), dtype=np.int64)
            passes = np.array([conditions[f][0] for f in features]).reshape(len(features), n_bins)
            shares, value = np.array([conditions[f][1] for f in features]), float(t.value[tree, node])
            found.append(Path(tree, node, features, passes, shares, value, _parts(shares, value)))
            return
        f = int(t.feature[tree, node])
        left = np.arange(n_bins) <= t.cut[tree, node]
        left[0] = t.missing_left[tree, node]
        held, share = conditions.get(f, (np.ones(n_bins, dtype=bool), 1.0))
        for child, side in ((2 * node + 1, left), (2 * node + 2, ~left)):
            walk(tree, child, conditions | {f: (held & side, share * t.cover[tree, child] / t.cover[tree, node])})

    for tree in range(len(t.feature)):
        walk(tree, 0, {})
    return found


def expected_margin(booster: Booster) -> float:
    """The mean margin, each leaf in proportion to the training weight that reaches it."""
    return booster.base + sum(p.value * math.prod(p.shares.tolist()) for p in paths(booster))


def attributions(found: list[Path], x: np.ndarray) -> np.ndarray:
    """Shapley values of binned rows, one column a feature."""
    out = np.zeros(x.shape)
    for p in found:
        if len(p.features):
            passed = np.zeros(len(x), dtype=np.int64)
            for k, f in enumerate(p.features):
                passed |= p.passes[k][x[:, f]].astype(np.int64) << k
            out[:, p.features] += p.parts[passed]
    return out


def path_table(spark: SparkSession, booster: Booster) -> DataFrame:
    """tree, leaf, value, feature, lowest and highest bin, whether missing values pass, share: a row for each path and feature."""
    rows = []
    for p in paths(booster):
        for k, f in enumerate(p.features):
            inside = np.flatnonzero(p.passes[k][1:]) + 1
            ends = (int(inside[0]), int(inside[-1])) if len(inside) else (None, None)
            rows.append((p.tree, p.leaf, p.value, booster.bins.features[f], *ends, bool(p.passes[k][0]), float(p.shares[k])))
    return spark.createDataFrame(rows, "tree int, leaf int, value double, feature string, low int, high int, missing boolean, share double")
