"""Decision trees grown level by level over one table of binned features, many trees at once.

Every feature becomes a small bin number, 0 for a missing value. For each level of all trees that grow together there is one job: tasks count
their rows into histograms by tree, node, feature and bin, the histograms of a tree are added up and cut in one place, and only the chosen cuts
reach the driver. Gradients are whole numbers (multiples of 1 / ``SCALE``), so sums do not depend on how the rows are dealt.

A split is the cut of a feature, and the side missing values take, with the largest sum of G² / (H + l2) over its two sides. Forests of means
(G: labels, H: weights) and boosters with second-order steps (G: gradients, H: curvatures) differ in these two only.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

SCALE = 1 << 24
#: Bytes of histograms that one task holds; trees beyond that are counted by further tasks over the same rows.
HISTOGRAM_BYTES = 64 << 20
#: Rows that a task counts at once.
CHUNK = 1 << 17
#: Rows whose values decide where the bins of numbers lie, chosen by hash.
CUT_ROWS = 50_000


# --- bins ------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Bins:
    """For each feature either the upper ends of all bins but the last, or its categories in the order of their bins."""

    features: tuple[str, ...]
    cuts: tuple[tuple, ...]
    categorical: tuple[bool, ...]

    @property
    def count(self) -> int:
        """Bins a feature may have, with the one for missing values."""
        return 2 + max((len(c) for c in self.cuts), default=0)

    def inputs(self) -> list[Column]:
        """The features as doubles: numbers as they are, categories as their bin; null where missing or unknown."""
        out = []
        for name, cuts, categorical in zip(self.features, self.cuts, self.categorical, strict=True):
            if not categorical:
                value = F.col(f"`{name}`").cast("double")
                out.append(F.when(~F.isnan(value), value))
            elif not cuts:
                out.append(F.lit(None).cast("double"))
            else:
                known = F.create_map(*(x for i, c in enumerate(cuts, 1) for x in (F.lit(c), F.lit(float(i)))))
                out.append(F.element_at(known, F.col(f"`{name}`").cast("string")))
        return out

    def encode(self, columns: list[np.ndarray]) -> np.ndarray:
        """Bin numbers of ``inputs``, a row a line."""
        out = np.zeros((len(columns[0]) if columns else 0, len(columns)), dtype=np.uint8)
        for j, (x, cuts, categorical) in enumerate(zip(columns, self.cuts, self.categorical, strict=True)):
            seen = ~np.isnan(x)
            out[seen, j] = x[seen] if categorical else 1 + np.searchsorted(np.asarray(cuts, dtype=float), x[seen], side="left")
        return out


def is_number(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def fit_bins(df: DataFrame, features: list[str], label: str, bins: int = 32) -> Bins:
    """At most ``bins`` bins a feature, besides the one for missing values.

    Numbers are cut at quantiles of ``CUT_ROWS`` rows (of all, if there are fewer). Categories are put in the order of their mean label; of more
    than ``bins`` categories the commonest have a bin each, the others count as missing.
    """
    if not 2 <= bins <= 254:
        raise ValueError("a bin number is one byte: 2 to 254 bins")
    numbers = [c for c in features if is_number(df, c)]
    cuts: dict[str, tuple] = {}
    if numbers:
        rows = df.count()
        picked = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(1 << 40))
        values = [F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(numbers)]
        sample = df.filter(picked < int((1 << 40) * CUT_ROWS / max(rows, 1))) if rows > CUT_ROWS else df
        table = sample.select(*values).toArrow()
        for i, c in enumerate(numbers):
            x = table.column(f"v{i}").to_numpy()
            x = np.sort(x[~np.isnan(x)])
            at = np.unique(np.ceil(np.arange(1, bins) * len(x) / bins).astype(int) - 1).clip(min=0) if len(x) else []
            found = np.unique(x[at])
            cuts[c] = tuple(float(v) for v in found if len(x) and v < x[-1])
    texts = [c for c in features if c not in numbers]
    if texts:
        pairs = F.array(*(F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("string").alias("value")) for c in texts))
        seen = df.select(F.explode(pairs).alias("p"), F.col(label).cast("double").alias("y")).select("p.*", "y").filter("value IS NOT NULL")
        means = seen.groupBy("name", "value").agg(F.count("*").alias("n"), F.avg("y").alias("mean"))
        first = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("n"), "value"))
        kept = means.withColumn("place", first).filter(F.col("place") <= bins).collect()
        for c in texts:
            cuts[c] = tuple(r.value for r in sorted(kept, key=lambda r: (r["mean"] or 0.0, r.value)) if r.name == c)
    return Bins(tuple(features), tuple(cuts[c] for c in features), tuple(c in texts for c in features))


def binned(df: DataFrame, bins: Bins, label: str, weight: Column | None = None, part: Column | None = None, carry: list[str] = ()) -> DataFrame:
    """label, weight (1 unless given), part (a 64-bit hash that folds, samples and bootstrap draws are made from), bins (a byte a feature), and
    the ``carry`` columns."""
    plain = [F.col(label).cast("double").alias("_y"), (F.lit(1.0) if weight is None else weight.cast("double")).alias("_w")]
    rows = df.select(*plain, (F.lit(0).cast("long") if part is None else part).alias("_part"), *carry, *(c.alias(f"_x{i}") for i, c in enumerate(bins.inputs())))
    n_features = len(bins.features)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [batch.column(f"_x{i}").to_numpy(zero_copy_only=False) for i in range(n_features)]
            matrix = np.ascontiguousarray(bins.encode(values))
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * n_features
            packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(matrix)])
            yield pa.RecordBatch.from_arrays([*batch.columns[: 3 + len(carry)], packed], names)

    names = ["label", "weight", "part", *carry, "bins"]
    carried = [T.StructField(c, df.schema[c].dataType) for c in carry]
    head = [T.StructField("label", T.DoubleType()), T.StructField("weight", T.DoubleType()), T.StructField("part", T.LongType())]
    return rows.mapInArrow(encode, T.StructType([*head, *carried, T.StructField("bins", T.BinaryType())]))


@dataclass
class Rows:
    """Some rows of the binned table; ``x`` has a line a feature."""

    x: np.ndarray
    y: np.ndarray
    w: np.ndarray
    part: np.ndarray
    margins: np.ndarray | None

    @staticmethod
    def of(batch: pa.RecordBatch, n_features: int) -> Rows:
        def matrix(name: str, dtype: type, width: int | None) -> np.ndarray:
            column = batch.column(name)
            offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
            data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]] if len(column) else np.empty(0, np.uint8)
            return np.frombuffer(data.tobytes(), dtype=dtype).reshape(len(column), width if width is not None else -1)

        numbers = [pc.fill_null(batch.column(c), 0).to_numpy(zero_copy_only=False) for c in ("label", "weight", "part")]
        held = matrix("margins", np.float64, None) if "margins" in batch.schema.names and batch.num_rows else None
        return Rows(np.ascontiguousarray(matrix("bins", np.uint8, n_features).T), *numbers, held)

    @staticmethod
    def chunks(batches: Iterator[pa.RecordBatch], n_features: int) -> Iterator[Rows]:
        """The rows of a task, some ``CHUNK`` at a time."""
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= CHUNK:
                yield Rows.of(pa.concat_batches(held), n_features)
                held, size = [], 0
        if size:
            yield Rows.of(pa.concat_batches(held), n_features)


# --- trees -----------------------------------------------------------------------------------------


@dataclass
class Trees:
    """Complete trees in arrays: the children of node i are 2 i + 1 and 2 i + 2; a feature below 0 ends a path."""

    depth: int
    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray

    @staticmethod
    def empty(n: int, depth: int) -> Trees:
        inner, all_ = (n, 2**depth - 1), (n, 2 ** (depth + 1) - 1)
        return Trees(depth, np.full(inner, -1, np.int16), np.zeros(inner, np.uint8), np.zeros(inner, bool), np.zeros(all_), np.zeros(all_), np.zeros(inner))

    def shape(self) -> Trees:
        """What ``route`` needs, without values and sums."""
        none = np.empty((0, 0))
        return replace(self, value=none, cover=none, gain=none)

    def take(self, which) -> Trees:
        return Trees(self.depth, *(getattr(self, a)[which] for a in ("feature", "cut", "missing_left", "value", "cover", "gain")))

    def nodes(self, tree: int, levels: int) -> np.ndarray:
        """The node of each of the 2 ** ``levels`` places of a level; below a path that has ended, where it did."""
        nodes = [0]
        for _ in range(levels):
            nodes = [c for k in nodes for c in ((2 * k + 1, 2 * k + 2) if self._asks(tree, k) else (k, k))]
        return np.array(nodes)

    def _asks(self, tree: int, node: int) -> bool:
        return node < self.feature.shape[1] and self.feature[tree, node] >= 0

    def places(self, tree: int, x: np.ndarray, levels: int) -> np.ndarray:
        """The place among the 2 ** ``levels`` of a level that each row has come to; rows whose path has ended keep to the left.

        All rows answer every question of a level, a byte each, and the answers of their own nodes are taken by bit operations: no look-up a row.
        """

        def right(nodes: list[int], sides: list[np.ndarray | None]) -> np.ndarray | None:
            if len(nodes) == 1:
                if not self._asks(tree, nodes[0]):
                    return None
                bins, cut = x[self.feature[tree, nodes[0]]], int(self.cut[tree, nodes[0]])
                # Bin 0 less one is 255, above every cut.
                return bins > cut if self.missing_left[tree, nodes[0]] else bins - np.uint8(1) > cut - 1
            half = len(nodes) // 2
            low = right(nodes[:half], sides[1:])
            if sides[0] is None:
                return low
            high = right(nodes[half:], sides[1:])
            if low is None:
                return None if high is None else sides[0] & high
            return low & ~sides[0] if high is None else low ^ (sides[0] & (low ^ high))

        sides: list[np.ndarray | None] = []
        place = np.zeros(x.shape[1], dtype=np.uint8 if levels <= 8 else np.uint32)
        for level in range(levels):
            side = right(self.nodes(tree, level).tolist(), sides)
            sides.append(side)
            place <<= 1
            if side is not None:
                place |= side
        return place

    def values(self, tree: int, x: np.ndarray) -> np.ndarray:
        """The value of the leaf of each row."""
        return self.value[tree, self.nodes(tree, self.depth)].take(self.places(tree, x, self.depth))


@dataclass(frozen=True)
class Job:
    """Trees that grow together."""

    n_trees: int
    n_features: int
    #: The most features a tree has.
    width: int
    depth: int

    def statistics(self, rows: Rows, which: list[int]) -> Iterator[tuple[int, object, np.ndarray, list[np.ndarray]]]:
        """For each tree of ``which``: number, a name that trees share only if they have the same rows and weights, bins of its rows, and the whole numbers
        to be added up, of which ``sums`` makes G and H as multiples of 1 / SCALE."""
        raise NotImplementedError

    def sums(self, added: list[np.ndarray]) -> list[np.ndarray]:
        return [v.astype(np.int64) for v in added]

    def features_of(self, tree: int) -> np.ndarray:
        """The features a tree may use, as columns of the binned table."""
        raise NotImplementedError

    def depth_of(self, tree: int) -> int:
        return self.depth

    def allowed(self, tree: int, nodes: np.ndarray) -> np.ndarray | None:
        """For each node, which of ``features_of`` it may use; all, if None."""
        return None

    def l2(self, tree: int) -> float:
        return 0.0

    def least(self, tree: int) -> float:
        """The least H of either side of a split."""
        return 1.0

    def leaf(self, tree: int, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Values of nodes with these sums; h is above 0."""
        raise NotImplementedError


@dataclass
class Splits:
    """The best split of each node: feature (-1 where none has a gain), last bin on the left, side of missing values, gain, and the sums of G and H on the
    left and on the right."""

    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    gain: np.ndarray
    left: np.ndarray
    right: np.ndarray


def best_splits(hist: np.ndarray, l2: float, least: float, allowed: np.ndarray | None) -> Splits:
    """``hist`` has node × feature × bin × (G, H). Of several best splits the first is taken, one with missing values on the left before others."""
    nodes, features, n_bins, _ = hist.shape
    total = hist[:, 0].sum(axis=1)[:, None, None]
    below = np.cumsum(hist[:, :, 1:], axis=2)
    left = np.stack([below + hist[:, :, :1], below], axis=1)
    right = total[:, None] - left
    with np.errstate(divide="ignore", invalid="ignore"):
        worth = lambda s: np.where(s[..., 1] + l2 > 0, s[..., 0] ** 2 / (s[..., 1] + l2), 0.0)
        gain = worth(left) + worth(right) - worth(total[:, None])
    gain[(left[..., 1] < least) | (right[..., 1] < least)] = -np.inf
    if allowed is not None:
        gain = np.where(allowed[:, None, :, None], gain, -np.inf)
    best = gain.reshape(nodes, -1).argmax(axis=1)
    side, feature, cut = np.unravel_index(best, gain.shape[1:])
    at = (np.arange(nodes), side, feature, cut)
    feature = np.where(gain[at] > 1e-9, feature, -1)
    return Splits(feature, cut + 1, side == 0, gain[at], left[at], right[at])


class Cells:
    """Where the rows of ``x`` count in histograms. With enough rows two features are counted in one go, by bin of the one and bin of the other, and the
    table is added up along either side: the counting of rows is the work."""

    def __init__(self, x: np.ndarray, n_bins: int) -> None:
        self.x, self.n_bins, self.held = x, n_bins, {}

    def _codes(self, pair: tuple[int, ...], keep: bool) -> np.ndarray:
        if pair in self.held:
            return self.held[pair]
        codes = self.x[pair[0]].astype(np.uint16)
        if len(pair) == 2:
            codes = codes * np.uint16(self.n_bins) + self.x[pair[1]]
        if keep:
            self.held[pair] = codes
        return codes

    def histogram(self, features: np.ndarray, place: np.ndarray | None, places: int, weights: list[np.ndarray], keep: bool) -> np.ndarray:
        """Sums of each of ``weights`` by place, feature and bin; ``keep`` where the same features come again."""
        n = self.n_bins
        out = np.zeros((len(weights), places, len(features), n))
        each = 2 if self.x.shape[1] >= places * n * n else 1
        size = places * n**each
        kind = np.uint16 if size <= 1 << 16 else np.uint32
        first = None if place is None else place.astype(kind) * kind(n**each)
        for at in range(0, len(features), each):
            pair = tuple(features[at : at + each].tolist())
            cell, width = self._codes(pair, keep), n ** len(pair)
            if first is not None:
                cell = cell + (first if len(pair) == each else place.astype(kind) * kind(width))
            for k, w in enumerate(weights):
                table = np.bincount(cell, w, places * width).reshape(places, -1, n)
                out[k, :, at + len(pair) - 1] = table.sum(axis=1)
                if len(pair) == 2:
                    out[k, :, at] = table.sum(axis=2)
        return out


def _count(batches: Iterator[pa.RecordBatch], job: Job, trees: Trees, level: int, low: int, high: int, n_bins: int) -> Iterator[pa.RecordBatch]:
    """Histograms of the nodes of one level over a task's rows."""
    first, places = 2**level - 1, 2**level
    alive = {t: trees.nodes(t, level) >= first for t in range(low, high) if level < job.depth_of(t)}
    which = [t for t, a in alive.items() if a.any()]
    sums = np.zeros((high - low, 2, places, job.width, n_bins), dtype=np.int64)
    every = np.unique(np.concatenate([job.features_of(t) for t in which])) if which and not level else None
    same = all(np.array_equal(job.features_of(t), np.arange(job.n_features)) for t in which)
    for rows in Rows.chunks(batches, job.n_features):
        cells, roots = None, {}
        for tree, name, x, weights in job.statistics(rows, which):
            if cells is None or cells.x is not x:
                cells = Cells(x, n_bins)
            features = job.features_of(tree)
            if level:
                own = x if same else x[features]
                added = cells.histogram(features, trees.places(tree, own, level), places, weights, same)
            else:
                if name not in roots:
                    roots[name] = cells.histogram(every, None, 1, weights, same)
                added = roots[name][:, :, np.searchsorted(every, features)]
            for k, v in enumerate(job.sums(added)):
                sums[tree - low, k, :, : len(features)] += v
    for t in which:
        sums[t - low, :, ~alive[t]] = 0
    yield from _batched(((t, pa.compress(sums[t - low], "zstd", asbytes=True)) for t in which if sums[t - low, 1].any()), "hist")


def _batched(rows: Iterator[tuple[int, bytes]], name: str) -> Iterator[pa.RecordBatch]:
    """Rows of tree and bytes, in batches of some megabytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1])
        if size > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in held], pa.int32()), pa.array([b for _, b in held], pa.binary())], ["tree", name])
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in held], pa.int32()), pa.array([b for _, b in held], pa.binary())], ["tree", name])


def _cut(batches: Iterator[pa.RecordBatch], job: Job, level: int, n_bins: int) -> Iterator[pa.RecordBatch]:
    """Adds the histograms of each tree, which lie together, and cuts its nodes."""
    shape = (2, 2**level, job.width, n_bins)

    def cuts(tree: int, sums: np.ndarray) -> tuple[int, bytes]:
        hist = np.moveaxis(sums.reshape(shape) / SCALE, 0, -1)
        number = np.arange(2**level - 1, 2 ** (level + 1) - 1)
        best = best_splits(hist, job.l2(tree), job.least(tree), job.allowed(tree, number))
        own = hist[:, 0].sum(axis=1)
        if level >= job.depth_of(tree):
            best.feature[:] = -1
        sides = np.stack([own, best.left, best.right], axis=1)
        held = sides[..., 1] > 0
        values = np.where(held, job.leaf(tree, sides[..., 0], np.where(held, sides[..., 1], 1.0)), 0.0)
        out = np.column_stack([number, best.feature, best.cut, best.missing_left, best.gain, values, sides[..., 1]]).astype(np.float64)
        return tree, out[own[:, 1] > 0].tobytes()

    def each() -> Iterator[tuple[int, bytes]]:
        tree, sums = None, None
        for batch in batches:
            for number, hist in zip(batch.column("tree").to_pylist(), batch.column("hist"), strict=True):
                values = np.frombuffer(pa.decompress(hist.as_buffer(), 8 * math.prod(shape), "zstd"), dtype=np.int64)
                if number != tree:
                    if tree is not None:
                        yield cuts(tree, sums)
                    tree, sums = number, values.copy()
                else:
                    sums += values
        if tree is not None:
            yield cuts(tree, sums)

    yield from _batched(each(), "cuts")


def grow(table: DataFrame, job: Job, n_bins: int) -> Trees:
    """All trees of a job, one Spark job a level. What comes back has a size of trees times nodes."""
    trees = Trees.empty(job.n_trees, job.depth)
    for level in range(max((job.depth_of(t) for t in range(job.n_trees)), default=0)):
        per_tree = 2 * 8 * 2**level * job.width * n_bins
        block = max(1, HISTOGRAM_BYTES // per_tree)
        parts = []
        for low in range(0, job.n_trees, block):
            count = functools.partial(_count, job=job, trees=trees.shape(), level=level, low=low, high=min(low + block, job.n_trees), n_bins=n_bins)
            parts.append(table.mapInArrow(count, "tree int, hist binary"))
        hists = functools.reduce(DataFrame.unionByName, parts)
        cut = hists.repartition("tree").sortWithinPartitions("tree").mapInArrow(functools.partial(_cut, job=job, level=level, n_bins=n_bins), "tree int, cuts binary")
        split = False
        for row in cut.collect():
            found = np.frombuffer(row["cuts"], dtype=np.float64).reshape(-1, 11)
            node, t = found[:, 0].astype(int), row["tree"]
            trees.feature[t, node], trees.cut[t, node], trees.missing_left[t, node], trees.gain[t, node] = found[:, 1:5].T
            inside = found[:, 1] >= 0
            own = found[:, 8] > 0
            trees.value[t, node[own]], trees.cover[t, node[own]] = found[own, 5], found[own, 8]
            for k, child in ((6, 1), (7, 2)):
                trees.value[t, 2 * node[inside] + child], trees.cover[t, 2 * node[inside] + child] = found[inside, k], found[inside, k + 3]
            split |= bool(inside.any())
        if not split:
            break
    return trees


# --- scores of many models at once -----------------------------------------------------------------


#: Scores that are told apart: six digits from 0 to 1.
STEPS = 1_000_000


def losses(scored: DataFrame) -> dict[int, float]:
    """Loss, 1 − AUC, of each model of a table of ``_tally``. Half where a class is missing.

    A model's scores meet in one place, as weights of positives and negatives for each of ``STEPS`` scores at most.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, sums, found = None, np.zeros((2, STEPS + 1)), []

        def loss() -> float:
            positive, negative = sums
            pairs = positive.sum() * negative.sum()
            return 1 - (positive * (np.cumsum(negative) - negative / 2)).sum() / pairs if pairs > 0 else 0.5

        for batch in batches:
            for number, packed in zip(batch.column("model").to_pylist(), batch.column("scores").to_pylist(), strict=True):
                if number != model:
                    if model is not None:
                        found.append((model, loss()))
                    model, sums[:] = number, 0.0
                n = int.from_bytes(packed[:4], "little")
                data = pa.decompress(packed[4:], 20 * n, "zstd", asbytes=True)
                sums[:, np.cumsum(np.frombuffer(data, np.int32, n))] += np.frombuffer(data, np.float64, 2 * n, 4 * n).reshape(2, n)
        if model is not None:
            found.append((model, loss()))
        yield pa.RecordBatch.from_arrays([pa.array([m for m, _ in found], pa.int32()), pa.array([v for _, v in found], pa.float64())], ["model", "loss"])

    return {r["model"]: r["loss"] for r in scored.repartition("model").sortWithinPartitions("model").mapInArrow(judge, "model int, loss double").collect()}


def _tally(batches: Iterator[pa.RecordBatch], n_features: int, scores: Callable[[Rows], Iterator[tuple[int, np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
    """Weights of positives and negatives by model and rounded score, some rows' at a time in one packed row; ``scores`` yields model, row numbers, scores."""

    def pack(rows: Rows, chosen: np.ndarray, score: np.ndarray) -> bytes:
        values, place = np.unique(np.rint(score * STEPS).astype(np.int32), return_inverse=True)
        y, w = rows.y[chosen], rows.w[chosen]
        sums = [np.bincount(place, w * (y == k), len(values)) for k in (1, 0)]
        data = np.diff(values, prepend=np.int32(0)).tobytes() + sums[0].tobytes() + sums[1].tobytes()
        return len(values).to_bytes(4, "little") + pa.compress(data, "zstd", asbytes=True)

    every = ((model, pack(rows, chosen, score)) for rows in Rows.chunks(batches, n_features) for model, chosen, score in scores(rows) if len(chosen))
    for batch in _batched(every, "scores"):
        yield pa.RecordBatch.from_arrays(batch.columns, ["model", "scores"])


SCORED = "model int, scores binary"


# --- forests ---------------------------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit hash of 64-bit numbers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: The bit from which a sum of draws holds those of positive rows; a chunk has fewer draws than that.
POSITIVE = 26


@dataclass(frozen=True)
class Forests(Job):
    """``trees`` trees for every subset of features and every fold, each on bootstrap draws of the rows of the other folds.

    The draws of a row are Poisson numbers hashed from its part and the tree, the same for every subset. A node looks at √p of its features.
    """

    subsets: tuple[tuple[int, ...], ...] = ()
    folds: int = 5
    trees: int = 20
    seed: int = 123

    @staticmethod
    def of(subsets: list[list[int]], n_features: int, folds: int, trees: int, depth: int, seed: int) -> Forests:
        width = max(map(len, subsets))
        return Forests(len(subsets) * folds * trees, n_features, width, depth, tuple(map(tuple, subsets)), folds, trees, seed)

    def names(self, tree: int) -> tuple[int, int, int]:
        """Subset, fold and number of a tree."""
        return tree // (self.folds * self.trees), tree // self.trees % self.folds, tree % self.trees

    def fold(self, rows: Rows) -> np.ndarray:
        return _mix(rows.part) % np.uint64(self.folds)

    def draws(self, rows: Rows, number: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            hashed = _mix(rows.part + np.int64((self.seed * 1_000_003 + number + 1) * 0x9E3779B97F4A7C15 % (1 << 63)))
        uniform = (hashed >> np.uint64(11)).astype(np.float64) / (1 << 53)
        chances = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
        return np.searchsorted(chances, uniform, side="right")

    def statistics(self, rows, which):
        """A row's draws and, above them, those of a positive row are one number, so both are added up at once."""
        fold, same = self.fold(rows), {}
        for tree in which:
            same.setdefault(self.names(tree)[1:], []).append(tree)
        drawn = {t: self.draws(rows, t) for t in {t for _, t in same}}
        for (f, t), trees in same.items():
            chosen = np.flatnonzero((fold != f) & (drawn[t] > 0))
            n, x = drawn[t][chosen], np.take(rows.x, chosen, axis=1)
            weights = [(n + (n * (rows.y[chosen] == 1) << POSITIVE)).astype(np.float64)]
            for tree in trees:
                yield tree, (f, t), x, weights

    def sums(self, added):
        both = added[0].astype(np.int64)
        return [(both >> POSITIVE) * SCALE, (both & (1 << POSITIVE) - 1) * SCALE]

    def features_of(self, tree):
        return np.array(self.subsets[self.names(tree)[0]])

    def allowed(self, tree, nodes):
        p = len(self.features_of(tree))
        with np.errstate(over="ignore"):
            hashed = _mix(_mix(np.uint64(self.seed) + _mix(np.array([tree]))) + (nodes[:, None] * 1024 + np.arange(self.width)).astype(np.uint64))
        order = np.argsort(np.argsort(hashed[:, :p], axis=1), axis=1)
        return np.pad(order < math.ceil(math.sqrt(p)), ((0, 0), (0, self.width - p)))

    def leaf(self, tree, g, h):
        return g / h

    def scores(self, rows: Rows, trees: Trees) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For every subset and fold the fold's rows, scored by the trees that did not see them."""
        fold = self.fold(rows)
        held = [np.flatnonzero(fold == f) for f in range(self.folds)]
        own = [np.take(rows.x, chosen, axis=1) for chosen in held]
        for s, subset in enumerate(self.subsets):
            for f, chosen in enumerate(held):
                if len(chosen):
                    x, first = own[f][list(subset)], (s * self.folds + f) * self.trees
                    total = sum(trees.values(t, x) for t in range(first, first + self.trees))
                    yield s * self.folds + f, chosen, total / self.trees


def forest_losses(
    df: DataFrame, subsets: list[list[str]], label: str, key: str, seed: int = 123, trees: int = 20, depth: int = 5, folds: int = 5, bins: int = 32
) -> list[float]:
    """1 − AUC of a forest on each list of columns, the mean over ``folds`` hashed parts, each judged by trees that were grown on the others.

    The table is binned once for all columns, and the forests of all lists and folds grow together.
    """
    names = sorted({c for s in subsets for c in s})
    fitted = fit_bins(df, names, label, bins)
    table = compact(binned(df, fitted, label, part=F.xxhash64(F.lit(seed), F.col(key)))).persist()
    try:
        job = Forests.of([[names.index(c) for c in s] for s in subsets], len(names), folds, trees, depth, seed)
        grown = grow(table, job, fitted.count)
        tally = functools.partial(_tally, n_features=len(names), scores=functools.partial(job.scores, trees=grown))
        by_model = losses(table.mapInArrow(tally, SCORED))
    finally:
        table.unpersist()
    return [sum(by_model.get(s * folds + f, 0.5) for f in range(folds)) / folds for s in range(len(subsets))]


def compact(table: DataFrame) -> DataFrame:
    """As many partitions as tasks that run at once: each task returns a histogram of every tree, whatever its rows."""
    return table.repartition(table.sparkSession.sparkContext.defaultParallelism, "part")


# --- boosting --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Candidate:
    """Settings of one booster; with ``fold`` it sees only the rows of the other folds, with ``share`` the rows whose hash lies below it."""

    rounds: int = 20
    depth: int = 5
    rate: float = 0.1
    l2: float = 1.0
    least: float = 1.0
    fold: int | None = None
    share: float = 1.0


@dataclass(frozen=True)
class Round(Job):
    """One tree more for each candidate that has rounds left; ``held`` are the trees since margins were last written, each with the candidates' places in
    it (-1 for none)."""

    candidates: tuple[Candidate, ...] = ()
    active: tuple[int, ...] = ()
    base: float = 0.0
    folds: int = 5
    held: tuple[tuple[tuple[int, ...], Trees], ...] = ()

    def features_of(self, tree):
        return np.arange(self.n_features)

    def depth_of(self, tree):
        return self.candidates[self.active[tree]].depth

    def l2(self, tree):
        return self.candidates[self.active[tree]].l2

    def least(self, tree):
        return self.candidates[self.active[tree]].least

    def leaf(self, tree, g, h):
        c = self.candidates[self.active[tree]]
        return -c.rate * g / (h + c.l2)

    def margin(self, rows: Rows, candidate: int) -> np.ndarray:
        margin = np.full(len(rows.y), self.base) if rows.margins is None else rows.margins[:, candidate].copy()
        for places, trees in self.held:
            if places[candidate] >= 0:
                margin += trees.values(places[candidate], rows.x)
        return margin

    def chosen(self, rows: Rows, candidate: int) -> np.ndarray:
        return np.flatnonzero(self._seen(rows, candidate))

    def _seen(self, rows: Rows, candidate: int) -> np.ndarray:
        c, keep = self.candidates[candidate], np.ones(len(rows.y), dtype=bool)
        if c.fold is not None:
            keep &= fold_of(rows.part, self.folds) != c.fold
        if c.share < 1:
            keep &= sampled(rows.part, c.share)
        return keep

    def statistics(self, rows, which):
        seen, start, positive = {}, {}, (rows.y == 1).astype(np.float64)
        for tree in which:
            candidate = self.active[tree]
            c = self.candidates[candidate]
            name = c.fold, c.share
            if name not in seen:
                seen[name] = SCALE * np.where(self._seen(rows, candidate), rows.w, 0.0)
            fresh = not self.held and rows.margins is None
            if not fresh or name not in start:
                p, w = 1 / (1 + np.exp(-self.margin(rows, candidate))), seen[name]
                start[name] = [np.round(w * (p - positive)), np.round(w * p * (1 - p))]
            yield tree, name if fresh else tree, rows.x, start[name]

    def scores(self, rows: Rows) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Each candidate's probabilities: of its own fold, or of all rows."""
        for i, c in enumerate(self.candidates):
            chosen = np.arange(len(rows.y)) if c.fold is None else np.flatnonzero(fold_of(rows.part, self.folds) == c.fold)
            yield i, chosen, 1 / (1 + np.exp(-self.margin(rows, i)[chosen]))


def fold_of(part: np.ndarray, folds: int) -> np.ndarray:
    return (_mix(part) % np.uint64(folds)).astype(np.int64)


def sampled(part: np.ndarray, share: float) -> np.ndarray:
    """Rows of a sample; a smaller share's rows are among a larger one's."""
    return (_mix(part ^ np.int64(0x5851F42D4C957F2D)) >> np.uint64(11)).astype(np.float64) / (1 << 53) < share


#: Rounds after which margins are written into the table, so that a pass never walks more trees than these.
SETTLE = 16


def _settled(table: DataFrame, job: Round, n_features: int, written: Callable[[DataFrame], DataFrame]) -> DataFrame:
    plain = [c for c in table.columns if c != "margins"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = Rows.of(batch, n_features)
            margins = np.stack([job.margin(rows, c) for c in range(len(job.candidates))], axis=1)
            packed = pa.array([m.tobytes() for m in margins], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in plain), packed], [*plain, "margins"])

    schema = T.StructType([*(table.schema[c] for c in plain), T.StructField("margins", T.BinaryType())])
    return written(table.mapInArrow(add, schema))


def prior(table: DataFrame) -> float:
    """Log odds of the weighted mean label, kept off certainty."""
    total, positive = table.agg(F.sum("weight"), F.sum(F.when(F.col("label") == 1, F.col("weight")).otherwise(0.0))).first()
    p = min(max((positive or 0.0) / total, 1e-6), 1 - 1e-6) if total else 0.5
    return math.log(p / (1 - p))


def boost(
    table: DataFrame, n_features: int, n_bins: int, candidates: list[Candidate], written: Callable[[DataFrame], DataFrame], folds: int = 5
) -> tuple[list[list[tuple[Trees, int]]], float]:
    """All candidates at once, a job for each round and level: each one's trees, as (trees, number), and the common base margin.

    Candidates that differ in their number of rounds only have their first trees in common, which grow once.
    """
    base = prior(table)
    alike: dict[Candidate, list[int]] = {}
    for i, c in enumerate(candidates):
        alike.setdefault(replace(c, rounds=0), []).append(i)
    growing = [replace(c, rounds=max(candidates[i].rounds for i in own)) for c, own in alike.items()]
    shares = {c.share for c in candidates}
    sample = _sampled(table, min(shares)).persist() if len(shares) == 1 and min(shares) < 1 else None
    rows = table if sample is None else sample
    held, own = [], [[] for _ in growing]
    job = Round(0, n_features, n_features, max(c.depth for c in growing), tuple(growing), (), base, folds)
    rounds = max(c.rounds for c in growing)
    try:
        for number in range(rounds):
            active = tuple(i for i, c in enumerate(growing) if c.rounds > number)
            job = replace(job, n_trees=len(active), active=active, held=tuple(held))
            grown = grow(rows, job, n_bins)
            held.append((_places(active, len(growing)), grown))
            for t, i in enumerate(active):
                own[i].append((grown, t))
            if len(held) == SETTLE and number + 1 < rounds:
                rows = _settled(rows, replace(job, held=tuple(held)), n_features, written)
                held = []
    finally:
        if sample is not None:
            sample.unpersist()
    trees = dict(zip(alike, own, strict=True))
    return [trees[replace(c, rounds=0)][: c.rounds] for c in candidates], base


def _sampled(table: DataFrame, share: float) -> DataFrame:
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(sampled(pc.fill_null(batch.column("part"), 0).to_numpy(zero_copy_only=False), share)))

    return table.mapInArrow(keep, table.schema)


def _places(active: tuple[int, ...], number: int) -> tuple[int, ...]:
    return tuple(active.index(i) if i in active else -1 for i in range(number))


def judging(n_features: int, candidates: list[Candidate], own: list[list[tuple[Trees, int]]], base: float, folds: int = 5) -> Round:
    """The grown candidates with all their trees, to give margins."""
    held = []
    for number in range(max(map(len, own))):
        grown = [trees[number][0] if len(trees) > number else None for trees in own]
        for one in {id(g): g for g in grown if g is not None}.values():
            held.append((tuple(trees[number][1] if g is one else -1 for g, trees in zip(grown, own, strict=True)), one))
    return Round(0, n_features, n_features, 0, tuple(candidates), (), base, folds, tuple(held))


def candidate_losses(table: DataFrame, n_features: int, candidates: list[Candidate], own: list[list[tuple[Trees, int]]], base: float, folds: int = 5) -> list[float]:
    """1 − AUC of each candidate on a binned table: on its own fold, or on all rows."""
    job = judging(n_features, candidates, own, base, folds)
    tally = functools.partial(_tally, n_features=n_features, scores=job.scores)
    by_model = losses(table.mapInArrow(tally, SCORED))
    return [by_model.get(i, 0.5) for i in range(len(candidates))]


# --- a fitted booster ------------------------------------------------------------------------------


def probability_added(df: DataFrame, bins: Bins, margin: Callable[[str], Column], name: str) -> DataFrame:
    held, result = f"_inputs_of_{name}", f"_margin_of_{name}"
    kept = [F.col(f"`{c}`") for c in df.columns]
    given = df.select(*kept, F.array(*bins.inputs()).alias(held)).withColumn(result, margin(held))
    return given.select(*kept, (1 / (1 + F.exp(-F.col(result)))).alias(name))


@dataclass(frozen=True)
class Booster:
    """Bins, trees and base margin; scores are the logistic function of base plus the leaves' values."""

    bins: Bins
    base: float
    trees: Trees = field(repr=False)

    @staticmethod
    def of(bins: Bins, base: float, own: list[tuple[Trees, int]]) -> Booster:
        parts = [trees.take([t]) for trees, t in own]
        joined = {a: np.concatenate([getattr(p, a) for p in parts]) for a in ("feature", "cut", "missing_left", "value", "cover", "gain")}
        return Booster(bins, base, Trees(parts[0].depth, **joined))

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Margins of binned rows, a row a line."""
        out, x = np.full(len(x), self.base), np.ascontiguousarray(x.T)
        for t in range(len(self.trees.feature)):
            out += self.trees.values(t, x)
        return out

    def importance(self) -> dict[str, float]:
        """Share of all gain by feature; 0 for all where nothing was split."""
        inside = self.trees.feature >= 0
        sums = np.bincount(self.trees.feature[inside], self.trees.gain[inside], len(self.bins.features))
        return dict(zip(self.bins.features, (sums / (sums.sum() or 1)).tolist(), strict=True))

    def margin(self, inputs: str) -> Column:
        """The margin of the column ``inputs``, an array of ``Bins.inputs``, by NumPy on Arrow batches.

        The column counts as not deterministic, so the optimizer evaluates it where it stands and makes no second one for a filter.
        """

        def margins(held: pa.Array) -> pa.Array:
            flat = held.flatten().to_numpy(zero_copy_only=False).astype(float)
            return pa.array(self.margins(self.bins.encode(list(np.ascontiguousarray(flat.reshape(len(held), -1).T)))))

        return F.arrow_udf(margins, T.DoubleType()).asNondeterministic()(F.col(inputs))

    def with_probability(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` and the probability of class 1, without a shuffle."""
        return probability_added(df, self.bins, self.margin, name)

    def tables(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        """Bins and nodes as tables; ``from_tables`` makes the same booster again."""
        kinds = "feature string, position int, categorical boolean, cuts array<double>, categories array<string>"
        held = zip(self.bins.features, self.bins.cuts, self.bins.categorical, strict=True)
        rows = [(f, i, c, None if c else list(cuts), list(cuts) if c else None) for i, (f, cuts, c) in enumerate(held)]
        t, nodes = self.trees, []
        for tree, values in enumerate(t.value):
            for node, value in enumerate(values):
                inner = node < t.feature.shape[1]
                split = (int(t.feature[tree, node]), int(t.cut[tree, node]), bool(t.missing_left[tree, node]), float(t.gain[tree, node])) if inner else (-1, 0, False, 0.0)
                nodes.append((self.base, t.depth, tree, node, *split, float(value), float(t.cover[tree, node])))
        schema = "base double, depth int, tree int, node int, feature int, cut int, missing_left boolean, gain double, value double, cover double"
        return spark.createDataFrame(rows, kinds), spark.createDataFrame(nodes, schema)

    @staticmethod
    def from_tables(bins: DataFrame, nodes: DataFrame) -> Booster:
        held = sorted(bins.collect(), key=lambda r: r.position)
        fitted = Bins(tuple(r.feature for r in held), tuple(tuple(r.categories if r.categorical else r.cuts) for r in held), tuple(r.categorical for r in held))
        rows = nodes.collect()
        trees = Trees.empty(1 + max(r.tree for r in rows), rows[0].depth)
        for r in rows:
            trees.value[r.tree, r.node], trees.cover[r.tree, r.node] = r.value, r.cover
            if r.node < trees.feature.shape[1]:
                at = (r.tree, r.node)
                trees.feature[at], trees.cut[at], trees.missing_left[at], trees.gain[at] = r.feature, r.cut, r.missing_left, r.gain
        return Booster(fitted, rows[0].base, trees)
