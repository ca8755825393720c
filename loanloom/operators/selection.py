"""Feature selection: Welch tests, rank correlation, subset search."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loanloom.functions import numbers, student_t
from loanloom.operators import joins, ordered, trees

MAX_P, MIN_CORRELATION = 0.001, 0.9
HOT_SHARE = 256
#: Rows whose ranks for all pairs of columns a task holds at once.
ROWS_AT_ONCE = 1000


def welch_t(df: DataFrame, variables: list[str], label: str) -> DataFrame:
    """Welch's t per variable: class 1 against class 0, missing values left out.

    One aggregate over all variables and both classes; what follows is one row per variable.
    """
    aggregates = []
    for v in variables:
        value = F.col(v).cast("double")
        for k in (0, 1):
            mine = F.when((F.col(label) == k) & ordered.present(value), value)
            aggregates += [
                F.count(mine).alias(f"{v}__n{k}"), F.avg(mine).alias(f"{v}__m{k}"), F.var_samp(mine).alias(f"{v}__v{k}"),
            ]
    fields = [f"{s}{k}" for k in (0, 1) for s in ("n", "m", "v")]
    rows = F.array(
        *[F.struct(F.lit(v).alias("variable"), *[F.col(f"{v}__{f}").cast("double").alias(f) for f in fields]) for v in variables]
    )
    c = F.col
    share = lambda k: numbers.ratio(c(f"v{k}"), c(f"n{k}"))
    stats = df.agg(*aggregates).select(F.inline(rows)).withColumns({"s0": share(0), "s1": share(1)})
    t = numbers.ratio(c("m1") - c("m0"), F.sqrt(c("s0") + c("s1")))
    freedom = numbers.ratio(
        F.pow(c("s0") + c("s1"), 2), F.pow(c("s0"), 2) / (c("n0") - 1) + F.pow(c("s1"), 2) / (c("n1") - 1)
    )
    return stats.select("variable", t.alias("t"), freedom.alias("freedom")).withColumn("abs_t", F.abs("t"))


def with_p_value(tests: DataFrame) -> DataFrame:
    return tests.withColumn("p_value", student_t.p_value("t", "freedom"))


def top_variables(tests: DataFrame, n: int = 10, offset: int = 0, max_p: float = MAX_P) -> DataFrame:
    """The significant variables by falling |t|, ``n`` of them after ``offset``."""
    found = tests.filter(F.col("p_value") < max_p).orderBy(F.desc("abs_t"), "variable")
    return (found.offset(offset) if offset else found).limit(n)


def combine_top(*tops: DataFrame) -> DataFrame:
    return joins.union_tables(*tops).orderBy(F.desc("abs_t"), "variable")


def with_ranks(
    df: DataFrame, columns: list[str], source: DataFrame | None = None, spreads: dict[str, ordered.Spread] | None = None, pairwise: bool = False
) -> DataFrame:
    """Add ``<column>__rank``, the average rank over the whole table; missing values get none. With ``pairwise`` it is an array: for each
    of ``columns`` the rank among the rows that have both.

    Ranks are computed on distinct values (of ``source``, when ``df`` was already cut to distinct rows) and
    brought back by an equi-join on the value. A table of few distinct values is broadcast after its size
    was estimated. Otherwise the values that hold more than 1/256 of the rows, at most 256 of them, are
    broadcast; rows with such a value need no partner in the shuffled join and are spread over the tasks
    by a hash of the row, which a repeated task computes alike.
    """
    source = df if source is None else source
    spreads = spreads or ordered.spread_of(source, *columns)
    spread_hash = F.pmod(F.xxhash64(*df.columns), F.lit(4096)) + 1
    result = df
    for c in columns:
        key, rank = f"{c}__value", f"{c}__rank"
        value = F.col(c).cast("double")
        keyed = result.withColumn(key, F.when(ordered.present(value), value))
        ranked = ordered.ranked_among(source, c, columns, spreads[c]) if pairwise else ordered.ranked_values(source, c, spreads[c])
        table = ranked.select(F.col(c).alias(key), F.col("average_rank").alias(rank), "n")
        if spreads[c].distinct * (len(columns) if pairwise else 1) <= joins.BROADCAST_ROWS // 2:
            result = keyed.join(F.broadcast(table.drop("n")), key, "left").drop(key)
            continue
        hot = table.filter(F.col("n") * HOT_SHARE > spreads[c].rows).select(key, F.col(rank).alias("_hot"))
        marked = keyed.join(F.broadcast(hot), key, "left")
        settled = F.col("_hot").isNotNull() | F.col(key).isNull()
        salted = marked.withColumn("_salt", F.when(settled, spread_hash).otherwise(0).cast("bigint"))
        cold = table.select(key, F.lit(0).cast("bigint").alias("_salt"), rank)
        joined = salted.join(cold, [key, "_salt"], "left")
        result = joined.withColumn(rank, F.coalesce("_hot", rank)).drop("_hot", "_salt", key)
    return result


def _rank_correlations(df: DataFrame, columns: list[str], spreads: dict[str, ordered.Spread]) -> DataFrame:
    """Cells (a, b, value) for all pairs of complete columns.

    Equal rows are counted first, so a combination that fills a third of the table is one row. Ranks are
    centred at their known mean (rows + 1) / 2.
    """
    distinct_rows = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_w"))
    ranked = with_ranks(distinct_rows, columns, source=df, spreads=spreads)
    rows = spreads[columns[0]].rows
    centred = {c: F.col(f"{c}__rank") - (rows + 1) / 2 for c in columns}
    moment = lambda a, b: F.sum(F.col("_w") * centred[a] * centred[b])
    pairs = list(combinations(columns, 2))
    sums = ranked.agg(
        *[moment(c, c).alias(f"v_{c}") for c in columns], *[moment(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)]
    )
    cells = [
        F.struct(
            F.lit(a).alias("a"),
            F.lit(b).alias("b"),
            numbers.ratio(F.col(f"p{i}"), F.sqrt(F.col(f"v_{a}") * F.col(f"v_{b}"))).alias("value"),
        )
        for i, (a, b) in enumerate(pairs)
    ]
    return sums.select(F.inline(F.array(*cells)))


def _present_pairs(df: DataFrame, columns: list[str]) -> np.ndarray:
    """How many rows have both columns, for every two of them."""
    p = len(columns)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((p, p), dtype=np.int64)
        for batch in batches:
            have = np.stack([~batch.column(i).is_null().to_numpy(zero_copy_only=False) for i in range(p)], axis=1).astype(np.float64)
            total += (have.T @ have).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(p * p)), pa.array(total.ravel())], ["cell", "n"])

    cells = df.select(*columns).mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    found = np.zeros(p * p, dtype=np.int64)
    for r in cells.collect():
        found[r["cell"]] = r["n"]
    return found.reshape(p, p)


def _pairwise_correlations(df: DataFrame, columns: list[str], spreads: dict[str, ordered.Spread]) -> DataFrame:
    """Cells (a, b, value) for all pairs, each on the rows that have both, whatever the gaps: one ranking a column, none a pair.

    A value has as many ranks as there are columns, one among the rows that have the other column too. Each task adds up the products of
    its rows for all pairs and gives one row a pair.
    """
    p = len(columns)
    middle = (_present_pairs(df, columns) + 1) / 2
    distinct_rows = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_w"))
    ranked = with_ranks(distinct_rows, columns, source=df, spreads=spreads, pairwise=True).select("_w", *[f"{c}__rank" for c in columns])

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, own = np.zeros((p, p)), np.zeros((p, p))
        for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
            have = np.stack([~batch.column(i + 1).is_null().to_numpy(zero_copy_only=False) for i in range(p)], axis=1)
            ranks = np.zeros((batch.num_rows, p, p))
            for i in range(p):
                ranks[have[:, i], i] = batch.column(i + 1).drop_null().flatten().to_numpy().reshape(-1, p)
            centred = np.where(have[:, :, None] & have[:, None, :], ranks - middle, 0.0)
            weighed = centred * batch.column(0).to_numpy()[:, None, None]
            both += (weighed * centred.transpose(0, 2, 1)).sum(axis=0)
            own += (weighed * centred).sum(axis=0)
        a, b = np.triu_indices(p, 1)
        arrays = [pa.array(x.astype(np.int32)) for x in (a, b)] + [pa.array(x) for x in (both[a, b], own[a, b], own[b, a])]
        yield pa.RecordBatch.from_arrays(arrays, ["i", "j", "s", "v", "u"])

    sums = ranked.mapInArrow(moments, "i int, j int, s double, v double, u double").groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in "svu"])
    names = F.array(*map(F.lit, columns))
    return sums.select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), numbers.ratio(F.col("s"), F.sqrt(F.col("v") * F.col("u"))).alias("value"))


def spearman(df: DataFrame, columns: list[str]) -> DataFrame:
    """Matrix of rank correlations with variable names in ``variable``.

    Complete columns have one rank a value. Where values are missing, a pair is ranked on its complete rows, as its
    correlation is defined. A constant column has no correlation.
    """
    chosen = df.select(*[F.when(ordered.present(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in columns])
    spreads = ordered.spread_of(chosen, *columns)
    complete = all(spreads[c].complete for c in columns)
    half = (_rank_correlations if complete else _pairwise_correlations)(chosen, columns, spreads)
    mirrored = half.unionByName(half.select(F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    diagonal = half.sparkSession.createDataFrame([(c, c, 1.0) for c in columns], half.schema)
    cells = mirrored.unionByName(diagonal)
    return cells.groupBy(F.col("a").alias("variable")).agg(
        *[F.max(F.when(F.col("b") == c, F.col("value"))).alias(c) for c in columns]
    )


def melt(df: DataFrame, ids: list[str], variable: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot(ids, [c for c in df.columns if c not in ids], variable, value)


def correlated_pairs(matrix: DataFrame, minimum: float = MIN_CORRELATION) -> DataFrame:
    long = melt(matrix.withColumnRenamed("variable", "var1"), ["var1"], "var2")
    return long.filter((F.col("var1") != F.col("var2")) & (F.col("value") >= minimum))


def draw_subsets(names: DataFrame, subsets: int, size: int | None = None, seed: int = 123) -> DataFrame:
    """subset_id and features: seeded subsets of the distinct values of ``name``, √p of them each unless told otherwise.

    A subset is made of the names with the smallest hashes under its number, so it depends neither on the order of the names nor on partitions.
    """
    drawn = names.select("name").filter("name IS NOT NULL").distinct().withColumn("subset_id", F.explode(F.sequence(F.lit(0), F.lit(subsets - 1))))
    hashed = F.struct(F.xxhash64(F.lit(seed), "subset_id", "name").alias("h"), F.col("name"))
    ordered = F.sort_array(F.collect_list(hashed))
    taken = F.lit(size) if size else F.greatest(F.lit(1), F.floor(F.sqrt(F.size(F.col("ordered"))))).cast("int")
    return drawn.groupBy("subset_id").agg(ordered.alias("ordered")).select("subset_id", F.slice("ordered", 1, taken)["name"].alias("features"))


def subset_losses(df: DataFrame, subsets: DataFrame, label: str, key: str, **settings) -> DataFrame:
    """subset_id, features and the cross-validated loss of a forest on each subset. All forests grow together; only names and losses pass the driver."""
    drawn = sorted(subsets.collect(), key=lambda r: r.subset_id)
    losses = trees.forest_losses(df, [list(r.features) for r in drawn], label, key, **settings) if drawn else []
    rows = [(r.subset_id, list(r.features), loss) for r, loss in zip(drawn, losses, strict=True)]
    return df.sparkSession.createDataFrame(rows, "subset_id int, features array<string>, loss double")


def subset_importance(losses: DataFrame) -> DataFrame:
    """How often each feature was drawn and the mean loss of the subsets it was in."""
    return (
        losses.select(F.explode("features").alias("feature"), "loss")
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("draws"), F.avg("loss").alias("average_loss"))
    )
