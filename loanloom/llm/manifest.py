"""A Merkle manifest of a table: leaf and root digests, and for every row a proof that leads from its leaf to the root.

A node is the hex sha256 of up to ``arity`` consecutive digests of the level below, joined as text. Aligned blocks of arity**height nodes hold
each level as one string of fixed-width digests: parents hash substrings of it, and what flanks a node's digest within its run of siblings are
the two halves of its step in the proof. The tops of the blocks are the nodes of the next round, until every group has one node left.

Cases: nulls in any column are written as ``-``; rows that agree in group and order go by leaf, equal rows each get a place; a table without
rows gives none, and its tree has no root. Columns that are not named are not read and cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanloom.llm.common import materialized

#: Hex digits of a digest.
WIDTH = 64
STEPS = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length in UTF-8 bytes, so that no two rows are written alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def fold(leaf: Column, steps: Column) -> Column:
    """The digest at the end of ``steps`` from ``leaf``."""
    return F.aggregate(steps, leaf, lambda node, s: digest(s["before"], node, s["after"]))


def siblings(steps: Column) -> Column:
    """All digests of a proof as one text, from the leaf up and from left to right."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), "")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def numbered(rows: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """``rows``, written with place (0, 1, … within its group) and size (rows of the group).

    Rows are dealt by ranges of group and order, so one group may span many tasks; a table with a row for each task and group says where
    each begins. Equal rows are dealt at random by a fixed seed, which moves no place's content.
    """
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    dealt = rows.withColumn("_spread", F.rand(7)).repartitionByRange(*keys, "_spread").sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id()
    dealt = materialized(dealt.withColumn("_at", at).withColumn("_task", F.shiftright("_at", 33)).drop("_spread"), label)
    spans = dealt.groupBy("_task", *group).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy(*group)
    before = F.coalesce(F.sum("_rows").over(whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select(
        F.col("_task").alias("_t"), *(F.col(c).alias(f"_g_{c}") for c in group), (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(whole).alias("size")
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group], F.col("_task") == F.col("_t"))
    return dealt.join(spans, same).withColumn("place", F.col("_at") + F.col("_shift")).select(*rows.columns, "place", "size")


@dataclass(frozen=True)
class Round:
    """One round of blocks: ``blocks`` has group, block, nodes, levels; ``tops`` has group, place, size, node."""

    blocks: DataFrame
    tops: DataFrame


def _run(level: Column, first: Column, count) -> Column:
    return F.substring(level, first * WIDTH + 1, count * WIDTH)


def _levels(nodes: Column, size: Column, arity: int, height: int) -> Column:
    """Each level of a block as one binary of digests: ``height`` levels above the nodes, or as many as leave one node of a small group."""

    def above(level: Column) -> Column:
        runs = F.sequence(F.lit(0), F.ceil(F.octet_length(level) / (WIDTH * arity)).cast("int") - 1)
        return F.array_join(F.transform(runs, lambda i: F.sha2(_run(level, i * arity, arity), 256)), "").cast("binary")

    def grow(levels: Column, _: Column) -> Column:
        last = F.element_at(levels, -1)
        single = (F.octet_length(last) == WIDTH) & (size <= arity**height)
        return F.when(single, levels).otherwise(F.concat(levels, F.array(above(last))))

    return F.aggregate(F.sequence(F.lit(1), F.lit(height)), F.array(nodes.cast("binary")), grow)


def _steps(levels: Column, place: Column, arity: int) -> Column:
    """What stands before and after a node in its run of siblings, on each level but the last; ``place`` is its number in the block."""

    def step(i: Column) -> Column:
        level, node = levels[i - 1], F.floor(place / F.pow(F.lit(float(arity)), i - 1)).cast("int")
        first = node - node % arity
        before, after = _run(level, first, node % arity), _run(level, node + 1, arity - 1 - node % arity)
        return F.struct(before.cast("string").alias("before"), after.cast("string").alias("after"))

    return F.when(F.size(levels) > 1, F.transform(F.sequence(F.lit(1), F.size(levels) - 1), step)).otherwise(F.array().cast(STEPS))


def one_round(nodes: DataFrame, group: list[str], carried: list[str], arity: int, height: int) -> Round:
    """Blocks of ``nodes`` (group, place, size, node and the ``carried`` columns)."""
    width = arity**height
    block = nodes.withColumn("block", F.expr(f"place div {width}")).withColumn("at", F.expr(f"cast(place % {width} as int)"))
    rows = block.groupBy(*group, "block").agg(
        F.max("size").alias("size"), F.array_sort(F.collect_list(F.struct("at", "node", *carried))).alias("members")
    )
    rows = rows.withColumn("levels", _levels(F.array_join(F.col("members.node"), ""), F.col("size"), arity, height))
    written = materialized(rows, "blocks")
    tops = written.select(
        *group, F.col("block").alias("place"), F.expr(f"cast(ceil(size / {width}D) as bigint)").alias("size"),
        F.element_at("levels", -1).cast("string").alias("node"),
    )
    return Round(written, tops)


def tree(nodes: DataFrame, group: list[str], carried: list[str], arity: int = 2, height: int = 8) -> tuple[DataFrame, DataFrame]:
    """Every node with the steps to the top of its group, and the tops: (group, node, carried, steps) and (group, node)."""
    rounds = [one_round(nodes, group, carried, arity, height)]
    while rounds[-1].blocks.filter("block > 0").limit(1).count():
        rounds.append(one_round(rounds[-1].tops, group, [], arity, height))
    paths = None
    for r in reversed(rounds):
        held = r.blocks
        if paths is None:
            held = held.withColumn("_above", F.array().cast(STEPS))
        else:
            above = paths.select(*(F.col(c).alias(f"_g_{c}") for c in group), F.col("at").alias("_b"), F.col("steps").alias("_above"))
            same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group], F.col("block") == F.col("_b"))
            held = held.join(above, same)
        here = _let(F.col("levels"), lambda levels: F.transform(F.col("members"), lambda m: F.struct(m.alias("m"), _steps(levels, m["at"], arity).alias("steps"))))
        rows = held.select(*group, "block", "_above", F.explode(here).alias("n"))
        place = F.col("block") * arity**height + F.col("n.m.at")
        held_by = ["node", *(carried if r is rounds[0] else [])]
        paths = rows.select(*group, place.alias("at"), *(F.col(f"n.m.{c}").alias(c) for c in held_by), F.concat("n.steps", "_above").alias("steps"))
    return paths.drop("at"), rounds[-1].tops.select(*group, "node")


def manifest(
    rows: DataFrame, columns: list[str], key: str, group: str, changed: Column, altered: dict[str, Column], arity: int = 2, height: int = 8
) -> DataFrame:
    """One row for each row of ``rows``: its key, leaf, the top of its group (subroot), root, proof_sha256, and folded_root: the root that its
    steps lead to from the leaf as it would be with the ``altered`` columns where ``changed`` holds; verified says whether that is the root.

    Leaves ascend by ``key`` within ``group``, groups go by their value (null first) into one more tree.
    """
    def leaf(of: dict[str, Column]) -> Column:
        return digest(*(field(of.get(c, F.col(c))) for c in columns))

    claim = F.when(F.coalesce(changed, F.lit(False)), leaf(altered))
    leaves = rows.select(F.col(group).alias("g"), F.col(key).alias("k"), leaf({}).alias("node"), claim.alias("claim"))
    placed = numbered(materialized(leaves, "leaves"), ["g"], ["k", "node"], "places")
    nodes, tops = tree(placed, ["g"], ["k", "claim"], arity, height)

    grouped = numbered(tops.select(F.lit(0).alias("one"), F.col("g").alias("of"), "node"), ["one"], ["of"], "groups")
    ways, top = tree(grouped, ["one"], ["of"], arity, height)
    ways = ways.select(F.col("of").alias("_of"), F.col("node").alias("subroot"), F.col("steps").alias("_rest"), "one").join(
        top.select("one", F.col("node").alias("root")), "one"
    )
    full = nodes.join(ways, F.col("g").eqNullSafe(F.col("_of"))).withColumn("steps", F.concat("steps", "_rest"))
    folded = fold(F.coalesce("claim", "node"), F.col("steps"))
    return full.select(
        F.col("k").alias(key), F.col("node").alias("leaf"), "subroot", "root", F.sha2(siblings(F.col("steps")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
