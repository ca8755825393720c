"""Numeric expressions with the missing-value rules the reports rely on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def missing_if_nan(value: Column) -> Column:
    return F.when(F.isnan(value), F.lit(None)).otherwise(value)


def total(*values: Column) -> Column:
    """Sum of columns, missing when any part is missing."""
    return reduce(lambda a, b: a + b, values)


def false_if_null(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Null instead of a division by zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def sum_if(condition: Column, value: Column | float = 1) -> Column:
    """Conditional sum that is 0, not null, over no rows."""
    value = value if isinstance(value, Column) else F.lit(value)
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))


def sum_or_zero(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0.0))


def step(value: Column, edges: list[float], results: list, closed: str = "left") -> Column:
    """A step function: ``results[i]`` where ``i`` of the sorted ``edges`` lie below the value. With
    ``closed`` "left" an edge itself belongs to the step above it, with "right" to the one below. Null stays
    null.

    Written as a balanced tree of conditions, so a row takes log2 comparisons in generated code.
    """
    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(results[low])
        middle = (low + high) // 2
        edge = F.lit(edges[middle])
        below = value < edge if closed == "left" else value <= edge
        return F.when(below, tree(low, middle)).otherwise(tree(middle + 1, high))

    return F.when(value.isNotNull(), tree(0, len(edges)))


def pick(values: list, position: Column) -> Column:
    """The value at a position from 1. An unknown position gives null: ``element_at`` alone takes a null
    position for the last one."""
    return F.when(position.isNotNull(), F.element_at(F.array(*[F.lit(v) for v in values]), position))
