"""Internal rate of return over an array of cash flows, inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Rates are looked for between exp(-REACH) - 1 and exp(REACH) - 1, on a grid that is densest around 0.
REACH, HALF_GRID, STEPS = 14.0, 400, 60


def discounted_sign(flows: Column, rate: Column) -> Column:
    """Sign of the flows' present value; ``flows`` is an array of struct(week, amount), ordered by week.

    Below a rate of zero the flows are carried forward to the last week instead of back to the first. That
    scales the sum by a positive factor and keeps every power at or below one, so nothing overflows.
    """
    last = F.element_at(flows, -1)["week"]
    exponent = lambda week: F.when(rate < 0, last - week).otherwise(-week).cast("double")
    value = F.aggregate(flows, F.lit(0.0), lambda acc, f: acc + f["amount"] * F.pow(1 + rate, exponent(f["week"])))
    return F.signum(value)


def sign_changes(flows: Column) -> Column:
    """How often the amounts change sign from one to the next, zeros left out."""

    def step(seen: Column, flow: Column) -> Column:
        sign = F.coalesce(F.signum(flow["amount"]), F.lit(0.0))
        changed = (sign * seen["sign"] < 0).cast("int")
        return F.when(sign == 0, seen).otherwise(F.struct(sign.alias("sign"), (seen["n"] + changed).alias("n")))

    return F.aggregate(flows, F.struct(F.lit(0.0).alias("sign"), F.lit(0).alias("n")), step, lambda seen: seen["n"])


def irr(flows: Column) -> Column:
    """Rate at which the flows are worth nothing; of several, the one nearest to 0.

    The sign of the present value is taken on a grid of growth factors from 1e-6 to 1e6, about 0.004 apart near 1; bisection
    then closes in between two neighbours of different sign. Flows that change sign once have one such rate, so for them the
    grid is its two ends. Null where the sign never changes.
    """
    fine = F.transform(F.sequence(F.lit(-HALF_GRID), F.lit(HALF_GRID)), lambda i: F.pow(i / float(HALF_GRID), F.lit(3)) * REACH)
    places = F.when(sign_changes(flows) > 1, fine).otherwise(F.array(F.lit(-REACH), F.lit(REACH)))
    grid = F.transform(places, lambda g: F.struct(g.alias("g"), discounted_sign(flows, F.expm1(g)).alias("s")))
    empty = F.lit(None).cast("double")
    start = F.struct(
        empty.alias("low"), empty.alias("high"), empty.alias("s"), empty.alias("last"), empty.alias("last_s"),
    )

    def step(best: Column, point: Column) -> Column:
        """Keep the pair of neighbours nearest to 0 between which the sign changes."""
        change = point["s"] != best["last_s"]
        nearer = best["low"].isNull() | (F.abs(best["last"] + point["g"]) < F.abs(best["low"] + best["high"]))
        take = F.coalesce(change & nearer, F.lit(False))
        return F.struct(
            F.when(take, best["last"]).otherwise(best["low"]).alias("low"), F.when(take, point["g"]).otherwise(best["high"]).alias("high"),
            F.when(take, best["last_s"]).otherwise(best["s"]).alias("s"), point["g"].alias("last"), point["s"].alias("last_s"),
        )

    def halve(b: Column, _: Column) -> Column:
        middle = (b["low"] + b["high"]) / 2
        same_side = discounted_sign(flows, F.expm1(middle)) == b["s"]
        return F.struct(
            F.when(same_side, middle).otherwise(b["low"]).alias("low"), F.when(same_side, b["high"]).otherwise(middle).alias("high"), b["s"].alias("s"),
        )

    def root(b: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.struct(b["low"].alias("low"), b["high"].alias("high"), b["s"].alias("s")), halve, lambda x: F.expm1((x["low"] + x["high"]) / 2))

    found = F.aggregate(grid, start, step)
    return F.transform(F.array(found), lambda b: F.when(b["low"].isNotNull(), root(b)))[0]


def annualised(weekly_rate: Column) -> Column:
    return F.pow(1 + weekly_rate, F.lit(52)) - 1
