"""Joins and table assembly."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

BROADCAST_ROWS = 100_000


class DuplicateKeyError(ValueError):
    """A join declared one-to-one met a repeated key."""


def duplicate_keys(df: DataFrame, on: list[str]) -> DataFrame:
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def join_one_to_one(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join that raises when a key is repeated on either side.

    The check reads the key columns only and counts on the map side before its shuffle.
    """
    for side, df in (("left", left), ("right", right)):
        repeated = duplicate_keys(df, on).take(1)
        if repeated:
            raise DuplicateKeyError(f"{side} side repeats key {repeated[0].asDict()}")
    return left.join(right, on, "inner")


def left_join_to_many(one: DataFrame, many: DataFrame, on: list[str]) -> DataFrame:
    """Left join whose right side may hold a third of its rows under one key.

    Adaptive execution can split a hot right side for an inner join but not for a left join, so the
    matched part is an inner join and the rows without a partner come from an anti join on the keys.
    """
    matched = one.join(many, on, "inner")
    unmatched = one.join(many.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def loan_cashflows(loans: DataFrame, repayments: DataFrame, on: str = "loan_id") -> DataFrame:
    """Every loan with its repayments; loans without one keep a row of nulls.

    A clashing repayment column gets the suffix ``_repayment``.
    """
    clashes = [c for c in repayments.columns if c in loans.columns and c != on]
    renamed = repayments.withColumnsRenamed({c: f"{c}_repayment" for c in clashes})
    return left_join_to_many(loans, renamed, [on])


def repayments_with_loans(loans: DataFrame, repayments: DataFrame, on: str = "loan_id") -> DataFrame:
    """Every repayment with its loan's columns, null where the loan is not in the table."""
    return loans.join(repayments, on, "right")


def collected_vs_disbursed(collected: DataFrame, disbursed: DataFrame, on: list[str]) -> DataFrame:
    """Aggregate on aggregate: the repeated-principal monthly table."""
    return collected.join(disbursed, on, "left")


def curve_with_total(curve: DataFrame, totals: DataFrame, on: list[str]) -> DataFrame:
    return curve.join(totals, on, "inner")


def attach_correlates(variables: DataFrame, pairs: DataFrame, name: str = "variable") -> DataFrame:
    """Each variable with the variables it is highly correlated to, if any."""
    return variables.join(pairs, variables[name] == pairs["var1"], "left")


def keep_scored(df: DataFrame, scored: DataFrame, on: list[str]) -> DataFrame:
    return df.join(scored.select(*on).distinct(), on, "left_semi")


def lost_rows(df: DataFrame, kept: DataFrame, on: list[str]) -> DataFrame:
    return df.join(kept.select(*on).distinct(), on, "left_anti")


def lookback_join(
    requests: DataFrame,
    transactions: DataFrame,
    days: int,
    on: str = "request_id",
    until_request: bool = False,
) -> DataFrame:
    """Each request with its transactions of the last ``days`` days; no upper bound unless asked for."""
    inside = F.col("trx_date") >= F.date_sub(F.col("request_date"), days)
    if until_request:
        inside = inside & (F.col("trx_date") <= F.col("request_date"))
    return requests.join(transactions, on, "inner").filter(inside)


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join in which a missing key matches a missing key."""
    l, r = left.alias("l"), right.alias("r")
    condition = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    rest = [c for c in right.columns if c not in keys]
    return l.join(r, condition, how).select("l.*", *[F.col(f"r.{c}") for c in rest])


def latest_thresholds(records: DataFrame, created: str = "created_at", tie: str | None = None) -> DataFrame:
    """The newest threshold record, one row, by a combining aggregate rather than a sort."""
    order = F.struct(created, *([tie] if tie else []))
    newest = records.agg(F.max_by(F.struct(*records.columns), order).alias("r"))
    return newest.filter(F.col("r").isNotNull()).select("r.*")


def daily_versions(records: DataFrame, last_day: Column | None = None, created: str = "created_at", tie: str | None = None) -> DataFrame:
    """The threshold version in force at the end of each day, one row per calendar day.

    Versions are first cut to the last one of each day, so from there on the table is bounded by the
    calendar, whatever the number of records.
    """
    values = [c for c in records.columns if c != created]
    order = F.struct(created, *([tie] if tie else []))
    per_day = records.groupBy(F.to_date(created).alias("day")).agg(
        F.max_by(F.struct(*values), order).alias("version")
    )
    following = F.lead("day").over(Window.orderBy("day"))
    end = F.coalesce(F.date_sub(following, 1), F.greatest(F.col("day"), last_day) if last_day is not None else F.col("day"))
    return per_day.select("day", "version", end.alias("until")).select(
        F.explode(F.sequence("day", "until")).alias("day"), "version.*"
    )


def with_thresholds(
    df: DataFrame, records: DataFrame, as_of: str | None = None, created: str = "created_at", tie: str | None = None
) -> DataFrame:
    """Put thresholds on every row: the newest record, or the version in force on the row's ``as_of`` day.

    The newest record is one row and enters as a scalar subquery. The historical form is an equi-join on
    the calendar day; rows before the first version get nulls. A date gets the last version of its day. A time gets the last version
    created until then: of the versions of that hour, else of the hours before.
    """
    values = [c for c in records.columns if c not in (created, tie)]
    if as_of is None:
        newest = latest_thresholds(records, created, tie).select(F.struct(*values)).scalar()
        return df.withColumn("_newest", newest).select(*df.columns, *[F.col("_newest")[v].alias(v) for v in values])
    if not isinstance(df.schema[as_of].dataType, T.DateType):
        return _with_thresholds_at(df, records, as_of, created, tie, values)
    last_day = df.agg(F.max(as_of)).scalar()
    calendar = daily_versions(records, last_day, created, tie).select(F.col("day").alias(as_of), *values)
    return df.join(calendar, as_of, "left").select(*df.columns, *values)


def _with_thresholds_at(df: DataFrame, records: DataFrame, as_of: str, created: str, tie: str | None, values: list[str]) -> DataFrame:
    """Rows and versions meet in one ordered pass an hour, whatever the number of either; the hours hand on their last version, a row each."""
    version = F.struct(F.col(created).alias("_at"), *([F.col(tie).alias("_tie")] if tie else []), *values)
    versions = records.filter(F.col(created).isNotNull()).select(F.col(created).alias("_time"), version.alias("_version"), F.lit(False).alias("_asks"))
    asking = df.select(F.col(as_of).alias("_time"), F.lit(True).alias("_asks"), F.struct(*df.columns).alias("_row"))
    rows = asking.unionByName(versions, allowMissingColumns=True).withColumn("_hour", F.date_trunc("hour", "_time"))
    own = Window.partitionBy("_hour").orderBy("_time", "_asks", "_version").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = rows.withColumn("_held", F.last("_version", ignorenulls=True).over(own)).filter("_asks").select("_hour", "_row", "_held")
    earlier = Window.orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = rows.groupBy("_hour").agg(F.max("_version").alias("_version"))
    before = hours.select("_hour", F.last("_version", ignorenulls=True).over(earlier).alias("_before"))
    held = F.coalesce("_held", "_before")
    return met.join(before, "_hour", "left").select("_row.*", *[held[v].alias(v) for v in values])


def union_tables(*tables: DataFrame) -> DataFrame:
    """Union by name; a column missing from one table is null there.

    Where the tables disagree on a column's type, numbers widen to double and all else to string.
    """
    kinds: dict[str, set[str]] = {}
    types: dict[str, T.DataType] = {}
    for t in tables:
        for field in t.schema.fields:
            kinds.setdefault(field.name, set()).add(field.dataType.simpleString())
            if field.name in types and types[field.name] != field.dataType:
                both = isinstance(types[field.name], T.NumericType) and isinstance(field.dataType, T.NumericType)
                types[field.name] = T.DoubleType() if both else T.StringType()
            else:
                types.setdefault(field.name, field.dataType)
    mixed = {name for name, seen in kinds.items() if len(seen) > 1}
    aligned = [
        t.withColumns({c: F.col(c).cast(types[c]) for c in t.columns if c in mixed}) if mixed else t for t in tables
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def dedupe(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


class LostRowsError(ValueError):
    """The parts of a split do not add up to the whole."""


def reassemble(parts: list[DataFrame], expected: DataFrame | None = None) -> DataFrame:
    """Put the parts of a split together again; with ``expected``, check that no row was lost."""
    whole = union_tables(*parts)
    if expected is not None:
        found, wanted = whole.count(), expected.count()
        if found != wanted:
            raise LostRowsError(f"{found} rows in the parts, {wanted} expected")
    return whole
