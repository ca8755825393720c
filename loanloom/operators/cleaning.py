"""Cleaning, labelling and feature columns of loan applications."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from loanloom.functions import dates, numbers, text
from loanloom.sources.feature_spec import FeatureSpec

Step = Callable[[DataFrame], DataFrame]

# Fixed values of the underwriting rules.
PROFIT_CUTOFF = 50
MIN_ACCOUNT_AGE, MAX_NSF_90, MAX_NSF_30, MAX_STOP_PAYMENT_90 = 85, 8, 6, 4


# --- projections -----------------------------------------------------------------------------------


def keep_known(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    known = set(spec.variables)
    return df.select([c for c in df.columns if c in known])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def tag(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def harmonise(df: DataFrame, id_from: str | None = None) -> DataFrame:
    """One id column and lower-case gender, whichever source the row comes from."""
    if id_from:
        df = df.withColumn("Id", F.col(id_from).cast("string"))
    if "gender" in df.columns:
        df = df.withColumn("gender", F.lower("gender"))
    return df


def rolling_sums(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumns(
        {
            "recurring_deposits_90_days": numbers.total(
                c("recurring_deposits_current_month"), c("recurring_deposits_previous_month"), c("recurring_deposits_2_months_ago")
            ),
            "sum_micro_loans_60_days": numbers.total(
                c("sum_micro_loan_payments_current_month"), c("sum_micro_loan_payments_previous_month")
            ),
        }
    )


def with_profit(df: DataFrame, paid: str = "total_paid", principal: str = "principal") -> DataFrame:
    return df.withColumn("profit", F.col(paid) - F.col(principal))


def with_default_label(df: DataFrame, cutoff: float = PROFIT_CUTOFF, name: str = "status") -> DataFrame:
    """1 for a loan that earned less than the cutoff; an unknown profit counts as repaid."""
    return df.withColumn(name, F.when(F.col("profit") < cutoff, 1).otherwise(0))


def with_month_key(df: DataFrame, col: str = "request_date") -> DataFrame:
    key = dates.month_key(F.col(col))
    return df.withColumns(
        {
            "request_month_key": key,
            "request_year": F.substring(key, 1, 4).try_cast("int"),
            "request_month": F.substring(key, 6, 2).try_cast("int"),
        }
    )


def flag_in(df: DataFrame, col: str, values: list, name: str) -> DataFrame:
    return df.withColumn(name, numbers.false_if_null(F.col(col).isin(values)))


def with_recency_weight(df: DataFrame, ramp_year: int = 2022, key: str = "request_month_key") -> DataFrame:
    """Month/12 within the ramp year, 1 otherwise."""
    year, month = F.substring(key, 1, 4).try_cast("int"), F.substring(key, 6, 2).try_cast("int")
    return df.withColumn("weight", F.when(year == ramp_year, month / 12).otherwise(1.0))


def _as_date(df: DataFrame, col: str) -> Column:
    if isinstance(df.schema[col].dataType, T.StringType):
        return dates.parse_date(F.col(col))
    return F.to_date(col)


def with_age(df: DataFrame) -> DataFrame:
    """Age in completed years at the request; null when either date is missing or unreadable."""
    return df.withColumn("age", dates.completed_years(_as_date(df, "dob"), _as_date(df, "request_date")))


MONTHS = ("current_month", "previous_month", "2_months_ago")


def with_non_classified_income(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            f"non_classified_income_{m}": F.col(f"sum_non_employer_income_{m}") - F.col(f"sum_government_income_{m}")
            for m in MONTHS
        }
    )


def with_repayment_capacity(df: DataFrame) -> DataFrame:
    capacity = F.col("sum_employer_income_current_month") - F.col("sum_loan_deposits_90_days") / 3
    return df.withColumn("monthly_repayment_capacity", capacity)


def with_income_minus_microloan(df: DataFrame) -> DataFrame:
    margin = F.col("average_employer_income_deposit") - F.col("average_micro_loan_payment")
    return df.withColumn("avg_employer_income_minus_microloan_payment", margin)


COMMON_STEPS: tuple[Step, ...] = (with_age, with_non_classified_income, with_repayment_capacity)
MODEL_STEPS: dict[str, tuple[Step, ...]] = {
    "refusal": COMMON_STEPS,
    "default": (*COMMON_STEPS, with_income_minus_microloan),
}


def engineered(df: DataFrame, steps: Iterable[Step]) -> DataFrame:
    for step in steps:
        df = df.transform(step)
    return df


def feature_columns(df: DataFrame, spec: FeatureSpec) -> list[str]:
    """The model's features among the columns of an engineered table."""
    dropped = {spec.target, *spec.extra, *spec.optional}
    return [c for c in df.columns if c not in dropped]


def feature_engineer(df: DataFrame, spec: FeatureSpec, steps: Iterable[Step], carry: list[str] | None = None) -> DataFrame:
    """Known columns → engineered columns → feature list, with ``carry`` columns kept beside them.

    ``steps`` is any list of table functions, which is also how a caller adds own features.
    """
    carry = carry or []
    kept = df.select(*dict.fromkeys([*carry, *keep_known(df, spec).columns]))
    table = engineered(kept, steps)
    features = [c for c in feature_columns(table, spec) if c not in carry]
    return table.select(*carry, *features)


def strip_punctuation(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, text.without_punctuation(F.col(col)))


def fill_missing(df: DataFrame, value: float = -1, cols: list[str] | None = None) -> DataFrame:
    """Replace null and NaN. A number fills numeric columns; named string columns get it as text."""
    named = cols or df.columns
    filled = {}
    for f in df.schema.fields:
        if f.name not in named:
            continue
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            filled[f.name] = F.coalesce(numbers.missing_if_nan(F.col(f.name)), F.lit(value).cast(f.dataType))
        elif isinstance(f.dataType, T.NumericType):
            filled[f.name] = F.coalesce(F.col(f.name), F.lit(value).cast(f.dataType))
        elif isinstance(f.dataType, T.StringType):
            filled[f.name] = F.coalesce(F.col(f.name), F.lit(str(value)))
    return df.withColumns(filled)


def is_numeric(kind: T.DataType) -> bool:
    """Flags count as numbers."""
    return isinstance(kind, (T.NumericType, T.BooleanType))


def _non_numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not is_numeric(f.dataType)]


def small_domains(df: DataFrame, cols: list[str], max_distinct: int = 20) -> dict[str, list]:
    """Sorted values of the columns that have fewer than ``max_distinct`` of them.

    Two aggregates: approximate counts first, so that sets are gathered only where they stay small.
    """
    if not cols:
        return {}
    estimate = df.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in cols]).first()
    candidates = [c for c in cols if estimate[c] <= 2 * max_distinct]
    if not candidates:
        return {}
    sets = df.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in candidates]).first()
    return {c: sets[c] for c in candidates if len(sets[c]) < max_distinct}


def encode_categories(df: DataFrame, cols: list[str] | None = None, max_distinct: int = 20) -> DataFrame:
    """Category → position in the sorted list of values, null → −1; wider columns stay as they are."""
    domains = small_domains(df, cols or _non_numeric(df), max_distinct)
    codes = {}
    for c, values in domains.items():
        array = F.array(*[F.lit(v) for v in values]) if values else F.array()
        codes[c] = F.when(F.col(c).isNull(), -1).otherwise((F.array_position(array, F.col(c)) - 1).cast("int"))
    return df.withColumns(codes) if codes else df


def drop_unusable(df: DataFrame, exclude: list[str], max_distinct: int = 20) -> DataFrame:
    """Drop the named columns and every non-numeric column with ``max_distinct`` values or more."""
    df = df.drop(*exclude)
    wide = _non_numeric(df)
    narrow = small_domains(df, wide, max_distinct)
    return df.drop(*[c for c in wide if c not in narrow])


def common_columns(a: DataFrame, b: DataFrame) -> tuple[list[str], list[str], list[str]]:
    """Columns in both tables, only in the first, only in the second."""
    return (
        [c for c in a.columns if c in b.columns],
        [c for c in a.columns if c not in b.columns],
        [c for c in b.columns if c not in a.columns],
    )


def combined_inputs(*specs: FeatureSpec) -> list[str]:
    return sorted({c for spec in specs for c in spec.inputs})


def columns_like(
    df: DataFrame, prefix: str | None = None, exclude: Iterable[str] = (), not_prefixes: tuple[str, ...] = (), numeric: bool = False
) -> list[str]:
    excluded = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if f.name not in excluded
        and (prefix is None or f.name.startswith(prefix))
        and not (not_prefixes and f.name.startswith(not_prefixes))
        and (not numeric or is_numeric(f.dataType))
    ]


def select_like(df: DataFrame, prefix: str | None = None, exclude: Iterable[str] = (), **kinds) -> DataFrame:
    return df.select(columns_like(df, prefix, exclude, **kinds))


def dates_to_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in cols})


def whole_numbers_to_text(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int").cast("string") for c in cols})


# --- filters ---------------------------------------------------------------------------------------


def missing(col: str, df: DataFrame) -> Column:
    if isinstance(df.schema[col].dataType, (T.FloatType, T.DoubleType)):
        return F.col(col).isNull() | F.isnan(col)
    return F.col(col).isNull()


def threshold_rules(df: DataFrame, spec: FeatureSpec) -> list[tuple[str, Column]]:
    """Limits of the model; an unknown value passes."""
    rules = [(f"{c} below minimum", missing(c, df) | (F.col(c) >= low)) for c, low in spec.minima.items()]
    rules += [(f"{c} above maximum", missing(c, df) | (F.col(c) <= high)) for c, high in spec.maxima.items()]
    return rules


def threshold_rules_present(df: DataFrame, spec: FeatureSpec) -> list[tuple[str, Column]]:
    """The same for the limits whose column the table has."""
    have = set(df.columns)
    return threshold_rules(
        df,
        replace(
            spec,
            minima={c: v for c, v in spec.minima.items() if c in have},
            maxima={c: v for c, v in spec.maxima.items() if c in have},
        ),
    )


def quality_rules(df: DataFrame) -> list[tuple[str, Column]]:
    """Rules on whichever of these columns the table has; an unknown account age does not pass."""
    rules = []
    if "error" in df.columns:
        rules.append(("error present", missing("error", df)))
    if "Id" in df.columns:
        rules.append(("Id missing", ~missing("Id", df)))
    if "request_date" in df.columns:
        rules.append(("request_date missing", ~missing("request_date", df)))
    if "account_age_days" in df.columns:
        rules.append(("account_age_days not positive", ~missing("account_age_days", df) & (F.col("account_age_days") > 0)))
    return rules


def prescreen_rules() -> list[tuple[str, Column]]:
    c = F.col
    return [
        ("account too young", (c("account_age_days") >= MIN_ACCOUNT_AGE) & ~F.isnan("account_age_days")),
        ("NSF in 90 days", c("count_nsf_90_days") <= MAX_NSF_90),
        ("NSF in 30 days", c("count_nsf_30_days") <= MAX_NSF_30),
        ("stop payments in 90 days", c("count_stop_payment_90_days") <= MAX_STOP_PAYMENT_90),
    ]


def keep(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    for _, condition in rules:
        df = df.filter(condition)
    return df


def filter_thresholds(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    return keep(df, threshold_rules(df, spec))


def filter_quality(df: DataFrame) -> DataFrame:
    return keep(df, quality_rules(df))


def base_filter(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The filter in front of scoring and training."""
    return filter_quality(filter_thresholds(df, spec))


def filter_audit(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Rows removed per rule, in rule order, from one pass: each row counts at its first failing rule."""
    outcome = F.lit(None).cast("string")
    for name, condition in reversed(rules):
        outcome = F.when(~numbers.false_if_null(condition), name).otherwise(outcome)
    return (
        df.groupBy(F.coalesce(outcome, F.lit("kept")).alias("rule"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def prescreen(df: DataFrame) -> DataFrame:
    """History that the basic rule would not have refused; unknown values drop out."""
    return keep(df, prescreen_rules())


def auto_refuse_basic() -> Column:
    """True when one known value is over its limit. Spark holds NaN to be above every number, hence the test."""
    def over(col: str, limit: float) -> Column:
        return (F.col(col) > limit) & ~F.isnan(col)

    terms = [
        F.col("account_age_days") < MIN_ACCOUNT_AGE,
        over("count_nsf_90_days", MAX_NSF_90),
        over("count_nsf_30_days", MAX_NSF_30),
        over("count_stop_payment_90_days", MAX_STOP_PAYMENT_90),
    ]
    flag = F.lit(False)
    for t in terms:
        flag = flag | numbers.false_if_null(t)
    return flag


def with_auto_refuse_basic(df: DataFrame, name: str = "auto_refuse_basic") -> DataFrame:
    return df.withColumn(name, auto_refuse_basic())


def for_month(df: DataFrame, month: str, col: str = "request_date", key: str = "request_month_key") -> DataFrame:
    """Rows of one ``yyyy-MM``. Both text and dates compare as a range, which reaches the scan; in a table
    stored by month key only that month's folder is read."""
    if key in df.columns:
        df = df.filter(F.col(key) == month)
    year, number = int(month[:4]), int(month[5:7])
    following = f"{year + number // 12:04d}-{number % 12 + 1:02d}"
    if isinstance(df.schema[col].dataType, T.StringType):
        return df.filter((F.col(col) >= month) & (F.col(col) < following))
    low, high = F.lit(f"{month}-01").cast("date"), F.lit(f"{following}-01").cast("date")
    return df.filter((F.col(col) >= low) & (F.col(col) < high))


def drop_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.na.drop(subset=cols)


def lookup(df: DataFrame, col: str, value: object) -> DataFrame:
    return df.filter(F.col(col) == value)


def sample_by_status(df: DataFrame, status: str, key: str, n: int = 1, seed: int = 0) -> DataFrame:
    """``n`` rows per status in a seeded hash order.

    A rank limit lets every map task keep its own best ``n`` per status before the shuffle.
    """
    order = F.xxhash64(F.col(key), F.lit(seed))
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(status).orderBy(order, key)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")
