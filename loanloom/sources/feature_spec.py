"""The two models' columns: what they need, what they may carry, and their limits."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T

CONFIG_SCHEMA = T.StructType(
    [
        T.StructField("variable", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("threshold_min", T.DoubleType()),
        T.StructField("threshold_max", T.DoubleType()),
    ]
)

# Columns of the default model, with their kind.
DEFAULT_MODEL = {
    "target": ["status"],
    "optional": ["Id", "principal", "total_paid"],
    "extra": ["request_date", "dob"],
    "categorical": ["employer_income_frequency", "gender"],
    "numeric": [
        "average_closing_balance_day_after_employer_income",
        "average_closing_balance_day_of_employer_income",
        "balance_90_days_ago",
        "balance_current",
        "balance_min",
        "count_loan_payments_current_month",
        "count_loan_payments_previous_month",
        "count_nsf_30_days",
        "sum_employer_income_current_month",
        "sum_employer_income_previous_month",
        "sum_employer_income_2_months_ago",
        "count_distinct_micro_lenders",
        "count_days_negative_balance_90_days",
        "sum_non_employer_income_current_month",
        "sum_non_employer_income_previous_month",
        "sum_non_employer_income_2_months_ago",
        "sum_non_employer_income",
        "average_closing_balance_day_of_income",
        "average_monthly_micro_loan_payments_complex",
        "average_monthly_utility_payments_complex",
        "telecom_payments_average",
        "other_loan_payments_average",
        "utility_payments_average",
        "sum_government_income_current_month",
        "sum_government_income_previous_month",
        "sum_government_income_2_months_ago",
        "sum_loan_deposits_90_days",
        "average_closing_balance_day_after_income",
        "average_employer_income_deposit",
        "average_micro_loan_payment",
        "average_monthly_free_cash_flow",
        "average_monthly_nsf_fees_count",
        "average_monthly_recurring_transfers_in_complex",
    ],
}
DEFAULT_MODEL_MINIMA = {"balance_min": -5000.0}

# Columns of the refusal model, with their kind.
REFUSAL_MODEL = {
    "target": ["refused"],
    "optional": ["Id", "refusalReason"],
    "extra": ["request_date", "dob"],
    "categorical": [],
    "numeric": [
        "account_age_days",
        "count_nsf_90_days",
        "count_nsf_30_days",
        "count_stop_payment_90_days",
        "sum_micro_loan_payments_current_month",
        "sum_micro_loan_payments_previous_month",
        "sum_micro_loan_payments_2_months_ago",
        "recurring_deposits_current_month",
        "recurring_deposits_previous_month",
        "recurring_deposits_2_months_ago",
        "count_active_days",
        "sum_total_income_current_month",
        "sum_total_income_previous_month",
        "sum_total_income_2_months_ago",
        "sum_loan_payments_current_month",
        "sum_loan_payments_previous_month",
        "sum_loan_payments_2_months_ago",
        "sum_loan_deposits_30_days",
        "sum_loan_deposits_60_days",
        "sum_loan_deposits_90_days",
        "sum_government_income_current_month",
        "sum_government_income_previous_month",
        "sum_government_income_2_months_ago",
        "sum_employment_insurance_income_current_month",
        "sum_employment_insurance_income_previous_month",
        "sum_employment_insurance_income_2_months_ago",
        "sum_employer_income_current_month",
        "sum_employer_income_previous_month",
        "sum_employer_income_2_months_ago",
        "average_monthly_recurring_transfers_in_complex",
        "average_monthly_recurring_transfers_out_complex",
        "sum_non_employer_income_current_month",
        "sum_non_employer_income_previous_month",
        "sum_non_employer_income_2_months_ago",
    ],
}


@dataclass(frozen=True)
class FeatureSpec:
    target: str
    numeric: list[str]
    categorical: list[str] = field(default_factory=list)
    extra: list[str] = field(default_factory=list)
    optional: list[str] = field(default_factory=list)
    minima: dict[str, float] = field(default_factory=dict)
    maxima: dict[str, float] = field(default_factory=dict)

    @property
    def variables(self) -> list[str]:
        return [self.target, *self.optional, *self.extra, *self.categorical, *self.numeric]

    @property
    def inputs(self) -> list[str]:
        """What a caller must supply to be scored: all but the optional columns and the target."""
        return [*self.extra, *self.categorical, *self.numeric]

    @classmethod
    def from_table(cls, df: DataFrame) -> FeatureSpec:
        """From a config table: one row per model column, so it is small by nature."""
        rows = df.select("variable", "type", "threshold_min", "threshold_max").collect()

        def of(kind: str) -> list[str]:
            return [r.variable for r in rows if r.type == kind]

        targets = of("target")
        if len(targets) != 1:
            raise ValueError(f"a model needs one target, the table has {len(targets)}")
        return cls(
            target=targets[0],
            numeric=of("numeric"),
            categorical=of("categorical"),
            extra=of("extra"),
            optional=of("optional"),
            minima={r.variable: r.threshold_min for r in rows if r.threshold_min is not None},
            maxima={r.variable: r.threshold_max for r in rows if r.threshold_max is not None},
        )

    def to_table(self, spark: SparkSession) -> DataFrame:
        kinds = {self.target: "target"}
        for kind in ("optional", "extra", "categorical", "numeric"):
            kinds.update(dict.fromkeys(getattr(self, kind), kind))
        rows = [(v, k, self.minima.get(v), self.maxima.get(v)) for v, k in kinds.items()]
        return spark.createDataFrame(rows, CONFIG_SCHEMA)


def read_feature_spec(spark: SparkSession, path: str) -> FeatureSpec:
    return FeatureSpec.from_table(spark.read.schema(CONFIG_SCHEMA).option("header", True).csv(path))


def _spec(columns: dict[str, list[str]], minima: dict[str, float]) -> FeatureSpec:
    rest = {k: v for k, v in columns.items() if k != "target"}
    return FeatureSpec(target=columns["target"][0], minima=minima, **rest)


DEFAULT_SPEC = _spec(DEFAULT_MODEL, DEFAULT_MODEL_MINIMA)
REFUSAL_SPEC = _spec(REFUSAL_MODEL, {})
