"""Does a request row have every field, of the right type and from the allowed values?"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from loanloom.sources import views


@dataclass(frozen=True)
class Rule:
    column: str
    kind: str
    allowed: tuple[str, ...] = ()
    required: bool = True

    def error(self) -> Column:
        """Null when the text value is fine."""
        value = F.col(self.column).cast("string")
        problem = F.lit(None).cast("string")
        if self.kind == "enum":
            problem = F.when(~value.isin(*self.allowed), "not allowed")
        elif self.kind == "date":
            problem = F.when(F.try_to_date(value, "yyyy-MM-dd").isNull(), "not a date")
        elif self.kind == "double":
            problem = F.when(value.try_cast("double").isNull(), "not a number")
        elif self.kind == "int":
            whole = value.rlike(r"^\s*-?\d+(\.0*)?\s*$")
            problem = F.when(~whole, "not an integer").when(~F.coalesce(value.try_cast("double").between(-(2**31), 2**31 - 1), F.lit(False)), "out of range")
        found = F.when(value.isNull(), "missing" if self.required else None).otherwise(problem)
        return F.when(found.isNotNull(), F.concat(F.lit(f"{self.column}: "), found))


# These counts must be whole numbers.
WHOLE_NUMBERS = [
    "count_loan_payments_current_month",
    "count_loan_payments_previous_month",
    "count_distinct_micro_lenders",
    "count_days_negative_balance_90_days",
]

REQUEST_RULES = [
    Rule("gender", "enum", ("male", "female")),
    Rule("dob", "date"),
    Rule("request_date", "date"),
    Rule("account_age_days", "double"),
    Rule("count_nsf_90_days", "double"),
    Rule("count_nsf_30_days", "double"),
    Rule("count_stop_payment_90_days", "double"),
    Rule("employer_income_frequency", "string"),
    Rule("balance_min", "double"),
    *[Rule(c, "int" if c in WHOLE_NUMBERS else "double") for c in views.ATTRIBUTES],
]


def with_errors(df: DataFrame, rules: list[Rule] = REQUEST_RULES, only: list[str] | None = None) -> DataFrame:
    """Add ``errors``, the list of what is wrong. A column that the table lacks counts as missing, unless
    ``only`` limits the rules to named columns."""
    found = []
    for rule in rules:
        if only is not None and rule.column not in only:
            continue
        if rule.column in df.columns:
            found.append(rule.error())
        elif rule.required:
            found.append(F.lit(f"{rule.column}: missing"))
    return df.withColumn("errors", F.array_compact(F.array(*found)))


def validate_applications(df: DataFrame, rules: list[Rule] = REQUEST_RULES) -> tuple[DataFrame, DataFrame]:
    """Rows that may be scored, typed; and the others with their errors."""
    checked = with_errors(df, rules)
    typed = {}
    for rule in rules:
        if rule.column in df.columns and rule.kind in ("double", "int", "date"):
            kind = F.try_to_date(F.col(rule.column).cast("string"), "yyyy-MM-dd") if rule.kind == "date" else F.col(
                rule.column
            ).try_cast("double")
            typed[rule.column] = kind.try_cast("int") if rule.kind == "int" else kind
    valid = checked.filter(F.size("errors") == 0).drop("errors").withColumns(typed)
    return valid, checked.filter(F.size("errors") > 0)


ACCOUNT_TEXTS = ["Category", "Type", "Currency", "Id"]
HOLDER_TEXTS = ["Name", "Email", "PhoneNumber"]
TRANSACTION_FIELDS = ["Date", "Description", "Id"]
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s.]+$"


def document_errors(document: str = "document") -> Column:
    """What is wrong with a transactions document, as a list of texts. An absent document is fine.

    The test runs inside the nested value, so a long document stays one row.
    """
    doc = F.col(document)
    accounts = doc["Accounts"]

    def any_missing(value: Column, fields: list[str]) -> Column:
        found = F.lit(False)
        for f in fields:
            found = found | value[f].isNull()
        return found

    def some_account(test) -> Column:
        return F.coalesce(F.exists(accounts, test), F.lit(False))

    def bad_transaction(account: Column) -> Column:
        return F.coalesce(F.exists(account["Transactions"], lambda t: any_missing(t, TRANSACTION_FIELDS)), F.lit(False))

    rules = {
        "HttpStatusCode: missing": doc["HttpStatusCode"].isNull(),
        "Accounts: missing": accounts.isNull(),
        "account: field missing": some_account(lambda a: any_missing(a, [*ACCOUNT_TEXTS, "Transactions", "Balance", "Holder"])),
        "holder: field missing": some_account(lambda a: a["Holder"].isNotNull() & any_missing(a["Holder"], [*HOLDER_TEXTS, "Address"])),
        "holder: not an email": some_account(lambda a: ~F.coalesce(a["Holder"]["Email"].rlike(EMAIL), F.lit(True))),
        "transaction: field missing": some_account(bad_transaction),
    }
    found = F.array(*[F.when(doc.isNotNull() & F.coalesce(broken, F.lit(False)), text) for text, broken in rules.items()])
    return F.array_compact(found)


def validate_documents(df: DataFrame, document: str = "document") -> tuple[DataFrame, DataFrame]:
    """Rows whose document may be used, and the others with their errors."""
    checked = df.withColumn("errors", document_errors(document))
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)
