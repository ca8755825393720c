"""Automatic refusal from bank transactions and account history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loanloom.functions import numbers, text
from loanloom.operators import cleaning, history
from loanloom.sources import documents

# Look-back windows in days and the counts that refuse.
LONG_DAYS, SHORT_DAYS = 90, 30
REFUSE_STOP, REFUSE_NSF_LONG, REFUSE_NSF_SHORT, REFUSE_LAWYER = 4, 8, 6, 1
FLAGS = ["stop_payments_long", "nsf_long", "nsf_short", "lawyer_long"]


def classify_transactions(transactions: DataFrame, name: str = "trx_class") -> DataFrame:
    return transactions.withColumn(name, text.transaction_class(F.col("description")))


def classified_only(transactions: DataFrame) -> DataFrame:
    """The transactions that have a class, with it. The filter searches once; the class is worked out for
    the few rows that are left."""
    return classify_transactions(transactions.filter(text.is_classified(F.col("description"))))


def daily_classes(transactions: DataFrame, key: str = "request_id") -> DataFrame:
    """Classified transactions counted per request and day.

    However many transactions a request has, at most one row per day is left of them for the join.
    """
    return _per_day(classified_only(transactions), key)


def _per_day(classified: DataFrame, key: str) -> DataFrame:
    of = lambda name: F.count_if(F.col("trx_class") == name).alias(name)
    return classified.groupBy(key, "trx_date").agg(of(text.STOP_PAYMENT), of(text.NSF), of(text.LAWYER))


def transaction_flags(
    requests: DataFrame,
    transactions: DataFrame,
    long_days: int = LONG_DAYS,
    short_days: int = SHORT_DAYS,
    until_request: bool = False,
    key: str = "request_id",
) -> DataFrame:
    """Per request: classified transactions in the long and the short window before it, over all accounts.

    The first day of a window counts; transactions after the request count too unless ``until_request``.
    Requests without transactions get zeros. ``requests`` has one row per key. Only transactions from the first day of the
    earliest window on are read, and only those of the requests are counted.
    """
    return _window_counts(requests, transactions, "left", long_days, short_days, until_request, key)


def _window_counts(
    requests: DataFrame, transactions: DataFrame, how: str, long_days: int, short_days: int, until_request: bool, key: str
) -> DataFrame:
    asked = requests.select(key, "request_date")
    first = asked.agg(F.date_sub(F.min("request_date"), max(long_days, short_days))).scalar()
    recent = transactions.filter(F.col("trx_date") >= first)
    own = classified_only(recent).join(asked.select(key), key, "left_semi")
    joined = asked.join(_per_day(own, key), key, how)
    since = lambda days: F.col("trx_date") >= F.date_sub("request_date", days)
    last = F.col("trx_date") <= F.col("request_date") if until_request else F.lit(True)
    total = lambda name, days: numbers.sum_if(since(days) & last, F.col(name)).cast("bigint")
    return joined.groupBy(key).agg(
        total(text.STOP_PAYMENT, long_days).alias("stop_payments_long"),
        total(text.NSF, long_days).alias("nsf_long"),
        total(text.NSF, min(short_days, long_days)).alias("nsf_short"),
        total(text.LAWYER, long_days).alias("lawyer_long"),
    )


CLASSES = [text.STOP_PAYMENT, text.NSF, text.LAWYER]


def account_history(transactions: DataFrame, account: str = "account_id") -> DataFrame:
    """Classified transactions per account as running totals, to be stored, added to (``history.merged``) and asked about."""
    return history.blocks(daily_classes(transactions, account), account, CLASSES)


def account_flags(
    requests: DataFrame,
    counted: DataFrame,
    long_days: int = LONG_DAYS,
    short_days: int = SHORT_DAYS,
    until_request: bool = False,
    account: str = "account_id",
) -> DataFrame:
    """Requests with the counts of ``transaction_flags``, looked up in an ``account_history``. Any number of requests may ask about one account."""
    spans = {
        "stop_payments_long": (text.STOP_PAYMENT, long_days),
        "nsf_long": (text.NSF, long_days),
        "nsf_short": (text.NSF, min(short_days, long_days)),
        "lawyer_long": (text.LAWYER, long_days),
    }
    return history.look_back(requests, counted, account, "request_date", spans, until_request)


def document_flags(
    df: DataFrame,
    document: str = "document",
    long_days: int = LONG_DAYS,
    short_days: int = SHORT_DAYS,
    until_request: bool = False,
) -> DataFrame:
    """The same counts where each row carries its own transactions document: worked out inside the row, so
    nothing is exploded, shuffled or joined. A row without a document gets zeros."""
    empty = F.array().cast(documents.ACCOUNT["Transactions"].dataType)
    accounts = F.col(f"{document}.Accounts")
    transactions = F.flatten(F.transform(accounts, lambda a: F.coalesce(a["Transactions"], empty)))

    def recent(t: Column, days: int) -> Column:
        inside = t["Date"] >= F.date_sub("request_date", days)
        return inside & (t["Date"] <= F.col("request_date")) if until_request else inside

    flagged = F.transform(
        F.filter(transactions, lambda t: recent(t, long_days) & text.is_classified(t["Description"])),
        lambda t: F.struct(t["Date"].alias("Date"), text.transaction_class(t["Description"]).alias("trx_class")),
    )

    def number(name: str, days: int) -> Column:
        found = F.filter("_flagged", lambda t: (t["trx_class"] == name) & recent(t, days))
        return F.when(found.isNotNull(), F.size(found)).otherwise(0).cast("bigint")

    counts = {
        "stop_payments_long": number(text.STOP_PAYMENT, long_days),
        "nsf_long": number(text.NSF, long_days),
        "nsf_short": number(text.NSF, min(short_days, long_days)),
        "lawyer_long": number(text.LAWYER, long_days),
    }
    return df.withColumn("_flagged", flagged).withColumns(counts).drop("_flagged")


def refused_by_flags() -> Column:
    return numbers.false_if_null(
        (F.col("stop_payments_long") >= REFUSE_STOP)
        | (F.col("nsf_long") >= REFUSE_NSF_LONG)
        | (F.col("nsf_short") >= REFUSE_NSF_SHORT)
        | (F.col("lawyer_long") >= REFUSE_LAWYER)
    )


def auto_refuse_computed(requests: DataFrame, transactions: DataFrame, **windows) -> DataFrame:
    return transaction_flags(requests, transactions, **windows).withColumn("auto_refuse_computed", refused_by_flags())


def auto_refuse(
    applications: DataFrame,
    transactions: DataFrame,
    key: str = "request_id",
    long_days: int = LONG_DAYS,
    short_days: int = SHORT_DAYS,
    until_request: bool = False,
) -> DataFrame:
    """Applications with both refusal flags and their union.

    Only applications with a classified transaction go through the count; the others cannot be refused
    by it.
    """
    counted = _window_counts(applications, transactions, "inner", long_days, short_days, until_request, key)
    refused = counted.filter(refused_by_flags()).select(key, F.lit(True).alias("auto_refuse_computed"))
    both = cleaning.with_auto_refuse_basic(applications).join(refused, key, "left")
    flag = numbers.false_if_null(F.col("auto_refuse_computed"))
    return both.withColumns(
        {"auto_refuse_computed": flag, "auto_refuse": F.col("auto_refuse_basic") | flag}
    )


def auto_refuse_documents(applications: DataFrame, document: str = "document", **windows) -> DataFrame:
    """``auto_refuse`` for applications that carry their transactions document: no join and no shuffle."""
    flagged = cleaning.with_auto_refuse_basic(document_flags(applications, document, **windows))
    computed = flagged.withColumn("auto_refuse_computed", refused_by_flags()).drop(*FLAGS)
    return computed.withColumn("auto_refuse", F.col("auto_refuse_basic") | F.col("auto_refuse_computed"))
