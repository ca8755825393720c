"""Bank-transaction documents: accounts with their holder and transactions, nested."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def _fields(**kinds: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, kind) for name, kind in kinds.items()]


TEXT_MAP = T.MapType(T.StringType(), T.StringType())
TRANSACTION = T.StructType(
    _fields(
        Date=T.DateType(), Code=T.StringType(), Description=T.StringType(), Debit=T.DoubleType(),
        Credit=T.DoubleType(), Balance=T.DoubleType(), Id=T.StringType(),
    )
)
HOLDER = T.StructType(
    _fields(Name=T.StringType(), Address=TEXT_MAP, Email=T.StringType(), PhoneNumber=T.StringType())
)
ACCOUNT = T.StructType(
    _fields(
        Transactions=T.ArrayType(TRANSACTION), TransitNumber=T.StringType(), InstitutionNumber=T.StringType(),
        Title=T.StringType(), AccountNumber=T.StringType(), LastFourDigits=T.StringType(), Balance=TEXT_MAP,
        Category=T.StringType(), Type=T.StringType(), Currency=T.StringType(), Holder=HOLDER, Id=T.StringType(),
    )
)
DOCUMENT = T.StructType(_fields(HttpStatusCode=T.IntegerType(), Accounts=T.ArrayType(ACCOUNT)))


def flatten_transactions(df: DataFrame, keys: list[str], document: str = "document", keep_empty: bool = False) -> DataFrame:
    """One row per transaction, over all accounts. ``keep_empty`` keeps a row for a document without any."""
    explode = F.explode_outer if keep_empty else F.explode
    accounts = df.select(*keys, explode(f"{document}.Accounts").alias("account"))
    rows = accounts.select(*keys, F.col("account.Id").alias("account_id"), explode("account.Transactions").alias("trx"))
    return rows.select(
        *keys,
        "account_id",
        F.col("trx.Id").alias("trx_id"),
        F.col("trx.Date").alias("trx_date"),
        F.col("trx.Code").alias("code"),
        F.col("trx.Description").alias("description"),
        F.col("trx.Debit").alias("debit"),
        F.col("trx.Credit").alias("credit"),
        F.col("trx.Balance").alias("balance"),
    )


def account_holders(df: DataFrame, keys: list[str], document: str = "document") -> DataFrame:
    """The holder of the first account, for documents that were fetched well and have an account."""
    fetched = (F.col(f"{document}.HttpStatusCode") == 200) & (F.size(f"{document}.Accounts") > 0)
    holder = F.col(f"{document}.Accounts")[0]["Holder"]
    return df.filter(fetched).select(
        *keys,
        holder["Name"].alias("name"),
        holder["Address"].alias("address"),
        holder["Email"].alias("email"),
        holder["PhoneNumber"].alias("phone_number"),
    )
