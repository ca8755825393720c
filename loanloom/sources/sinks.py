"""Writers. Output is split by the number of partitions, never gathered into one file."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from loanloom.operators import cleaning
from loanloom.sources import documents


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None, mode: str = "overwrite"
) -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        # Quotes are doubled and blanks kept, as readers expect; line breaks in a text need multi_line there.
        writer = writer.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def save_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, mode: str = "overwrite") -> None:
    """A catalog table hashed and sorted by its join key: joins and groupings on the key need no shuffle.

    Tables to be joined need the same number of buckets.
    """
    df.repartition(buckets, *keys).write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(name)


def with_decision_id(df: DataFrame) -> DataFrame:
    """The same application always gets the same id, so a repeated write can be recognised. 128 bits, for
    with 64 two of ten billion applications would share one."""
    return df.withColumn("decision_id", F.md5(F.to_json(F.struct("organization", "application_id", "request_date"))))


LOG_COLUMNS = ["refusal_score", "refusal_percentile", "default_score", "default_percentile"]


def decision_tables(decisions: DataFrame, attributes: list[str], document: str | None = None) -> dict[str, DataFrame]:
    """The three tables of the decision log, linked by decision id.

    Attributes and holder are kept only for applications that got past the filter.
    """
    decided = decisions.filter(F.col("uw_decision") != "n/a")
    # Fixed value: the log spells the reason of an automatic refusal with a hyphen.
    logged_info = F.when(F.col("info") == "auto_refuse", "auto-refuse").otherwise(F.col("info")).alias("info")
    text = cleaning.dates_to_text(decided.select("decision_id", *attributes))
    tables = {
        "logs": decisions.select(
            F.col("decision_id").alias("id"), "organization", F.col("uw_decision").alias("decision"), logged_info, *LOG_COLUMNS
        ),
        "attributes": text.select("decision_id", F.to_json(F.struct(*attributes)).alias("attributes_json")),
    }
    if document:
        tables["account_holder"] = documents.account_holders(decided, ["decision_id"], document)
    return tables


def write_decisions(
    decisions: DataFrame, base: str, attributes: list[str], document: str | None = None, batch_id: int | str = 0
) -> None:
    """Write the decision log of one batch. Writing the same batch again replaces it.

    The decisions are computed once and kept on disk for the three writes.
    """
    kept = with_decision_id(decisions).persist(StorageLevel.DISK_ONLY)
    try:
        for name, table in decision_tables(kept, attributes, document).items():
            write_table(table, f"{base}/{name}/batch_id={batch_id}")
    finally:
        kept.unpersist()


def metrics_long(df: DataFrame, run_id: str) -> DataFrame:
    """One row per metric of a one-row metrics table."""
    metrics = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in df.columns])
    return df.select(F.lit(run_id).alias("run_id"), F.inline(metrics))


def write_metrics(df: DataFrame, path: str, run_id: str) -> None:
    """Put a run's metrics beside those of other runs; the same run replaces its own."""
    write_table(metrics_long(df, run_id).drop("run_id"), f"{path}/run_id={run_id}")


def scored_export(df: DataFrame, features: list[str], side: list[str]) -> DataFrame:
    """Features, prediction, score, label, and side columns marked ``test_``. All come from the same row."""
    return df.select(
        *features, "y_pred", "y_pred_proba", "y_test", *[F.col(c).alias(f"test_{c}") for c in side if c in df.columns]
    )


def export_scored(df: DataFrame, path: str, features: list[str], side: list[str], fmt: str = "csv") -> None:
    write_table(scored_export(df, features, side), path, fmt)
