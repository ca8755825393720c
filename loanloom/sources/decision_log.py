"""A decision log whose tables become visible together.

Every attempt to write a batch has folders of its own, which nothing reads until a commit names the attempt. A commit is one file of one
row, written last, so a crash at any point leaves the whole batch or nothing of it. Writing a batch again replaces it with the next commit,
and readers that hold a version go on seeing the tables as they were.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from urllib.parse import quote

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from loanloom.sources import sinks

COMMIT = "version bigint, tables map<string, struct<rows: bigint, schema: string>>"
OWN = T.StructType([T.StructField("batch_id", T.StringType()), T.StructField("attempt", T.StringType())])


def _path(base: str, name: str, batch_id: int | str, attempt: str) -> str:
    return f"{base}/{name}/batch_id={quote(str(batch_id), safe='')}/attempt={attempt}"


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The files below a folder; none where the folder is not there."""
    whole = T.StructType([*schema.fields, *OWN.fields])
    try:
        return spark.read.schema(whole).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], whole)


def commits(spark: SparkSession, base: str) -> DataFrame:
    """version, tables (rows and schema of each), batch_id and attempt of every commit."""
    return _read(spark, f"{base}/commits", T.StructType.fromDDL(COMMIT))


def version(spark: SparkSession, base: str) -> int:
    """The newest version; 0 before the first commit."""
    return commits(spark, base).agg(F.max("version")).first()[0] or 0


def append(spark: SparkSession, base: str, tables: Mapping[str, DataFrame], batch_id: int | str) -> int:
    """Write the tables of one batch and commit them together; gives the new version. One writer at a time has a log.

    A table with a column ``batch_id`` or ``attempt`` is an error.
    """
    if clashing := [n for n, t in tables.items() if {"batch_id", "attempt"} & {c.lower() for c in t.columns}]:
        raise ValueError(f"batch_id and attempt are the log's own columns, but are in {clashing}")
    attempt, written = uuid.uuid4().hex, {}
    for name, table in tables.items():
        path = _path(base, name, batch_id, attempt)
        sinks.write_table(table, path)
        written[name] = (spark.read.schema(table.schema).parquet(path).count(), table.schema.json())
    following = version(spark, base) + 1
    row = spark.createDataFrame([(following, written)], COMMIT).coalesce(1)
    sinks.write_table(row, _path(base, "commits", batch_id, attempt))
    return following


def write_decisions(
    decisions: DataFrame, base: str, attributes: list[str], document: str | None = None, batch_id: int | str = 0
) -> int:
    """``sinks.write_decisions`` with all tables of the batch committed at once. The decisions are computed once and kept on disk."""
    kept = sinks.with_decision_id(decisions).persist(StorageLevel.DISK_ONLY)
    try:
        return append(decisions.sparkSession, base, sinks.decision_tables(kept, attributes, document), batch_id)
    finally:
        kept.unpersist()


def visible(spark: SparkSession, base: str, at: int | None = None) -> DataFrame:
    """batch_id, attempt, version and tables of the commit that holds for each batch, at a version or at the newest."""
    seen = commits(spark, base) if at is None else commits(spark, base).filter(F.col("version") <= at)
    newest = seen.groupBy("batch_id").agg(F.max_by(F.struct("attempt", "version", "tables"), F.struct("version", "attempt")).alias("c"))
    return newest.select("batch_id", "c.*")


def read(spark: SparkSession, base: str, name: str, at: int | None = None) -> DataFrame:
    """The committed rows of a table with their batch_id, in the schema of its newest commit.

    A batch whose newest commit lacks the table has no rows in it. A table that no commit names is an error, since its columns are unknown.
    """
    holding = visible(spark, base, at).filter(F.col("tables")[name].isNotNull())
    schema = holding.agg(F.max_by(F.col("tables")[name]["schema"], "version")).first()[0]
    if schema is None:
        raise LookupError(f"no commit of {base} holds a table {name}")
    own = T.StructType.fromJson(json.loads(schema))
    rows = _read(spark, f"{base}/{name}", own)
    # Attempts are folders: the join prunes those that are not named.
    return rows.join(holding.select("batch_id", "attempt"), ["batch_id", "attempt"], "left_semi").select(*[F.col(f"`{c}`") for c in own.names], "batch_id")


def read_all(spark: SparkSession, base: str, names: list[str], at: int | None = None) -> dict[str, DataFrame]:
    """Several tables at one version, so that a batch committed meanwhile is in all of them or in none."""
    held = version(spark, base) if at is None else at
    return {name: read(spark, base, name, held) for name in names}


def damaged(spark: SparkSession, base: str) -> DataFrame:
    """batch_id, table, expected and found of committed batches whose files no longer hold the rows that were committed."""
    told = visible(spark, base).select("batch_id", "attempt", F.explode("tables").alias("table", "held"))
    names = [r[0] for r in told.select("table").distinct().collect()]
    counted = spark.createDataFrame([], "batch_id string, attempt string, found bigint, table string")
    for name in names:
        rows = _read(spark, f"{base}/{name}", T.StructType([]))
        counted = counted.unionByName(rows.groupBy("batch_id", "attempt").agg(F.count("*").alias("found")).withColumn("table", F.lit(name)))
    both = told.join(counted, ["batch_id", "attempt", "table"], "left").select(
        "batch_id", "table", F.col("held.rows").alias("expected"), F.coalesce("found", F.lit(0)).alias("found")
    )
    return both.filter("expected <> found")
