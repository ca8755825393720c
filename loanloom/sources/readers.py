"""Readers. Every one takes an explicit schema; missing numbers arrive as null, never NaN."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from loanloom.functions import numbers

# Texts that pandas reads as missing.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]
LATIN_1 = "ISO-8859-1"
CORRUPT = "_corrupt_record"


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: numbers.missing_if_nan(F.col(c)) for c in floats}) if floats else df


def missing_text_to_null(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != CORRUPT]
    return df.withColumns({c: F.when(~F.col(c).isin(MISSING_TEXTS), F.col(c)) for c in texts}) if texts else df


def _csv(spark: SparkSession, paths: str | list[str], schema: T.StructType, encoding: str, multi_line: bool = False, whole: bool = False) -> DataFrame:
    """Quotes inside a quoted field are doubled; a backslash is an ordinary character.

    Without ``multi_line`` files are split by lines. A line that opens a quoted field and does not close it then stops the
    job, since the rest of its row would be read as another row. ``whole`` parses every column of a line, whatever is selected, so
    that a wrong number of cells shows.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    df = (
        spark.read.schema(with_corrupt)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("nanValue", "NaN")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("columnPruning", not whole)
        .csv(paths)
    )
    if multi_line:
        return df
    open_quote = (F.length(CORRUPT) - F.length(F.replace(F.col(CORRUPT), F.lit('"'), F.lit("")))) % 2 == 1
    broken = F.raise_error(F.concat(F.lit("a quoted field goes over several lines; read it with multi_line: "), F.left(CORRUPT, F.lit(200))))
    # The hash, always true, names a column of the table: Spark does not scan for the corrupt lines alone, as a count would.
    return df.filter(F.when(open_quote, broken.cast("boolean")).otherwise(F.hash(F.col(schema.names[0])) >= -(2**31)))


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", encoding: str = "UTF-8", keep_corrupt: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header, or any Spark format. The header must carry the schema's names in order.

    A cell that does not fit its type becomes null; ``keep_corrupt`` keeps the raw line of such rows in
    ``_corrupt_record``, and ``quarantine`` divides by it. ``multi_line`` allows line breaks inside quotes; such a file is read by
    one task, so huge files are better written without them. Without it, such a line is an error.
    """
    if fmt != "csv":
        return nan_to_null(spark.read.schema(schema).format(fmt).load(path))
    df = missing_text_to_null(nan_to_null(_csv(spark, path, schema, encoding, multi_line, keep_corrupt)))
    return df if keep_corrupt else df.drop(CORRUPT)


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sound rows, and the raw lines of the others, of a table read with ``keep_corrupt``."""
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), df.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def read_monthly(
    spark: SparkSession, paths: list[str], schema: T.StructType, encoding: str = "UTF-8", with_path: bool = False, multi_line: bool = False
) -> DataFrame:
    """Many files of one schema in a single scan, each row with the name (and path) of its file."""
    df = _csv(spark, paths, schema, encoding, multi_line).withColumn("source_file", F.col("_metadata.file_name"))
    if with_path:
        df = df.withColumn("source_path", F.col("_metadata.file_path"))
    return missing_text_to_null(nan_to_null(df)).drop(CORRUPT)


def expand_json(df: DataFrame, col: str, schema: T.StructType) -> DataFrame:
    """Replace a JSON text column by its fields."""
    parsed = df.withColumn("_json", F.from_json(col, schema))
    return parsed.select(*[c for c in df.columns if c != col], "_json.*")


TRIAL_SCHEMA = T.StructType(
    [
        T.StructField("record_id", T.LongType()),
        T.StructField("iter_per_learner", T.LongType()),
        T.StructField("logged_metric", T.StructType([T.StructField("pred_time", T.DoubleType())])),
        T.StructField("trial_time", T.DoubleType()),
        T.StructField("wall_clock_time", T.DoubleType()),
        T.StructField("validation_loss", T.DoubleType()),
        T.StructField("config", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("learner", T.StringType()),
        T.StructField("sample_size", T.LongType()),
    ]
)


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """A log of training trials, one JSON object per line; the closing line that names the best is dropped."""
    return spark.read.schema(TRIAL_SCHEMA).json(path).filter(F.col("record_id").isNotNull())
