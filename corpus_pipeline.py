"""From raw documents to packed training sequences: language, repeated lines, near duplicates, mixing, packing."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loanloom.llm import language, mixing, packing, passages, prefix_tree
from loanloom.llm.common import held_out, materialized, table


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def carrying(stage: Stage) -> Stage:
    """A stage that carries columns other than those of documents untouched, under generated names that no operator uses."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        other = [c for c in docs.columns if c not in COLUMNS]
        held = {c: f"__carried_{i}__" for i, c in enumerate(other)}
        named = docs.select(*(F.col(f"`{c.replace('`', '``')}`").alias(held.get(c, c)) for c in docs.columns))
        done = stage(spark, named, sf_dir)
        return done.select(*(F.col(held.get(c, c)).alias(c) for c in docs.columns))

    return run_stage


@carrying
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told. Those without letters, and those of which no language holds two fifths, go.
    Where no language is named, only documents without letters go."""
    model = language.train(docs, ~held_out("doc_id"))
    if not model.names:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    return language.identify(docs, model).filter(~language.rejected()).select(*docs.columns)


@carrying
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines, and the passages of 50 or more words, that stand earlier in the corpus; a document of which nothing is
    left goes."""
    cleaned = passages.without_repeats(docs)
    left = cleaned.filter((F.col("n_touched") == 0) | (F.trim(F.col("text")) != ""))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col("n_touched") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


@carrying
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles link at 0.8, the first by id; repeated rows stay once."""
    groups = prefix_tree.join(docs).filter("stays").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    text_hash = F.xxhash64(F.col("text"))
    kept = docs.join(groups, F.col("doc_id").eqNullSafe(F.col("_id")) & (text_hash == F.col("_hash")))
    # Rows that agree in id and text lie together after the join.
    first = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy(F.lit(1)))
    return kept.withColumn("_row", first).filter("_row = 1").select(*docs.columns)


@carrying
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    rows = materialized(mixing.measured(docs, docs.columns), "sizes")
    mixed = mixing.mix(rows, mixing.plan(rows)).filter("copies > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies").cast("long")))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    pieces = packing.pack(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
#: Tries, mixtures of languages and tokens are beyond SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on what the one before kept, written between them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
