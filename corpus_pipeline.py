"""Corpus pipeline: language ID, line dedup, SimHash near-dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of
``documents``; the last returns the packed pieces. ``run`` writes every stage as Parquet into the
session's shared checkpoint folder and reads it again as the next stage's documents, so a lost
executor costs no more than the stage at hand.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import decontam, langid, line_dedup, packing, simhash
from tidewatch.llm.common import prepare, table, unused
from tidewatch.llm.queries import tokenizer_path
from tidewatch.session import ensure_checkpoint_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a determined language; those without text or without a letter go."""
    prepare(spark)
    return langid.keep_identified(docs, langid.fit(docs))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line repeats; those of which no word is left go.

    ``n_chars`` follows the text. Documents that had no word to begin with stay.
    """
    prepare(spark)
    removed = unused(docs.columns, "removed")
    found = line_dedup.dedup_lines(docs, name=removed)
    emptied = (F.size(removed) > 0) & ~F.regexp_like(F.col("text"), F.lit(r"\S"))
    kept = found.where(~F.coalesce(emptied, F.lit(False)))
    length = F.when(F.size(removed) > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", length).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of SimHash near-duplicates, the one with the smallest doc_id."""
    prepare(spark)
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    prepare(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    prepare(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: tokenizer ids are beyond SQL; tests/llm/test_pipeline.py has a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    prepare(spark)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
