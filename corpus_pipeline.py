"""A corpus from documents to training sequences: languages, repeated lines, near duplicates, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import language_id, line_dedup, packing, simhash
from panelcast.llm.queries import BYTES, RANKS
from panelcast.llm.staging import scratch


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null texts, texts without a letter and unsure ones go."""
    return language_id.keep_identified(docs)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each line once in the whole corpus; documents of which nothing is left go. Lengths follow the text."""
    out = line_dedup.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints links connect: four-word shingles, at most four of 64 bits."""
    return simhash.keep_one(docs, width=4, distance=4)


def training_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in sequences of at most 2048 tokens."""
    return packing.pack(docs, BYTES, ranks_path=RANKS)


STAGES = [
    ("language_id", known_languages), ("line_dedup", distinct_lines), ("simhash", distinct_documents), ("packing", training_sequences),
]
#: SQL can express neither the fitted model nor MinHash nor SimHash; run() is tested against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's rows are written to the shared folder and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
