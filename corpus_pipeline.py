"""From raw documents to packed token sequences.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the
next stage's ``docs``. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wellspring.llm import decontaminate, jaccard_join, packing, quality
from wellspring.llm.bpe import tokenizer_path
from wellspring.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all quality rules."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: 5-word shingles, similarity 0.8 or more."""
    return jaccard_join.keep_one(docs, shingle=5, similarity=(80, 100))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any 10-word window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.keep_clean(docs, benchmark)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and their places in sequences of 2048 tokens."""
    return packing.pack(packing.token_pieces(docs, tokenizer_path(), end_id=50256))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("packed", packed),
]

#: The tokenizer of the last stage and the hashes of the second have no SQL equivalent.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs)
    return docs
