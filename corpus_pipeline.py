"""From raw documents to packed training sequences: language, lines, near duplicates, repeated passages, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tableops.llm.language_id import keep_identified
from tableops.llm.line_dedup import drop_lines
from tableops.llm.ngram_join import keep_one_of_each
from tableops.llm.packing import pack_documents
from tableops.llm.suffix_dedup import drop_repeats
from tableops.scratch import Tables


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified language go."""
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go."""
    return drop_lines(docs, min_chars=10)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return keep_one_of_each(docs, k=5, percent=80)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that occur earlier go."""
    return drop_repeats(docs, min_words=50)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids and their places in sequences of 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, limit=2048)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("packing", packing),
]

ORACLE_SQL = None  # SQL has no tokenizer; the tests hold the pipeline against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again, so no stage runs twice."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Tables(spark) as tables:
        for name, stage in STAGES[:-1]:
            docs = tables.put(stage(spark, docs, sf_dir), name)
        return tables.put(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0], keep=True)
