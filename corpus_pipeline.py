"""Corpus pipeline: five stages from raw ``documents`` to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns a DataFrame that is written as Parquet and read again as the
next stage's ``docs``.  All but the last keep the columns of ``docs``.

1. quality        documents that the rule ensemble rejects go;
2. near_dedup     one document of each component of near duplicates stays
                  (five-word shingles, similarity 0.8 or more);
3. decontaminate  documents with a benchmark window go;
4. secrets        secrets of all layers are masked in the text;
5. pack           the tokens of the documents, as pieces of sequences.

Rows with a null text are empty documents: the classifier decides on them.
An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adfuse.llm.decontaminate import decontaminate
from adfuse.llm.near_dedup import deduplicate
from adfuse.llm.packing import pack
from adfuse.llm.quality_rules import keep_good
from adfuse.llm.secret_scan import redact
from adfuse.llm.tables import frozen, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicate(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", benchmark_free),
    ("secrets", secrets),
    ("pack", packed),
]

#: The fitted rules, layered spans and packing are not SQL; tests/llm holds them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = frozen(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
