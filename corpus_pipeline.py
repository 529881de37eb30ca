"""Documents to packed training sequences, one operator of ``caretiers.llm`` a stage.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the documents of the next. All but the last return the columns of
``documents``: the first and third drop rows, the second and fourth cut text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caretiers.llm import common, decontam, lines, ngramjoin, packing, quality


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites stay in one document only."""
    return lines.remove(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id stays."""
    return ngramjoin.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out of texts."""
    return decontam.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = common.documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Components and packing are iterative; the stages are tested against brute force instead.
ORACLE_SQL = None
