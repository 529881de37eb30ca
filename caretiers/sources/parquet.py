"""Parquet files, as they are or cleaned on read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caretiers.operators.cleaning import clean


def read_from_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_from_parquet_and_clean(spark: SparkSession, path: str) -> DataFrame:
    """Lower-case names, trimmed text, blank text as null. The scan still reads only used columns."""
    return read_from_parquet(spark, path).transform(clean)
