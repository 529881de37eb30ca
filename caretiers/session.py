"""Session settings the jobs are written for. Every one can be overridden by the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Partition counts and skewed partitions are settled at run time from real sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A JSON object that repeats a key keeps the last value, as most JSON parsers do.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Variants are stored shredded, so a path read from a variant is a column read.
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
    # The JVM does not compile methods over 8000 bytes of bytecode. A stage that would need one
    # (many JSON fields in one projection) is better run operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # One small file per bundle is common: pack many of them into a task.
    "spark.sql.files.openCostInBytes": "262144",
}


def build_session(app_name: str = "caretiers", **overrides: str) -> SparkSession:
    """Session with ``SETTINGS``; settings already given, to spark-submit or to a running session, win."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in overrides.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = dict(spark.sparkContext.getConf().getAll()) | dict(spark.conf.getAll) | overrides
    for key, value in SETTINGS.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark
