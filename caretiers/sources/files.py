"""Questions to the file system that Spark reads through."""

from __future__ import annotations

import re
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession


#: Characters with a meaning in path patterns.
_PATTERN = re.compile(r"[\[\]{}*?\\]")


def _at(spark: SparkSession, path: str) -> tuple[Any, Any]:
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), name


def is_directory(spark: SparkSession, path: str) -> bool:
    system, name = _at(spark, path)
    return system.exists(name) and system.getFileStatus(name).isDirectory()


def exists(spark: SparkSession, path: str) -> bool:
    system, name = _at(spark, path)
    return system.exists(name)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches the pattern."""
    system, name = _at(spark, pattern)
    return bool(system.globStatus(name))


def directories(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories in a directory, sorted; none if it does not exist."""
    system, name = _at(spark, path)
    if not system.exists(name):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(name) if status.isDirectory())


def sizes(spark: SparkSession, path: str, ending: str) -> list[int]:
    """Bytes of each file in a directory whose name ends so."""
    system, name = _at(spark, path)
    return [status.getLen() for status in system.listStatus(name) if status.isFile() and status.getPath().getName().endswith(ending)]


def bytes_of(spark: SparkSession, text: str) -> int:
    """A setting's size, such as ``64MB``, in bytes."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def tasks_reading(df: DataFrame) -> int:
    """The tasks that make the rows straight from what they read; 0 if there is an exchange in the plan. Nothing is run."""
    execution = df._jdf.queryExecution()
    if execution.executedPlan().nodeName() == "AdaptiveSparkPlan":
        return 0
    return execution.toRdd().getNumPartitions()


def escaped(path: str) -> str:
    """The path as a pattern that matches it alone."""
    return _PATTERN.sub(r"\\\g<0>", path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, none if it does not exist."""
    system, name = _at(spark, path)
    if not system.exists(name):
        return None
    stream = system.open(name)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file. Readers see the old text or the new one, never a part."""
    system, name = _at(spark, f"{path}.{uuid.uuid4().hex}")
    stream = system.create(name, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    source, target = system.makeQualified(name), system.makeQualified(hadoop.Path(path))
    hadoop.FileContext.getFileContext(source.toUri(), system.getConf()).rename(source, target, options)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a file or a directory with all that it holds, if it exists."""
    system, name = _at(spark, path)
    system.delete(name, True)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Makes a directory that is deleted when the application ends."""
    system, name = _at(spark, path)
    system.mkdirs(name)
    system.deleteOnExit(name)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as the catalog keeps it."""
    system, name = _at(spark, path)
    return system.makeQualified(name).toString()
