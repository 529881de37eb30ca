"""What the operators share: reading documents, SQL text pieces, shared folders."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words where a contract says ``[^\x20\x09-\x0D]+``.
SPACES = r" \t\n\u000B\u000C\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def let(value: str, name: str, body: str) -> str:
    """SQL text of ``body`` with ``name`` standing for ``value``, which is computed once per row."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def words(text: str) -> str:
    """SQL text: the words ``[^\\x20\\x09-\\x0D]+`` of a text that is not null, as an array."""
    trimmed = let(f"btrim({text}, '{SPACES}')", "_t", r"if(_t = '', cast(array() as array<string>), split(_t, '[\\x20\\x09-\\x0D]+'))")
    return trimmed


def shared_dir(spark: SparkSession) -> str:
    """A new folder that driver and executors share, under ``spark.checkpoint.dir``.

    Where that setting is missing, as in local tests, the session's warehouse folder holds it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_llm"
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's modules to the Python workers, once an application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp()) / "caretiers.zip"
        with zipfile.ZipFile(target, "w") as archive:
            for module in sorted(package.rglob("*.py")):
                archive.write(module, module.relative_to(package.parent))
        context.addPyFile(str(target))
        _shipped.add(context.applicationId)


def _at(spark: SparkSession, path: str) -> tuple[Any, Any]:
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), name


def temporary(spark: SparkSession, path: str) -> None:
    """A folder that was written goes when the application ends, unless it is deleted before."""
    system, name = _at(spark, path)
    system.deleteOnExit(name)


def delete(spark: SparkSession, path: str) -> None:
    """The folder goes now."""
    system, name = _at(spark, path)
    system.delete(name, True)


def stored(df: DataFrame) -> DataFrame:
    """The rows written as Parquet to a shared folder and read back: lineage ends here.

    The folder goes with ``discard``, at the latest when the application ends.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    df.write.parquet(path)
    temporary(spark, path)
    read = spark.read.schema(df.schema).parquet(path)
    read.stored_at = path
    if _scratch:
        _scratch[-1].append(read)
    return read


_scratch: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """What is ``stored`` inside is deleted at the end, but for frames given to the function that this gives."""
    mine: list[DataFrame] = []

    def kept(df: DataFrame) -> DataFrame:
        mine[:] = [other for other in mine if other is not df]
        if len(_scratch) > 1:
            _scratch[-2].append(df)
        return df

    _scratch.append(mine)
    try:
        yield kept
    finally:
        _scratch.remove(mine)
        discard(*mine)


def discard(*frames: DataFrame) -> None:
    """Deletes what ``stored`` wrote for these frames; nothing made of them can be read after that."""
    for df in frames:
        delete(df.sparkSession, df.stored_at)


def share(total: int) -> int:
    """Rows of a key that may meet in one task: a ten-thousandth of all, or 1000 in small tables."""
    return max(1000, total // 10_000)


def spread_join(rows: DataFrame, small: DataFrame, key: str, size: str, how: str = "inner", total: int | None = None) -> DataFrame:
    """``rows`` joined with ``small`` on ``key``, where hot keys are split over many tasks at any size.

    ``small`` has one row for each key, and in ``size`` how many of ``rows`` have that key. A key with more
    than ``share`` rows is copied once for each share of them, and its rows are dealt over the copies.
    At most 10,000 keys are so hot; only these are broadcast, with their number of copies. ``total`` is the
    number of ``rows``, or more; without it the sizes are summed, so ``small`` should be stored.
    """
    most = share(total if total is not None else small.agg(F.sum(size)).first()[0] or 0)
    hot = small.where(F.col(size) > most).select(key, F.expr(f"`{size}` div {most} + 1").alias("_copies"))
    copied = small.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"if(`{size}` > {most}, `{size}` div {most}, 0)"))))
    dealt = rows.withColumn("_row", F.monotonically_increasing_id()).join(F.broadcast(hot), key, "left")
    dealt = dealt.withColumn("_copy", F.coalesce(F.pmod("_row", "_copies"), F.lit(0).cast("bigint"))).drop("_row", "_copies")
    return dealt.join(copied, [key, "_copy"], how).drop("_copy")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def keep_columns(docs: DataFrame, alias: str, **changed: Column) -> list[Column]:
    """The columns of ``docs`` (aliased), some replaced; safe for any further column names of the other side."""
    return [changed[c].alias(c) if c in changed else F.col(f"{alias}.`{c}`") for c in docs.columns]
