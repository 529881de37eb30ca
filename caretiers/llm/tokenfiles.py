"""Token ids in ORC files: stripes of run-length encoded integers, row indexes, Bloom filters on ids.

Documents are dealt by ranges of ``doc_id`` (ties by text), sorted, and encoded while the sorted rows
are written: one file a range, in ascending order. Each row carries the ids before it in its file, so a
reader needs only the files' totals, a row for each file, for every document's place in the whole.
Stripes are read in parallel; ranges and Bloom filters let a look-up of some documents skip the rest.

Rows without an id come first. A null or empty text has the end id only; repeated rows are all written;
other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caretiers.llm.common import documents, shared_dir, ship

TOKENIZER = "byte_bpe_50k.json"
END = 0
SCHEMA = "doc_id long, before long, n_tokens long, ids array<int>"
OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(32 << 20),
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def encoding(tokenizer: str, end: int):
    """The function that encodes one sorted partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caretiers.llm.encoding import encoder

        encode = encoder(tokenizer).encode
        tail = np.uint32(end).astype("<u4").tobytes()
        before = 0
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                found = [encode(t.as_py() or "") + tail for t in b.column("text")]
                counts = np.array([len(x) // 4 for x in found], np.int64)
                ends = counts.cumsum()
                ids = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), np.frombuffer(b"".join(found), "<i4"))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(before + ends - counts), pa.array(counts), ids], ["doc_id", "before", "n_tokens", "ids"])
                before += int(ends[-1])

    return run


def write(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end: int = END) -> None:
    """Writes the ids of all texts in ascending order of ``doc_id``."""
    ship(docs.sparkSession)
    texts = docs.selectExpr("cast(doc_id as bigint) as doc_id", "coalesce(text, '') as text")
    dealt = texts.repartitionByRange(F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(encoding(tokenizer, end), SCHEMA).write.options(**OPTIONS).orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (the ids of all documents before it), ``n_tokens``, ``ids``."""
    number = F.expr(r"cast(regexp_extract(_metadata.file_name, 'part-(\\d+)', 1) as int)")
    rows = spark.read.schema(SCHEMA).orc(path).withColumn("file", number)
    totals = rows.groupBy("file").agg(F.max(F.col("before") + F.col("n_tokens")).alias("total"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("first"))
    return rows.join(F.broadcast(starts), "file").select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids")


def look_up(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Rows of some documents; files, stripes and row groups that cannot hold them are not read."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "n_tokens", "ids")


def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column("ids")
        offsets = ids.offsets.to_numpy()
        data = memoryview(np.ascontiguousarray(ids.values.to_numpy(), "<i4")).cast("B")
        crc = [zlib.crc32(data[4 * x : 4 * y]) for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n_tokens"), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, count and checksum, read back from the files."""
    path = shared_dir(spark)
    write(documents(spark, sf_dir), path)
    return read(spark, path).mapInArrow(checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")
