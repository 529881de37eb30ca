"""Importance resampling of documents towards a target, with hashed word features of an automaton.

A block is a run of rows of bounded size inside a partition. Its distinct words, each between two
delimiters, go into an Aho-Corasick automaton with their CRC-32 and their length as payload. One scan of
the block's text emits the payloads of all words in order, neighbours sharing a delimiter. A feature is a
run of up to ``MAX_WORDS`` words joined by a space; its CRC is composed of those of its words, without its
bytes: crc(x + y) is crc(x) moved on by the length of y, and crc(y). The CRC modulo ``BUCKETS`` is the bucket.

A first pass adds up features by bucket, per task before the shuffle, over the raw and over the target
texts. From these come the gains of the buckets, the only thing that all tasks get (``BUCKETS`` numbers). A
second pass gives each document the mean gain of its features. Documents are drawn without replacement by
largest weight plus Gumbel noise, which a hash of the id stands for; ranks come from a range-dealt sort
with the sizes of its partitions, so that no task sees all rows.

Null and empty texts have no words: no features, weight 0, never drawn where ``min_words`` is over 0.
Repeated rows are counted and drawn as rows of their own; ties go to the smaller id. A row without an id
is hashed as if its id were an empty text and comes last among ties. Other columns are not looked at.
"""

from __future__ import annotations

import math
from binascii import crc32
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caretiers.llm.common import documents, scratch, ship, stored
from caretiers.llm.wordhash import ALNUM, LOWER, blocks, text_bytes

#: Words in a feature, at most.
MAX_WORDS = 1
BUCKETS = 10_000
#: Words that a document needs to be drawn.
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
BLOCK_BYTES = 8 << 20

#: Bytes of words lower-cased, all others a space.
FOLD = np.where(ALNUM, LOWER, np.uint8(0x20)).astype(np.uint8)


def _shifts() -> np.ndarray:
    """For 2**k zero bytes (k from 0 to 31): what each byte of a CRC becomes when they follow it."""
    table = np.zeros((32, 4, 256), np.uint32)
    for k in range(32):
        for place in range(4):
            for bit in range(8):
                value = np.array([1 << (8 * place + bit)], np.uint32)
                if k == 0:
                    for _ in range(8):
                        value = np.where(value & 1, (value >> np.uint32(1)) ^ np.uint32(0xEDB88320), value >> np.uint32(1))
                else:
                    value = _moved(table[k - 1], _moved(table[k - 1], value))
                table[k, place, (np.arange(256) >> bit) & 1 == 1] ^= value
    return table


def _moved(shift: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return shift[0][crc & 255] ^ shift[1][(crc >> 8) & 255] ^ shift[2][(crc >> 16) & 255] ^ shift[3][crc >> 24]


SHIFTS = _shifts()


def composed(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs of joined texts from those of their parts and the second parts' lengths in bytes."""
    first = first.astype(np.uint32)
    for k in range(int(length.max()).bit_length() if len(length) else 0):
        first = np.where((length >> k) & 1 == 1, _moved(SHIFTS[k], first), first)
    return first ^ second


def payloads(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC and length of every word of a block in order, and per row where its words begin."""
    n = len(offsets) - 1
    spaced = np.full(len(values) + n + 1, 0x20, np.uint8)
    spaced[np.arange(len(values)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))] = FOLD[values]
    data = spaced.tobytes()
    words = sorted(set(data.split(b" ")) - {b""})
    if not words:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    automaton = ahocorasick.Automaton()
    for i, word in enumerate(words):
        automaton.add_word(f" {word.decode('latin-1')} ", i)
    automaton.make_automaton()
    crcs, lengths = np.array([crc32(w) for w in words], np.uint32), np.array([len(w) for w in words], np.int64)
    found = np.array(list(automaton.iter(data.decode("latin-1"))), np.int64)
    at = found[:, 1]
    return crcs[at], lengths[at], np.searchsorted(found[:, 0], offsets + np.arange(n + 1), "right")


def features(block: pa.RecordBatch, max_words: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each number of words: the buckets of a block's features and the row of each."""
    values, offsets = text_bytes(block.column("text"))
    crcs, lengths, begins = payloads(values, offsets)
    rows = np.repeat(np.arange(block.num_rows), np.diff(begins))
    space = np.uint32(crc32(b" "))
    last_crc, last_length, run = crcs, lengths, crcs
    for k in range(max_words):
        if k:
            joined = composed(np.full(len(last_crc), space), last_crc, last_length)  # a space before the word that comes to the run
            run = composed(run[:-1], joined[k:], last_length[k:] + 1)
            rows, whole = rows[:-1], rows[:-1] == np.repeat(np.arange(block.num_rows), np.diff(begins))[k:]
            yield (run % buckets)[whole].astype(np.int64), rows[whole]
        else:
            yield (run % buckets).astype(np.int64), rows


def counting(max_words: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for block in blocks(batches, "text", BLOCK_BYTES):
            for found, _ in features(block, max_words, buckets):
                total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    return run


def weighing(gains: np.ndarray, max_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK_BYTES):
            n, words = np.zeros(block.num_rows, np.int64), np.zeros(block.num_rows, np.int64)
            sums = np.zeros(block.num_rows, np.int64)
            for k, (found, rows) in enumerate(features(block, max_words, len(gains))):
                here = np.bincount(rows, minlength=block.num_rows)
                words = here if k == 0 else words
                n += here
                added = np.concatenate([[0], np.cumsum(gains[found])])
                ends = np.cumsum(here)
                sums += added[ends] - added[ends - here]
            weight = np.where(n > 0, sums // np.maximum(n, 1), 0)
            arrays = [block.column("doc_id"), *map(pa.array, (n, words, weight))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_features", "n_words", "weight"])

    return run


def bucket_counts(texts: DataFrame, max_words: int = MAX_WORDS, buckets: int = BUCKETS) -> dict[int, int]:
    """Features of all rows of ``text`` by bucket: at most ``buckets`` numbers."""
    ship(texts.sparkSession)
    made = texts.select("text").mapInArrow(counting(max_words, buckets), "bucket long, n long")
    return {r["bucket"]: r["n"] for r in made.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def bucket_gains(raw: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the logarithm of target share by raw share, one added to every bucket's count."""
    s, t = sum(raw.values()), sum(target.values())
    gains = [math.log((target.get(b, 0) + 1) * (s + buckets) / ((raw.get(b, 0) + 1) * (t + buckets))) for b in range(buckets)]
    return np.array([math.floor(1000 * g) for g in gains], np.int64)


def weights(docs: DataFrame, target: DataFrame, max_words: int = MAX_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id``, ``n_features``, ``n_words`` and ``weight`` (the floored mean of gains) of every row of ``docs``."""
    gains = bucket_gains(bucket_counts(docs, max_words, buckets), bucket_counts(target, max_words, buckets), buckets)
    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "text")
    return rows.mapInArrow(weighing(gains, max_words), "doc_id long, n_features long, n_words long, weight long")


def scored(weighed: DataFrame, seed: int = SEED) -> DataFrame:
    """``weighed`` with ``score``: the weight and Gumbel noise of the id, in thousandths."""
    h = f"cast(conv(substr(sha2(concat('{seed}:', coalesce(cast(doc_id as string), '')), 256), 1, 8), 16, 10) as double)"
    return weighed.withColumn("score", F.expr(f"weight + cast(floor(-1000 * ln(-ln(({h} + 0.5) / 4294967296))) as bigint)"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, max_words: int = MAX_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Every row's ``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank``, null where it is not drawn.

    Of the rows with ``min_words`` words or more, ``percent`` in a hundred are drawn (floored).
    """
    of = F.when(F.col("n_words") >= min_words, 0).otherwise(1)
    dealt = scored(weights(docs, target, max_words, buckets), seed).withColumn("out", of)
    order = [F.col("out"), F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # The partition and the place in it, as they are while the sorted rows are written.
    with scratch() as kept:
        sorted_rows = kept(stored(stored(dealt).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())))
    rows = sorted_rows.withColumn("part", F.expr("shiftright(place, 33)")).withColumn("place", F.expr("place & 8589934591"))
    sizes = rows.groupBy("part").agg(F.count("*").alias("n"), F.count_if(F.col("out") == 0).alias("m"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.expr(f"sum(m) over () * {percent} div 100").alias("drawn"))
    rank = F.col("first") + F.col("place") + 1
    joined = rows.join(F.broadcast(starts), "part")
    return joined.select("doc_id", "n_features", "weight", "score", F.when((F.col("out") == 0) & (rank <= F.col("drawn")), rank).alias("rank"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed towards the benchmark's texts, and the tenth of them that is drawn."""
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
