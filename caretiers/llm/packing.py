"""Packing of token ids into sequences by Karmarkar-Karp multiway differencing.

A document's ids are cut into full sequences and a rest, and the rest into pieces of at most ``PIECE``
ids. Pieces of neighbouring documents form groups of bounded size. Within a group, differencing merges
the two partial partitions of largest spread, the fullest windows of one with the emptiest of the
other, until one partition of the group into near-equal windows is left. The number of windows starts
at what the sum of lengths needs and rises for as long as a window is over capacity.

Groups form inside a partition, so that nothing is shuffled, and a lost task is simply run again. A
sequence's id holds the partition and a counter. A null or empty text is one piece that holds the end
id; repeated rows are packed one by one; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from caretiers.llm.common import documents, ship

CAPACITY = 2048
#: Largest piece of a document's rest. Small pieces balance well; each is a row.
PIECE = 512
#: Pieces that are packed together.
GROUP = 1024
TOKENIZER = "word_bpe_49k.json"
END = 1

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"
NO_IDS = SCHEMA.removesuffix(", ids array<int>")


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Indices of ``sizes`` in ``k`` windows of near-equal sums.

    A partial partition is a vector of ``k`` sums, descending, and the chain of items of each window.
    """
    n = len(sizes)
    following = np.full(n, -1, np.int64)
    heap = []
    for i, size in enumerate(sizes):
        sums, head = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[0], head[0] = size, i
        heap.append((-size, i, sums, head, head.copy()))
    heapq.heapify(heap)
    for merged in range(n, 2 * n - 1):
        _, _, a, a_head, a_tail = heapq.heappop(heap)
        _, _, b, b_head, b_tail = heapq.heappop(heap)
        b, b_head, b_tail = b[::-1], b_head[::-1], b_tail[::-1]
        both = (a_head >= 0) & (b_head >= 0)
        following[a_tail[both]] = b_head[both]
        head = np.where(a_head >= 0, a_head, b_head)
        tail = np.where(b_head >= 0, b_tail, a_tail)
        sums = a + b
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), merged, sums, head[order], tail[order]))
    windows = []
    for i in heap[0][3] if heap else ():
        chain = []
        while i >= 0:
            chain.append(int(i))
            i = following[i]
        windows.append(chain)
    return windows


def windows_of(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows of at most ``capacity``; their number rises until none is over it."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        found = differencing(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in found):
            return [w for w in found if w]
        k += max(1, k // 256)


def packer(tokenizer: str, end: int, capacity: int, piece: int, group: int, with_ids: bool):
    """The function that packs one partition's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caretiers.llm.encoding import encoder

        encode = encoder(tokenizer).encode
        tail = np.uint32(end).astype("<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 40
        out: list[tuple] = []
        waiting: list[tuple] = []

        def emit(piece_of: tuple, offset: int) -> None:
            doc, start, ids, total = piece_of
            row = (doc, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset)
            out.append((*row, np.frombuffer(ids, "<i4")) if with_ids else row)

        def pack() -> None:
            nonlocal sequence
            for window in windows_of([len(p[2]) // 4 for p in waiting], capacity):
                offset = 0
                for i in window:
                    emit(waiting[i], offset)
                    offset += len(waiting[i][2]) // 4
                sequence += 1
            waiting.clear()

        def batch() -> pa.RecordBatch:
            names = [c.split()[0] for c in SCHEMA.split(", ")][: 7 + with_ids]
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            arrays = [pa.array(c, pa.list_(pa.int32()) if n == "ids" else pa.int64()) for n, c in zip(names, columns, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                ids = encode(text.as_py() or "") + tail
                total, at = len(ids) // 4, 0
                while total - at >= capacity:
                    emit((doc, at, ids[4 * at : 4 * (at + capacity)], total), 0)
                    sequence += 1
                    at += capacity
                while at < total:
                    size = min(piece, total - at)
                    waiting.append((doc, at, ids[4 * at : 4 * (at + size)], total))
                    at += size
                if len(waiting) >= group:
                    pack()
                    yield batch()
        pack()
        yield batch()

    return run


def pack(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    end: int = END,
    capacity: int = CAPACITY,
    piece: int = PIECE,
    group: int = GROUP,
    with_ids: bool = True,
) -> DataFrame:
    """A row for each piece: its place in its document, its sequence, its place there, and its ids."""
    ship(docs.sparkSession)
    texts = docs.selectExpr("cast(doc_id as bigint) as doc_id", "text")
    return texts.mapInArrow(packer(tokenizer, end, capacity, piece, group, with_ids), SCHEMA if with_ids else NO_IDS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), with_ids=False)
