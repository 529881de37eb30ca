"""Benchmark passages in documents, found with an FM-index over each shard of documents.

A shard is a run of rows of bounded size inside a partition. Words become numbers; words that no
benchmark item has can be in no occurrence, so the index covers the stretches between them, each closed
by a mark of its own. From the stretches' suffix array come the Burrows-Wheeler transform, a wavelet
matrix that counts a word among the first i entries, and suffix positions sampled at every ``SAMPLE``-th
word and at each stretch's first. All test phrases are searched backwards together, a word a step; the
rows of those that occur are walked back to a sampled position. Covered words merge into removal spans.

Phrases are an item's windows of ``WINDOW`` words, or all its words if it has fewer. Tasks over the
benchmark write them in parts of at most ``PART_PHRASES``; an item with more is in several. The driver
broadcasts one part after the other and holds one at a time. A shard is indexed once and searched for
part after part; what the parts cover and find is united, so a benchmark may have any size.
Null and empty texts and items have no words. Repeated rows are scanned one by one, items of equal id
count once, items without an id still hit words. No shuffle, and a lost task is simply run again.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from caretiers.llm.common import documents, ship, stored
from caretiers.llm.wordhash import ALNUM, blocks, text_bytes, words

WINDOW = 10
SAMPLE = 8
SHARD_BYTES = 8 << 20
#: Bytes of benchmark text that a task makes into phrases together (one item at least).
PART_BYTES = 4 << 20
#: Phrases in a part, about 50 MB in each Python worker.
PART_PHRASES = 1_000_000


class Phrases:
    """Distinct windows of benchmark items, by length, as numbers into the sorted hashes of their words."""

    def __init__(self, hashes: np.ndarray, names: list[str], start: np.ndarray, size: np.ndarray, owner: np.ndarray) -> None:
        used = np.unique(np.concatenate([hashes[start[size > k] + k] for k in range(WINDOW)]))
        self.vocabulary = used
        self.items = np.array(names, object)
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in np.unique(size).tolist():
            at, own = start[size == n], owner[size == n]
            every = np.stack([np.searchsorted(used, hashes[at + k]) for k in range(n)], 1).astype(np.int32)
            distinct, which = np.unique(every, axis=0, return_inverse=True)
            order = np.lexsort((own, which.ravel()))
            begins = np.searchsorted(which.ravel()[order], np.arange(len(distinct) + 1))
            self.windows[n] = (distinct, begins, own[order].astype(np.int32))


def parts_of(items: pa.RecordBatch, most: int) -> Iterator[Phrases]:
    """The phrases of some items, at most ``most`` at a time."""
    values, offsets = text_bytes(items.column("text"))
    _, _, hashes, rows = words(values, offsets, ALNUM)
    counts = np.diff(rows)
    many = np.where(counts > 0, np.maximum(counts - WINDOW, 0) + 1, 0)
    ends = np.cumsum(many)
    names = np.array([str(i) if i is not None else "" for i in items.column("item_id").to_pylist()], object)
    for a in range(0, int(many.sum()), most):
        phrase = np.arange(a, min(a + most, int(ends[-1])))
        owner = np.searchsorted(ends, phrase, "right")
        start = rows[owner] + phrase - (ends - many)[owner]
        yield Phrases(hashes, names[owner[0] : owner[-1] + 1].tolist(), start, np.minimum(counts[owner], WINDOW), owner - owner[0])


def packed(limits: tuple[int, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each part: its number in the task, the words it has, and its phrases."""
    number = 0
    for block in blocks(batches, "text", limits[0]):
        for part in parts_of(block, limits[1]):
            words_of = [part.vocabulary.tobytes(), min(part.windows)]
            row = [[number], *([pickle.dumps(x, pickle.HIGHEST_PROTOCOL)] for x in (words_of, part))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["number", "words", "phrases"])
            number += 1


class Benchmark:
    """Broadcast parts, each in two: its words with its shortest phrase's length, and its phrases."""

    def __init__(self, parts: list[tuple]) -> None:
        self.parts = parts

    def each(self, half: int) -> Iterator:
        """One half of every part. Where there are many, none but the last one read is held."""
        for part in self.parts:
            yield pickle.loads(part[half].value)
            if len(self.parts) > 1 and "_path" in vars(part[half]):
                vars(part[half]).pop("_value", None)  # pyspark would hold it as long as the worker lives; it can be read from disk again

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, int]:
        """Which of some distinct words the benchmark has, and the length of its shortest phrase."""
        found, shortest = np.zeros(len(hashes), bool), WINDOW
        for vocabulary, least in self.each(0):
            vocabulary = np.frombuffer(vocabulary, np.uint64)
            found |= numbers(vocabulary, hashes) >= 0
            shortest = min(shortest, least)
        return found, shortest


def numbers(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of hashes in a sorted vocabulary, -1 for those that it lacks."""
    if not len(vocabulary):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at, -1)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling: each round sorts by twice as many symbols, until all ranks differ."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    step = 1
    while True:
        second = np.zeros(n, np.int64)
        second[: n - step] = rank[step:] + 1
        key = rank.astype(np.int64) * (n + 1) + second
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.zeros(n, np.int64)
        new[order] = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        rank = new
        if rank[order[-1]] == n - 1 or step >= n:
            return order
        step *= 2


class FMIndex:
    """Over ``text``: words as numbers from 0 on, marks negative and all different."""

    def __init__(self, text: np.ndarray, symbols: int) -> None:
        n = len(text)
        array = suffix_array(text)
        marks = int((text < 0).sum())
        previous = text[array - 1]
        self.size = n
        self.less = np.concatenate([[marks], marks + np.cumsum(np.bincount(text[text >= 0], minlength=symbols))])
        self.bwt = np.where(previous < 0, symbols, previous)
        first = np.concatenate([[True], text[:-1] < 0])
        position = np.arange(n)
        self.sampled = ((position % SAMPLE == 0) | first)[array]
        self.samples = np.where(self.sampled, array, -1)
        self.levels = []
        level = self.bwt
        for bit in range(int(symbols).bit_length() - 1, -1, -1):
            ones = (level >> bit) & 1
            counts = np.concatenate([[0], np.cumsum(ones, dtype=np.int32)])
            self.levels.append((bit, counts, n - int(counts[-1])))
            level = np.concatenate([level[ones == 0], level[ones == 1]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` is among the first ``i`` entries of the transform."""
        start = np.zeros(len(i), np.int64)
        for bit, counts, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            ones, first = counts[i], counts[start]
            i = np.where(one, zeros + ones, i - ones)
            start = np.where(one, zeros + first, start - first)
        return i - start

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which patterns (rows of words) occur, and the rows from ``low`` to ``high`` of the suffix array."""
        which = np.arange(len(patterns))
        low, high = np.zeros(len(which), np.int64), np.full(len(which), self.size, np.int64)
        for k in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[which, k]
            low, high = self.less[c] + self.rank(c, low), self.less[c] + self.rank(c, high)
            found = low < high
            which, low, high = which[found], low[found], high[found]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: back a word at a time, to a sampled one."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.sampled[rows])
        while len(walking):
            c = self.bwt[rows[walking]]
            rows[walking] = self.less[c] + self.rank(c, rows[walking])
            steps[walking] += 1
            walking = walking[~self.sampled[rows[walking]]]
        return self.samples[rows] + steps


def stretches(ids: np.ndarray, row_of: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of known words of one row, long enough for a phrase, a mark after each; and each entry's word."""
    known = ids >= 0
    breaks = np.ones(len(ids) + 1, bool)
    breaks[1:-1] = (known[1:] != known[:-1]) | (row_of[1:] != row_of[:-1])
    edges = np.flatnonzero(breaks)
    begin, end = edges[:-1], edges[1:]
    use = known[begin] & (end - begin >= shortest)
    begin, size = begin[use], (end - begin)[use]
    total = size + 1
    firsts = np.cumsum(total) - total
    at = np.repeat(begin - firsts, total) + np.arange(int(total.sum()))
    marks = firsts + size
    text = ids[np.minimum(at, len(ids) - 1)] if len(ids) else np.zeros(0, np.int64)
    text[marks] = -1 - np.arange(len(marks))
    return text, at


def hits(benchmark: Benchmark, block: pa.RecordBatch):
    """Of a shard: word starts and ends, rows, whether each word is hit, and the pairs (row, item's name) found."""
    values, offsets = text_bytes(block.column("text"))
    starts, ends, hashes, rows = words(values, offsets, ALNUM)
    row_of = np.repeat(np.arange(block.num_rows), np.diff(rows))
    cover = np.zeros(len(starts) + 1, np.int64)
    pairs = []
    own, place = np.unique(hashes, return_inverse=True)
    known, shortest = benchmark.known(own)
    own = own[known]
    text, word_of = stretches(np.where(known, np.cumsum(known) - 1, -1)[place], row_of, shortest)
    if len(text):
        index = FMIndex(text, len(own))
        for phrases in benchmark.each(1):
            ids = numbers(own, phrases.vocabulary)
            for n, (windows, begins, owners) in phrases.windows.items():
                held = np.flatnonzero((ids >= 0)[windows].all(1))
                which, low, high = index.search(ids[windows[held]])
                which, counts = held[which], high - low
                suffixes = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
                first = word_of[index.locate(suffixes)]
                np.add.at(cover, first, 1)
                np.add.at(cover, first + n, -1)
                found = np.unique(np.stack([row_of[first], np.repeat(which, counts)], 1), axis=0)
                many = begins[found[:, 1] + 1] - begins[found[:, 1]]
                at = np.repeat(begins[found[:, 1]] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
                of = np.unique(np.stack([np.repeat(found[:, 0], many), owners[at]], 1), axis=0)
                pairs.append((of[:, 0], phrases.items[of[:, 1]]))
    return values, offsets, starts, ends, rows, np.cumsum(cover)[:-1] > 0, pairs


def report(benchmark: Benchmark, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text", SHARD_BYTES):
        _, _, _, _, rows, hit, pairs = hits(benchmark, block)
        summed = np.concatenate([[0], np.cumsum(hit)])
        n_hit = summed[rows[1:]] - summed[rows[:-1]]
        names: list[set[str]] = [set() for _ in range(block.num_rows)]
        for row, name in (x for of in pairs for x in zip(*of, strict=True)):
            names[row].add(name)
        found = [sorted(x for x in own if x) for own in names]
        yield pa.RecordBatch.from_arrays(
            [
                block.column("doc_id"),
                pa.array(np.diff(rows).astype(np.int64)),
                pa.array(n_hit.astype(np.int64)),
                pa.array([len(x) for x in found], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in found], pa.string()),
                pa.array(n_hit > 0),
            ],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def cleaned(benchmark: Benchmark, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text", SHARD_BYTES):
        values, offsets, starts, ends, rows, hit, _ = hits(benchmark, block)
        row_of = np.repeat(np.arange(block.num_rows), np.diff(rows))
        joined = np.zeros(len(hit) + 1, bool)  # to the word before, in the same removal span
        joined[1:-1] = hit[1:] & hit[:-1] & (row_of[1:] == row_of[:-1])
        first, last = np.flatnonzero(hit & ~joined[:-1]), np.flatnonzero(hit & ~joined[1:])
        texts, lengths = block.column("text").to_pylist(), None
        if "n_chars" in block.schema.names:
            lengths = block.column("n_chars").to_pylist()
        for row in np.unique(row_of[first]):
            own = row_of[first] == row
            edges = np.concatenate([[offsets[row]], np.stack([starts[first[own]], ends[last[own]]], 1).ravel(), [offsets[row + 1]]])
            texts[row] = b"".join(values[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2], strict=True)).decode()
            if lengths is not None:
                lengths[row] = len(texts[row])
        for name, column in (("text", texts), ("n_chars", lengths)):
            if column is not None:
                k = block.schema.get_field_index(name)
                block = block.set_column(k, block.schema.field(k), pa.array(column, block.schema.field(k).type))
        yield block


def shared(benchmark: DataFrame, part_bytes: int = PART_BYTES, part_phrases: int = PART_PHRASES) -> Benchmark:
    """The phrases of all items, made by tasks and broadcast part by part."""
    spark = benchmark.sparkSession
    ship(spark)
    n = benchmark.selectExpr("coalesce(sum(octet_length(text)), 0) as n").first()["n"]
    items = benchmark.select("item_id", "text").coalesce(1 + int(n) // part_bytes)
    made = items.mapInArrow(lambda it: packed((part_bytes, part_phrases), it), "number long, words binary, phrases binary")
    made = stored(made.selectExpr("spark_partition_id() as task", "*"))
    parts = []
    for task, number in sorted(map(tuple, made.select("task", "number").collect())):
        row = made.where(f"task = {task} and number = {number}").select("words", "phrases").first()
        parts.append(tuple(spark.sparkContext.broadcast(bytes(x)) for x in row))
    return Benchmark(parts)


def scan(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """For every row its words, hit words, the items found (count and digest), and whether any was hit."""
    parts = shared(benchmark)
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(lambda it: report(parts, it), schema)


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` with removal spans cut out of ``text``; ``n_chars`` follows where it is a column."""
    parts = shared(benchmark)
    return docs.mapInArrow(lambda it: cleaned(parts, it), docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
  FROM b, LATERAL (SELECT unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i) WHERE len(w) > 0),
l AS (SELECT DISTINCT n FROM p),
o AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, l WHERE len(w) >= n)),
occ AS (SELECT doc_id, i, n, item_id FROM o JOIN p USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT doc_id, i, unnest(range(0, n)) AS k FROM occ) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM occ) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
