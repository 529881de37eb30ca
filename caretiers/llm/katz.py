"""Katz backoff model of word pairs: learning from some documents, scoring all.

P(w | h) is d(r) r / c(h) where the pair (h, w) was seen r times after a history h seen c(h) times, and
alpha(h) P(w) where it was not; P(w) is d(r) r / N for a word seen r times, and the rest for all unknown
words, which count as one. d is the Good-Turing discount of counts up to ``K``, taken from how many words, or
pairs, were seen how often; where these numbers give no discount between 0 and 1, 0.5 is taken off each
count. alpha(h) is what the discounts leave of h, by one less the P(w) of all words seen after h, so that the
probabilities of every history add up to 1. A history without a count up to ``K`` leaves 1 / (c(h) + 1);
all unknown words together have 1 / (N + 1) at least, known words so much less.
Histories are the word before or the document's begin; each document ends with an end token.

Texts are cut into blocks, runs of rows of bounded size, stored by the number of the block. Counts lie in
buckets: a word in the bucket of its hash, a pair in that of its history, and the pairs of a history with
more than a bucket's share of all tokens in several, by their words. A block sends each bucket its distinct
words (then pairs) with counts, packed and sorted; a bucket adds them up and answers in the same order. So
tokens never move, only distinct words and pairs of blocks do. All sums are whole numbers, of which discounts
and weights are made when a block scores its tokens; they don't depend on the order of tasks.

Words are compared by 64-bit hashes. A null or empty text is its end alone. Rows without an id are learnt
from (the CRC-32 of an empty text is 0) and scored; repeated rows count as often as they are there. Without
rows to learn from, every word is unknown and has probability 1. Other columns are not looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretiers.llm.common import delete, documents, scratch, shared_dir, ship, stored, temporary
from caretiers.llm.packed import added, from_steps, packed, ranges, runs, steps, unpacked
from caretiers.llm.wordhash import NOT_SPACE, mix, text_bytes, words

#: Counts up to this are discounted.
K = 5
BLOCK_BYTES = 8 << 20
#: Bytes of text that are hashed together.
BATCH_BYTES = 1 << 20
#: Bytes of text for each bucket of counts. Blocks times buckets is the number of messages.
BUCKET_BYTES = 24 << 20
#: Documents are learnt from unless CRC-32 of the id as text, modulo ``FOLDS``, is ``HELD_OUT``.
FOLDS, HELD_OUT = 7, 2
#: Hash of the end token, and the number of the history at the begin of documents.
END, BEGIN = np.uint64(0x0E17D0E17D0E17D0), 0
MESSAGE = "bucket long, block long, data binary"
REPLY = MESSAGE + ", totals array<long>"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


# Blocks and words


def stored_blocks(block_bytes: int, buckets: int):
    """Rows of documents to a row a block: documents, tokens as places in the block's words, words and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, part in enumerate(runs(batches, block_bytes, BATCH_BYTES)):
            hashes, sizes, ids, held = [], [], [], []
            for b in part:
                values, offsets = text_bytes(b.column("text"))
                _, _, found, rows = words(values, offsets, NOT_SPACE)
                hashes.append(np.insert(found, rows[1:], END))
                sizes.append(np.diff(rows) + 1)
                ids += b.column("doc_id").to_pylist()
                held += b.column("held_out").to_pylist()
            size, out = np.concatenate(sizes), np.array(held, bool)
            distinct, place = np.unique(np.concatenate(hashes), return_inverse=True)
            order = np.argsort(distinct % np.uint64(buckets), kind="stable")  # by bucket, then by hash
            distinct, number = distinct[order], np.empty(len(order), np.int64)
            number[order] = np.arange(len(order))
            place = number[place.ravel()]
            learnt = np.bincount(place[np.repeat(~out, size)], minlength=len(distinct))
            begins = np.searchsorted(distinct % np.uint64(buckets), np.arange(buckets + 1, dtype=np.uint64))
            sent = [(b, packed(steps(distinct[x:y], np.zeros(1, int)), learnt[x:y])) for b, (x, y) in enumerate(zip(begins[:-1], begins[1:], strict=True)) if y > x]
            tokens = packed(place, size)
            row = [[TaskContext.get().partitionId() << 32 | k], [ids], [held], [tokens], [[{"bucket": b, "data": d} for b, d in sent]]]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, BLOCK_TYPES, strict=True)], BLOCK_NAMES)

    return run


BLOCK = "block long, ids array<long>, held_out array<boolean>, tokens binary, sent array<struct<bucket: long, data: binary>>"
BLOCK_NAMES = ["block", "ids", "held_out", "tokens", "sent"]
BLOCK_TYPES = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.list_(pa.struct([("bucket", pa.int64()), ("data", pa.binary())]))]


def answers(bucket: int, of: list[int], data: list[bytes], times: np.ndarray) -> pa.Table:
    """A row for each block, and one without a block: how many were seen 1, 2, ... ``K`` + 1 times, all, and their sum."""
    seen = times[times > 0]
    totals = np.append(np.bincount(np.minimum(seen, K + 2), minlength=K + 3)[1 : K + 2], [len(seen), seen.sum()])
    columns = [[bucket] * (len(of) + 1), [*of, None], [*data, None], [*[None] * len(of), totals]]
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
    return pa.table([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["bucket", "block", "data", "totals"])


def word_counts(buckets: int):
    """Adds up a bucket's words; each block gets its words' numbers and counts. Numbers go from 1 on, frequent words first."""

    def run(messages: pa.Table) -> pa.Table:
        of, bucket = messages.column("block").to_pylist(), messages.column("bucket")[0].as_py()
        found = [unpacked(x) for x in messages.column("data").to_pylist()]
        hashes = np.concatenate([np.cumsum(d.view(np.uint64)) for d, _ in found])
        distinct, place = np.unique(hashes, return_inverse=True)
        times = added(place.ravel(), np.concatenate([n for _, n in found]), len(distinct))
        number = np.empty(len(distinct), np.int64)
        number[np.argsort(-times, kind="stable")] = 1 + bucket + buckets * np.arange(len(distinct))
        ends = np.cumsum([len(d) for d, _ in found])
        data = [packed(number[place[e - len(d) : e]], times[place[e - len(d) : e]]) for e, (d, _) in zip(ends.tolist(), found, strict=True)]
        return answers(bucket, of, data, times)

    return run


# Pairs


@dataclass
class Pairs:
    """The distinct pairs of a block that may have been learnt, by bucket, history and word; and the histories of each bucket."""

    held_out: np.ndarray  #: of each document
    size: np.ndarray  #: tokens of each document
    word: np.ndarray  #: of each token, its place in the block's words
    times: np.ndarray  #: of each word, how often it was learnt
    asked: np.ndarray  #: tokens that ask for a pair
    of_token: np.ndarray  #: of these, the pair
    of_history: np.ndarray  #: of each pair, the place of its history in ``history``
    learnt: np.ndarray  #: of each pair, how often in this block
    pair_word: np.ndarray  #: of each pair, its word's place
    before: np.ndarray  #: of each token, its history's place in the block's words; the begin comes after all words
    number: np.ndarray  #: of each word and the begin
    bucket: np.ndarray  #: of each row of ``history``
    history: np.ndarray  #: places of histories, by bucket and number
    run: np.ndarray  #: pairs of each row of ``history``


def pairs_of(row: pa.Table, replies: list[tuple[int, bytes]], buckets: int, total: int) -> Pairs:
    """What a block asks for, the same whenever it is made: ``replies`` are its words' numbers and counts by bucket."""
    place, size = unpacked(row.column("tokens")[0].as_py())
    out = np.array(row.column("held_out")[0].as_py(), bool)
    told = [unpacked(d) for _, d in sorted(replies)]
    number, times = (np.concatenate([t[k] for t in told]) for k in (0, 1))
    n = len(number)
    number = np.append(number, BEGIN)
    ends = np.cumsum(size) - 1
    before = np.empty(len(place), np.int64)
    before[1:] = place[:-1]
    before[ends - size + 1] = n
    seen = np.append(times, times[place[ends[0]]])  # as many begins as ends
    asked = np.flatnonzero((seen[before] > 0) & (seen[place] > 0))
    learnt = np.repeat(~out, size)[asked]
    keys, of_token = np.unique(before[asked] * n + place[asked], return_inverse=True)
    history, word = np.divmod(keys, n)
    copies = np.minimum(seen // max(1, total // buckets) + 1, buckets)
    home = (mix(number.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    dealt = (mix(number[word].astype(np.uint64) + np.uint64(1 << 40)) % copies[history].astype(np.uint64)).astype(np.int64)
    bucket = (home[history] + dealt) % buckets
    order = np.lexsort((number[word], number[history], bucket))
    moved = np.empty(len(order), np.int64)
    moved[order] = np.arange(len(order))
    of_token, bucket, history, word = moved[of_token.ravel()], bucket[order], history[order], word[order]
    # A history has a row in each of its buckets, with or without pairs of this block: each knows a part of what followed it.
    own = np.unique(before[seen[before] > 0])
    every = (np.repeat(home[own], copies[own]) + ranges(np.zeros(len(own), int), copies[own])) % buckets
    rows = np.unique(np.stack([every, np.repeat(number[own], copies[own]), np.repeat(own, copies[own])], 1), axis=0)
    rank = np.empty(n + 1, np.int64)
    rank[np.argsort(number)] = np.arange(n + 1)
    of_history = np.searchsorted(rows[:, 0] * (n + 1) + rank[rows[:, 2]], bucket * (n + 1) + rank[history])
    run = np.bincount(of_history, minlength=len(rows))
    return Pairs(out, size, place, times, asked, of_token, of_history, np.bincount(of_token[learnt], minlength=len(word)), word, before, number, rows[:, 0], rows[:, 2], run)


def by_bucket(p: Pairs) -> Iterator[tuple[int, slice, slice]]:
    """Buckets that a block asks, with their rows of histories and of pairs."""
    ends = np.cumsum(p.run)
    edges = np.flatnonzero(np.diff(p.bucket, prepend=-1))
    for x, y in zip(edges.tolist(), [*edges.tolist(), len(p.bucket)][1:], strict=True):
        yield int(p.bucket[x]), slice(x, y), slice(int(ends[x] - p.run[x]), int(ends[y - 1]))


def asking(buckets: int, total: int):
    """A block's message to each bucket: histories, their pairs' words, how often learnt here, and the words' counts."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        p = pairs_of(left, replies(right), buckets, total)
        of, data = [], []
        for bucket, h, x in by_bucket(p):
            sizes = p.run[h]
            firsts = (np.cumsum(sizes) - sizes)[sizes > 0]
            data.append(packed(steps(p.number[p.history[h]], np.zeros(1, int)), sizes, steps(p.number[p.pair_word[x]], firsts), p.learnt[x], p.times[p.pair_word[x]]))
            of.append(bucket)
        block = left.column("block")[0].as_py()
        return pa.table([pa.array(of, pa.int64()), pa.array([block] * len(of), pa.int64()), pa.array(data, pa.binary())], ["bucket", "block", "data"])

    return run


def replies(right: pa.Table) -> list[tuple[int, bytes]]:
    return list(zip(right.column("bucket").to_pylist(), right.column("data").to_pylist(), strict=True))


def pair_counts(messages: pa.Table) -> pa.Table:
    """Adds up a bucket's pairs. Each block gets its pairs' counts and, for its histories, what they were followed by.

    That is the sum of their pairs' counts, how many pairs have each count up to ``K``, and the same of the
    counts of the words in these pairs.
    """
    of, bucket = messages.column("block").to_pylist(), messages.column("bucket")[0].as_py()
    found = [unpacked(x) for x in messages.column("data").to_pylist()]
    histories, place = np.unique(np.concatenate([np.cumsum(f[0]) for f in found]), return_inverse=True)
    sizes = np.concatenate([f[1] for f in found])
    numbers = np.concatenate([from_steps(f[2], f[1]) for f in found])
    distinct, word = np.unique(numbers, return_inverse=True)
    after = np.repeat(place.ravel(), sizes)
    keys, first, pair = np.unique(after * max(1, len(distinct)) + word.ravel(), return_index=True, return_inverse=True)
    times = added(pair.ravel(), np.concatenate([f[3] for f in found]), len(keys))
    here, of_word = after[first], np.concatenate([f[4] for f in found])[first]
    seen = times > 0
    told = []
    for values in (times, of_word):
        told.append(added(here[seen], values[seen], len(histories)))
        told += [np.bincount(here[seen & (values == r)], minlength=len(histories)) for r in range(1, K + 1)]
    data, x, y = [], 0, 0
    for f in found:
        own, mine = place.ravel()[x : x + len(f[0])], pair.ravel()[y : y + len(f[2])]
        data.append(packed(times[mine], *(t[own] for t in told)))
        x, y = x + len(f[0]), y + len(f[2])
    return answers(bucket, of, data, times)


# Probabilities


def discounts(seen: np.ndarray) -> np.ndarray:
    """Good-Turing discounts of counts 0 to ``K`` (of 0: 1) from how many things were seen 1, 2, ... ``K`` + 1 times."""
    n = [0.0, *seen[: K + 1].tolist()]
    for k in range(K, 1, -1):
        if all(n[1 : k + 2]):
            common = (k + 1) * n[k + 1] / n[1]
            d = [((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if common != 1 else 0.0 for r in range(1, k + 1)]
            if all(0 < x < 1 for x in d):
                return np.array([1.0, *d, *[1.0] * (K - k)])
    return np.array([1.0, *[(r - 0.5) / r for r in range(1, K + 1)]])


@dataclass
class Model:
    """What all tasks know: discounts of words and pairs, the tokens learnt and the distinct ones among them."""

    words: np.ndarray
    pairs: np.ndarray
    total: int
    distinct: int
    unknown: float  #: probability of an unknown word
    kept: float  #: what counts of words are multiplied with, beside their discounts

    @staticmethod
    def of(word_totals: np.ndarray, pair_totals: np.ndarray) -> Model:
        """From the sums of the buckets' totals, as ``answers`` gives them."""
        total, d = int(word_totals[-1]), discounts(word_totals)
        left = float((np.arange(1, K + 1) * word_totals[:K] * (1 - d[1:])).sum())
        unknown = max(left / total, 1 / (total + 1)) if total else 1.0
        return Model(d, discounts(pair_totals), total, int(word_totals[-2]), unknown, (1 - unknown) / (total - left) if total > left else 0.0)

    def word(self, times: np.ndarray) -> np.ndarray:
        """P(w) of words that were learnt so often."""
        return np.where(times > 0, self.kept * self.words[np.where(times <= K, times, 0)] * times, self.unknown)

    def histories(self, told: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """What counts of pairs are multiplied with, beside their discounts, and alpha. No pairs: 0 and 1."""
        (total, *seen), (of_words, *words) = told[: K + 1], told[K + 1 :]
        left = sum(r * n * (1 - self.pairs[r]) for r, n in enumerate(seen, 1))
        free = np.where(left > 0, left / np.maximum(total, 1), 1 / (total + 1))
        known = self.kept * (of_words - sum(r * n * (1 - self.words[r]) for r, n in enumerate(words, 1)))
        some = total > 0
        return np.where(some, (1 - free) / np.where(some, total - left, 1), 0.0), np.where(some, free / (1 - known), 1.0)


def scoring(buckets: int, model: Model):
    """Every document of a block, from its words' and its pairs' counts."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        of_pairs = np.array(right.column("of_pairs").to_pylist(), bool)
        found = replies(right)
        p = pairs_of(left, [x for x, second in zip(found, of_pairs, strict=True) if not second], buckets, model.total)
        told = [unpacked(d) for _, d in sorted(x for x, second in zip(found, of_pairs, strict=True) if second)]
        n = len(p.times)
        pair_times, *rows = (np.concatenate([t[k] for t in told]) if told else np.zeros(0, np.int64) for k in range(2 * K + 3))
        history = [added(p.history, x, n + 1) for x in rows]
        weight, alpha = model.histories(history)
        times = p.times[p.word]
        chance = alpha[p.before] * model.word(times)
        seen = pair_times[p.of_token]
        some = p.asked[seen > 0]
        seen = seen[seen > 0]
        chance[some] = weight[p.before[some]] * model.pairs[np.where(seen <= K, seen, 0)] * seen
        base = np.log10((times + 1) / (model.total + model.distinct + 1))
        begins = np.cumsum(p.size) - p.size
        sums = [np.add.reduceat(x, begins) for x in ((times > 0).astype(np.int64), base, np.log10(chance))]
        columns = [left.column("ids")[0].as_py(), p.held_out, p.size, sums[0], np.full(len(begins), model.total), *sums[1:]]
        return pa.table([pa.array(c, t) for c, t in zip(columns, SCORE_TYPES, strict=True)], SCORE_NAMES)

    return run


SCORE_NAMES = [x.split()[0] for x in SCORES.split(", ")]
SCORE_TYPES = [pa.int64(), pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2]


def totals(counts: DataFrame) -> np.ndarray:
    """The sums of the buckets' totals: ``K`` + 3 numbers."""
    out = np.zeros(K + 3, np.int64)
    for r in counts.select(F.posexplode("totals").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[r["k"]] = r["n"]
    return out


def score(docs: DataFrame, held_out: str | None = None, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Tokens, known tokens, and the log10 probability by words alone (one added to counts) and by the model.

    ``held_out`` is the SQL condition of rows that are not learnt from.
    """
    spark = docs.sparkSession
    ship(spark)
    held_out = held_out or f"coalesce(crc32(cast(doc_id as string)) % {FOLDS} = {HELD_OUT}, false)"
    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", f"{held_out} as held_out", "text")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = 8 + size // bucket_bytes
    table, path = f"caretiers_katz_{uuid.uuid4().hex}", shared_dir(spark)
    # Stored by block, so that blocks stay in their place while answers come to them.
    made = rows.mapInArrow(stored_blocks(block_bytes, buckets), BLOCK)
    places = max(2 * buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    made.write.bucketBy(places, "block").option("path", path).option("compression", "zstd").saveAsTable(table)
    temporary(spark, path)
    kept = spark.table(table)
    with scratch() as keep:
        found = keep(stored(_scores(kept, buckets)))
    spark.sql(f"DROP TABLE {table}")
    delete(spark, path)
    return found


def _scores(kept: DataFrame, buckets: int) -> DataFrame:
    """What ``score`` gives, from the stored blocks."""
    sent = kept.select("block", F.explode("sent").alias("m")).select("m.bucket", "block", "m.data")
    of_words = stored(sent.groupBy("bucket").applyInArrow(word_counts(buckets), REPLY))
    word_totals = totals(of_words)
    known = of_words.where("block is not null").drop("totals")
    asked = kept.select("block", "held_out", "tokens").groupBy("block").cogroup(known.groupBy("block")).applyInArrow(asking(buckets, int(word_totals[-1])), MESSAGE)
    of_pairs = stored(asked.groupBy("bucket").applyInArrow(pair_counts, REPLY))
    model = Model.of(word_totals, totals(of_pairs))
    both = known.withColumn("of_pairs", F.lit(False)).unionByName(of_pairs.where("block is not null").drop("totals").withColumn("of_pairs", F.lit(True)))
    return kept.select("block", "ids", "held_out", "tokens").groupBy("block").cogroup(both.groupBy("block")).applyInArrow(scoring(buckets, model), SCORES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))


