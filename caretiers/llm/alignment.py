"""Alignment of two tokenizers' tokens over all documents, with corpus-wide counts of linked ids.

Rows are shuffled by their full text, so that each distinct text is tokenised and aligned once, however
many rows hold it. Both tokenizers' tokens are laid over the text's bytes; a token of each that end at the
same byte are linked, and links cut the text into groups. A block is a run of texts of bounded size
inside a partition: it is stored with each text's pairs of linked ids, as places among the block's distinct
pairs. These go to buckets by their id of the second tokenizer, with their counts weighted by how many rows
hold each text, packed. A bucket sums the counts of all blocks and answers each block in the same order,
and the block gives its texts' measures.

Measures are joined to rows by the text's SHA-256. A text on very many rows is split: its rows are dealt
over as many copies of its measures as it has shares of ``common.share`` rows. All that is broadcast is
which texts are split, at most 10,000.

Texts that are null, empty, or that a tokenizer does not give back byte for byte have no tokens: all
measures 0, the digest an empty text. Rows without an id or with equal ids are rows of their own. Other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretiers.llm.common import documents, scratch, ship, spread_join, stored
from caretiers.llm.packed import added, from_steps, packed, runs, steps, unpacked
from caretiers.llm.wordhash import mix

FIRST = "byte_bpe_50k.json"
SECOND = "piece_bpe_32k.model"
BLOCK_BYTES = 16 << 20
#: Bytes of text for each bucket of pairs.
BUCKET_BYTES = 64 << 20
#: Bytes of text that are tokenised together.
BATCH_BYTES = 1 << 20
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class Tokenizers:
    """Both tokenizers, and the bytes of their tokens by id."""

    def __init__(self, first: str, second: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        from caretiers.llm.encoding import _byte_letters

        self.first = Tokenizer.from_file(public_tokenizers.path(first))
        self.first.encode_special_tokens = True
        self.second = SentencePieceProcessor(model_file=public_tokenizers.path(second))
        byte_of = {letter: byte for byte, letter in _byte_letters().items()}
        a = self.first.get_vocab(with_added_tokens=True)
        self.a = [b""] * (max(a.values()) + 1)
        for token, i in a.items():
            self.a[i] = bytes(map(byte_of.__getitem__, token)) if all(c in byte_of for c in token) else token.encode()
        pieces = map(self.second.id_to_piece, range(self.second.get_piece_size()))
        self.b = [bytes([int(p[3:-1], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], np.int64) for t in (self.a, self.b))
        #: An id of the first and what follows it, within its group or last in it; then those of the second.
        self.written = [b"%d%s" % (i, end) for t, ends in ((self.a, b",|"), (self.b, b",;")) for i in range(len(t)) for end in (ends[:1], ends[1:])]

    def tokens(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both for each text; none for a text that either does not give back."""
        spaced = [" " + t for t in texts]
        first = [e.ids for e in self.first.encode_batch_fast(spaced, add_special_tokens=False)]
        second = self.second.encode(texts, num_threads=1)
        for k, text in enumerate(spaced):
            data = text.encode()
            if data == b" " or any(b"".join(map(t.__getitem__, ids)) != data for t, ids in ((self.a, first[k]), (self.b, second[k]))):
                first[k], second[k] = [], []
        return first, second


@cache
def tokenizers(first: str, second: str) -> Tokenizers:
    """Loaded once in a Python worker."""
    return Tokenizers(first, second)


def flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids and where each text's begin."""
    begins = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
    return np.fromiter((i for x in ids for i in x), np.int64, int(begins[-1])), begins


def align(both: Tokenizers, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Links of some texts as ``b << 32 | a``, each link's text, ``n_a`` and ``n_b`` per text, and the groups' digests."""
    (a, a_begins), (b, b_begins) = map(flat, both.tokens(texts))
    a_ends, b_ends = np.cumsum(both.a_sizes[a]), np.cumsum(both.b_sizes[b])
    ends = np.zeros(int(a_ends[-1]) + 1 if len(a) else 1, np.int8)
    ends[a_ends] = 1
    ends[b_ends] += 2
    a_last, b_last = ends[a_ends] == 3, ends[b_ends] == 3
    a_at, b_at = np.flatnonzero(a_last), np.flatnonzero(b_last)
    text_of = np.searchsorted(a_begins, a_at, "right") - 1
    # A group's ids of the first come before those of the second, and both after all earlier groups.
    codes = np.empty(len(a) + len(b), np.int64)
    a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    codes[np.arange(len(a)) + np.concatenate([[0], b_at + 1])[a_group]] = 2 * a + a_last
    codes[np.arange(len(b)) + np.concatenate([a_at + 1, [0]])[b_group]] = 2 * (len(both.a) + b) + b_last
    edges = a_begins + b_begins
    written = list(map(both.written.__getitem__, codes.tolist()))
    digests = [hashlib.sha256(b"".join(written[x:y])[:-1]).hexdigest() if y > x else "" for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
    return b[b_at] << 32 | a[a_at], text_of, np.stack([np.diff(a_begins), np.diff(b_begins)], 1), digests


BLOCK = "block long, texts binary, sent array<struct<bucket: long, data: binary>>"
BLOCK_TYPES = [pa.int64(), pa.binary(), pa.list_(pa.struct([("bucket", pa.int64()), ("data", pa.binary())]))]
MESSAGE = "bucket long, block long, data binary"


def stored_block(names: tuple[str, str], limits: tuple[int, int], buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each block: its number, its texts' links, and a message to each bucket that has some of its pairs.

    A pair is in the bucket of its id of the second tokenizer.
    """
    both = tokenizers(*names)
    for k, parts in enumerate(runs(batches, *limits)):
        links, owners, sizes, groups, rows, texts = [], [], [], [], [], []
        for part in parts:
            link, owner, size, digest = align(both, part.column("text").to_pylist())
            links.append(link)
            owners.append(owner + len(groups))
            sizes.append(size)
            groups += digest
            rows += part.column("n").to_pylist()
            texts += part.column("digest").to_pylist()
        link, owner, size, rows = np.concatenate(links), np.concatenate(owners), np.concatenate(sizes), np.array(rows, np.int64)
        pairs, place = np.unique(link, return_inverse=True)
        home = (mix((pairs >> 32).astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        pairs, home, moved = pairs[order], home[order], np.empty(len(order), np.int64)
        moved[order] = np.arange(len(order))
        held, times = np.unique(owner * max(len(pairs), 1) + moved[place.ravel()], return_counts=True)
        owner, place = np.divmod(held, max(len(pairs), 1))
        weights = added(place, times * rows[owner], len(pairs))
        begins = np.searchsorted(owner, np.arange(len(groups) + 1))
        found = (texts, rows, size, groups, begins, packed(steps(place, begins[:-1][np.diff(begins) > 0]), times))
        edges = np.flatnonzero(np.diff(home, prepend=-1))
        sent = [
            {"bucket": int(home[x]), "data": packed(steps(pairs[x:y], np.zeros(1, int)), weights[x:y])}
            for x, y in zip(edges.tolist(), [*edges.tolist(), len(home)][1:], strict=True)
        ]
        row = [[TaskContext.get().partitionId() << 32 | k], [zstandard.compress(pickle.dumps(found, pickle.HIGHEST_PROTOCOL), 1)], [sent]]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, BLOCK_TYPES, strict=True)], ["block", "texts", "sent"])


def pair_counts(messages: pa.Table) -> pa.Table:
    """Adds up a bucket's pairs; each block gets its pairs' counts, and whether each is the highest of its id."""
    bucket, of = messages.column("bucket")[0].as_py(), messages.column("block").to_pylist()
    found = [unpacked(x) for x in messages.column("data").to_pylist()]
    pairs, place = np.unique(np.concatenate([np.cumsum(p) for p, _ in found]), return_inverse=True)
    place = place.ravel()
    counts = added(place, np.concatenate([n for _, n in found]), len(pairs))
    own = np.flatnonzero(np.diff(pairs >> 32, prepend=-1))
    best = counts == np.repeat(np.maximum.reduceat(counts, own), np.diff([*own, len(pairs)]))
    ends = np.cumsum([len(p) for p, _ in found])
    mine = [place[e - len(p) : e] for e, (p, _) in zip(ends.tolist(), found, strict=True)]
    columns = [[bucket] * len(of), of, [packed(counts[m], best[m]) for m in mine]]
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["bucket", "block", "data"])


def measured(left: pa.Table, right: pa.Table) -> pa.Table:
    """The measures of a block's texts from the counts of its pairs."""
    digest, rows, size, groups, begins, links = pickle.loads(zstandard.decompress(left.column("texts")[0].as_py()))
    place, times = unpacked(links)
    place = from_steps(place, np.diff(begins))
    told = [unpacked(data) for _, data in sorted(zip(right.column("bucket").to_pylist(), right.column("data").to_pylist(), strict=True))]
    counts, best = (np.concatenate([np.zeros(0, np.int64), *(t[k] for t in told)]) for k in (0, 1))

    def sums(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[begins[1:]] - total[begins[:-1]]

    linked = sums(times)
    columns = [digest, rows, size[:, 0], size[:, 1], linked, linked, sums(times * best[place]), sums(times * counts[place]), groups]
    return pa.table([pa.array(c, k) for c, k in zip(columns, [pa.binary(), *[pa.int64()] * 7, pa.string()], strict=True)], ["digest", "n", *MEASURES, "groups_sha256"])


def text_measures(
    texts: DataFrame, buckets: int, first: str = FIRST, second: str = SECOND, block_bytes: int = BLOCK_BYTES, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """Measures of distinct texts (``text``, and ``n``, the rows that hold it) by their ``digest``."""
    ship(texts.sparkSession)
    rows = texts.select("text", "n", F.unhex(F.sha2("text", 256)).alias("digest"))
    kept = stored(rows.mapInArrow(lambda it: stored_block((first, second), (block_bytes, batch_bytes), buckets, it), BLOCK))
    sent = kept.select("block", F.explode("sent").alias("m")).select("m.bucket", "block", "m.data")
    replies = stored(sent.groupBy("bucket").applyInArrow(pair_counts, MESSAGE))
    schema = "digest binary, n long, " + ", ".join(f"{m} long" for m in MEASURES) + ", groups_sha256 string"
    return kept.select("block", "texts").groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(measured, schema)


def measure(docs: DataFrame, first: str = FIRST, second: str = SECOND, block_bytes: int = BLOCK_BYTES, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Every row's ``doc_id``, tokens of both, groups, links, best links, summed counts and the groups' digest."""
    texts = docs.where("text <> ''").groupBy("text").agg(F.count("*").alias("n"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    with scratch() as kept:
        found = kept(stored(text_measures(texts, 8 + size // BUCKET_BYTES, first, second, block_bytes, batch_bytes)))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.expr("if(text <> '', unhex(sha2(text, 256)), null)").alias("digest"))
    both = spread_join(rows, found, "digest", "n", "left")
    return both.select("doc_id", *[F.coalesce(m, F.lit(0)).alias(m) for m in MEASURES], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure(documents(spark, sf_dir))
