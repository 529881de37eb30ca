"""Documents linked by the Jaccard similarity of their five-word shingles, by a prefix-tree join.

1. Texts with the same set of shingles are one class, named by a hash of the set.
2. Shingles get a global order: those that recur inside the blocks of a task last, by their counts,
   the others by hash. Any order gives right results; this one keeps common passages out of prefixes.
3. Two sets of similarity ``PERCENT`` share a shingle among their first n - ceil(0.75 n) + 1. These are dealt
   by shingle, once: for every one the smallest class that has it leads; the others become members of the
   leader's bucket. A shingle known for very many rows is dealt in parts, whose smallest classes then meet.
4. In a bucket, sizes and sketches, whose differing bits bound the differing shingles from below, drop
   members without a possible partner before any text moves. The others' ordered sets go one by one
   into a trie of shared prefixes. Each set first walks the trie, carrying the overlap so far; a branch
   is left when what remains of its longest set cannot bring the overlap to the bound, when its sets
   are too long, or when all are in the same component.
5. Links make components. A large bucket is dealt into chunks of bounded size, each with the leader. Its
   members that did not join the leader's component then meet every other chunk, in blocks.

Every pair that shares a prefix shingle is thus either compared or already connected. A shingle or class
in a third of all rows is summed before the shuffle, and its bucket is split; no pairs are listed.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z became a-z. A text of fewer than five words is one shingle;
without words it has none and is linked with nothing. Rows with equal ids count as separate documents
of that id; rows without an id take the smallest id of their component, or none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretiers.llm.common import documents, scratch, share, ship, spread_join, stored
from caretiers.llm.graph import components
from caretiers.llm.wordhash import NOT_SPACE, blocks, mix, shingles, text_bytes, words

PERCENT = 75
#: Texts in a block of rows.
BLOCK_BYTES = 8 << 20
#: Rows in a block: their numbers stand above a shingle's bits.
BLOCK_ROWS = 4095
BITS = np.uint64(52)
TOKEN = np.uint64((1 << 52) - 1)
#: A shingle this often in a block of texts is reported as recurring.
RECURS = 2
#: Most frequent recurring shingles that are ordered by count; the others go by hash. Sets the order only.
ORDERED = 200_000
#: Parts into which a shingle's rows are dealt, at most: their numbers stand above a shingle's bits.
PARTS = 4095
#: Shingles, and sets, in a chunk of a bucket.
CHUNK = 2_000_000
CHUNK_SETS = 4_000
#: Bits that tell which texts are wanted, 8 MB in all. Too many wanted texts make them tell less, nothing worse.
WANTED_BITS = 1 << 26


def sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct shingles, ascending, and where each row's begin. At most ``BLOCK_ROWS`` rows."""
    values, offsets = text_bytes(column)
    _, _, hashes, rows = words(values, offsets, NOT_SPACE)
    found, begins = shingles(hashes, rows)
    row = np.repeat(np.arange(len(column), dtype=np.uint64), np.diff(begins))
    found = np.sort(row << BITS | found >> np.uint64(64 - int(BITS)))
    found = found[np.concatenate([[True], found[1:] != found[:-1]])[: len(found)]]
    return found & TOKEN, np.searchsorted(found, np.arange(len(column) + 1, dtype=np.uint64) << BITS)


def signatures(found: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A hash of each row's set, as a signed integer."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(found ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    sizes = np.diff(begins).astype(np.uint64)
    return mix(sums[begins[1:]] - sums[begins[:-1]] + sizes * np.uint64(0x2545F4914F6CDD1D)).view(np.int64)


def sketches(found: np.ndarray, begins: np.ndarray) -> list[bytes]:
    """For each row, how often its shingles fall on each bit, modulo 2; as many bits as shingles, to a power of two.

    Two sketches differ in no more bits than the sets in shingles.
    """
    sizes = np.diff(begins)
    wide = sketch_words(sizes)
    first = np.cumsum(wide) - wide
    bit = found & (np.repeat(wide, sizes) * 64 - 1).astype(np.uint64)
    out = np.zeros(int(wide.sum()), np.uint64)
    np.bitwise_xor.at(out, np.repeat(first, sizes) + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    data = out.tobytes()
    return [data[8 * a : 8 * (a + n)] for a, n in zip(first.tolist(), wide.tolist(), strict=True)]


def sketch_words(sizes: np.ndarray) -> np.ndarray:
    return 1 << np.ceil(np.log2(np.maximum(sizes, 64) / 64)).astype(np.int64)


def firsts(signature: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows of a block that are the first of their class and have a shingle."""
    _, first = np.unique(signature, return_index=True)
    return np.sort(first[sizes[first] > 0])


def picked(found: np.ndarray, begins: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first ``counts`` entries of some rows, and the row of each."""
    at = np.repeat(begins[rows] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    return found[at], np.repeat(rows, counts)


class Order:
    """The global order of shingles: the known ones last, by their places, the others by hash."""

    def __init__(self, token: np.ndarray, place: np.ndarray, parts: np.ndarray) -> None:
        by_token = np.argsort(token)
        self.token, self.place = token[by_token], place[by_token]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[token & np.uint64(len(self.maybe) - 1)] = True
        several = parts[by_token] > 1
        self.often, self.parts = self.token[several], parts[by_token][several].astype(np.uint64)

    def apply(self, found: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Every row's shingles (ascending by hash) in this order."""
        at = np.flatnonzero(self.maybe[found & np.uint64(len(self.maybe) - 1)])
        if not len(at):
            return found
        where = np.minimum(np.searchsorted(self.token, found[at]), len(self.token) - 1)
        known = self.token[where] == found[at]
        at, where = at[known], where[known]
        row = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
        last = (row * 2).astype(np.uint16)
        last[at] += 1
        out = found[np.argsort(last, kind="stable")]
        slots = np.flatnonzero(np.sort(last, kind="stable") & 1)
        out[slots] = found[at][np.lexsort((found[at], self.place[where], row[at]))]
        return out

    def dealt(self, token: np.ndarray, signature: np.ndarray) -> np.ndarray:
        """The shingles, those in very many rows with the number of their class's part, from 1 on, above."""
        if not len(self.often):
            return token
        where = np.minimum(np.searchsorted(self.often, token), len(self.often) - 1)
        part = mix(signature.view(np.uint64)) % self.parts[where] + np.uint64(1)
        return np.where(self.often[where] == token, token | part << BITS, token)


CLASSES = "doc_id long, key long, n long, sig long, sketch binary, token long, count long"


def class_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document with its class, and one for each shingle that recurs in the block."""
    for b in blocks(batches, "text", BLOCK_BYTES, BLOCK_ROWS):
        found, begins = sets(b.column("text"))
        sizes, signature = np.diff(begins), signatures(found, begins)
        rows = firsts(signature, sizes)
        held, count = np.unique(picked(found, begins, rows, sizes[rows])[0], return_counts=True)
        often = count >= RECURS
        known, more = len(sizes), int(often.sum())
        columns = [b.column("doc_id"), b.column("key"), pa.array(sizes.astype(np.int64)), pa.array(signature), pa.array(sketches(found, begins), pa.binary())]
        columns = [pa.concat_arrays([c, pa.nulls(more, c.type)]) for c in columns]
        columns += [pa.concat_arrays([pa.nulls(known, pa.int64()), pa.array(x[often].astype(np.int64))]) for x in (held, count)]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in CLASSES.split(", ")])


def prefixes(order, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in blocks(batches, "text", BLOCK_BYTES, BLOCK_ROWS):
        found, begins = sets(b.column("text"))
        sizes, signature = np.diff(begins), signatures(found, begins)
        rows = firsts(signature, sizes)
        found = order.value.apply(found, begins)
        token, row = picked(found, begins, rows, sizes[rows] - (PERCENT * sizes[rows] + 99) // 100 + 1)
        token = order.value.dealt(token, signature[row])
        yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(signature[row]), pa.array(sizes[row].astype(np.int32))], ["token", "sig", "n"])


LED = "token long, leader long, sig long, n int"


def led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shingle; those of shingles that several classes have, with the smallest of these.

    Rows of a shingle that is dealt in parts all stay, with the smallest class of the part, and keep the shingle.
    """
    held: list[pa.RecordBatch] = []

    def judged(t: pa.Table) -> list[pa.RecordBatch]:
        token, sig = t["token"].to_numpy(), t["sig"].to_numpy()
        begins = np.concatenate([[0], np.flatnonzero(token[1:] != token[:-1]) + 1])
        least, last = np.minimum.reduceat(sig, begins), np.maximum.reduceat(sig, begins)
        part = token.view(np.uint64) > TOKEN
        sizes = np.diff(begins, append=len(token))
        keep = np.flatnonzero(np.repeat(least < last, sizes) | part)
        known = pa.array((token & np.int64(TOKEN))[keep], mask=~part[keep])
        return [pa.RecordBatch.from_arrays([known, pa.array(np.repeat(least, sizes)[keep]), pa.array(sig[keep]), pa.array(t["n"].to_numpy()[keep])], ["token", "leader", "sig", "n"])]

    for b in batches:
        # Whole shingles only: what follows the last border waits for the next batch.
        token = b.column("token").to_numpy()
        borders = np.flatnonzero(token[1:] != token[:-1])
        if len(borders):
            yield from judged(pa.Table.from_batches([*held, b.slice(0, borders[-1] + 1)]))
            held, b = [], b.slice(borders[-1] + 1)
        if b.num_rows:
            held.append(b)
    if held:
        yield from judged(pa.Table.from_batches(held))


def with_partner(n: np.ndarray, sketch: list[bytes]) -> np.ndarray:
    """Which sets may be similar to another one, as far as sizes and sketches tell; none that is goes."""
    out = np.zeros(len(n), bool)
    wide = sketch_words(n)
    for w in np.unique(wide):
        at = np.flatnonzero(wide == w)
        bits = np.frombuffer(b"".join(sketch[i] for i in at), np.uint64).reshape(len(at), w)
        above = np.flatnonzero(wide == 2 * w)
        folded = np.frombuffer(b"".join(sketch[i] for i in above), np.uint64).reshape(len(above), 2, w)
        bits, both = np.concatenate([bits, folded[:, 0] ^ folded[:, 1]]), np.concatenate([at, above])
        sizes = n[both]
        for i in range(len(at)):
            rest = slice(i + 1, None)
            fits = 100 * np.minimum(sizes[rest], sizes[i]) >= PERCENT * np.maximum(sizes[rest], sizes[i])
            apart = np.bitwise_count(bits[rest] ^ bits[i]).sum(1, dtype=np.int64)
            close = fits & ((100 + PERCENT) * apart <= (100 - PERCENT) * (sizes[rest] + sizes[i]))
            if close.any():
                out[both[i]] = True
                out[both[rest][close]] = True
    return out


PLACED = "leader long, chunk string, sig long"


def hopeful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket; those with a possible partner in theirs."""
    held: list[pa.RecordBatch] = []

    def judged(t: pa.Table) -> list[pa.RecordBatch]:
        n, sketch = t["n"].to_numpy(), t["sketch"].to_pylist()
        leader, chunk = t["leader"].to_numpy(), t["chunk"].to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero((leader[1:] != leader[:-1]) | (chunk[1:] != chunk[:-1])) + 1), len(n)]
        keep = np.concatenate([with_partner(n[a:b], sketch[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)])
        return t.select(["leader", "chunk", "sig"]).filter(pa.array(keep)).to_batches()

    for b in batches:
        # Whole buckets only: what follows the last border waits for the next batch.
        leader, chunk = b.column("leader").to_numpy(), b.column("chunk").to_numpy(zero_copy_only=False)
        borders = np.flatnonzero((leader[1:] != leader[:-1]) | (chunk[1:] != chunk[:-1]))
        if len(borders):
            yield from judged(pa.Table.from_batches([*held, b.slice(0, borders[-1] + 1)]))
            held, b = [], b.slice(borders[-1] + 1)
        if b.num_rows:
            held.append(b)
    if held:
        yield from judged(pa.Table.from_batches(held))


class Trie:
    """Ordered sets sharing their prefixes; walks find sets similar to a new one in another component."""

    # A node: [tokens on the edge to it, children by first token, longest, shortest, one set, mixed, sets that end here]
    def __init__(self) -> None:
        self.root = [(), {}, 0, 1 << 62, -1, False, []]
        self.parent: list[int] = []

    def component(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def add(self, tokens: tuple[int, ...]) -> None:
        """Joins the set's component with those of similar sets in the trie, then stores the set."""
        me = len(self.parent)
        self.parent.append(me)
        self._walk(me, tokens)
        self._store(me, tokens)

    def _walk(self, me: int, tokens: tuple[int, ...]) -> None:
        n, held = len(tokens), set(tokens)
        stack = [(child, 0, 0) for child in self.root[1].values()]
        while stack:
            (edge, children, longest, shortest, one, mixed, ends), depth, overlap = stack.pop()
            if (100 + PERCENT) * n < PERCENT * (n + shortest) or (not mixed and self.component(one) == self.component(me)):
                continue
            # The overlap o with a set of m must satisfy (100 + PERCENT) o >= PERCENT (n + m).
            missing = ((100 + PERCENT) * longest - PERCENT * (n + longest)) // (100 + PERCENT) - (depth - overlap)
            for token in edge:
                if token in held:
                    overlap += 1
                else:
                    missing -= 1
                    if missing < 0:
                        break
            if missing < 0:
                continue
            depth += len(edge)
            if ends and (100 + PERCENT) * overlap >= PERCENT * (n + depth):
                self.parent[self.component(ends[0])] = self.component(me)
            stack.extend((child, depth, overlap) for child in children.values())

    def _store(self, me: int, tokens: tuple[int, ...]) -> None:
        n, at, node = len(tokens), 0, self.root
        while True:
            node[2], node[3] = max(node[2], n), min(node[3], n)
            if node[4] < 0:
                node[4] = me
            elif self.component(node[4]) != self.component(me):
                node[5] = True
            if at == n:
                node[6].append(me)
                return
            child = node[1].get(tokens[at])
            if child is None:
                node[1][tokens[at]] = [tokens[at:], {}, n, n, me, False, [me]]
                return
            edge, same = child[0], 0
            most = min(len(edge), n - at)
            while same < most and edge[same] == tokens[at + same]:
                same += 1
            if same < len(edge):
                lower = [edge[same:], *child[1:]]
                child[:] = [edge[:same], {edge[same]: lower}, child[2], child[3], child[4], child[5], []]
            at, node = at + same, child


def bucket_links(order, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``leader`` and ``chunk``; from every bucket, its components as links to one class."""
    trie, names, key = Trie(), {}, None

    def links() -> list[tuple[int, int]]:
        own = list(names)
        return [(own[i], own[trie.component(i)]) for i in range(len(own)) if trie.component(i) != i]

    for b in blocks(batches, "text", BLOCK_BYTES, BLOCK_ROWS):
        found, begins = sets(b.column("text"))
        found = order.value.apply(found, begins)
        out = []
        for i, (leader, chunk, sig) in enumerate(zip(*(b.column(c).to_pylist() for c in ("leader", "chunk", "sig")), strict=True)):
            if (leader, chunk) != key:
                out += links()
                trie, names, key = Trie(), {}, (leader, chunk)
            if sig not in names:
                names[sig] = True
                trie.add(tuple(found[begins[i] : begins[i + 1]].tolist()))
        yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})
    out = links()
    yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def shingle_order(counted: DataFrame, most: int):
    """Recurring shingles and their places behind all others, broadcast; at most ``ORDERED``.

    Those in over ``most`` rows are dealt in parts. A shingle that recurs in no block has a row a block at most.
    """
    top = counted.groupBy("token").agg(F.sum("count").alias("count")).orderBy(F.desc("count"), "token").limit(ORDERED).collect()
    parts = np.minimum(np.array([r[1] for r in top], np.int64) // most + 1, PARTS)
    order = Order(np.array([r[0] for r in top], np.int64).view(np.uint64), np.arange(len(top), 0, -1), parts)
    return counted.sparkSession.sparkContext.broadcast(order)


def maybe_among(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``_maybe``, false where the number in the column ``key`` is certainly not among those of ``keys``.

    A bitmap of fixed size is broadcast for that; rows don't move.
    """
    place = f"pmod({key}, {WANTED_BITS}L)"
    maps = keys.groupBy(F.expr(f"bitmap_bucket_number({place})").alias("_bucket")).agg(F.expr(f"bitmap_construct_agg(bitmap_bit_position({place}))").alias("_bits"))
    both = rows.join(F.broadcast(maps), F.expr(f"bitmap_bucket_number({place}) = _bucket"), "left")
    byte = f"cast(conv(hex(substring(_bits, cast(bitmap_bit_position({place}) div 8 as int) + 1, 1)), 16, 10) as int)"
    maybe = F.expr(f"coalesce(getbit({byte}, cast(bitmap_bit_position({place}) % 8 as int)) = 1, false)")
    return both.withColumn("_maybe", maybe).drop("_bucket", "_bits")


def maybe_wanted(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose key may be among ``keys``."""
    return maybe_among(texts, keys, "key").where("_maybe").select("doc_id", "key", "text")


def classes(docs: DataFrame) -> DataFrame:
    """For every row ``doc_id``, ``key``, ``n`` (its number of shingles), ``sig`` (its class) and ``root`` (its component's)."""
    ship(docs.sparkSession)
    texts = docs.selectExpr("cast(doc_id as bigint) as doc_id", "text", "xxhash64(text) as key")
    both_kinds = stored(texts.mapInArrow(class_rows, CLASSES))
    nodes = both_kinds.where("sig is not null").select("doc_id", "key", "n", "sig", "sketch")
    rows = nodes.agg(F.expr(f"coalesce(sum(n - (n * {PERCENT} + 99) div 100 + 1), 0)")).first()[0]
    order = shingle_order(both_kinds.where("token is not null").select("token", "count"), share(rows))

    prefix = texts.mapInArrow(lambda it: prefixes(order, it), "token long, sig long, n int")
    with scratch() as kept:
        met = stored(prefix.repartition("token").sortWithinPartitions("token").mapInArrow(led, LED))
        members = met.where("token is null").select("leader", "sig", "n")
        if len(order.value.often):
            parts = met.where("token is not null")
            shared = parts.groupBy("token").agg(F.min("leader").alias("leader"), F.max("sig").alias("last"), F.count("*").alias("rows")).where("leader < last").drop("last")
            members = members.unionByName(spread_join(parts.drop("leader"), shared, "token", "rows", total=rows).select("leader", "sig", "n"))
        members = kept(stored(members.distinct()))
    sizes = stored(members.groupBy("leader").agg(F.ceil(F.greatest(F.sum("n") / CHUNK, F.count("*") / CHUNK_SETS)).alias("chunks"), F.count("*").alias("rows")))
    of_class = nodes.where("n > 0").groupBy("sig").agg(F.min(F.struct("doc_id", "key")).alias("owner"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))

    def compared(placed: DataFrame) -> DataFrame:
        """Links inside buckets: rows ``leader``, ``chunk``, ``sig``. Texts of hopeless members are not fetched."""
        sketched = placed.join(of_class.select("sig", "n", "sketch"), "sig").repartition("leader", "chunk").sortWithinPartitions("leader", "chunk")
        left = stored(sketched.select("leader", "chunk", "sig", "n", "sketch").mapInArrow(hopeful, PLACED))
        named = left.join(of_class.select("sig", "owner"), "sig").alias("p")
        wanted = maybe_wanted(texts, named.select("owner.key")).alias("t")
        rows = named.join(wanted, F.expr("p.owner.key = t.key and p.owner.doc_id <=> t.doc_id")).select("leader", "chunk", "sig", "text")
        dealt = rows.repartition("leader", "chunk").sortWithinPartitions("leader", "chunk", "sig")
        return stored(dealt.mapInArrow(lambda it: bucket_links(order, it), "a long, b long"))

    every = "transform(if(sig = leader, sequence(0L, chunks - 1), array(pmod(xxhash64(sig), chunks))), c -> string(c))"
    placed = spread_join(members, sizes, "leader", "rows")
    links = compared(placed.select("leader", "sig", F.expr(f"explode({every})").alias("chunk")))
    found = components(links, "a", "b")

    split = stored(spread_join(members, sizes.where("chunks > 1"), "leader", "rows").drop("rows"))
    of_sig = found.select(F.col("node").alias("sig"), F.col("root").alias("own"))
    of_leader = found.select(F.col("node").alias("leader"), F.col("root").alias("led"))
    apart = split.join(of_sig, "sig", "left").join(of_leader, "leader", "left").where("coalesce(own, sig) <> coalesce(led, leader)")
    apart = stored(apart.select("leader", "sig", "n", "chunks"))
    if not apart.isEmpty():
        parts = apart.groupBy("leader").agg(F.ceil(F.greatest(F.sum("n") / CHUNK, F.count("*") / CHUNK_SETS)).alias("parts"))
        chunk, part = "pmod(xxhash64(sig), chunks)", "pmod(xxhash64(sig, 1), parts)"
        all_members = split.join(parts, "leader").selectExpr("leader", "sig", f"{chunk} as i", "explode(sequence(0L, parts - 1)) as j")
        those_apart = apart.join(parts, "leader").selectExpr("leader", "sig", "explode(sequence(0L, chunks - 1)) as i", f"{part} as j")
        both = all_members.unionByName(those_apart).selectExpr("leader", "sig", "concat(i, ':', j) as chunk").distinct()
        found = components(links.unionByName(compared(both)), "a", "b")
    copies = nodes.groupBy("sig").agg(F.count("*").alias("rows"))
    roots = stored(copies.join(found, F.col("sig") == F.col("node"), "left").select("sig", "rows", F.coalesce("root", "sig").alias("root")))
    return spread_join(nodes, roots, "sig", "rows").select("doc_id", "key", "n", "sig", "root")


def link(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable by links, for every row."""
    with scratch() as kept:
        rows = kept(stored(classes(docs)))
    least = stored(rows.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")))
    both = spread_join(rows.withColumn("root", F.expr("if(n > 0, root, null)")), least, "root", "rows", "left")
    return both.selectExpr("doc_id", "n as n_shingles", "if(n > 0, least, doc_id) as component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each component of ``docs``, and all rows whose text has no words.

    That is the one with the smallest id, one with an id before any without; of rows with that id the one whose
    text has the smallest hash; of rows with that text too, any one.
    """
    with scratch() as kept:
        rows = stored(classes(docs).where("n > 0"))
        # A row for each id and text. Rows with a text have one component.
        name = "concat(coalesce(cast(doc_id as string), ''), ':', key)"
        texts = stored(rows.groupBy("doc_id", "key").agg(F.first("root").alias("root"), F.count("*").alias("times")))
        best = texts.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("best"), F.count("*").alias("texts"))
        judged = spread_join(texts, stored(best), "root", "texts").withColumn("gone", F.expr("not (doc_id <=> best.doc_id and key = best.key)"))
        decided = kept(stored(judged.where("gone or times > 1").select(F.expr(name).alias("_name"), "times", "gone")))
    # As one column, the columns of ``docs`` may have any names. Only rows that may be decided on are moved.
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.expr(name.replace("key", "xxhash64(text)")).alias("_name"))
    hashed = named.withColumn("_key", F.xxhash64("_name"))
    marked = maybe_among(hashed, decided.select(F.xxhash64("_name").alias("_key")), "_key")
    both = spread_join(marked.where("_maybe"), decided, "_name", "times", "left")
    once = marked.where("not _maybe").select("doc.*").unionByName(both.where("times is null").select("doc.*"))
    if decided.where("not gone").isEmpty():
        return once
    repeated = both.where("not gone").groupBy("_name").agg(F.first("doc").alias("doc"))
    return once.unionByName(repeated.select("doc.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(documents(spark, sf_dir))
