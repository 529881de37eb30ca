"""Words of many texts at once: positions and 64-bit hashes from the texts' UTF-8 bytes, in NumPy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words ``[^\x20\x09-\x0D]+``.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower case.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row's begin (one more than rows). Null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2] if len(column) else None
    values = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return values[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str, most: int, rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of at most ``rows`` rows whose texts have at most ``most`` bytes together (one row at least)."""
    for b in batches:
        _, offsets = text_bytes(b.column(column))
        at = 0
        while at < b.num_rows:
            end = min(at + rows, max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1))
            yield b.slice(at, end - at)
            at = end


def words(values: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of all words, and per row where its words begin. Words don't cross rows."""
    inside = kind[values]
    edge = np.zeros(len(values) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    rows = np.searchsorted(starts, offsets)
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64), rows
    lengths = ends - starts
    held = LOWER[values[inside]]
    first = np.cumsum(lengths) - lengths
    at = np.arange(len(held), dtype=np.int64) - np.repeat(first, lengths)
    powers = np.ones(int(lengths.max()), np.uint64)
    powers[1:] = _STEP
    powers = np.multiply.accumulate(powers)
    sums = np.add.reduceat(_BYTE[held] * powers[at], first)
    return starts, ends, mix(sums + lengths.astype(np.uint64)), rows


def shingles(hashes: np.ndarray, rows: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``n``-word shingles of every row and where each row's begin.

    A row with fewer words has one shingle of all of them; one without words has none.
    """
    counts = np.diff(rows)
    sizes = np.where(counts >= n, counts - n + 1, (counts > 0).astype(counts.dtype))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    start = np.repeat(rows[:-1], sizes) + np.arange(begins[-1]) - np.repeat(begins[:-1], sizes)
    held = np.minimum(np.repeat(counts, sizes), n)
    out = np.zeros(begins[-1], np.uint64)
    for k in range(n):
        out = mix(out * _STEP + np.where(k < held, padded[start + k], np.uint64(k + 1)))
    return out, begins
