"""What blocks of rows and buckets of counts send each other: arrays of whole numbers, packed."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

from caretiers.llm.wordhash import blocks


def runs(batches: Iterator[pa.RecordBatch], most: int, part: int) -> Iterator[list[pa.RecordBatch]]:
    """Runs of batches whose texts have about ``most`` bytes together, each of ``part`` bytes at most, or of one row."""
    held, size = [], 0
    for b in blocks(batches, "text", min(most, part)):
        if held and size + b.column("text").nbytes > most:
            yield held
            held, size = [], 0
        held.append(b)
        size += b.column("text").nbytes
    if held:
        yield held


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers, their bytes by place, compressed."""
    planes = [(len(x), np.ascontiguousarray(x.astype(np.uint64)).view(np.uint8).reshape(-1, 8).T.tobytes()) for x in arrays]
    return zstandard.compress(pickle.dumps(planes), 1)


def unpacked(data: bytes) -> list[np.ndarray]:
    planes = pickle.loads(zstandard.decompress(data))
    return [np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(8, n).T).view(np.uint64).ravel().astype(np.int64) for n, x in planes]


def steps(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Differences of ascending runs, each run's first value as it is."""
    out = np.diff(values, prepend=values[:1] * 0)
    out[begins] = values[begins]
    return out


def from_steps(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``sizes`` values that ``steps`` was made of."""
    total = np.cumsum(values)
    begins = np.cumsum(sizes) - sizes
    return total - np.repeat(np.concatenate([[0], total])[begins], sizes)


def ranges(firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each of ``firsts`` on, ``sizes`` of them."""
    return np.arange(int(sizes.sum())) + np.repeat(firsts - (np.cumsum(sizes) - sizes), sizes)


def added(place: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.add.at(out, place, values)
    return out
