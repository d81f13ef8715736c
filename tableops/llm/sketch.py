"""Count-min sketches of hashed items over a whole table: bounded summaries that may be broadcast.

Estimates are never too low. The size is fixed, so with more input all counters rise together and the frequent items keep
standing out; nothing that must be exact may depend on an estimate being close.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_BLOCK = 1 << 14
_WAYS = 16  # tasks that first add up a block, before one task adds up their sums
_SCHEMA = "block int, way int, counts binary"


@dataclass(frozen=True)
class Shape:
    """depth rows of 2**bits counters of 4 bytes, whatever the input."""

    bits: int
    depth: int

    @property
    def size(self) -> int:
        return self.depth << self.bits

    def cells(self, hashes: np.ndarray) -> list[np.ndarray]:
        """The counter of each hash, per row."""
        mask, step = np.uint64((1 << self.bits) - 1), (64 - self.bits) // self.depth
        return [((hashes >> np.uint64(step * row)) & mask).astype(np.int64) + (row << self.bits) for row in range(self.depth)]

    def estimates(self, counts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        found = [counts[cell] for cell in self.cells(hashes)]
        return found[0] if self.depth == 1 else np.min(found, axis=0)


def _rows(blocks: dict[int, np.ndarray], way: int) -> Iterator[pa.RecordBatch]:
    for block, counts in blocks.items():
        columns = {"block": pa.array([block], pa.int32()), "way": pa.array([way], pa.int32())}
        yield pa.RecordBatch.from_pydict(columns | {"counts": [zlib.compress(counts.tobytes(), 1)]})


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams: holds one array per block of this task."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
            more = np.frombuffer(zlib.decompress(counts), np.uint32).astype(np.int64)
            sums[block] = np.minimum(sums.get(block, 0) + more, 0xFFFFFFFF)
    yield from _rows({block: counts.astype(np.uint32) for block, counts in sums.items()}, 0)


def count_min(
    df: DataFrame, shapes: list[Shape], items: Callable[[pa.RecordBatch], Iterator[list[np.ndarray]]]
) -> list[np.ndarray]:
    """Counters of each shape for the hashes that ``items`` yields for each batch, one array per shape; runs one job."""
    total = sum(shape.size for shape in shapes)
    assert all(shape.size % _BLOCK == 0 for shape in shapes)

    def one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts = [np.zeros(shape.size, np.uint32) for shape in shapes]
        for batch in batches:
            for arrays in items(batch):
                for shape, own, hashes in zip(shapes, counts, arrays):
                    for cell in shape.cells(hashes):
                        np.add.at(own, cell, 1)
        parts = np.concatenate(counts).reshape(-1, _BLOCK)
        way = TaskContext.get().partitionId() % _WAYS
        yield from _rows({i: parts[i] for i in range(len(parts)) if parts[i].any()}, way)

    sums = df.mapInArrow(one_task, _SCHEMA)
    for keys in (["block", "way"], ["block"]):
        sums = sums.repartition(*keys).mapInArrow(_add_up, _SCHEMA)
    counts = np.zeros((total // _BLOCK, _BLOCK), np.uint32)
    for row in sums.select("block", "counts").collect():  # as many bytes as the shapes have, at most
        counts[row.block] = np.frombuffer(zlib.decompress(row.counts), np.uint32)
    bounds = np.cumsum([0, *[shape.size for shape in shapes]])
    return [counts.reshape(-1)[a:b] for a, b in zip(bounds, bounds[1:])]
