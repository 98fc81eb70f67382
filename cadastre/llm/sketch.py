"""Count-min sketch of 64-bit hashes, merged from one sketch of each task.

Two rows of cells; a task counts into its own cells (saturating), sends the
blocks of cells it has touched, and blocks are summed in two steps, so that no
step gathers more than :data:`FAN` sketches of a block.  What the driver gets
and broadcasts is one bit a cell for each level asked for (count at least 2,
say): its size is fixed by ``bits``, whatever the corpus.  A count is never
underestimated, so nothing that repeats is missed; a fuller sketch only lets
more through to the exact step behind it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import log2

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import SHUFFLES_GO, settings
from .common import ship, tidy

#: Cells in a block, rows of cells, sketches summed in one step, and the largest width (2 ** 27 cells: 64 MB a level).
BLOCK, ROWS, FAN, MOST_BITS = 1 << 16, 2, 256, 27
_SEEDS = (np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93))


def width_bits(expected: float) -> int:
    """Width for about ``expected`` different hashes: four cells for each, up to the largest width."""
    return int(min(MOST_BITS, max(16, log2(max(1.0, 4 * expected)))))


def cells_of(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    return [((hashes ^ (hashes >> np.uint64(32))) * s >> np.uint64(64 - bits)).astype(np.int64) for s in _SEEDS]


def merged(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int, levels: tuple[int, ...]) -> list[np.ndarray]:
    """For each level, packed bits (rows x cells) telling which cells count at
    least so much; ``hashes`` gives the hashes of a batch."""
    ship(df.sparkSession)
    top, width = max(levels), 1 << bits
    kind = np.uint8 if top < 256 else np.uint16
    schema = "block int, step int, cells binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((ROWS, width), kind)
        for batch in batches:
            for h in hashes(batch):
                for row, at in zip(cells, cells_of(h, bits), strict=True):
                    place, n = np.unique(at, return_counts=True)
                    row[place] = np.minimum(row[place].astype(np.int64) + n, top)
        press = zstandard.ZstdCompressor(level=1)
        step = TaskContext.get().partitionId() % FAN
        blocks = cells.reshape(-1, min(BLOCK, width))
        used = np.flatnonzero(blocks.any(axis=1))
        for lo in range(0, len(used), 64):
            some = used[lo : lo + 64]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([step] * len(some), pa.int32()),
                 pa.array([press.compress(blocks[i].tobytes()) for i in some], pa.binary())], names=["block", "step", "cells"])

    def total(cells: pa.ChunkedArray) -> np.ndarray:
        out, open_ = np.zeros(min(BLOCK, width), np.int64), zstandard.ZstdDecompressor()
        for one in cells:
            out += np.frombuffer(open_.decompress(one.as_py()), kind)
        return np.minimum(out, top).astype(kind)

    def add(table: pa.Table) -> pa.Table:
        sums = zstandard.ZstdCompressor(level=1).compress(total(table["cells"]).tobytes())
        return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int32()), "step": pa.array([0], pa.int32()), "cells": pa.array([sums], pa.binary())})

    def levels_of(table: pa.Table) -> pa.Table:
        sums = total(table["cells"])
        bits_ = b"".join(np.packbits(sums >= n).tobytes() for n in levels)
        return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int32()), "step": pa.array([0], pa.int32()), "cells": pa.array([bits_], pa.binary())})

    parts = df.mapInArrow(tidy(count), schema)
    sums = parts.groupBy("block", "step").applyInArrow(add, schema)
    bits_of = sums.withColumn("step", F.lit(0)).groupBy("block").applyInArrow(levels_of, schema)
    out = [np.zeros(ROWS * width // 8, np.uint8) for _ in levels]
    size = min(BLOCK, width) // 8
    with settings(df.sparkSession, SHUFFLES_GO):
        rows = bits_of.collect()  # bounded by the width
    for row in rows:
        data = np.frombuffer(row["cells"], np.uint8)
        for i, level in enumerate(out):
            level[row["block"] * size : (row["block"] + 1) * size] = data[i * size : (i + 1) * size]
    return [level.reshape(ROWS, -1) for level in out]


def reaches(level: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Whether each hash may count as much as the level (never wrongly false)."""
    ok = np.ones(len(hashes), bool)
    for row, at in zip(level, cells_of(hashes, bits), strict=True):
        ok &= (row[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)
    return ok
