"""Vectors as bytes: reading array columns and dealing rows out to held blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import tidy

#: Rows of a held block, and streamed rows compared with it at a time.
HELD, STREAMED = 2048, 2048


def dense(column: pa.Array) -> list[np.ndarray | None]:
    """Each row as a double vector; None if it is null, empty, or holds a null
    or non-finite component."""
    flat = column.flatten()
    empty = np.asarray(flat.is_null())
    data = np.asarray(flat.fill_null(0).cast(pa.float64()))
    bad = np.concatenate([[0], np.cumsum(empty | ~np.isfinite(data))])
    valid = np.asarray(column.is_valid())
    size = np.asarray(pa.compute.list_value_length(column).fill_null(0), np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    return [data[a:b] if ok and b > a and bad[b] == bad[a] else None for ok, a, b in zip(valid, at[:-1], at[1:], strict=True)]


def blocks_of(rows: DataFrame, fn: Callable[[str, list[tuple], Iterator[list[tuple]]], Iterator[pa.RecordBatch]], schema: str,
              columns: tuple[str, ...]) -> DataFrame:
    """``rows``: block (string), role (0: held, 1: streamed) and ``columns``.
    ``fn`` gets a block's held rows and then its streamed rows, some at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[tuple[str, int, list[tuple]]]:
            now, have = None, []
            for batch in batches:
                for block, role, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if (block, role) != now or role and len(have) == STREAMED:
                        if have:
                            yield *now, have
                        now, have = (block, role), []
                    have.append(tuple(rest))
            if have:
                yield *now, have

        source = pieces()
        ahead = next(source, None)
        while ahead:
            block, role, held = ahead
            if role:  # nothing is held: nothing to compare with
                held = []
            else:
                ahead = next(source, None)

            def streamed(block: str = block) -> Iterator[list[tuple]]:
                nonlocal ahead
                while ahead and ahead[0] == block:
                    yield ahead[2]
                    ahead = next(source, None)

            rest = streamed()
            if held:
                yield from fn(block, held, rest)
            for _ in rest:
                pass

    return rows.select("block", "role", *columns).repartition("block").sortWithinPartitions("block", "role").mapInArrow(tidy(run), schema)
