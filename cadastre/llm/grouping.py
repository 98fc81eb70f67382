"""Exact grouping of very many small records: tasks pack them as columns, one
compressed blob for each bucket of their hash; a bucket is then grouped with
numpy.  Spark deals the blobs out and sorts them; a task holds one bucket."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy

#: Text bytes for each bucket, and the bounds of the number of buckets.
BUCKET_BYTES, LEAST_BUCKETS, MOST_BUCKETS = 2 << 20, 64, 1 << 18
SCHEMA = "bucket int, kind int, blob binary"


def text_bytes_in(df: DataFrame, text_col: str) -> int:
    return int(df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0)


def bucket_count(size: int) -> int:
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, size // BUCKET_BYTES))


def pack(columns: tuple[np.ndarray, ...], rest: np.ndarray | None = None) -> bytes:
    """Columns of one length and, after them, any bytes."""
    data = [np.int64(len(columns[0])).tobytes(), *(c.tobytes() for c in columns), *([] if rest is None else [rest.tobytes()])]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(data))


def unpack(blob: bytes, kinds: tuple, rest: bool = False) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int(np.frombuffer(data, np.int64, 1)[0]), 8, []
    for k in kinds:
        out.append(np.frombuffer(data, k, n, at))
        at += n * np.dtype(k).itemsize
    return [*out, np.frombuffer(data, np.uint8, offset=at)] if rest else out


def unpack_all(blobs: list[bytes], kinds: tuple) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*(unpack(b, kinds) for b in blobs), strict=True)]


def dealt(columns: tuple[np.ndarray, ...], bucket: np.ndarray) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    """The records of each bucket, in their order."""
    if not len(bucket):
        return
    by = np.argsort(bucket, kind="stable")
    bucket = bucket[by]
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    for a, b in zip(cut, [*cut[1:], len(bucket)], strict=True):
        yield int(bucket[a]), tuple(c[by[a:b]] for c in columns)


def blob_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
         pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "kind", "blob"])


def by_bucket(rows: DataFrame, fn: Callable[[int, dict[int, list[bytes]]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Deal the blobs out by bucket; ``fn`` gets a bucket's blobs by kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, have = None, {}
        for batch in batches:
            for bucket, kind, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now:
                    if have:
                        yield from fn(now, have)
                    now, have = bucket, {}
                have.setdefault(kind, []).append(blob)
        if have:
            yield from fn(now, have)

    return rows.repartition("bucket").sortWithinPartitions("bucket").select("bucket", "kind", "blob").mapInArrow(tidy(run), schema)


#: Replies: the text's key (16 bytes), and a run of positions in it.
RUNS = ("V16", np.int64, np.int64)


def runs_by_key(rows: DataFrame) -> DataFrame:
    """``key`` and ``runs`` (binary: start and end, int64, of each run) from
    blobs of :data:`RUNS` dealt by key."""

    def fn(bucket: int, blobs: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        key, start, end = unpack_all([b for many in blobs.values() for b in many], RUNS)
        names, of = np.unique(key, return_inverse=True)
        by = np.lexsort((end, start, of))
        of, pairs = of[by], np.stack([start[by], end[by]], axis=1)
        cut = np.searchsorted(of, np.arange(len(names) + 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k.tobytes() for k in names], pa.binary()),
             pa.array([pairs[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())], names=["key", "runs"])

    return by_bucket(rows, fn, "key binary, runs binary")


def key_buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (keys.view(np.uint64).reshape(-1, 2)[:, 0] % np.uint64(buckets)).astype(np.int64)


def as_runs(doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive positions (sorted by document, then position):
    document, first position and one past the last."""
    if not len(at):
        return doc, at, at
    head = np.concatenate([[True], (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1)])
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(at)) - 1
    return doc[first], at[first], at[last] + 1


def repeats(columns: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts the records by all columns, the group of each in that
    order, and the size of each group."""
    by = np.lexsort(columns[::-1])
    head = np.zeros(len(by), bool)
    if len(by):
        head[0] = True
        for c in columns:
            s = c[by]
            head[1:] |= s[1:] != s[:-1]
    group = np.cumsum(head) - 1
    return by, group, np.bincount(group) if len(by) else np.empty(0, np.int64)
