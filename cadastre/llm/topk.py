"""Exact top-k by inner product with vector-approximation files.

Vectors become whole numbers, floor(scale * x).  A slice of vectors is scanned
as quantised cells (6 bits a component): a cell bounds each inner product from
above and below.  Exact vectors are then read in the order of their upper
bounds until the k-th score found is above every bound left.  Queries are held
in blocks and slices stream past them; the k best of each slice are merged.

Defined cases: vectors that are null, empty, or hold null or non-finite
components take no part; only vectors of one length are compared; a row with
the query's own id is its own row; a null id never asks and loses ties; equal
rows are candidates each, and ask once; scores saturate at the bounds of long.
Columns besides the id and the vector are not read, whatever their names; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, ship, staged
from .vectors import blocks_of, dense

#: Queries held together, vectors dealt to one task, cells of a component, and exact vectors read at a time.
QUERIES, SLICE, LEVELS, READ = 1024, 16_384, 64, 64
_EXACT = 2**53
_LONG = 2**63 - 1


def whole(vector: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x), as doubles; exact, as far as a double holds it."""
    return np.floor(scale * vector)


def approximations(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell of each component, and the cells' lower and upper ends (levels x
    components): the vector-approximation file of a slice."""
    low, high = vectors.min(axis=0), vectors.max(axis=0)
    step = np.maximum(1.0, np.ceil((high - low + 1) / LEVELS))
    cell = np.minimum((vectors - low) // step, LEVELS - 1).astype(np.uint8)
    ends = low + step * np.arange(LEVELS)[:, None]
    return cell, ends, np.minimum(ends + step - 1, high)


def bounds(queries: np.ndarray, cell: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each query with each cell vector."""
    over, under = np.maximum(queries, 0), np.minimum(queries, 0)
    at = np.arange(cell.shape[1])
    a, b = low[cell, at], high[cell, at]
    return over @ a.T + under @ b.T, over @ b.T + under @ a.T


def _merged(scores: np.ndarray, ids: np.ndarray, more: np.ndarray, more_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of both, ties to smaller ids."""
    scores, ids = np.concatenate([scores, more]), np.concatenate([ids, more_ids])
    first = np.lexsort((ids, -scores))[:k]
    return scores[first], ids[first]


def _beyond_doubles(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products in whole numbers, saturated at the bounds of long."""
    q = [int(x) for x in query]
    out = [sum(a * int(b) for a, b in zip(q, v, strict=True)) for v in vectors]
    return np.array([max(-_LONG - 1, min(_LONG, s)) for s in out], object)


def search_slice(queries: np.ndarray, asked: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, best: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Bring each query's (scores, ids) up to date with a slice.  What was found
    in slices before narrows what has to be read of this one."""
    if np.abs(queries).max() * np.abs(vectors).max() * vectors.shape[1] >= _EXACT:
        for q, query in enumerate(queries):
            other = ids != asked[q]
            best[q] = _merged(best[q][0].astype(object), best[q][1], _beyond_doubles(query, vectors[other]), ids[other], k)
        return
    cell, low, high = approximations(vectors)
    for q0 in range(0, len(queries), 128):
        least, most = bounds(queries[q0 : q0 + 128], cell, low, high)
        own = asked[q0 : q0 + 128, None] == ids[None, :]
        least[own] = most[own] = -np.inf
        sure = np.partition(least, -k, axis=1)[:, -k] if len(ids) >= k else np.full(len(least), -np.inf)  # k score at least this
        for q in range(len(least)):
            scores, found = best[q0 + q]
            bar = max(sure[q], scores[k - 1]) if len(scores) == k else sure[q]
            cand = np.flatnonzero((most[q] >= bar) & ~own[q])
            if not len(cand):
                continue
            cand = cand[np.argsort(-most[q, cand], kind="stable")]
            for at in range(0, len(cand), READ):
                some = cand[at : at + READ]
                if len(scores) == k and most[q, some[0]] < scores[k - 1]:
                    break  # the k-th result is certain
                scores, found = _merged(scores, found, vectors[some] @ queries[q0 + q], ids[some], k)
            best[q0 + q] = (scores, found)


def top_k(df: DataFrame, asks: Column, k: int = 20, scale: float = 64.0, vec_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k``
    best of each row for which ``asks`` holds, ties to smaller ids."""
    ship(df.sparkSession)

    def read(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"vec": pa.array([None if v is None else whole(v, scale).tobytes() for v in dense(batch.column(0))], pa.binary())}

    source = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("vector"), F.coalesce(asks, F.lit(False)).alias("asks"))
    rows = staged(map_batches(source, ("vector",), ("id", "asks"), "vec binary", read).where("vec is not null"), "whole")
    n, n_asks = rows.agg(F.count("*"), F.count(F.when(F.col("asks") & F.col("id").isNotNull(), 1))).first()
    asked, sliced = max(1, ceil(n_asks / QUERIES)), max(1, ceil(n / SLICE))
    size = F.length("vec")
    name = lambda q, s: F.concat_ws("/", size, q, s)
    spread = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    held = rows.where("asks and id is not null").select("id", "vec").distinct().withColumn(
        "q", F.pmod(F.xxhash64("id", "vec"), F.lit(asked)).cast("int")).withColumn("s", spread(sliced)).select(
        name("q", "s").alias("block"), F.lit(0).alias("role"), "id", "vec")
    data = rows.withColumn("s", F.pmod(F.xxhash64("vec", "id"), F.lit(sliced)).cast("int")).withColumn("q", spread(asked)).select(
        name("q", "s").alias("block"), F.lit(1).alias("role"), "id", "vec")

    def search(block: str, held: list[tuple], streamed: Iterator[list[tuple]]) -> Iterator[pa.RecordBatch]:
        asked_ids = np.array([r[0] for r in held], np.int64)
        queries = np.array([np.frombuffer(r[1]) for r in held])
        best = [(np.empty(0), np.empty(0, np.int64)) for _ in held]
        for part in streamed:
            ids = np.array([_LONG if r[0] is None else r[0] for r in part], np.int64)  # no id loses ties
            search_slice(queries, asked_ids, np.array([np.frombuffer(r[1]) for r in part]), ids, k, best)
        out = [(int(asked_ids[q]), held[q][1], int(s), None if i == _LONG else int(i))
               for q, (scores, ids) in enumerate(best) for s, i in zip(scores, ids, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], kind) for c, kind in enumerate(
            (pa.int64(), pa.binary(), pa.int64(), pa.int64()))], names=["query_id", "asked", "score", "vec_id"])

    found = blocks_of(held.union(data), search, "query_id bigint, asked binary, score bigint, vec_id bigint", ("id", "vec"))
    first = Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
