"""Hard-negative mining with segment summaries.

Vectors become whole numbers, floor(scale * x).  Each vector is cut into
segments, and each segment's mean and deviation are stored beside it.  Over a
segment of n components two vectors' inner product is n times the product of the means,
plus or minus n times the product of the deviations at most; summed over the segments this bounds
the score.  Coarser segments' summaries follow from the stored ones, so bounds are refined
from one segment to the finest for what is still open, and only rows that may yet matter
are scored exactly, in the order of their upper bounds, until no row left can enter.

The table is cut into slices by hash; every exact vector is dealt to one slice
and only anchors are sent past all slices.  A first pass finds each anchor's
positives, its best rows of the same label; the second knows their scores and
finds the best rows of other labels in the window under each.

Defined cases: rows with a null label, a vector that is null, empty, or holds null or
non-finite components (also once scaled) take no part; only vectors of one length are
compared; rows with an anchor's own id are that anchor; a null id is never an anchor and loses
ties; equal rows count each, and are one anchor; scores saturate at the bounds of long; an anchor
without positives, or a positive without negatives, gives no row.  Very long vectors make
smaller slices.  Other columns, also of clashing names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, ship, staged
from .vectors import blocks_of, dense

#: Bytes of a slice's exact vectors, and segments of the stored summary (a power of four, fewer for short vectors).
SLICE_BYTES, SEGMENTS = 16 << 20, 16
#: Exact vectors read at a time, at first and at most.
READ = (64, 4096)
_EXACT = 2.0**53
_LONG = 2**63 - 1


def lengths(d: int, most: int) -> np.ndarray:
    """Components of each segment: a power of four of them, two components or more each."""
    n = 1
    while 4 * n <= most and 8 * n <= d:
        n *= 4
    return np.diff(d * np.arange(n + 1) // n)


def summarised(vectors: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment of each row."""
    at = np.cumsum(size) - size
    mean = np.add.reduceat(vectors, at, axis=1) / size
    off = vectors - np.repeat(mean, size, axis=1)
    return mean, np.sqrt(np.add.reduceat(off * off, at, axis=1) / size)


def coarser(mean: np.ndarray, dev: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Summaries of four segments each, from theirs."""
    shape = (len(mean), -1, 4)
    m, s, n = mean.reshape(shape), dev.reshape(shape), size.reshape(1, -1, 4)
    total = n.sum(axis=2)
    whole = (m * n).sum(axis=2) / total
    return whole, np.sqrt(((s**2 + (m - whole[:, :, None]) ** 2) * n).sum(axis=2) / total), total[0]


def levels(mean: np.ndarray, dev: np.ndarray, size: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """From one segment to the finest: means and deviations times the root of
    the segment's length, so that bounds are sums of products."""
    out = []
    while True:
        out.append((mean * np.sqrt(size), dev * np.sqrt(size)))
        if len(size) == 1:
            return out[::-1]
        mean, dev, size = coarser(mean, dev, size)


class Asked(NamedTuple):
    id: int
    label: str
    vector: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]


class Slice:
    """Rows of one slice in the order of their labels, with all levels of their summaries."""

    def __init__(self, ids: np.ndarray, labels: list[str], vectors: np.ndarray, mean: np.ndarray, dev: np.ndarray):
        names, code = np.unique(np.array(labels, object).astype(str), return_inverse=True)
        self.order = np.argsort(code, kind="stable")
        self.of = {n: (a, b) for n, a, b in zip(names.tolist(), *(np.searchsorted(code[self.order], np.arange(len(names)), s).tolist()
                                                                  for s in ("left", "right")), strict=True)}
        self.ids, self.vectors = ids[self.order], vectors[self.order]
        with np.errstate(all="ignore"):
            self.levels = levels(mean[self.order], dev[self.order], lengths(vectors.shape[1], mean.shape[1]))
            top = self.levels[0]
            self.norm = np.sqrt((top[0] ** 2 + top[1] ** 2).sum(axis=1))
        self.peak = float(np.abs(vectors).max())
        self.read = 0  # exact vectors scored so far

    def bounds(self, asked: Asked, level: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """No score lies outside; a billionth of the norms is left for rounding."""
        (m, s), (qm, qs) = self.levels[level], asked.levels[level]
        with np.errstate(all="ignore"):
            mid, off = m[rows] @ qm, s[rows] @ qs + 1e-9 * self.norm[rows] * np.sqrt((asked.levels[0][0] ** 2 + asked.levels[0][1] ** 2).sum())
            low, high = mid - off, mid + off
        low[np.isnan(low)], high[np.isnan(high)] = -np.inf, np.inf
        return np.clip(low, -(2.0**63), 2.0**63), np.clip(high, -(2.0**63), 2.0**63)

    def scores(self, asked: Asked, rows: np.ndarray) -> np.ndarray:
        self.read += len(rows)
        if self.peak * float(np.abs(asked.vector).max()) * self.vectors.shape[1] < _EXACT:
            return (self.vectors[rows] @ asked.vector).astype(np.int64)
        q = [int(x) for x in asked.vector]
        found = (sum(a * int(b) for a, b in zip(q, v, strict=True)) for v in self.vectors[rows])
        return np.array([max(-_LONG - 1, min(_LONG, s)) for s in found], np.int64)

    def rows(self, asked: Asked, same: bool) -> np.ndarray:
        """Rows of the anchor's label, or the others; without its own."""
        lo, hi = self.of.get(asked.label, (0, 0))
        rows = np.arange(lo, hi) if same else np.concatenate([np.arange(lo), np.arange(hi, len(self.ids))])
        return rows[self.ids[rows] != asked.id]

    def best(self, asked: Asked, rows: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Scores and rows of the first ``k`` with a score in each window (least,
        most), ties to smaller ids."""
        ends = [(float(a), float(b)) for a, b in windows]
        low = high = None
        for level in range(len(self.levels)):
            if not len(rows):
                break
            low, high = self.bounds(asked, level, rows)
            may = np.zeros(len(rows), bool)
            for least, most in ends:
                sure = low[(low >= least) & (high <= most)]
                bar = np.partition(sure, -k)[-k] if len(sure) >= k else least
                may |= (high >= bar) & (low <= most)
            rows, low, high = rows[may], low[may], high[may]
        found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
        if not len(rows):
            return found
        first = np.argsort(-high, kind="stable")
        rows, low, high = rows[first], low[first], high[first]
        at, step = 0, READ[0]
        while at < len(rows):
            bars = [float(s[k - 1]) if len(s) == k else least for (s, _), (least, _) in zip(found, ends, strict=True)]
            if high[at] < min(bars):
                break  # what is certain stays
            some = slice(at, at + step)
            need = np.zeros(len(rows[some]), bool)
            for bar, (_, most) in zip(bars, ends, strict=True):
                need |= (high[some] >= bar) & (low[some] <= most)
            read = rows[some][need]
            score = self.scores(asked, read)
            for w, (least, most) in enumerate(windows):
                inside = (score >= least) & (score <= most)
                s, r = np.concatenate([found[w][0], score[inside]]), np.concatenate([found[w][1], read[inside]])
                keep = np.lexsort((self.ids[r], ~s))[:k]
                found[w] = (s[keep], r[keep])
            at, step = at + step, min(2 * step, READ[1])
        return found


def mine(df: DataFrame, anchors: Column, label: Column, n_positives: int = 5, n_negatives: int = 5, percent: int = 80, scale: float = 256.0,
         vec_col: str = "embedding", id_col: str = "vec_id", segments: int = SEGMENTS) -> DataFrame:
    """For each row for which ``anchors`` holds, and each of its ``n_positives`` best
    rows of the same ``label``, the first ``n_negatives`` rows of other labels with
    a score from ``percent`` in a hundred of the positive's up to it:
    ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``,
    ``positive_score``, ``negative_score``."""
    spark = df.sparkSession
    ship(spark)

    def read(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        with np.errstate(all="ignore"):
            made = [None if v is None else np.floor(scale * v) for v in dense(batch.column(0))]
        return {"vec": pa.array([None if v is None or not np.isfinite(v).all() else v.tobytes() for v in made], pa.binary())}

    def summary(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        out: list[list[bytes]] = [[], []]
        for raw in batch.column(0).to_pylist():
            vector = np.frombuffer(raw)[None, :]
            with np.errstate(all="ignore"):
                for into, part in zip(out, summarised(vector, lengths(vector.shape[1], segments)), strict=True):
                    into.append(part.tobytes())
        return {"mean": pa.array(out[0], pa.binary()), "dev": pa.array(out[1], pa.binary())}

    source = df.select(F.col(id_col).cast("bigint").alias("id"), label.cast("string").alias("label"), F.col(vec_col).alias("vector"),
                       F.coalesce(anchors, F.lit(False)).alias("asks")).where("label is not null")
    whole = map_batches(source, ("vector",), ("id", "label", "asks"), "vec binary", read).where("vec is not null")
    # equal rows are one with a number, so a row that is a third of the table is no hot key below
    each = whole.groupBy("id", "label", "vec").agg(F.count("*").alias("copies"), F.max("asks").alias("asks"))
    rows = staged(map_batches(each, ("vec",), tuple(each.columns), "mean binary, dev binary", summary), "summaries")
    held_as = ("id", "label", "copies", "vec", "mean", "dev")
    n, size = rows.agg(F.count("*"), F.sum(F.length("vec"))).first()
    # slices of bounded bytes; of a small table some for each task, since anchors cost little there
    sliced = max(1, ceil((size or 0) / SLICE_BYTES), min(int(spark.conf.get("spark.sql.shuffle.partitions")), n // 1024))
    asked = staged(rows.where("asks and id is not null").withColumn("a", F.monotonically_increasing_id()).select("a", *held_as), "anchors")
    block = lambda s: F.concat_ws("/", F.length("vec"), s)
    data = rows.select(block(F.pmod(F.xxhash64("id", "label", "vec"), F.lit(sliced))).alias("block"), F.lit(0).alias("role"),
                       F.lit(None).cast("bigint").alias("a"), *held_as, F.lit(None).cast("array<bigint>").alias("scores"))

    def against(anchors_: DataFrame, windows: bool, k: int) -> DataFrame:
        sent = anchors_.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(sliced - 1)))).select(
            block("s").alias("block"), F.lit(1).alias("role"), "a", *held_as, "scores")

        def search(block: str, held: list[tuple], streamed: Iterator[list[tuple]]) -> Iterator[pa.RecordBatch]:
            _, ids, labels, copies, vecs, means, devs, _ = zip(*held, strict=True)
            matrix = lambda cells: np.frombuffer(b"".join(cells)).reshape(len(cells), -1)
            own = Slice(np.array([_LONG if i is None else i for i in ids], np.int64), list(labels), matrix(vecs), matrix(means), matrix(devs))
            copies_, unnamed = np.array(copies, np.int64)[own.order], np.array([i is None for i in ids])[own.order]
            del held, vecs, means, devs
            for part in streamed:
                out: list[tuple] = []
                for a, id_, label_, _, vec, mean, dev, scores in part:
                    vector = np.frombuffer(vec)
                    with np.errstate(all="ignore"):
                        steps = levels(np.frombuffer(mean)[None, :], np.frombuffer(dev)[None, :], lengths(len(vector), len(mean) // 8))
                    ask = Asked(id_, label_, vector, [(m[0], s[0]) for m, s in steps])
                    tops = sorted(scores) if windows else [None]
                    spans = [(-(-percent * p // 100), p) for p in tops] if windows else [(-_LONG - 1, _LONG)]
                    for top, (score, at) in zip(tops, own.best(ask, own.rows(ask, not windows), spans, k), strict=True):
                        out += [(a, top, int(s), None if unnamed[r] else int(own.ids[r]), int(copies_[r])) for s, r in zip(score, at, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], pa.int64()) for c in range(5)],
                                                 names=["a", "top", "score", "id", "copies"])

        found = blocks_of(data.union(sent), search, "a bigint, top bigint, score bigint, id bigint, copies bigint", ("a", *held_as, "scores"))
        each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
        first = Window.partitionBy("a", "top").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        return each.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select("a", "top", "score", "id", "rank")

    positives = staged(against(asked.withColumn("scores", F.lit(None).cast("array<bigint>")), False, n_positives), "positives")
    tops = positives.groupBy("a").agg(F.collect_set("score").alias("scores"))  # n_positives at most
    negatives = against(asked.join(tops, "a"), True, n_negatives)
    pairs = positives.join(asked.select("a", F.col("id").alias("anchor_id")), "a").select(
        "a", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("top"))
    return pairs.join(negatives, ["a", "top"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), F.col("top").alias("positive_score"),
        F.col("score").alias("negative_score"))
