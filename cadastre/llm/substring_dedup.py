"""Substring de-duplication over word windows, behind a count-min prefilter.

First pass: the windows' counts are overestimated by a merged count-min sketch.
It counts each window under its least word n-gram: equal windows hold it at the
same place, so the n-gram's count is no less than the window's, and far fewer
are counted than there are windows.  Second pass: only windows estimated as
repeated are grouped exactly, by 96 bits of hash; none is lost.  A task settles
what repeats inside itself and passes on one record of each window, so a
passage that a third of all texts share is one record a task.

Defined cases: words are runs without blanks, unchanged; a null text has no
words; copies of a text (rows repeated, too) are repeats of each other; a text
of fewer words than a window keeps them all.  A very long text is a slice of its
own, with memory in proportion to it; kept columns may have any names but those
added; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import sketch
from .common import PIECE_BYTES, ship, slices, staged, text_bytes, tidy
from .grouping import (
    RUNS, SCHEMA, as_runs, blob_batch, bucket_count, by_bucket, dealt, key_buckets, pack, repeats, runs_by_key, text_bytes_in, unpack_all,
)
from .hashing import mix, prefix_sums, spans, window_hashes, word_spans

#: Windows a task gathers before it passes them on.
FLUSH = 2_000_000
_WINDOWS = (np.uint64, np.uint32, "V16", np.int64)
_SETTLED = -1  # position of a record whose windows are known to repeat


def least_in_windows(values: np.ndarray, size: int) -> np.ndarray:
    """Index of the least value of each ``size`` consecutive ones, the first on
    ties (on the leading bits; equal runs of values give equal places)."""
    n = len(values) - size + 1
    if n <= 0:
        return np.empty(0, np.int64)
    low = np.uint64(max(1, int(len(values)).bit_length()))
    place = np.arange(len(values), dtype=np.uint64)
    best, span = (values >> low << low) | place, 1
    while span < size:
        step = min(span, size - span)
        best = np.minimum(best[: len(best) - step], best[step:])
        span += step
    return (best[:n] & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)


def _windows(raw: np.ndarray, rows: np.ndarray, size: int, gram: int):
    """Word hashes, valid window starts, and each window's n-gram hash and place."""
    start, end, count = word_spans(raw, rows)
    words = spans(prefix_sums(raw, 0), start, end, 0)
    first = np.cumsum(count) - count
    inside = np.arange(len(words)) - np.repeat(first, count)
    grams = window_hashes(words, gram, 1)
    place = least_in_windows(grams, size - gram + 1)
    ok = np.flatnonzero((inside + size <= np.repeat(count, count))[: len(place)])
    return words, inside, np.repeat(np.arange(len(count)), count), ok, grams, place[ok]


def mark(df: DataFrame, size: int = 35, gram: int = 12, text_col: str = "text") -> DataFrame:
    """``key`` (md5 of the text, binary) and ``runs`` of the windows of that
    text that also start elsewhere (binary: start and end word, int64)."""
    spark = df.sparkSession
    ship(spark)
    texts = df.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.unhex(F.md5(F.col(text_col))).alias("key"))
    volume = text_bytes_in(texts, "text")
    buckets = bucket_count(volume)
    bits = sketch.width_bits(volume / 80)

    def anchors(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        raw, rows = text_bytes(batch.column(0))
        for lo, hi in slices(rows, 4 << 20):
            *_, grams, place = _windows(raw[rows[lo] : rows[hi]], rows[lo : hi + 1] - rows[lo], size, gram)
            yield grams[np.unique(place)]

    repeated = spark.sparkContext.broadcast(sketch.merged(texts.select("text"), anchors, bits, (2,))[0])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: list[tuple[np.ndarray, ...]] = []
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            h, g, key, at = (np.concatenate(c) for c in zip(*have, strict=True))
            by, group, sizes = repeats((h, g))
            many = np.zeros(len(h), bool)
            many[by] = sizes[group] > 1
            out = []
            # what repeats here is settled; its text may be here more than once
            own = np.flatnonzero(many)
            names, of = np.unique(key[own], return_inverse=True)
            pairs = np.unique(np.stack([of, at[own]], axis=1), axis=0) if len(own) else np.empty((0, 2), np.int64)
            doc, a, b = as_runs(pairs[:, 0], pairs[:, 1])
            for bucket, cols in dealt((names[doc], a, b), key_buckets(names[doc], buckets)):
                out.append((bucket, 1, pack(cols)))
            one = np.sort(by[np.concatenate([[True], group[1:] != group[:-1]])])  # one record of each window
            send_at = np.where(many[one], _SETTLED, at[one])
            send_key = key[one].copy()
            send_key[many[one]] = np.zeros(1, "V16")[0]
            for bucket, cols in dealt((h[one], g[one], send_key, send_at), (h[one] % np.uint64(buckets)).astype(np.int64)):
                out.append((bucket, 0, pack(cols)))
            for lo in range(0, len(out), 256):
                yield blob_batch(out[lo : lo + 256])

        for batch in batches:
            raw, rows = text_bytes(batch.column(0))
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), "V16")
            for lo, hi in slices(rows, 4 << 20):
                words, inside, doc, ok, grams, place = _windows(raw[rows[lo] : rows[hi]], rows[lo : hi + 1] - rows[lo], size, gram)
                pick = sketch.reaches(repeated.value, grams[place], bits)
                ok, place = ok[pick], place[pick]
                if not len(ok):
                    continue
                h = window_hashes(words, size, 0)[ok]
                have.append((h, (mix(grams[place]) >> np.uint64(32)).astype(np.uint32), keys[lo + doc[ok]], inside[ok]))
                n += len(ok)
                if n >= FLUSH:
                    yield from flush()
                    have, n = [], 0
        if have:
            yield from flush()

    def settle(bucket: int, blobs: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        out = [(bucket, 1, b) for b in blobs.get(1, [])]
        if 0 in blobs:
            h, g, key, at = unpack_all(blobs[0], _WINDOWS)
            by, group, sizes = repeats((h, g))
            many = np.zeros(len(h), bool)
            many[by] = sizes[group] > 1
            own = np.flatnonzero(many & (at != _SETTLED))
            names, of = np.unique(key[own], return_inverse=True)
            order = np.lexsort((at[own], of))
            doc, a, b = as_runs(of[order], at[own][order])
            for to, cols in dealt((names[doc], a, b), key_buckets(names[doc], buckets)):
                out.append((to, 1, pack(cols)))
        for lo in range(0, len(out), 256):
            yield blob_batch(out[lo : lo + 256])

    return runs_by_key(by_bucket(texts.mapInArrow(tidy(gather), SCHEMA), settle, SCHEMA))


def covered(runs: bytes | None, n: int, size: int) -> np.ndarray:
    """Which of ``n`` places the windows of the runs cover."""
    edge = np.zeros(n + 1, np.int64)
    if runs:
        pairs = np.frombuffer(runs, np.int64).reshape(-1, 2)
        np.add.at(edge, pairs[:, 0], 1)
        np.add.at(edge, np.minimum(pairs[:, 1] - 1 + size, n), -1)
    return np.cumsum(edge[:-1]) > 0


def _key_hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)[::2]


def remove(df: DataFrame, size: int = 35, gram: int = 12, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), sift: bool = False) -> DataFrame:
    """``keep`` columns, ``n_words``, ``n_removed`` and ``kept_text`` (kept
    words, one space between): words covered by a repeated window go.  Texts
    meet their windows in one join, and travel once, kept or not.

    With ``sift``, for tables of which few texts hold a repeat (copies taken out
    before), texts are finished where they are unless merged bits of the keys
    that have a window tell of one; only those travel.  The result is the same."""
    sent = keep if text_col in keep else (*keep, text_col)
    own = [f"k{i}" for i in range(len(sent))]
    rows = df.select(*[df[c].alias(k) for c, k in zip(sent, own, strict=True)], F.unhex(F.md5(df[text_col])).alias("key"))
    at, n = sent.index(text_col), len(keep)
    done = T.StructType([*rows.schema.fields[:n], *T.StructType.fromDDL("n_words bigint, n_removed bigint, kept_text string")])
    runs = mark(df, size, gram, text_col)

    def cut(batches: Iterator[pa.RecordBatch], windows: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, PIECE_BYTES * batch.num_rows // max(1, batch.nbytes))
            for lo in range(0, batch.num_rows, step):
                part, total, gone, kept = batch.slice(lo, step), [], [], []
                found = part.column(len(sent)).to_pylist() if windows else [None] * part.num_rows
                for text, own_ in zip(part.column(at), found, strict=True):
                    words = (text.as_py() or "").encode().split()
                    out = covered(own_, len(words), size)
                    total.append(len(words))
                    gone.append(int(out.sum()))
                    kept.append(b" ".join(compress(words, ~out) if gone[-1] else words).decode())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n], pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=done.names)

    rest = None
    if sift:
        spark = df.sparkSession
        runs = staged(runs, "windows")
        bits = sketch.width_bits(runs.count())
        held = spark.sparkContext.broadcast(sketch.merged(runs.select("key"), _key_hashes, bits, (1,))[0])

        def chosen(batches: Iterator[pa.RecordBatch], with_windows: bool) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = batch.column(len(sent)).fill_null(bytes(16))
                may = sketch.reaches(held.value, np.frombuffer(b"".join(keys.to_pylist()), np.uint64)[::2], bits)
                yield batch.filter(pa.array(may if with_windows else ~may))

        rest = rows.mapInArrow(tidy(lambda batches: cut(chosen(batches, False), False)), done)
        rows = rows.mapInArrow(tidy(lambda batches: chosen(batches, True)), rows.schema)
    both = rows.join(runs, "key", "left").select(*own, "runs").mapInArrow(tidy(lambda batches: cut(batches, True)), done)
    return (both if rest is None else rest.union(both)).toDF(*keep, *done.names[n:])


__all__ = ["RUNS", "covered", "least_in_windows", "mark", "remove"]
