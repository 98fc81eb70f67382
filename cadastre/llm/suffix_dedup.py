"""Byte-substring de-duplication by blockwise suffix sorting.

Which 400-byte strings repeat is read off sorted suffixes: equal strings stand
next to each other.  Suffixes are sorted one bucket at a time.  A bucket holds
the suffixes whose string has the same anchor (its least 64-byte gram) at the
same distance, so strings in different buckets differ.  Within a block of
buckets, suffixes are first sorted by their leading bytes; long ties are
resolved by the ranks of a difference-cover sample, computed beforehand: any
two suffixes have, less than a period ahead, positions that are both in the
sample.  Memory is that of one block, however long the ties.

A segment is what an anchor's strings cover: first and last start, and the
bytes between.  A merged count-min sketch of anchors leaves out those that do
not repeat; equal segments are settled by their hash, in the task or after the
shuffle, and different segments of one anchor are sorted.  An anchor counted
more than ``HOT`` times (a passage that a large share of all texts hold, at its
ends) is not gathered in one place: each task sorts its own segments of it and
passes on one record of each distinct string, grouped exactly by 128 bits of
hash.

Defined cases: a null text is empty; texts shorter than the string keep all;
copies of a text (rows repeated, too) are repeats of each other; removed bytes
may cut a character, so the kept text is binary.  A very long text is cut into
segments; kept columns may have any names but those added; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sketch
from .common import map_batches, ship, slices, text_bytes, tidy
from .grouping import (
    RUNS, SCHEMA, as_runs, blob_batch, bucket_count, by_bucket, dealt, key_buckets, pack, repeats, runs_by_key, text_bytes_in,
    unpack, unpack_all,
)
from .hashing import mix, powers, prefix_sums, spans
from .substring_dedup import covered, least_in_windows

#: Bytes of an anchor's gram; occurrences from which an anchor is hot; bytes of segments sorted together; segments a task gathers.
GRAM, HOT, SORT_BYTES, FLUSH_BYTES = 64, 1000, 1 << 20, 12 << 20
#: A perfect difference set: every remainder mod 31 is a difference of two of its members.
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)
LEAD = 32  # leading bytes sorted before ranks are asked; at least the period
_STRINGS = (np.uint64, np.uint64, "V16", np.int64)
_SETTLED = -1


@cache
def _shifts() -> np.ndarray:
    """shift[i mod period, j mod period]: how far ahead both are in the sample."""
    out = np.full((PERIOD, PERIOD), -1, np.int64)
    for i in range(PERIOD):
        for j in range(PERIOD):
            out[i, j] = next(s for s in range(PERIOD) if (i + s) % PERIOD in COVER and (j + s) % PERIOD in COVER)
    return out


def _refined(group: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Dense groups, in order, of elements sorted by group and then keys."""
    by = np.lexsort((*keys[::-1], group))
    head = np.zeros(len(by), np.int64)
    for c in (group, *keys):
        s = c[by]
        head[1:] |= s[1:] != s[:-1]
    out = np.empty(len(by), np.int64)
    out[by] = np.cumsum(head)
    return out


def _words(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes at each place, as numbers in the order of the bytes."""
    return np.ndarray((len(text) - 7,), ">u8", text, strides=(1,))[at].astype(np.uint64)


def sample_ranks(text: np.ndarray, length: int) -> np.ndarray:
    """Rank of the suffix (its first ``length`` bytes or more) at each sample
    position, as periods x cover; ``text`` is padded by twice the length."""
    periods = (len(text) - 2 * length) // PERIOD + 1
    at = (np.arange(periods)[:, None] * PERIOD + np.array(COVER)).ravel()
    rank = _refined(np.zeros(len(at), np.int64), *[_words(text, at + k) for k in range(0, LEAD, 8)])
    have, ahead = LEAD, 1  # periods to the second half, at most the bytes ranked so far
    while have < length:
        ahead = have // PERIOD
        second = np.full(len(at), -1, np.int64)
        off = ahead * len(COVER)
        second[: max(0, len(at) - off)] = rank[off:]
        rank = _refined(rank, second)
        have += ahead * PERIOD
    return rank.reshape(periods, len(COVER))


def _same(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` bytes at two places are equal."""
    out = np.ones(len(a), bool)
    for k in [*range(0, length - 7, 8), length - 8]:
        left = np.flatnonzero(out)
        out[left] = _words(text, a[left] + k) == _words(text, b[left] + k)
    return out


def equal_strings(text: np.ndarray, at: np.ndarray, bucket: np.ndarray, length: int) -> np.ndarray:
    """Group of each start: the same exactly where the bucket and the
    ``length`` (at least LEAD) bytes there are."""
    padded = np.concatenate([text, np.zeros(2 * length + 2 * PERIOD + 8, np.uint8)])
    group = np.unique(bucket, return_inverse=True)[1].astype(np.int64)
    tied = np.arange(len(at))

    def still() -> np.ndarray:
        return tied[np.bincount(group)[group[tied]] > 1]

    for k in range(0, LEAD, 8):
        if not len(tied := still()):
            return group
        group[tied] = group.max() + 1 + _refined(group[tied], _words(padded, at[tied] + k))
    if not len(tied := still()):
        return group
    rank, shifts, place = sample_ranks(padded, length), _shifts(), np.full(PERIOD, -1)
    place[list(COVER)] = np.arange(len(COVER))
    rank_at = lambda p: rank[p // PERIOD, place[p % PERIOD]]
    # sort every tie by a pivot, all at once; a path has one base-3 digit for each pivot that an element met
    tied = tied[np.argsort(group[tied], kind="stable")]
    order = _refined(group[tied])
    path, digit = np.zeros(len(tied), np.int64), 3**38
    live, of = np.arange(len(tied)), order.copy()
    pick = np.random.default_rng(len(tied))
    while len(live):
        live, of = live[by := pick.permutation(len(live))], of[by]
        pivot = np.empty(of.max() + 1, np.int64)
        pivot[of] = at[tied[live]]  # whichever comes last
        p, q = at[tied[live]], pivot[of]
        ahead = shifts[p % PERIOD, q % PERIOD]
        side = np.sign(rank_at(p + ahead) - rank_at(q + ahead))
        path[live] += (side + 1) * digit
        if digit == 1:  # the paths are full: number the groups anew
            order, digit = _refined(order, path), 3**39
            path[:] = 0
        digit //= 3
        off = side != 0
        live, of = live[off], _refined(of[off], side[off])
        many = np.bincount(of, minlength=1)[of] > 1
        live, of = live[many], _refined(of[many])
    by = np.lexsort((path, order))
    first, second = tied[by[:-1]], tied[by[1:]]
    same = (group[first] == group[second]) & _same(padded, at[first], at[second], length)
    group[tied[by]] = group.max() + 1 + np.cumsum(np.concatenate([[0], ~same]).astype(np.int64))
    return group


def cut(text: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The pieces of ``text``, one after another."""
    view = memoryview(np.ascontiguousarray(text))
    return np.frombuffer(b"".join([view[a : a + n] for a, n in zip(start.tolist(), size.tolist(), strict=True)]), np.uint8)


class Segments:
    """Segments in columns, and their bytes one after another."""

    kinds = (np.uint64, np.uint64, np.uint64, np.int64, np.int64, np.int64, "V16")

    def __init__(self, columns: tuple[np.ndarray, ...], text: np.ndarray, length: int):
        self.anchor, self.h1, self.h2, self.first, self.count, self.ahead, self.key = self.columns = columns
        self.text, self.length = text, length
        self.size = self.count - 1 + length
        self.start = np.cumsum(self.size) - self.size

    def pick(self, some: np.ndarray) -> Segments:
        return Segments(tuple(c[some] for c in self.columns), cut(self.text, self.start[some], self.size[some]), self.length)

    def dumped(self) -> bytes:
        return pack((self.anchor, self.h1, self.h2, self.first, self.count, self.ahead, self.key), self.text)

    @classmethod
    def loaded(cls, blobs: list[bytes], length: int) -> Segments:
        parts = [unpack(b, cls.kinds, rest=True) for b in blobs]
        *columns, text = (np.concatenate(c) for c in zip(*parts, strict=True))
        return cls(tuple(columns), text, length)

    def strings(self) -> tuple[np.ndarray, np.ndarray]:
        """Segment and number of each string that starts in one."""
        of = np.repeat(np.arange(len(self.count)), self.count)
        return of, np.arange(len(of)) - np.repeat(np.cumsum(self.count) - self.count, self.count)

    def equal(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Segment, number and group of each string; equal strings have equal
        groups.  Anchors are taken some at a time."""
        by = np.argsort(self.anchor, kind="stable")
        cut = np.flatnonzero(np.concatenate([[True], self.anchor[by][1:] != self.anchor[by][:-1], [True]]))
        volume = np.concatenate([[0], np.cumsum(self.size[by])])
        segs, nums, groups, lo, base = [], [], [], 0, 0
        while lo < len(cut) - 1:
            hi = max(lo + 1, int(np.searchsorted(volume[cut], volume[cut[lo]] + SORT_BYTES, "right")) - 1)
            some = by[cut[lo] : cut[hi]]
            part = self.pick(some)
            of, num = part.strings()
            bucket = np.unique(part.anchor, return_inverse=True)[1][of] * (self.length + 1) + (part.ahead[of] - num)
            group = equal_strings(part.text, part.start[of] + num, bucket, self.length)
            segs.append(some[of])
            nums.append(num)
            groups.append(group + base)
            base, lo = base + int(group.max()) + 1, hi
        return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in (segs, nums, groups))


def _segments(raw: np.ndarray, rows: np.ndarray, length: int, anchors_only: bool = False):
    """Anchor hash of each segment and, unless only these are asked for, first
    start, starts, anchor place, row and running sums."""
    none = np.empty(0, np.int64)
    if len(raw) < length:
        return (np.empty(0, np.uint64), none, none, none, none, None)
    sums = prefix_sums(raw, 0)
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * powers(0, len(raw) - GRAM + 1, True))
    place = least_in_windows(grams, length - GRAM + 1)
    edge = np.zeros(len(raw) + 1, np.int64)
    long = np.flatnonzero(np.diff(rows) >= length)
    np.add.at(edge, rows[long], 1)
    np.add.at(edge, rows[long + 1] - length + 1, -1)
    ok = np.cumsum(edge[: len(place)]) > 0
    head = ok.copy()
    head[1:] &= ~ok[:-1] | (place[1:] != place[:-1])
    head[rows[long]] = True
    first = np.flatnonzero(head)
    anchors = grams[place[first]]
    if anchors_only:
        return anchors
    row = np.searchsorted(rows, first, "right") - 1
    end = np.minimum(np.append(first[1:], len(raw)), rows[row + 1] - length + 1)
    return anchors, first, end - first, place[first], row, sums


def mark(df: DataFrame, length: int = 400, text_col: str = "text", hot: int = HOT) -> DataFrame:
    """``key`` (md5 of the text, binary) and ``runs`` (binary: first start and
    one past the last, int64) of the strings of that text that also start
    elsewhere."""
    if length < 2 * GRAM:
        raise ValueError(f"strings have {2 * GRAM} bytes at least")
    spark = df.sparkSession
    ship(spark)
    texts = df.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.unhex(F.md5(F.col(text_col))).alias("key"))
    volume = text_bytes_in(texts, "text")
    buckets = bucket_count(volume)
    bits = sketch.width_bits(2 * volume / (length - GRAM))

    def anchors(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        raw, rows = text_bytes(batch.column(0))
        for lo, hi in slices(rows, 1 << 20):
            got = _segments(raw[rows[lo] : rows[hi]], rows[lo : hi + 1] - rows[lo], length, True)
            yield got if isinstance(got, np.ndarray) else got[0]

    levels = spark.sparkContext.broadcast(sketch.merged(texts.select("text"), anchors, bits, (2, hot)))

    def replies(key: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple[int, int, bytes]]:
        return [(b, 1, pack(cols)) for b, cols in dealt((key, start, end), key_buckets(key, buckets))]

    def string_runs(segs: Segments, seg: np.ndarray, num: np.ndarray) -> list[tuple[int, int, bytes]]:
        """Replies for some strings of unsettled segments."""
        by = np.lexsort((num, seg))
        doc, a, b = as_runs(seg[by], num[by])
        return replies(segs.key[doc], segs.first[doc] + a, segs.first[doc] + b)

    def settle_equal(segs: Segments) -> tuple[Segments, list[tuple[int, int, bytes]]]:
        """One segment of each equal ones, settled if there are more, and replies."""
        if not len(segs.count):
            return segs, []
        by, group, sizes = repeats((segs.anchor, segs.h1, segs.h2))
        many = np.zeros(len(by), bool)
        many[by] = sizes[group] > 1
        own = np.flatnonzero(many & (segs.first != _SETTLED))
        out = replies(segs.key[own], segs.first[own], segs.first[own] + segs.count[own])
        one = np.sort(by[np.concatenate([[True], group[1:] != group[:-1]])])
        left = segs.pick(one)
        left.first[many[one]] = _SETTLED
        return left, out

    def flush(segs: Segments, is_hot: np.ndarray) -> Iterator[pa.RecordBatch]:
        rest, out = settle_equal(segs.pick(np.flatnonzero(~is_hot)))
        for b, (some,) in dealt((np.arange(len(rest.count)),), (rest.anchor % np.uint64(buckets)).astype(np.int64)):
            out.append((b, 0, rest.pick(some).dumped()))
        if is_hot.any():
            crowd, more = settle_equal(segs.pick(np.flatnonzero(is_hot)))
            out += more
            seg, num, group = crowd.equal()
            size = np.bincount(group)
            many = size[group] > 1
            own = many & (crowd.first[seg] != _SETTLED)
            out += string_runs(crowd, seg[own], num[own])
            many |= crowd.first[seg] == _SETTLED
            # one record of each string, a settled one if there is one
            by = np.lexsort((~many, group))
            by = by[np.concatenate([[True], group[by][1:] != group[by][:-1]])]
            seg, num, many = seg[by], num[by], many[by]
            at = crowd.start[seg] + num
            h1, h2 = (spans(prefix_sums(crowd.text, w), at, at + length, w) for w in (0, 1))
            for b, cols in dealt((h1, h2, crowd.key[seg], np.where(many, _SETTLED, crowd.first[seg] + num)), (h1 % np.uint64(buckets)).astype(np.int64)):
                out.append((b, 2, pack(cols)))
        for lo in range(0, len(out), 64):
            yield blob_batch(out[lo : lo + 64])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, texts_, heat, size = [], [], [], 0

        def close() -> Iterator[pa.RecordBatch]:
            segs = Segments(tuple(np.concatenate(c) for c in zip(*have, strict=True)), np.concatenate(texts_), length)
            return flush(segs, np.concatenate(heat))

        for batch in batches:
            raw_all, rows = text_bytes(batch.column(0))
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), "V16")
            for lo, hi in slices(rows, 1 << 20):
                raw = raw_all[rows[lo] : rows[hi]]
                anchor, first, count, place, row, sums = _segments(raw, own := rows[lo : hi + 1] - rows[lo], length)
                pick = np.flatnonzero(sketch.reaches(levels.value[0], anchor, bits))
                if not len(pick):
                    continue
                anchor, first, count, place, row = (x[pick] for x in (anchor, first, count, place, row))
                end = first + count - 1 + length
                other = prefix_sums(raw, 1)
                have.append((anchor, spans(sums, first, end, 0), spans(other, first, end, 1), first - own[row], count, place - first, keys[lo + row]))
                n = end - first
                texts_.append(cut(raw, first, n))
                heat.append(sketch.reaches(levels.value[1], anchor, bits))
                size += int(n.sum())
                if size >= FLUSH_BYTES:
                    yield from close()
                    have, texts_, heat, size = [], [], [], 0
        if have:
            yield from close()

    def settle(bucket: int, blobs: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        out = [(bucket, 1, b) for b in blobs.get(1, [])]
        if 0 in blobs:
            segs, more = settle_equal(Segments.loaded(blobs[0], length))
            out += more
            of, size = np.unique(segs.anchor, return_inverse=True, return_counts=True)[1:]
            segs = segs.pick(np.flatnonzero(size[of] > 1))  # different segments of one anchor
            if len(segs.count):
                seg, num, group = segs.equal()
                own = (np.bincount(group)[group] > 1) & (segs.first[seg] != _SETTLED)
                out += string_runs(segs, seg[own], num[own])
        if 2 in blobs:
            h1, h2, key, at = unpack_all(blobs[2], _STRINGS)
            by, group, sizes = repeats((h1, h2))
            many = np.zeros(len(h1), bool)
            many[by] = sizes[group] > 1
            own = np.flatnonzero(many & (at != _SETTLED))
            names, of = np.unique(key[own], return_inverse=True)
            order = np.lexsort((at[own], of))
            doc, a, b = as_runs(of[order], at[own][order])
            out += replies(names[doc], a, b)
        for lo in range(0, len(out), 64):
            yield blob_batch(out[lo : lo + 64])

    return runs_by_key(by_bucket(texts.mapInArrow(tidy(gather), SCHEMA), settle, SCHEMA))


def remove(df: DataFrame, length: int = 400, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), hot: int = HOT) -> DataFrame:
    """``keep`` columns, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    runs) and ``kept`` (binary): bytes covered by a repeated string go."""
    own = [f"k{i}" for i in range(len(keep))]
    keyed = df.select(*[df[c].alias(k) for c, k in zip(keep, own, strict=True)], df[text_col].alias("text"), F.unhex(F.md5(df[text_col])).alias("key"))
    both = keyed.join(mark(df, length, text_col, hot), "key", "left")

    def fn(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        total, gone, cuts, kept = [], [], [], []
        for text, own in zip(batch.column(0), batch.column(1), strict=True):
            data = (text.as_py() or "").encode()
            out = covered(own.as_py(), len(data), length) if own.is_valid else np.zeros(1, bool)
            total.append(len(data))
            gone.append(int(out.sum()))
            cuts.append(int(out[0]) + int((out[1:] & ~out[:-1]).sum()) if len(out) else 0)
            kept.append(np.frombuffer(data, np.uint8)[~out].tobytes() if gone[-1] else data)
        return {"n_bytes": pa.array(total, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "n_spans": pa.array(cuts, pa.int64()),
                "kept": pa.array(kept, pa.binary())}

    out = map_batches(both, ("text", "runs"), tuple(own), "n_bytes bigint, n_removed bigint, n_spans bigint, kept binary", fn)
    return out.toDF(*keep, *out.columns[len(keep) :])


__all__ = ["RUNS", "Segments", "equal_strings", "mark", "remove", "sample_ranks"]
