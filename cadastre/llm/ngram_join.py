"""Exact n-gram Jaccard join by T-occurrence search.

Texts become sets of word n-gram hashes.  Two sets of Jaccard similarity ``t``
or more differ in at most H elements, H fixed by their sizes; cutting the hash
range into more than H parts leaves the others equal, so equal parts (of sets in
the same or the next size class) name all pairs that can link.  A set that
shares fewer parts than any partner would is out first, then one that shares
fewer n-grams; the others are linked to the least set of each part.
Components of the pairs so named are searched one by one: a component gets an
inverted index, each document merges its short lists with a heap, probes the
long ones by binary search (DivideSkip), and links with whatever reaches the
required overlap.  Only one link between two groups already joined matters, so
candidates of a document's own group are passed over.

Bounded work for hot groups: equal sets are one row from the start; each map
task passes on one row for a part however many of its sets have it; a component
over ``block_rows`` sets is searched in blocks of that size, then each two blocks
for links of what is not yet in the component's largest group; tasks read the two from
a table, so what is written grows with the sets, not with their pairs.

Defined cases: words are runs without blanks, A-Z lower-cased; a text with
fewer words than n is one n-gram of all its words; a text without words, or
null, has an empty set and links with nothing; rows repeat as they are; the
class id is the smallest non-null id reachable (null if there is none).  A very
long text is one set, held whole by a task; other columns, also of clashing names,
are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import sketch
from .common import LARGE_ROWS, discard, map_batches, ship, slices, staged, text_bytes, tidy
from .components import components
from .grouping import SCHEMA, blob_batch, by_bucket, pack, text_bytes_in, unpack
from .hashing import LOWER, mix, prefix_sums, spans, word_spans

#: Width of a size class, as a ratio.
CLASS_RATIO = 1.5
#: A block holds about so many sets, or so many times as many n-grams.
BLOCK_ROWS, BLOCK_SHINGLES = 4096, 400
#: Members of a block's largest group that are compared with those of other blocks first.
HUBS = 16
#: Text bytes for each bucket of parts, and parts a task gathers before it passes them on.
PART_BYTES, FLUSH = 16 << 20, 1_500_000
#: Short lists of up to this many entries are merged with a heap, larger ones by counting.
HEAP_ENTRIES = 512


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted set of n-gram hashes of each row."""
    raw, rows = text_bytes(column)
    raw = LOWER[raw]
    for lo, hi in slices(rows, 2 << 20):
        part, own = raw[rows[lo] : rows[hi]], rows[lo : hi + 1] - rows[lo]
        start, end, count = word_spans(part, own)
        words = spans(prefix_sums(part, 0), start, end, 0)
        grams = words[: max(0, len(words) - n + 1)].copy()
        for k in range(1, n):
            grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - n + 1 + k])
        at = 0
        for c in count.tolist():
            if c >= n:
                yield np.unique(grams[at : at + c - n + 1])
            elif c:
                whole = np.uint64(c)
                for w in words[at : at + c]:
                    whole = mix(np.array([whole]) * np.uint64(0xC2B2AE3D27D4EB4F) + w)[0]
                yield np.array([whole], np.uint64)
            else:
                yield np.empty(0, np.uint64)
            at += c


def _class_of(n: int) -> int:
    """Size class: class k has the sizes from floor(1.5**k) on."""
    k = max(0, floor(log(n) / log(CLASS_RATIO)))
    while floor(CLASS_RATIO ** (k + 1)) <= n:
        k += 1
    while k and floor(CLASS_RATIO**k) > n:
        k -= 1
    return k


def part_signatures(grams: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """Signatures (64-bit) of the set's parts under each size class that a
    partner of similarity ``percent`` / 100 may share with it, and how many of
    them any such partner shares at least."""
    n = len(grams)
    out, least = [], n + 1
    own = _class_of(n)
    most = n * 100 // percent  # of a partner
    for k in (own, own + 1):
        if k > own and most < floor(CLASS_RATIO**k):
            continue
        top = floor(CLASS_RATIO ** (k + 1)) - 1  # largest size in class k
        apart = (100 - percent) * 2 * top // (100 + percent)  # elements in which two linked sets differ, at most
        parts = apart + 3 + apart // 8
        edges = np.searchsorted(grams, (np.arange(1, parts, dtype=np.uint64) * np.uint64((2**64 - 1) // parts)))
        edges = np.concatenate([[0], edges, [n]])
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(grams), out=sums[1:])  # a sum is the same in any order and over any bounds
        part = sums[edges[1:]] - sums[edges[:-1]]
        label = np.arange(parts, dtype=np.uint64) * np.uint64(1 << 20) + np.uint64(k)
        filled = edges[1:] - edges[:-1]
        signed = mix(part + mix(label) + filled.astype(np.uint64))
        # a difference spoils one part: with more filled parts than differences the rest of them is equal;
        # only else do empty parts count
        whole = np.count_nonzero(filled)
        out.append(signed[filled > 0] if whole > apart else signed)
        least = min(least, max(1, whole - apart))
    return np.concatenate(out), least


class Groups:
    """Union-find over 0 .. n - 1, the least member as the root."""

    def __init__(self, labels: np.ndarray):
        self.of = labels.copy()  # every entry is a root: relabelled on each union
        self.members = {}
        for i, g in enumerate(labels.tolist()):
            self.members.setdefault(g, []).append(i)

    def union(self, a: int, b: int) -> None:
        x, y = self.of[a], self.of[b]
        if x == y:
            return
        if len(self.members[x]) < len(self.members[y]):
            x, y = y, x
        gone = self.members.pop(y)
        self.of[gone] = x
        self.members[x] += gone


def t_occurrence(sets: list[np.ndarray], percent: int, labels: np.ndarray | None = None, asking: np.ndarray | None = None,
                 sides: np.ndarray | None = None) -> Groups:
    """Groups of ``sets`` (non-empty, distinct) linked at similarity ``percent``
    / 100, joined to the groups that ``labels`` gives; with ``asking``, only
    links of at least one set for which it is true are looked for, with
    ``sides`` only those of sets on different sides."""
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")  # a set looks for partners of its size or less, which stand before it
    rank = np.empty(len(sets), np.int64)
    rank[order] = np.arange(len(sets))
    sizes = sizes[order]
    labels = np.arange(len(sets)) if labels is None else labels[order]
    asks = np.ones(len(sets), bool) if asking is None else asking[order]
    side = None if sides is None else sides[order]
    groups = Groups(labels)
    grams = np.concatenate([sets[i] for i in order])
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    by = np.argsort(grams, kind="stable")
    grams, owner = grams[by], owner[by]
    heads = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    width = np.diff(np.append(heads, len(grams)))
    listed = np.empty(len(grams), np.int32)
    listed[by] = np.repeat(np.arange(len(heads), dtype=np.int32), width)  # of each set's elements, the list
    keys = np.repeat(np.arange(len(heads)) * len(sets), width) + owner  # all lists as one sorted run
    first = np.concatenate([[0], np.cumsum(sizes)])
    for x in range(len(sets)):
        n = int(sizes[x])
        need = -(-n * percent // 100)  # overlap with any partner of at most n elements
        lo = int(np.searchsorted(sizes, need))  # and its size at least
        if lo >= x:
            continue
        own = listed[first[x] : first[x + 1]]
        own = own[np.argsort(width[own], kind="stable")]
        n_short = n - need + 1  # a partner is in one of these, however the rest falls
        short, long = own[:n_short], own[n_short:]
        entries = int(width[short].sum())
        if entries == n_short:
            continue  # only x itself
        ok = None if asks[x] else asks
        if entries <= HEAP_ENTRIES:
            lists = [owner[heads[i] : heads[i] + width[i]].tolist() for i in short.tolist() if width[i] > 1]
            found: dict[int, int] = {}
            for y in heapq.merge(*lists):
                if lo <= y < x:
                    found[y] = found.get(y, 0) + 1
            cand = np.fromiter(found, np.int64, len(found))
            seen = np.fromiter(found.values(), np.int64, len(found))
        else:
            flat = np.concatenate([owner[heads[i] : heads[i] + width[i]] for i in short.tolist()])
            counts = np.bincount(flat[(flat >= lo) & (flat < x)], minlength=1)
            cand = np.flatnonzero(counts)
            seen = counts[cand]
        if ok is not None and len(cand):
            keep = ok[cand]
            cand, seen = cand[keep], seen[keep]
        if side is not None and len(cand):
            keep = side[cand] != side[x]
            cand, seen = cand[keep], seen[keep]
        best = np.argsort(-seen, kind="stable")
        cand, seen = cand[best], seen[best]
        while len(cand):
            keep = groups.of[cand] != groups.of[x]
            cand, seen = cand[keep], seen[keep]
            if not len(cand):
                break
            some, got = cand[:64], seen[:64].copy()
            if len(long):  # binary probes of the long lists
                want = (long[:, None].astype(np.int64) * len(sets) + some[None, :]).ravel()
                place = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                got += (keys[place] == want).reshape(len(long), -1).sum(axis=0)
            linked = some[100 * got >= percent * (n + sizes[some] - got)]
            for y in linked.tolist():
                groups.union(x, y)
            cand, seen = cand[64:], seen[64:]
    return Groups(groups.of[rank])


def _search(frame: DataFrame, n: int, percent: int, labelled: bool) -> DataFrame:
    """``frame``: block, digest, text, label, asks.  Links (a, b) of digests that
    join the groups found in each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(rows: list[tuple]) -> pa.RecordBatch | None:
            seen: dict[bytes, tuple] = {}
            for r in rows:  # a set may come twice, once asking
                if r[0] not in seen or r[3]:
                    seen[r[0]] = r
            rows = list(seen.values())
            if len(rows) < 2:
                return None
            sets = list(shingle_sets(pa.array([r[1] for r in rows], pa.string()), n))
            label = None
            if labelled:
                names: dict[bytes, int] = {}
                label = np.array([names.setdefault(r[2], len(names)) for r in rows])
            groups = t_occurrence(sets, percent, label, np.array([r[3] for r in rows]) if labelled else None)
            a, b = [], []
            for members in groups.members.values():
                least = min(members, key=lambda i: rows[i][0])
                a += [rows[i][0] for i in members if i != least]
                b += [rows[least][0]] * (len(members) - 1)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"]) if a else None

        block, rows = None, []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[0] != block:
                    if rows and (made := close(rows)):
                        yield made
                    block, rows = r[0], []
                rows.append(r[1:])
        if rows and (made := close(rows)):
            yield made

    return frame.repartition("block").sortWithinPartitions("block").select("block", "digest", "text", "label", "asks").mapInArrow(
        tidy(run), "a binary, b binary")


def _hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield batch.column(0).to_numpy().view(np.uint64)


def _planes(values: np.ndarray) -> np.ndarray:
    """The bytes of numbers, all first ones, then all second ones …: in sorted
    numbers the leading ones repeat and compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).ravel()


def _from_planes(data: np.ndarray, kind: type, n: int) -> np.ndarray:
    return np.ascontiguousarray(data.reshape(-1, n).T).view(kind).ravel()


def _runs(key: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different (part, key) pairs in order, where each part begins, and its number of keys for each pair."""
    by = np.lexsort((key, part))
    key, part = key[by], part[by]
    new = np.concatenate([[True], (part[1:] != part[:-1]) | (key[1:] != key[:-1])])
    key, part = key[new], part[new]
    head = np.concatenate([[True], part[1:] != part[:-1]])
    return key, part, head, np.bincount(np.cumsum(head) - 1)[np.cumsum(head) - 1]


def _least_keys(key: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (a, b) of each part's other keys to its least one; the parts, and the least keys."""
    key, part, head, _ = _runs(key, part)
    least = key[head][np.cumsum(head) - 1]
    other = key != least
    pairs = np.unique(np.stack([key[other], least[other]], axis=1), axis=0) if other.any() else np.empty((0, 2), np.int64)
    return pairs[:, 0], pairs[:, 1], part[head], key[head]


#: Kinds of blobs: parts with a key each; counts (phase one) or links (phase two); parts known to be shared.
_KEYED, _DONE, _SHARED = 0, 1, 2


def _deal_parts(texts: DataFrame, n: int, percent: int, link: bool, keep: tuple | None = None, whole: bool = False) -> DataFrame:
    """Deals the parts of the sets of ``texts`` (text, key) by bucket, packed;
    with ``whole`` their n-grams, each as a part.  A task settles what it can: a
    part is one record a task however many of its sets have it.

    Phase one (``link`` false) gives ``a`` (key), ``b`` (parts that it shares)
    and ``c`` (how many any partner shares); phase two the links (a, b) of keys
    that share a part, for the keys that the filter ``keep`` lets through."""
    buckets = 1 << max(6, int(text_bytes_in(texts, "text") // PART_BYTES).bit_length())
    shift = np.uint64(64 - (buckets.bit_length() - 1))

    def keyed(kind: int, key: np.ndarray, part: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
        cut = np.searchsorted(part >> shift, np.arange(buckets + 1, dtype=np.uint64))
        for i, (lo, hi) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
            if hi > lo:
                names, of = np.unique(key[lo:hi], return_inverse=True)
                yield i, kind, pack((names,), np.concatenate([_planes(part[lo:hi]), _planes(of.astype(np.uint32))]))

    def flush(keys: list[np.ndarray], parts: list[np.ndarray], needs: dict[int, int], places: Iterator[int]) -> Iterator[pa.RecordBatch]:
        key, part = np.concatenate(keys), np.concatenate(parts)
        if link:
            a, b, part, key = _least_keys(key, part)
            out = [(next(places) % buckets, _DONE, pack((a, b, b)))] if len(a) else []
            out += keyed(_KEYED, key, part)
        else:
            key, part, head, size = _runs(key, part)
            many = size > 1
            names, shared = np.unique(key[many], return_counts=True)
            own = np.array(list(needs), np.int64)
            count = np.zeros(len(own), np.int64)
            if len(names):
                at = np.minimum(np.searchsorted(names, own), len(names) - 1)
                count = np.where(names[at] == own, shared[at], 0)
            out = [(next(places) % buckets, _DONE, pack((own, count, np.array(list(needs.values()), np.int64))))]
            out += keyed(_KEYED, key[~many], part[~many])
            out += keyed(_SHARED, np.zeros(int((many & head).sum()), np.int64), part[many & head])
        for lo in range(0, len(out), 64):
            yield blob_batch(out[lo : lo + 64])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, parts, needs, have = [], [], {}, 0
        places = itertools.count(7919 * TaskContext.get().partitionId())  # what is settled goes to a bucket of the task's own
        for batch in batches:
            column, key = batch.column(0), batch.column(1).to_numpy()
            if keep:
                pick = sketch.reaches(keep[0].value, key.view(np.uint64), keep[1])
                column, key = column.filter(pa.array(pick)), key[pick]
            for k, s in zip(key.tolist(), shingle_sets(column, n), strict=True):
                if not len(s):
                    continue
                own, needs[k] = (s, -(-len(s) * percent // 100)) if whole else part_signatures(s, percent)
                parts.append(own)
                keys.append(np.full(len(own), k, np.int64))
                have += len(own)
                if have >= FLUSH:
                    yield from flush(keys, parts, needs, places)
                    keys, parts, needs, have = [], [], {}, 0
        if keys:
            yield from flush(keys, parts, needs, places)

    def read(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        keys, parts = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for blob in blobs:
            names, data = unpack(blob, (np.int64,), rest=True)
            count = len(data) // 12
            parts.append(_from_planes(data[: 8 * count], np.uint64, count))
            keys.append(names[_from_planes(data[8 * count :], np.uint32, count)])
        return np.concatenate(keys), np.concatenate(parts)

    def settle(bucket: int, blobs: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        out = [tuple(unpack(x, (np.int64, np.int64, np.int64))) for x in blobs.get(_DONE, [])]
        if _KEYED in blobs:
            key, part = read(blobs[_KEYED])
            if link:
                a, b = _least_keys(key, part)[:2]
                out.append((a, b, b))
            else:
                known = np.unique(read(blobs.get(_SHARED, []))[1])
                key, part, _, size = _runs(key, part)
                shared = (size > 1) | np.isin(part, known)
                names, count = np.unique(key[shared], return_counts=True)
                out.append((names, count, np.zeros(len(names), np.int64)))
        for a, b, c in out:
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, c)], names=["a", "b", "c"])

    return by_bucket(texts.select("text", "key").mapInArrow(tidy(gather), SCHEMA), settle, "a bigint, b bigint, c bigint")


def _signature_links(texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) of keys that share a part, among the keys that share as many
    parts, and then as many n-grams, as any partner would (most share none, or
    those of a passage)."""
    spark = texts.sparkSession
    keep = None
    for whole in (False, True):
        counts = _deal_parts(texts, n, percent, False, keep, whole).groupBy("a").agg(F.sum("b").alias("shared"), F.max("c").alias("least"))
        live = staged(counts.where("shared >= least").select("a"), "live")
        bits = sketch.width_bits(live.count())
        keep = (spark.sparkContext.broadcast(sketch.merged(live, _hashes, bits, (1,))[0]), bits)
    return _deal_parts(texts, n, percent, True, keep).select("a", "b")


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, percent: int = 90,
            block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per row: the id, ``n_shingles`` (set size), ``component_id``
    (smallest id reachable by links of similarity ``percent`` / 100 or more) and
    ``text_hash`` (xxhash64), which tells rows of one id apart."""
    spark = df.sparkSession
    ship(spark)
    shared = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))

    def sets(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        size, digest, key = [], [], []
        for s in shingle_sets(batch.column(0), n):
            d = hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
            size.append(len(s))
            digest.append(d)
            key.append(int.from_bytes(d[:8], "little", signed=True) if d else None)
        return {"n_shingles": pa.array(size, pa.int64()), "digest": pa.array(digest, pa.binary()), "key": pa.array(key, pa.int64())}

    docs = staged(map_batches(shared, ("text",), ("id", "th"), "n_shingles bigint, digest binary, key bigint", sets), "documents")
    # in the search for links a set goes by the hash of its text: equal sets of other texts meet as equal parts
    named = components(_signature_links(shared.where("text is not null").withColumnRenamed("th", "key"), n, percent))
    # one row of each set that may link: its text is fetched by id and text hash, its set made again
    held = docs.where("digest is not null").join(named.withColumnRenamed("node", "th"), "th")
    one = staged(held.groupBy("digest", "component").agg(F.min(F.struct("id", "th")).alias("row"), F.max("n_shingles").alias("n")).select(
        "digest", "component", "n", F.col("row.id").alias("id"), F.col("row.th").alias("th")), "asked")
    # a filter of the texts asked for keeps the others from the shuffle; it lets some more pass, never fewer
    bits = sketch.width_bits(one.count())
    asked = spark.sparkContext.broadcast(sketch.merged(one.select("th"), _hashes, bits, (1,))[0])

    def wanted(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        pick = sketch.reaches(asked.value, batch.column(1).to_numpy().view(np.uint64), bits)
        return {"text": batch.column(0).take(pa.array(np.arange(len(pick)), mask=~pick))}

    size = one.groupBy("component").agg(F.greatest(F.count("*"), F.sum("n") / BLOCK_SHINGLES).alias("size"))
    blocks = F.ceil(F.col("size") / block_rows).cast("int")
    named_rows = staged(one.join(size, "component").withColumn("blocks", blocks).withColumn(
        "sub", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")), "blocks")
    left = map_batches(shared, ("text", "th"), ("id", "th"), "text string", wanted).where("text is not null").alias("l")
    right = named_rows.hint("merge").alias("r")
    found = staged(left.join(right, F.col("l.th").eqNullSafe(F.col("r.th")) & F.col("l.id").eqNullSafe(F.col("r.id"))).select(
        "r.component", "r.blocks", "r.sub", "r.digest", "l.text"), "texts")
    plain = found.select(F.concat_ws("/", "component", "sub").alias("block"), "digest", "text",
                         F.lit(None).cast("binary").alias("label"), F.lit(True).alias("asks"))
    links = staged(_search(plain, n, percent, False), "near")
    hot = found.where("blocks > 1")
    if not hot.isEmpty():
        links = _across_blocks(hot, links, n, percent, block_rows)
    joined = components(links)
    discard(found, one, named_rows, links)
    of = docs.where("digest is not null").join(joined.withColumnRenamed("node", "digest"), "digest", "left").select(
        "id", "th", "n_shingles", F.coalesce("component", "digest").alias("class"))
    least = staged(of.groupBy("class").agg(F.min("id").alias("component_id")), "least")
    out = of.join(least, "class").select("id", "n_shingles", "component_id", "th").union(
        docs.where("digest is null").select("id", "n_shingles", "id", "th"))
    return out.toDF(id_col, "n_shingles", "component_id", "text_hash")


def representatives(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df`` without near duplicates: of each class the row of its
    smallest id (once, if that row is repeated; of rows of one id and text the
    first by all columns).  Rows without words stay; of a class without any id,
    one row for each different text.  Columns of any names pass through."""
    found = classes(df, id_col, text_col, n, percent)
    name = lambda id_, th: F.concat_ws("/", F.coalesce(id_.cast("string"), F.lit("-")), th)
    kept = found.where(F.col(id_col).eqNullSafe(F.col("component_id"))).select(name(F.col(id_col), F.col("text_hash")).alias("row")).distinct()
    own = [f"k{i}" for i in range(len(df.columns))]
    keyed = df.toDF(*own).withColumn("row", name(F.col(own[df.columns.index(id_col)]), F.xxhash64(own[df.columns.index(text_col)])))
    first = Window.partitionBy("row").orderBy(*own)
    alone = keyed.join(kept, "row").withColumn("n", F.row_number().over(first)).where("n = 1")
    return alone.select(*own).toDF(*df.columns)


def _across_blocks(hot: DataFrame, links: DataFrame, n: int, percent: int, block_rows: int) -> DataFrame:
    """Links between the blocks of large components, added to ``links``."""

    def grouped(now: DataFrame) -> DataFrame:
        named = components(now).withColumnRenamed("node", "digest").withColumnRenamed("component", "group")
        return staged(hot.join(named, "digest", "left").withColumn("label", F.coalesce("group", "digest")).select(
            "component", "blocks", "sub", "digest", "text", "label"), "hot")

    # some members of each block's largest group, together: this joins the groups of one crowd
    of = grouped(links)
    count = of.groupBy("component", "sub", "label").agg(F.count("*").alias("members"))
    largest = count.groupBy("component", "sub").agg(F.max(F.struct("members", "label")).alias("top")).select(
        "component", "sub", F.col("top.label").alias("label"))
    hubs = of.join(largest, ["component", "sub", "label"]).withColumn(
        "r", F.row_number().over(Window.partitionBy("component", "sub").orderBy("digest"))).where(F.col("r") <= HUBS)
    chunk = F.floor(F.col("sub") / max(1, block_rows // HUBS)).cast("int")
    first = hubs.select(F.concat_ws("/", "component", chunk).alias("block"), "digest", "text", "label", F.lit(True).alias("asks"))
    before, links = links, staged(links.union(_search(first, n, percent, True)), "near")
    discard(before, of)
    # what is still outside the component's largest group asks every block
    of = hot_groups = grouped(links)
    count = of.groupBy("component", "label").agg(F.count("*").alias("members"))
    main = count.groupBy("component").agg(F.max(F.struct("members", "label")).alias("top")).select(
        "component", F.col("top.label").alias("main"))
    of = of.join(main, "component")
    packed = staged(_packed(of.withColumn("asks", F.col("label") != F.col("main"))), "packed", **LARGE_ROWS)
    # Pairs of blocks are read from the table as they are searched, not dealt out: nothing of quadratic size is written.
    h, s = packed.hint("shuffle_replicate_nl").alias("h"), packed.alias("s")
    pairs = h.join(s, (F.col("h.component") == F.col("s.component")) & (F.col("s.sub") < F.col("h.sub")) & (F.col("h.asks") | F.col("s.asks")))
    between = pairs.select("h.component", "h.sub", "h.body", "s.body").toDF("component", "sub", "body", "other").mapInArrow(
        tidy(_between(n, percent)), "a binary, b binary")
    out = staged(links.union(between), "near")
    discard(links, hot_groups, packed)
    return out


#: A block's sets, as they are packed.
_BODY = pa.schema([("digest", pa.binary()), ("text", pa.string()), ("label", pa.binary()), ("asks", pa.bool_())])


def _packed(rows: DataFrame) -> DataFrame:
    """One row of each block: its sets, compressed, and whether any of them asks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(at: tuple, sets: list[tuple]) -> pa.RecordBatch:
            out, columns = pa.BufferOutputStream(), zip(*sets, strict=True)
            with pa.ipc.new_stream(out, _BODY, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _BODY, strict=True)], schema=_BODY))
            return pa.RecordBatch.from_arrays(
                [pa.array([at[0]], pa.int64()), pa.array([at[1]], pa.int32()), pa.array([any(r[3] for r in sets)], pa.bool_()),
                 pa.array([out.getvalue().to_pybytes()], pa.binary())], names=["component", "sub", "asks", "body"])

        now, have = None, []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[:2] != now:
                    if have:
                        yield close(now, have)
                    now, have = r[:2], []
                have.append(r[2:])
        if have:
            yield close(now, have)

    return rows.repartition("component", "sub").sortWithinPartitions("component", "sub").select(
        "component", "sub", "digest", "text", "label", "asks").mapInArrow(tidy(run), "component bigint, sub int, asks boolean, body binary")


def _between(n: int, percent: int):
    """For pairs of packed blocks, the links of the labels whose groups some link
    between the two blocks joins; links of two sets that do not ask are not looked for."""

    def opened(body: bytes) -> tuple[list[bytes], np.ndarray, list[np.ndarray]]:
        sets = pa.ipc.open_stream(body).read_next_batch()
        return sets["label"].to_pylist(), sets["asks"].to_numpy(zero_copy_only=False), list(shingle_sets(sets["text"], n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, None
        for batch in batches:
            for component, sub, body, other in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (component, sub) != name:  # the blocks that one is searched with come one after another
                    name, held = (component, sub), opened(body)
                labels, asks, sets = (x + y if isinstance(x, list) else np.concatenate([x, y]) for x, y in zip(held, opened(other), strict=True))
                names: dict[bytes, int] = {}
                own = np.array([names.setdefault(x, len(names)) for x in labels])
                groups = t_occurrence(sets, percent, own, asks, np.arange(len(sets)) < len(held[0]))
                a, b = [], []
                for members in groups.members.values():
                    least, *rest = sorted({labels[i] for i in members})
                    a += rest
                    b += [least] * len(rest)
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return run
