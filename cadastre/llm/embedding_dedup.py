"""Near-duplicate vectors: spherical k-means cells, blocked cosine products.

Equal vectors are one row with a multiplicity.  Centres are fitted on a bounded
sample (``CELLS`` at most, ``SAMPLE`` vectors for each); every vector has its
home in the cell of the nearest centre.  A vector also visits each later cell
that can hold a linked one: two unit vectors of cosine t are sqrt(2 - 2t) apart
at most, so a vector farther than that from the plane between two centres has
no link across it.  No link is lost, whatever the sample.  A cell is cut into
blocks of bounded size, a row each in a table; tasks read the pairs of blocks to be
compared from it, so what is written grows with the vectors, not with their pairs.
A block gives sums and one link for each row, never its pairs.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing and stand alone; vectors of different lengths do
not link; a null id is never a class's smallest id, nor kept; rows repeat as
they are, copies being linked with each other.  Equal cosines need no order, as a
link has no rank.  Columns besides the id and the vector are not read, whatever
their names; very long vectors make larger blocks; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, hash_sample, map_batches, ship, staged, tidy
from .components import components
from .vectors import HELD, dense

#: Most cells, vectors a cell aims at, sampled vectors for each cell, and steps of the fit.
CELLS, CELL_ROWS, SAMPLE, STEPS = 1024, 4096, 48, 8
#: Bytes of a block's vectors at most, and rows that are compared with it at a time.
BLOCK_BYTES, STREAMED = 4 << 20, 512
_SLACK = 1e-4  # of single-precision products; what lies inside is decided in double precision


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def spherical_kmeans(sample: np.ndarray, k: int, steps: int = STEPS) -> np.ndarray:
    """``k`` unit centres of unit vectors (fewer if there are fewer)."""
    pick = np.random.default_rng(11).permutation(len(sample))[:k]
    centres = sample[pick]
    for _ in range(steps):
        home = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, sample)
        size = np.linalg.norm(sums, axis=1)
        centres = np.where(size[:, None] > 1e-9, sums / np.maximum(size, 1e-9)[:, None], centres)
    return centres


def visits(units: np.ndarray, centres: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each vector, and which later cells it has to visit."""
    near = units @ centres.T
    home = np.argmax(near, axis=1)
    margin = near[np.arange(len(units)), home][:, None] - near
    apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))[home]
    # twice the centres' plane: <x, c - c'> <= |c - c'| * sqrt(2 - 2t)
    may = margin <= apart * np.sqrt(2 - 2 * least) + 1e-9
    return home, may & (np.arange(len(centres))[None, :] > home[:, None])


def join_labels(labels: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Labels of held rows after each streamed row joins all that it links."""
    rows, cols = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    if not len(rows):
        return labels
    sub, top = linked[np.ix_(rows, cols)], len(labels)
    while True:
        own = labels[cols]
        least = np.where(sub, own[None, :], top).min(axis=1)
        new = np.minimum(np.where(sub, least[:, None], top).min(axis=0), own)
        if (new == own).all():
            return labels
        to = np.arange(top)
        np.minimum.at(to, own, new)
        while (to[to] != to).any():
            to = to[to]
        labels = to[labels]


_BLOCK = "block string, size int, home int, part int, several boolean, visited array<int>, digests binary, copies binary, vecs binary, away binary"


def _blocks(rows: DataFrame) -> DataFrame:
    """One row of each block: its vectors end to end, the bits of the cells that each
    visits, and which cells any of them does."""
    names = T.StructType.fromDDL(_BLOCK).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(at: tuple, digests: list[bytes], copies: list[int], vecs: list[bytes], away: list[bytes]) -> pa.RecordBatch:
            bits = np.bitwise_or.reduce(np.frombuffer(b"".join(away), np.uint8).reshape(len(away), -1), axis=0)
            row = (*at, np.flatnonzero(np.unpackbits(bits)).tolist(), b"".join(digests), np.array(copies, np.int64).tobytes(), b"".join(vecs), b"".join(away))
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.int32()), *[pa.binary()] * 4)
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=names)

        now, have = None, []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[:5] != now:
                    if have:
                        yield close(now, *zip(*have, strict=True))
                    now, have = r[:5], []
                have.append(r[5:])
        if have:
            yield close(now, *zip(*have, strict=True))

    dealt = rows.withColumn("block", F.concat_ws("/", "size", "home", "part")).repartition("block").sortWithinPartitions("block")
    return dealt.select("block", "size", "home", "part", "several", "digest", "copies", "vec", "away").mapInArrow(tidy(run), _BLOCK)


def links(df: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id", least: float = 0.95) -> DataFrame:
    """One row per row: the id, ``n_links`` (other rows of cosine ``least`` or
    more), ``component_id`` (smallest id reachable) and ``kept``."""
    spark = df.sparkSession
    ship(spark)
    # as the table has them: single-precision vectors take half the room
    kind = np.float32 if isinstance(df.schema[vec_col].dataType.elementType, T.FloatType) else np.float64

    def read(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        found = [v if v is not None and v.any() else None for v in dense(batch.column(0))]
        return {"digest": pa.array([None if v is None else hashlib.blake2b(v.tobytes(), digest_size=16).digest() for v in found], pa.binary()),
                "vec": pa.array([None if v is None else v.astype(kind).tobytes() for v in found], pa.binary())}

    def units(data: list[bytes]) -> np.ndarray:
        return unit(np.frombuffer(b"".join(data), kind).reshape(len(data), -1).astype(np.float64))

    source = map_batches(df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vector")), ("vector",), ("id",), "digest binary, vec binary", read)
    rows = staged(source.select("id", "digest"), "vectors")
    one = staged(source.where("digest is not null").groupBy("digest").agg(F.count("*").alias("copies"), F.first("vec").alias("vec")), "distinct")
    # the sample: vectors of the least hashes, about so many for each length
    n_of = {r["size"]: r["n"] for r in one.groupBy(F.length("vec").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(64).collect()}
    centres: dict[int, np.ndarray] = {}
    for size, n in n_of.items():
        k = int(min(CELLS, max(1, n // CELL_ROWS)))
        got = hash_sample(one.where(F.length("vec") == size), "digest", n, k * SAMPLE).limit(2 * k * SAMPLE).select("digest", "vec").collect()
        got = sorted(got) or one.where(F.length("vec") == size).limit(1).select("digest", "vec").collect()
        centres[size] = spherical_kmeans(units([r["vec"] for r in got]), k)
    shared = spark.sparkContext.broadcast(centres)

    def place(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        data = batch.column(0).to_pylist()
        homes, away = np.zeros(len(data), np.int64), [b""] * len(data)
        size = np.array([len(d) for d in data])
        for s in set(size.tolist()) & set(shared.value):
            at = np.flatnonzero(size == s)
            home, may = visits(units([data[i] for i in at]), shared.value[s], least)
            homes[at] = home
            for i, m in zip(at, np.packbits(may, axis=1), strict=True):
                away[i] = m.tobytes()
        return {"size": pa.array(size, pa.int32()), "home": pa.array(homes, pa.int32()), "away": pa.array(away, pa.binary())}

    placed = map_batches(one, ("vec",), ("digest", "copies", "vec"), "size int, home int, away binary", place)
    most = F.greatest(F.lit(1), F.least(F.lit(HELD), F.floor(F.lit(BLOCK_BYTES) / F.col("size"))))  # rows of a block
    parts = placed.groupBy("size", "home").agg(F.ceil(F.count("*") / most).cast("int").alias("parts"))
    parts = staged(parts.withColumn("several", F.sum("parts").over(Window.partitionBy("size")) > 1), "cells")  # a row a cell
    blocks = staged(_blocks(placed.join(F.broadcast(parts), ["size", "home"]).withColumn("part", F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int"))), "blocks")
    discard(one)

    def links_of(keys: list[bytes], to: list[bytes], n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(to, pa.binary()), pa.array(n, pa.int64())], names=["a", "b", "n"])

    class Block:
        """A block's vectors, and what is known of them so far."""

        def __init__(self, digests: bytes, copies: bytes, vecs: bytes):
            self.keys = [digests[i : i + 16] for i in range(0, len(digests), 16)]
            self.copies = np.frombuffer(copies, np.int64)
            self.exact = unit(np.frombuffer(vecs, kind).reshape(len(self.keys), -1).astype(np.float64))
            self.single = self.exact.astype(np.float32)
            self.labels, self.sums = np.arange(len(self.keys)), np.zeros(len(self.keys), np.int64)

        def linked(self, other: np.ndarray) -> np.ndarray | None:
            """Which vectors link with each of some others; None if none does."""
            out = None
            for lo in range(0, len(other), STREAMED):
                some = other[lo : lo + STREAMED]
                close = some.astype(np.float32) @ self.single.T
                if not len(close) or close.max() < least - _SLACK:
                    continue
                if out is None:
                    out = np.zeros((len(other), len(self.keys)), bool)
                sure = close >= least + _SLACK
                i, j = np.nonzero((close >= least - _SLACK) & ~sure)
                if len(i):
                    sure[i, j] = np.einsum("ij,ij->i", some[i], self.exact[j]) >= least
                out[lo : lo + STREAMED] = sure
            return out

        def found(self) -> Iterator[pa.RecordBatch]:
            some = np.flatnonzero(self.sums)
            if len(some):
                yield links_of([self.keys[i] for i in some], [self.keys[self.labels[i]] for i in some], self.sums[some])

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block = Block(*own)
                got = block.linked(block.exact)
                if got is None:
                    continue
                np.fill_diagonal(got, False)
                block.sums += got.T @ block.copies
                np.fill_diagonal(got, got.any(axis=1))  # a row is with those that it links
                block.labels = join_labels(block.labels, got)
                yield from block.found()

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, None
        for batch in batches:
            for at, home, *own, from_, away, digests, copies, vecs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (at, home) != name:  # the blocks that one is compared with come one after another
                    if held:
                        yield from held.found()
                    name, held = (at, home), Block(*own)
                other = Block(digests, copies, vecs)
                rows_ = np.arange(len(other.keys))
                if from_ != home:
                    bits = np.frombuffer(away, np.uint8).reshape(len(rows_), -1)
                    rows_ = np.flatnonzero(bits[:, home >> 3] >> (7 - (home & 7)) & 1)
                got = held.linked(other.exact[rows_])
                if got is None:
                    continue
                held.sums += got.T @ other.copies[rows_]
                held.labels = join_labels(held.labels, got)
                some = np.flatnonzero(got.any(axis=1))
                if len(some):
                    yield links_of([other.keys[i] for i in rows_[some]], [held.keys[j] for j in got[some].argmax(axis=1)], got[some] @ held.copies)
        if held:
            yield from held.found()

    schema, vectors = "a binary, b binary, n bigint", ("digests", "copies", "vecs")
    alone = blocks.select(*vectors).mapInArrow(tidy(inside), schema)
    # Pairs of blocks are read from the table as they are compared, not dealt out: nothing of quadratic size is written.
    several = blocks.where("several")
    h, s = several.hint("shuffle_replicate_nl").alias("h"), several.alias("s")
    same = (F.col("s.home") == F.col("h.home")) & (F.col("s.part") < F.col("h.part"))
    later = (F.col("s.home") < F.col("h.home")) & F.array_contains("s.visited", F.col("h.home"))
    pairs = h.join(s, (F.col("h.size") == F.col("s.size")) & (same | later))
    across = pairs.select("h.block", "h.home", *[f"h.{c}" for c in vectors], "s.home", "s.away", *[f"s.{c}" for c in vectors]).toDF(
        "block", "home", *vectors, "from", "away", *[f"s_{c}" for c in vectors]).mapInArrow(tidy(between), schema)
    found = staged(alone.union(across), "links")
    discard(blocks)
    classes = components(found.select("a", "b")).toDF("digest", "class")
    counts = found.groupBy(F.col("a").alias("digest")).agg(F.sum("n").alias("n"))
    copies = rows.where("digest is not null").groupBy("digest").agg(F.count("*").alias("copies"))
    of = copies.join(classes, "digest", "left").join(counts, "digest", "left").select(
        "digest", F.coalesce("class", "digest").alias("class"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    known = rows.where("digest is not null").select("id", "digest").join(of, "digest")
    # written, so that the join below has an exchange of its own, which Spark can split at a hot class
    smallest = staged(known.groupBy("class").agg(F.min("id").alias("component_id")), "least")
    out = known.join(smallest, "class").select("id", "n_links", "component_id").union(
        rows.where("digest is null").select("id", F.lit(0).cast("bigint"), "id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
