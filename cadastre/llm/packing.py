"""Packing by power-of-two decomposition.

A document's ids (with an end id) are split into pieces whose lengths are
powers of two, at most the sequence length: as many full pieces as fit, then
the binary digits of the remainder, longest first.  Each piece is a sequence of
its own in the bucket of its length, so no sequence crosses documents and,
training drawing each batch from one bucket, nothing is padded.

Defined cases: a null or empty text is the end id alone (one piece of length
1); repeated rows are packed each on its own; a very long text is many full
pieces; an empty table gives no pieces.  Other columns are not read, and a kept
one that has the name of an added one comes out as ``<name>_kept``.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import id_batches
from .common import map_batches


def piece_lengths(n: int, most: int) -> list[int]:
    """Lengths of the pieces of ``n`` ids, ``most`` a power of two."""
    rest = n % most
    return [most] * (n // most) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack(df: DataFrame, vocab_path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
         length: int = 2048, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """One row per piece: ``keep`` columns, ``start``, ``length``,
    ``ids_crc32`` (little-endian unsigned 32-bit ids), ``doc_tokens``,
    ``bucket`` (the piece's length, by which sequences are batched),
    ``sequence_id`` (unique, one piece each), ``offset`` (0) and, with
    ``with_ids``, ``ids`` (binary, the same little-endian ids)."""
    if length < 1 or length & (length - 1):
        raise ValueError("length must be a power of two")
    end = np.array([end_id], "<u4").tobytes()

    def fn(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        sizes, crcs, pieces, docs, at, tokens = [], [], [], [], [0], []
        for many in id_batches(batch.column(0), "json", vocab_path):
            for ids in many:
                view = memoryview(ids + end)
                n, lo = len(view) // 4, 0
                for k in piece_lengths(n, length):
                    part = view[4 * lo : 4 * (lo + k)]
                    sizes.append(k)
                    crcs.append(zlib.crc32(part))
                    docs.append(lo)
                    if with_ids:
                        pieces.append(bytes(part))
                    lo += k
                at.append(len(sizes))
                tokens.append(n)
        fields = {"start": pa.array(docs, pa.int64()), "length": pa.array(sizes, pa.int64()), "crc": pa.array(crcs, pa.int64())}
        if with_ids:
            fields["ids"] = pa.array(pieces, pa.binary())
        made = pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
        return {"doc_tokens": pa.array(tokens, pa.int64()),
                "_pieces": pa.ListArray.from_arrays(pa.array(at, pa.int32()), made)}

    kind = "start: bigint, length: bigint, crc: bigint" + (", ids: binary" if with_ids else "")
    own = [f"k{i}" for i in range(len(keep))]
    source = df.select(*[df[c].alias(k) for c, k in zip(keep, own, strict=True)], df[text_col].alias("text"))
    packed = map_batches(source, ("text",), tuple(own), f"doc_tokens bigint, _pieces array<struct<{kind}>>", fn, tokenizes=True)
    p = F.col("_p")
    pieces = packed.select(*own, "doc_tokens", F.explode("_pieces").alias("_p")).select(
        *own, p["start"].alias("start"), p["length"].alias("length"), p["crc"].alias("ids_crc32"),
        "doc_tokens", p["length"].alias("bucket"), F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"), *([p["ids"].alias("ids")] if with_ids else []))
    added = pieces.columns[len(keep) :]
    return pieces.toDF(*[f"{c}_kept" if c in added else c for c in keep], *added)
