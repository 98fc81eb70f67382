"""Posting lists of a batch of documents, made in Arrow: of each term the
documents that have it, by block.

A task keeps the lists of :data:`CHUNK` documents at most in memory.  A block
that is met in two chunks has two lists of a term, which a search reads alike.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

from pyspark import cloudpickle

# Task code of this module travels by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A document's number is its block and its place in it.
BLOCK_BITS = 17
#: Documents, and bytes of their names, of which lists are made at once.
CHUNK, CHUNK_BYTES = 1 << 15, 4 << 20
GRAM = 3

LISTS = "term string, run bigint, block bigint, alive boolean, docs array<int>"


def gram_codes(texts) -> tuple[Any, Any]:
    """The 3-grams of an Arrow column of strings as numbers, and the row of each."""
    import numpy as np
    import pyarrow.compute as pc

    texts = pc.fill_null(texts, "")
    points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    if len(points) < GRAM:
        return points[:0], row[:0]
    whole = row[: -(GRAM - 1)] == row[GRAM - 1 :]  # not from one text into the next
    return ((points[:-2] << 42) | (points[1:-1] << 21) | points[2:])[whole], row[: -(GRAM - 1)][whole]


def _grams(columns) -> tuple[Any, Any, Any]:
    """Each gram's place in the list of different grams, its row, and that list."""
    import numpy as np
    import pandas as pd
    import pyarrow as pa

    found = [gram_codes(c) for c in columns]
    place, codes = pd.factorize(np.concatenate([c for c, _ in found]))
    points = np.stack([codes >> 42, (codes >> 21) & 0x1FFFFF, codes & 0x1FFFFF], axis=1).astype("<u4")
    text = points.tobytes().decode("utf-32-le", "surrogatepass")
    return place, np.concatenate([r for _, r in found]), pa.array([text[i : i + GRAM] for i in range(0, len(text), GRAM)], pa.string())


def _words(columns) -> tuple[Any, Any, Any]:
    """The same of a column of lists of words; empty ones are no words."""
    import pyarrow.compute as pc

    words = pc.list_flatten(columns[0])
    rows = pc.list_parent_indices(columns[0]).to_numpy(zero_copy_only=False)
    known = words.dictionary_encode()
    place = known.indices.to_numpy(zero_copy_only=False)
    real = pc.not_equal(known.dictionary, "").to_numpy(zero_copy_only=False)
    keep = real[place] if len(place) else slice(0)
    return place[keep], rows[keep], known.dictionary


def _lists(table, kind: str):
    """Posting lists of one chunk: columns run, doc, alive, and what terms are made of."""
    import numpy as np
    import pyarrow as pa

    table = table.sort_by([("run", "ascending"), ("doc", "ascending"), ("alive", "ascending")]).combine_chunks()
    run, doc, alive = (table[c].to_numpy() for c in ("run", "doc", "alive"))
    columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in table.columns[3:]]
    place, row, terms = (_grams if kind == "gram" else _words)(columns)
    block = doc >> BLOCK_BITS
    # Rows are in order of their block, so each (term, block) is one stretch of the sorted pairs.
    group = np.cumsum(np.r_[0, (run[1:] != run[:-1]) | (block[1:] != block[:-1]) | (alive[1:] != alive[:-1])])
    pairs = np.sort(place.astype(np.int64) * len(doc) + row)
    pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]] if len(pairs) else pairs
    place, row = pairs // len(doc), pairs % len(doc)
    lists = group[row]
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (lists[1:] != lists[:-1])]) if len(pairs) else pairs
    at = (doc[row] & ((1 << BLOCK_BITS) - 1)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [terms.take(pa.array(place[first])), pa.array(run[row[first]]), pa.array(block[row[first]]), pa.array(alive[row[first]]),
         pa.ListArray.from_arrays(pa.array(np.r_[first, len(pairs)].astype(np.int32)), pa.array(at))],
        names=["term", "run", "block", "alive", "docs"])


def lists_of(kind: str):
    """The ``mapInArrow`` function that turns documents (run, doc, alive, then
    what terms are made of) into posting lists."""

    def run(batches: Iterator[Any]) -> Iterator[Any]:
        import pyarrow as pa

        held, rows, size = [], 0, 0
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                if held and (rows + batch.num_rows > CHUNK or size + batch.nbytes > CHUNK_BYTES):
                    yield _lists(pa.Table.from_batches(held), kind)
                    held, rows, size = [], 0, 0
                held.append(batch)
                rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows:
            yield _lists(pa.Table.from_batches(held), kind)

    return run
