"""Cross-tokenizer alignment by token-byte incidence matrices.

Two tokenizers cut the same bytes, a space and the text: A by a byte-level
vocabulary, B by a SentencePiece model (which puts the space there itself).  Each gives a 0/1 matrix
of tokens by bytes, held by rows (CSR).  Gustavson's row product A·Bᵀ gives the
overlap links, pairs of an A and a B token with the bytes they share; those
whose ranges end together cut the tokens into groups, and the product of the
two group incidences gives the shared-group links.

No token of either crosses a single space between two non-blank characters, so
a text is a row of pieces, and a piece always has the same alignment: a task
aligns each piece once.  Texts are gathered in bunches of some million pieces;
a bunch's pieces by id pairs are again a matrix in CSR.  The corpus-wide count of each id
pair is a sum over bunches, comes back to the bunches that hold the pair, and
the bunch's matrix times the counts gives each piece's, then each text's, sums.

Defined cases: a null or empty text, or one whose tokens of either kind do not
join to its bytes (SentencePiece shows U+2581 as a space), has no tokens, zeros
and an empty ``groups_sha256``, and adds nothing to the counts.  Special tokens' strings are plain text.  A very
long text is one row of pieces however long, a text without single spaces one piece.  Equal
rows repeat and count each time; ties for a B id's highest count all are highest.  Other columns, also
of clashing names, are not read; ``keep`` columns must not have names of the added ones.  An empty table
gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .bpe import byte_chars, tokenizer_of_json
from .common import binary_array, ddl, ship, staged, text_bytes, texts_of, tidy

#: Pieces of a bunch of texts; pieces and their characters that a task remembers before it starts afresh; pieces aligned at once, and encoded as one text.
BUNCH, REMEMBERED, REMEMBERED_CHARS, AT_ONCE, JOINED = 1 << 21, 300_000, 32 << 20, 1 << 13, 1 << 8
#: Which pairs of an A and a B token are linked: their bytes overlap, end together, or lie in one group.
KINDS = ("overlap", "end", "group")
_CUT = re.compile(r"(?<=\S) (?=\S)")
_DOC = ("n_a", "n_b", "n_groups", "n_links")


class Incidence(NamedTuple):
    """A 0/1 matrix by rows: row i has its ones in ``cols[at[i]:at[i + 1]]``."""

    at: np.ndarray
    cols: np.ndarray
    width: int


def runs(sizes: np.ndarray) -> Incidence:
    """Rows of adjacent columns: the bytes of tokens that follow each other."""
    at = np.concatenate([[0], np.cumsum(sizes)])
    return Incidence(at, np.arange(at[-1]), int(at[-1]))


def transposed(m: Incidence) -> Incidence:
    order = np.argsort(m.cols, kind="stable")
    rows = np.repeat(np.arange(len(m.at) - 1), np.diff(m.at))
    at = np.concatenate([[0], np.cumsum(np.bincount(m.cols, minlength=m.width))])
    return Incidence(at, rows[order], len(m.at) - 1)


def gathered(m: Incidence, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The columns of some rows one after the other, and how many each has."""
    size = np.diff(m.at)[rows]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return m.cols[np.arange(total) + np.repeat(m.at[:-1][rows] - (ends - size), size)], size


def product(a: Incidence, b: Incidence) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gustavson's product: each row of ``a`` gathers the rows of ``b`` that its
    columns name and adds up equal columns.  Row, column and value of what is
    not zero, in order."""
    cols, size = gathered(b, a.cols)
    row = np.repeat(np.repeat(np.arange(len(a.at) - 1), np.diff(a.at)), size)
    key = row * max(1, b.width) + cols
    if len(key) and (key[1:] < key[:-1]).any():
        key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
    value = np.diff(np.append(first, len(key)))
    return key[first] // max(1, b.width), key[first] % max(1, b.width), value


class Alignment(NamedTuple):
    """Links (A token, B token, shared bytes) and the group of each token."""

    a: np.ndarray
    b: np.ndarray
    shared: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    n_groups: int


def align_tokens(a_sizes: np.ndarray, b_sizes: np.ndarray, kind: str = "end") -> Alignment:
    """Align two cuts of the same bytes, given the bytes of each token."""
    tokens_a, tokens_b = runs(a_sizes), runs(b_sizes)
    a, b, shared = product(tokens_a, transposed(tokens_b))
    end_a, end_b = tokens_a.at[1:], tokens_b.at[1:]
    together = end_a[a] == end_b[b]
    ends = end_a[a[together]]
    a_group, b_group = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
    if kind == "end":
        a, b, shared = a[together], b[together], shared[together]
    elif kind == "group":
        one = lambda group: Incidence(np.arange(len(group) + 1), group, len(ends))
        i, j, _ = product(one(a_group), transposed(one(b_group)))
        key, asked = a * len(b_sizes) + b, i * len(b_sizes) + j  # both in order
        at = np.minimum(np.searchsorted(key, asked), max(0, len(key) - 1))
        a, b, shared = i, j, np.where(key[at] == asked, shared[at], 0)
    return Alignment(a, b, shared, a_group, b_group, len(ends))


class Vocabulary(NamedTuple):
    """Bytes of every id, one after the other."""

    flat: np.ndarray
    start: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        size = np.array([len(t) for t in tokens], np.int64)
        return cls(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        n = self.size[ids]
        ends = np.cumsum(n)
        return self.flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.start[ids] - (ends - n), n)]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(x) for x in lists], np.int64)
    return np.array([i for x in lists for i in x], np.int64), np.concatenate([[0], np.cumsum(size)])


class Aligner:
    """Aligned pieces of a task, by number."""

    def __init__(self, a_path: str, b_path: str, kind: str):
        import sentencepiece

        self.a, self.b, self.kind = tokenizer_of_json(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path), kind
        byte_of = {c: i for i, c in enumerate(byte_chars())}
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_words = Vocabulary.of([bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in names])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_words = Vocabulary.of([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                                      for i, p in enumerate(pieces)])
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)  # no piece of B spans a space between words
        # the ids as text after each of the three separators
        self.width = max(len(names), len(pieces))
        self.shown = Vocabulary.of([mark + str(i).encode() for mark in (b",", b"|", b";") for i in range(self.width)])
        self.a_opens = np.array([t.startswith(byte_chars()[0x20]) for t in names])
        self.b_opens = np.array([p.startswith("▁") for p in pieces])
        self.forget()

    def forget(self) -> None:
        self.plain: dict[str, int] = {}  # pieces of texts that are cut at every space
        self.odd: dict[str, int] = {}
        self.chars = 0
        self.groups: list[bytes] = []  # the groups' ids as text, a ";" before each
        self.good, self.stats = np.empty(0, bool), np.empty((0, 4), np.int64)
        self.at, self.pairs = np.zeros(1, np.int64), np.empty(0, np.int64)

    def encode(self, pieces: list[str], joined: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A's and B's ids with each piece's offsets, and which pieces both spell.
        ``joined``: no piece holds or borders on a blank that could be taken for
        the one before it, so many go to the libraries as one text, in which a
        token that begins with a space begins the next piece."""
        raw = np.frombuffer("".join([" " + p for p in pieces]).encode(), np.uint8)
        if joined:
            size = np.diff(np.append(np.flatnonzero(raw == 0x20), len(raw)))
            rows = [" ".join(pieces[lo : lo + JOINED]) for lo in range(0, len(pieces), JOINED)]
            a = np.concatenate([np.array(self.a.encode_batch_fast([" " + r], add_special_tokens=False)[0].ids, np.int64) for r in rows])
            b = _flat(self.b.encode(rows, num_threads=1))[0]
            a_at, b_at = (np.append(np.flatnonzero(opens[ids]), len(ids)) for ids, opens in ((a, self.a_opens), (b, self.b_opens)))
        if not joined or not len(size) == len(a_at) - 1 == len(b_at) - 1 == len(pieces):
            size = np.array([1 + len(p.encode()) for p in pieces], np.int64)
            a, a_at = _flat([e.ids for e in self.a.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False)])
            b, b_at = _flat(self.b.encode(pieces, num_threads=1))
        good, start = np.ones(len(pieces), bool), np.cumsum(size) - size
        for ids, at, words in ((a, a_at, self.a_words), (b, b_at, self.b_words)):
            long = np.concatenate([[0], np.cumsum(words.size[ids])])[at]
            good &= np.diff(long) == size
            spelt = words.spell(ids)
            if len(spelt) == len(raw) and good.all():
                wrong = np.flatnonzero(spelt != raw)
                good[np.searchsorted(long, wrong, "right") - 1] = False
            else:
                for i in np.flatnonzero(good):
                    good[i] = (spelt[long[i] : long[i + 1]] == raw[start[i] : start[i] + size[i]]).all()
        return a, a_at, b, b_at, good

    def learn(self, pieces: list[str], into: dict[str, int], joined: bool = False) -> None:
        """Align new pieces, and number them."""
        first = len(self.groups)
        made = [self._learned(pieces[lo : lo + AT_ONCE], joined) for lo in range(0, len(pieces), AT_ONCE)]
        if made:
            good, stats, pairs = (np.concatenate(x) for x in zip(*made, strict=True))
            into.update(zip(pieces, range(first, len(self.groups)), strict=True))
            self.chars += sum(map(len, pieces))
            self.good = np.concatenate([self.good, good])
            self.stats = np.concatenate([self.stats, stats])
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(stats[:, 3])])
            self.pairs = np.concatenate([self.pairs, pairs])

    def _learned(self, pieces: list[str], joined: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, a_at, b, b_at, good = self.encode(pieces, joined)
        keep_a, keep_b = np.repeat(good, np.diff(a_at)), np.repeat(good, np.diff(b_at))
        n_a, n_b = np.diff(a_at) * good, np.diff(b_at) * good
        a, b = a[keep_a], b[keep_b]
        made = align_tokens(self.a_words.size[a], self.b_words.size[b], self.kind)
        # pieces are adjacent and end together, so links and groups lie within one
        of_a = np.repeat(np.arange(len(pieces)), n_a)
        n_links = np.bincount(of_a[made.a], minlength=len(pieces))
        last = np.concatenate([[0], np.cumsum(n_a)])
        group_end = np.concatenate([[0], made.a_group + 1])[last]
        # the ids in the order of their groups, A's before B's, each after its separator
        cut_a, cut_b = (np.searchsorted(group, np.arange(made.n_groups + 1)) for group in (made.a_group, made.b_group))
        shown = np.empty(len(a) + len(b), np.int64)
        shown[np.arange(len(a)) + cut_b[made.a_group]] = a
        shown[np.arange(len(b)) + cut_a[made.b_group + 1]] = b
        shown[cut_a[:-1] + cut_b[:-1]] += 2 * self.width
        shown[cut_a[1:] + cut_b[:-1]] += self.width
        text = self.shown.spell(shown).tobytes()
        at = np.concatenate([[0], np.cumsum(self.shown.size[shown])])[(cut_a + cut_b)[group_end]].tolist()
        self.groups += [text[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]
        return good, np.stack([n_a, n_b, np.diff(group_end), n_links], axis=1), a[made.a] << 32 | b[made.b]

    def numbers(self, texts: pa.Array) -> list[np.ndarray]:
        """The pieces of each text, by number; an empty text has none.  Arrow cuts the
        texts and numbers their different pieces, so that only those are looked up."""
        texts = texts.fill_null("") if texts.null_count else texts
        if not self.cuts:
            return self._odd_numbers(texts.to_pylist())
        cut = pc.split_pattern(texts, " ")
        rows = np.asarray(cut.offsets, np.int64) - cut.offsets[0].as_py()
        numbered = cut.flatten().dictionary_encode()
        number = np.asarray(numbered.indices, np.int64)
        pieces = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.plain.get, pieces))
        missed = [i for i, n in enumerate(known) if n is None]
        odd = np.zeros(len(pieces), bool)
        odd[[i for i in missed if not (p := pieces[i]) or p[0].isspace() or p[-1].isspace()]] = True
        new = [pieces[i] for i in missed if not odd[i]]
        self.learn([p for p in new if "▁" not in p], self.plain, joined=True)
        self.learn([p for p in new if "▁" in p], self.plain)
        for i in missed:
            known[i] = self.plain.get(pieces[i], -1)
        flat = np.array(known, np.int64)[number]
        found = np.split(flat, rows[1:-1])
        some = np.flatnonzero(np.logical_or.reduceat(odd[number], rows[:-1])) if len(texts) else []
        for i, n in zip(some, self._odd_numbers([texts[i].as_py() for i in some]), strict=True):
            found[i] = n
        return found

    def _odd_numbers(self, texts: list[str]) -> list[np.ndarray]:
        """The same of texts that are not to be cut at every space."""
        cut = [list(self._cut(t)) if t else [] for t in texts]
        self.learn([p for p in dict.fromkeys(p for parts in cut for p in parts) if p not in self.plain and p not in self.odd], self.odd)
        number = lambda p: self.odd[p] if (n := self.plain.get(p)) is None else n
        return [np.array(list(map(number, parts)), np.int64) for parts in cut]

    def _cut(self, text: str) -> Iterator[str]:
        lo = 0
        for m in _CUT.finditer(text) if self.cuts else ():
            yield text[lo : m.start()]
            lo = m.end()
        yield text[lo:]

    def full(self) -> bool:
        return len(self.groups) > REMEMBERED or self.chars > REMEMBERED_CHARS


@functools.cache
def aligner(a_path: str, b_path: str, kind: str) -> Aligner:
    return Aligner(a_path, b_path, kind)


class _Bunch:
    """Texts of one bunch: kept columns, counts, digests and piece numbers."""

    def __init__(self):
        self.kept: list[tuple[int, list[pa.Array]]] = []
        self.numbers: list[np.ndarray] = []
        self.digests: list[str] = []
        self.pieces = 0

    def add(self, kept: list[pa.Array], numbers: list[np.ndarray], own: Aligner) -> None:
        for n in numbers:
            if len(n) and own.good[n].all():
                text = memoryview(b"".join(map(own.groups.__getitem__, n.tolist())))
                self.digests.append(hashlib.sha256(text[1:]).hexdigest())
            else:
                n = n[:0]
                self.digests.append("")
            self.numbers.append(n.astype(np.int32))
            self.pieces += len(n)
        self.kept.append((len(numbers), kept))

    def rows(self, number: int, own: Aligner, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        flat = np.concatenate(self.numbers)
        at = np.concatenate([[0], np.cumsum([len(n) for n in self.numbers])])
        held = np.bincount(flat, minlength=len(own.groups))
        pieces = np.flatnonzero(held)
        links, size = gathered(Incidence(own.at, own.pairs, 0), pieces)
        pairs, slot = np.unique(links, return_inverse=True)
        times = np.zeros(len(pairs), np.int64)
        np.add.at(times, slot, np.repeat(held[pieces], size))
        local = np.zeros(len(own.groups), np.int32)
        local[pieces] = np.arange(len(pieces))
        sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(own.stats[flat], axis=0)])[at]
        counts = np.diff(sums, axis=0)
        words, done = local[flat].astype("<u4"), 0
        for n, kept in self.kept:
            lo, hi = done, done + n
            made = {"words": binary_array(words[at[lo] : at[hi]].tobytes(), 4 * (at[lo : hi + 1] - at[lo])),
                    "groups_sha256": pa.array(self.digests[lo:hi], pa.string()),
                    **{c: pa.array(counts[lo:hi, i], pa.int64()) for i, c in enumerate(_DOC)},
                    **{f"k{i}": k for i, k in enumerate(kept)}}
            yield _batch(schema, n, number, 1, made)
            done = hi
        yield _batch(schema, 1, number, 0, {
            "pairs": pa.array([pairs], pa.list_(pa.int64())), "times": pa.array([times], pa.list_(pa.int64())),
            "at": pa.array([np.concatenate([[0], np.cumsum(size)]).astype("<u4").tobytes()], pa.binary()),
            "words": pa.array([slot.astype("<u4").tobytes()], pa.binary())})


def _batch(schema: pa.Schema, n: int, bunch: int, role: int, made: dict[str, pa.Array]) -> pa.RecordBatch:
    made = {"bunch": pa.array([bunch] * n, pa.int64()), "role": pa.array([role] * n, pa.int32()), **made}
    return pa.RecordBatch.from_arrays([made[f.name].cast(f.type) if f.name in made else pa.nulls(n, f.type) for f in schema], schema=schema)


def _bunches(df: DataFrame, a_path: str, b_path: str, text_col: str, keep: tuple[str, ...], kind: str) -> DataFrame:
    """The staged table of texts (role 1) and of their bunches' matrices (role 0)."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    ship(df.sparkSession)
    source = df.select(F.col(text_col).cast("string").alias("t"), *[df[c].alias(f"k{i}") for i, c in enumerate(keep)])
    schema = T.StructType(
        list(T.StructType.fromDDL("bunch bigint, role int, pairs array<bigint>, times array<bigint>, at binary, words binary, "
                                  "groups_sha256 string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint"))
        + [T.StructField(f"k{i}", df.schema[c].dataType) for i, c in enumerate(keep)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, now = aligner(a_path, b_path, kind), _Bunch()
        serial = TaskContext.get().partitionId() << 32
        for batch in batches:
            step = max(1, (4 << 20) * batch.num_rows // max(1, batch.nbytes))
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                now.add(part.columns[1:], own.numbers(part.column(0)), own)
                if now.pieces >= BUNCH or own.full():
                    yield from now.rows(serial, own, arrow)
                    now, serial = _Bunch(), serial + 1
                    if own.full():
                        own.forget()
        if now.numbers:
            yield from now.rows(serial, own, arrow)

    return staged(source.mapInArrow(tidy(run, tokenizes=True), schema), "aligned")


def _marked(table: DataFrame) -> DataFrame:
    """``pair``, ``count`` over the corpus, and ``best``: the count is its B id's highest."""
    held = table.where("role = 0").select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    counts = held.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("count"))
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    # one row for each id of B's vocabulary at most, whatever the corpus
    return counts.join(F.broadcast(most), b == most["b"]).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def id_pairs(df: DataFrame, a_path: str, b_path: str, text_col: str = "text", kind: str = "end") -> DataFrame:
    """``a_id``, ``b_id``, ``count`` (links of the corpus that hold the two) and
    ``best`` (the highest count of the B id, ties included)."""
    marked = _marked(_bunches(df, a_path, b_path, text_col, (), kind))
    return marked.select(F.shiftright("pair", 32).cast("int").alias("a_id"),
                         F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b_id"), "count", "best")


def links(df: DataFrame, a_path: str, b_path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), kind: str = "end") -> DataFrame:
    """``keep`` columns and ``links``: array of (a_index, a_id, b_index, b_id,
    shared bytes), a text's links one by one, in order."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    ship(df.sparkSession)
    fields = ("a_index", "a_id", "b_index", "b_id", "shared")
    schema = ddl(df, keep, "links array<struct<" + ", ".join(f"{f}: bigint" for f in fields) + ">>")
    struct = pa.struct([(f, pa.int64()) for f in fields])

    def of(text: str, own: Aligner) -> list[dict]:
        a, _, b, _, good = own.encode([text]) if text else (None, None, None, None, [False])
        if not good[0]:
            return []
        m = align_tokens(own.a_words.size[a], own.b_words.size[b], kind)
        return [dict(zip(fields, x, strict=True)) for x in zip(*(v.tolist() for v in (m.a, a[m.a], m.b, b[m.b], m.shared)), strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path, kind)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([*row.columns[1:], pa.array([of(texts_of(row.column(0))[0], own)], pa.list_(struct))],
                                                 names=schema.names)

    return df.select(F.col(text_col).cast("string").alias("t"), *[df[c].alias(f"k{i}") for i, c in enumerate(keep)]).mapInArrow(tidy(run, tokenizes=True), schema)


def align(df: DataFrame, a_path: str, b_path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), kind: str = "end") -> DataFrame:
    """``keep`` columns, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``
    (links whose pair's corpus-wide count is its B id's highest), ``count_sum``
    (those counts over the links) and ``groups_sha256`` (of ``a1,a2|b1;a3|b2``)."""
    table = _bunches(df, a_path, b_path, text_col, keep, kind)
    own = [f"k{i}" for i in range(len(keep))]
    held = table.where("role = 0").select("bunch", F.posexplode("pairs").alias("slot", "pair"))
    known = held.join(_marked(table), "pair").select("bunch", F.lit(1).alias("role"), "slot", "count", "best")
    sized = table.where("role = 0").select("bunch", "role", F.size("pairs").cast("bigint").alias("count"), "at", "words")
    texts = table.where("role = 1").select("bunch", F.lit(2).alias("role"), "words", "groups_sha256", *_DOC, *own)
    rows = sized.unionByName(known, allowMissingColumns=True).unionByName(texts, allowMissingColumns=True)
    added = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    schema = ddl(df, keep, added)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, count, best, sums = None, None, None, None
        for batch in batches:
            bunch, role = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((bunch[1:] != bunch[:-1]) | (role[1:] != role[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bunch)], strict=True):
                part = dict(zip(names, batch.slice(lo, hi - lo).columns, strict=True))
                if role[lo] == 0:
                    matrix = Incidence(np.frombuffer(part["at"][0].as_py(), "<u4").astype(np.int64),
                                       np.frombuffer(part["words"][0].as_py(), "<u4"), part["count"][0].as_py())
                    count, best, sums = np.zeros(matrix.width, np.int64), np.zeros(matrix.width, np.int64), None
                elif role[lo] == 1:
                    slot = part["slot"].to_numpy()
                    count[slot] = part["count"].to_numpy()
                    best[slot] = part["best"].to_numpy(zero_copy_only=False)
                else:
                    if sums is None:  # the bunch's pieces by pairs, times the pairs' counts
                        sums = [np.diff(np.concatenate([[0], np.cumsum(v[matrix.cols])])[matrix.at]) for v in (best, count)]
                    raw, at = text_bytes(part["words"])
                    words = np.frombuffer(raw.tobytes(), "<u4")
                    n_best, count_sum = (np.diff(np.concatenate([[0], np.cumsum(s[words])])[at // 4]) for s in sums)
                    yield pa.RecordBatch.from_arrays(
                        [*[part[k] for k in own], *[part[c] for c in _DOC], pa.array(n_best, pa.int64()),
                         pa.array(count_sum, pa.int64()), part["groups_sha256"]], names=schema.names)

    return rows.repartition("bunch").sortWithinPartitions("bunch", "role").mapInArrow(tidy(run), schema)
