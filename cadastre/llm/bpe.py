"""Byte-level BPE encoding and decoding over Arrow batches.

The vocabulary file stays where it is (its path is a parameter) and is read by
each Python worker once.  Texts are cut at single spaces between non-blank
characters: no match of the usual byte-level patterns crosses such a place, so
a piece always gets the same ids and is encoded by the tokenizers library once
per worker; a text with other blank runs is cut only where that is safe.

Defined cases: null and empty text give no ids; special tokens' strings are
ordinary text; rows repeat as they are; other columns are not touched.  A very
long text is one row of pieces like any other (one batch of its own); an empty
table gives no rows.
"""

from __future__ import annotations

import base64
import functools
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import binary_array, list_array, map_batches, slices, text_bytes

#: Pieces a worker remembers; when full, it keeps those in use.  New pieces encoded as one text.
CACHE_PIECES, JOINED = 600_000, 1 << 14
#: Characters whose pieces are a letter run and at most one mark: encoded without the pattern.
_PLAIN_END = "ɐ"
_MARKS = frozenset(",.;:?")
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")


@functools.cache
def byte_chars() -> tuple[str, ...]:
    """The printable character that stands for each byte in a byte-level
    vocabulary: printable Latin-1 bytes stand for themselves, the others take
    the code points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = dict(zip(own, map(chr, own), strict=True))
    for i, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + i)
    return tuple(table[b] for b in range(256))


@functools.cache
def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes → id of a rank file (base64 and rank on each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def tokenizer_of_ranks(path: str, pattern: str):
    """A ``tokenizers`` BPE of a rank file: every split of a token into two
    tokens is a merge, ordered by the rank of what it makes."""
    from tokenizers import Regex, Tokenizer
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

    ranks, chars = read_ranks(path), byte_chars()
    name = {t: "".join(chars[b] for b in t) for t in ranks}
    merges = []
    for t, _ in sorted(ranks.items(), key=lambda x: x[1]):
        halves = [(t[:i], t[i:]) for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        merges += [(name[a], name[b]) for a, b in sorted(halves, key=lambda x: (ranks[x[0]], ranks[x[1]]))]
    tok = Tokenizer(BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=merges))
    tok.pre_tokenizer = Sequence([Split(Regex(pattern), "isolated"), ByteLevel(add_prefix_space=False, use_regex=False)])
    return tok


def tokenizer_of_json(path: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return tok


class PieceCoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, each piece that a
    worker has not met yet encoded once.  A letter run goes to the library's model
    as it is; of the others many, a space before each, are one text for the
    library, in which a token that begins with a space begins the next piece."""

    def __init__(self, tokenizer, most: int = CACHE_PIECES):
        self.tok, self.most = tokenizer, most
        if hasattr(tokenizer.model, "_resize_cache"):
            tokenizer.model._resize_cache(0)  # pieces are remembered here, so the library meets none twice
        self.first: dict[str, bytes | None] = {}  # pieces that open a text
        self.rest: dict[str, bytes | None] = {}  # pieces after a space, without it; None: not to be cut off
        self.space, self.to_chars = byte_chars()[0x20], dict(enumerate(byte_chars()))
        self.opens = np.array([(tokenizer.id_to_token(i) or "").startswith(self.space) for i in range(tokenizer.get_vocab_size())])
        self.mark = {m: self._whole([m])[0] for m in _MARKS}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str], used: list[str]) -> None:
        if len(self.rest) + len(new) > self.most:  # the pieces now in use stay
            self.rest = {p: self.rest[p] for p in used if p in self.rest}
        rest, hard = self.rest, []
        for p in new:
            word = p[:-1] if p[-1:] in _MARKS else p
            if word.isalpha() and (word.isascii() or max(word) < _PLAIN_END):  # one letter run, so one match of the pattern
                ids = rest.get(word) or self._model(word)
                rest[p] = ids if word is p else ids + self.mark[p[-1]]
            elif not p or p[0].isspace() or p[-1].isspace():
                rest[p] = None
            else:
                hard.append(p)
        for lo in range(0, len(hard), JOINED):
            some = hard[lo : lo + JOINED]
            ids = np.array(self.tok.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(self.opens[ids])
            if len(at) == len(some):
                raw, ends = ids.tobytes(), np.append(at[1:], len(ids))
                rest.update((p, raw[a:b]) for p, a, b in zip(some, (4 * at).tolist(), (4 * ends).tolist(), strict=True))
            else:  # a piece holds such a token within
                rest.update(zip(some, self._whole([" " + p for p in some]), strict=True))

    def _model(self, word: str) -> bytes:
        """Ids of a letter run after a space."""
        shown = self.space + (word if word.isascii() else word.encode().decode("latin-1").translate(self.to_chars))
        return array("I", [t.id for t in self.tok.model.tokenize(shown)]).tobytes()

    def _learn_first(self, used: list[str]) -> None:
        if len(self.first) + len(used) > self.most // 10:
            self.first.clear()
        new = [p for p in dict.fromkeys(used) if p not in self.first]
        self.first.update(zip(new, self._whole(new), strict=True))
        self.first.update(dict.fromkeys(p for p in new if not p or p[0].isspace() or p[-1].isspace()))

    def _slow(self, text: str) -> bytes:
        cut = [m.start() for m in _SAFE_SPACE.finditer(text)]
        pieces = [text[a:b] for a, b in zip([0, *cut], [*cut, len(text)], strict=True)]
        return b"".join(self._whole(pieces))

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Ids of each text of a list, or of a column without nulls.  Arrow cuts the texts and
        numbers their different pieces, so that only those are looked up; ids are
        then gathered by number."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        n = len(texts)
        cut = pc.split_pattern(texts, " ")
        rows = np.asarray(cut.offsets, np.int64) - cut.offsets[0].as_py()
        numbered = cut.flatten().dictionary_encode()
        number = np.array(numbered.indices, np.int64)
        pieces = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        opening = [pieces[i] for i in number[rows[:-1]].tolist()]
        self._learn_first(opening)
        known = list(map(self.rest.get, pieces))
        missed = [i for i, k in enumerate(known) if k is None]  # not met yet, or not to be cut off
        self._learn([pieces[i] for i in missed], pieces)
        for i in missed:
            known[i] = self.rest[pieces[i]]
        known += [self.first[p] for p in opening]
        number[rows[:-1]] = np.arange(len(pieces), len(known))
        odd = np.zeros(len(known), bool)
        for i in (*missed, *range(len(pieces), len(known))):
            if known[i] is None:
                known[i], odd[i] = b"", True
        flat = np.frombuffer(b"".join(known), "<u4")
        size = np.array(list(map(len, known)), np.int64) // 4
        start = np.cumsum(size) - size
        each = size[number]
        ends = np.cumsum(each)
        raw = memoryview(flat[np.arange(int(ends[-1]) if n else 0) + np.repeat(start[number] - (ends - each), each)].tobytes())
        at = 4 * np.concatenate([[0], ends])[rows]
        out = [bytes(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        slow = np.add.reduceat(odd[number], rows[:-1]) if n else []
        for i in np.flatnonzero(slow):
            text = texts[i].as_py()
            out[i] = self._slow(text) if text else b""
        return out


@functools.cache
def coder(kind: str, path: str, pattern: str = "") -> PieceCoder:
    """The worker's coder of one vocabulary file."""
    return PieceCoder(tokenizer_of_ranks(path, pattern) if kind == "ranks" else tokenizer_of_json(path))


def id_batches(array: pa.Array, kind: str, path: str, pattern: str = "", size: int = 2 << 20):
    """Ids of a text column, some bytes of text at a time: lists of byte strings."""
    own = coder(kind, path, pattern)
    array = array.fill_null("") if array.null_count else array
    for lo, hi in slices(text_bytes(array)[1], size):
        yield own.encode(array.slice(lo, hi - lo))


@functools.cache
def _token_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ranks = read_ranks(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for t, r in ranks.items():
        tokens[r] = t
    size = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size


def decode_ids(ids: np.ndarray, path: str) -> np.ndarray:
    """Bytes of a run of ids (the byte table in reverse), as one array."""
    flat, start, size = _token_table(path)
    n = size[ids]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(start[ids] - (ends - n), n)]


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
           spans: bool = False, decoded: bool = False) -> DataFrame:
    """``keep`` columns, ``ids`` (array<int>), with ``decoded`` what they decode
    to (binary, as :func:`decode` gives) in the same pass, and with ``spans`` ``char_start``
    and ``char_end`` (array<int>): the characters of the text that each token
    touches (a token that holds only part of a character touches it whole)."""

    def fn(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        parts = [b for many in id_batches(batch.column(0), "ranks", ranks_path, pattern) for b in many]
        ids = np.frombuffer(b"".join(parts), "<u4").astype(np.int32)
        at = np.concatenate([[0], np.cumsum([len(b) // 4 for b in parts], dtype=np.int64)])
        out = {"ids": list_array(ids, at, pa.int32())}
        if decoded:
            size = np.concatenate([[0], np.cumsum(_token_table(ranks_path)[2][ids])])
            out["decoded"] = binary_array(decode_ids(ids, ranks_path).tobytes(), size[at])
        if spans:
            raw, rows = text_bytes(batch.column(0))
            heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters begun before each byte
            size = _token_table(ranks_path)[2][ids]
            ends = np.cumsum(size)
            base = np.repeat(heads[rows[:-1]], np.diff(at))
            first = heads[np.minimum(ends - size + 1, len(raw))] - 1 - base
            out["char_start"] = list_array(first.astype(np.int32), at, pa.int32())
            out["char_end"] = list_array((heads[ends] - base).astype(np.int32), at, pa.int32())
        return out

    added = "ids array<int>" + (", decoded binary" if decoded else "") + (", char_start array<int>, char_end array<int>" if spans else "")
    return map_batches(df, (text_col,), keep, added, fn, tokenizes=True)


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",),
           text: bool = False) -> DataFrame:
    """``keep`` columns and ``decoded`` (binary, the exact bytes).  With
    ``text``, also ``decoded_text``: a character that the ids hold only in part
    (a list cut inside it) becomes U+FFFD.  Null ids decode to no bytes."""

    def fn(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        lists = batch.column(0)
        if lists.null_count:
            lists = pa.array([x or [] for x in lists.to_pylist()], lists.type)
        ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.asarray(lists.offsets.to_numpy(), np.int64)
        at = at - at[0]
        size = np.concatenate([[0], np.cumsum(_token_table(ranks_path)[2][ids])])
        out = {"decoded": binary_array(decode_ids(ids, ranks_path).tobytes(), size[at])}
        if text:
            out["decoded_text"] = pa.array([b.as_py().decode("utf-8", "replace") for b in out["decoded"]], pa.string())
        return out

    return map_batches(df, (ids_col,), keep, "decoded binary" + (", decoded_text string" if text else ""), fn)
