"""Secret scan: fixed base patterns, and compression novelty on top.

Novelty: a string in a sensitive context is a candidate: a run of 12 or more key
characters that begins within ``around`` characters after a word such as
``secret`` or ``private key``, over line ends, or anywhere in a PEM block of a
private key; of a run that holds such a word, also the 12 or more characters after
the last one.  A candidate is compressed with zstandard, primed with an identifier dictionary, once after
its surrounding text and once as that text alone; the difference is what the
string adds.  Other occurrences of the candidate in a sensitive context are taken out of
the surrounding text first, so a secret that is repeated does not vouch for itself;
occurrences elsewhere are surrounding text.  Of a string found novel, every
occurrence in the text is reported.  A string made of the identifiers around it, or of common ones, adds
little; key material adds about its entropy and is reported.  So does a long
ordinary word that is in neither: the added bytes alone decide.

Defined cases: a null or empty text has no spans; spans are in code points, end
exclusive; overlapping spans of different kinds all stay; rows are scanned one
by one, so repeated rows repeat.  A text is read a bounded number of times,
however long; ``keep`` columns pass through and others, also of clashing names,
are not read; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import builtins
import functools
import keyword
import re
import sys

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches, texts_of

#: Order of kinds where spans start together.
KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CONTEXT = re.compile(
    r"passw|passphrase|secret|token|credential|bearer|api[_ -]?key|private[_ -]?key|access[_ -]?key|signing[_ -]?key", re.ASCII | re.IGNORECASE)
_PEM = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY[A-Z ]{0,40}-----|(-----END)")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{12,}")
_REST = re.compile(r"[A-Za-z0-9+/_=-]*")
_ALNUM = re.compile(r"[A-Za-z0-9]*")
#: Between a word and what follows it in its own run, as in ``private_key=...``.
_JOINT = re.compile(r"(?:[+/_-]*=+|[+/_-]+)(?=[A-Za-z0-9+/])")
_CONTEXT_WORDS = ("passw", "passphrase", "secret", "token", "credential", "bearer", "key")

#: Characters of a candidate, at least.
LEAST = 12
#: Bits that a reported string adds for each of its characters, at least.
NOVEL_BITS = 3.6
#: Characters of surrounding text on either side of a candidate, and from a context word to the last candidate.
AROUND = 512


def identifier_dictionary() -> bytes:
    """Common identifiers: the language's keywords, built-in and module names."""
    return " ".join([*sorted(sys.stdlib_module_names), *dir(builtins), *keyword.kwlist, *keyword.softkwlist]).encode()


@functools.cache
def _compressor(dictionary: bytes):
    import zstandard

    primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=6, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)


def added_bits(candidate: str, before: str, after: str, dictionary: bytes) -> float:
    """Bits that the candidate adds to its compressed surroundings, a character."""
    size = lambda s: len(_compressor(dictionary).compress(s.encode("utf-8", "replace")))
    return 8 * max(0, size(after + before + candidate) - size(after + before)) / max(1, len(candidate))


def candidates(text: str, around: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Start and end of each string in a sensitive context, and of the stretches of
    that context, both sorted.  Every part of the text is read a bounded number of
    times, however many words it has."""
    words = [m.end() for m in _CONTEXT.finditer(text)]
    tails: dict[int, int] = {}
    same = end = 0
    for e in words:
        if e < same:  # the letters go on to the same joint as those of the word before
            continue
        same = _ALNUM.match(text, e).end()
        if joint := _JOINT.match(text, same):
            if joint.end() >= end:
                end = _REST.match(text, joint.end()).end()
            if end - joint.end() >= LEAST:
                tails[end] = joint.end()
    found = {(a, b) for b, a in tails.items()}
    blocks, begun = [], None
    for m in _PEM.finditer(text):
        if not m[1]:
            begun = m.end() if begun is None else begun
        elif begun is not None:
            blocks.append((begun, m.start()))
            begun = None
    at, stretches = 0, []
    for lo, hi in sorted([(e, e + around) for e in words] + blocks):
        if stretches and lo <= stretches[-1][1]:
            stretches[-1] = (stretches[-1][0], max(hi, stretches[-1][1]))
        else:
            stretches.append((lo, hi))
        lo = max(lo, at)
        for m in _RUN.finditer(text, lo, hi + LEAST) if lo <= hi else ():
            if lo <= m.start() <= hi:
                lo = _REST.match(text, m.end()).end()
                found.add((m.start(), lo))
        at = max(lo, hi)
    return sorted(found), stretches


def _without(text: str, lo: int, hi: int, string: str, heads: list[int], stretches: list[tuple[int, int]]) -> str:
    """``text[lo:hi]`` without the occurrences of a string that begin in one of the stretches."""
    out, size = [], len(string)
    at = text.find(string, max(0, lo - size + 1), hi + size - 1)
    while at >= 0:
        i = bisect.bisect_right(heads, at) - 1
        if i >= 0 and at <= stretches[i][1]:
            out.append(text[lo : max(lo, at)])
            lo = max(lo, at + size)
            at = text.find(string, at + size, hi + size - 1)
        else:
            at = text.find(string, at + 1, hi + size - 1)
    return "".join([*out, text[lo:hi]])


def occurrences(text: str, strings: set[str]) -> list[tuple[int, int]]:
    """Where the strings, each of ``LEAST`` characters or more, stand in the text's runs."""
    sizes: dict[str, set[int]] = {}
    for s in strings:
        sizes.setdefault(s[:LEAST], set()).add(len(s))
    found = []
    for m in _RUN.finditer(text) if strings else ():
        for i in range(m.start(), m.end() - LEAST + 1):
            for n in sizes.get(text[i : i + LEAST], ()):
                if i + n <= m.end() and text[i : i + n] in strings:
                    found.append((i, i + n))
    return found


def scan_text(text: str, dictionary: bytes, novel_bits: float = NOVEL_BITS, around: int = AROUND) -> list[tuple[int, int, int]]:
    """(start, kind, end) of each span, sorted."""
    spans: list[tuple[int, int, int]] = []
    if not text:
        return spans
    low = text.lower()
    near = [w for w in _CONTEXT_WORDS if w in low]
    if near:
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    if near:
        strings, stretches = candidates(text, around)
        heads, novel = [lo for lo, _ in stretches], set()
        for a, b in strings:
            own = text[a:b]
            if own not in novel:
                before = _without(text, max(0, a - around), a, own, heads, stretches)
                after = _without(text, b, min(len(text), b + around), own, heads, stretches)
                if added_bits(own, before, after, dictionary) >= novel_bits:
                    novel.add(own)
        spans += [(a, 3, b) for a, b in occurrences(text, novel)]
    spans.sort()
    return spans


def scan(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), dictionary: bytes | None = None,
         novel_bits: float = NOVEL_BITS, around: int = AROUND, redact: str | None = None) -> DataFrame:
    """``keep`` columns and ``spans``: array of (kind, start, end).  With
    ``redact``, also ``redacted``: the text with each span's union replaced by
    that string (a null text stays null)."""
    words = identifier_dictionary() if dictionary is None else dictionary
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def cut(text: str, spans: list[tuple[int, int, int]]) -> str:
        out, at = [], 0
        for a, _, b in spans:
            if b > at:
                if a >= at:
                    out += [text[at:a], redact]
                at = b
        return "".join([*out, text[at:]])

    def fn(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = texts_of(batch.column(0))
        found = [scan_text(t, words, novel_bits, around) for t in texts]
        out = {"spans": pa.array([[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in s] for s in found], pa.list_(kind))}
        if redact is not None:
            known = batch.column(0).is_valid().to_pylist()
            out["redacted"] = pa.array([cut(t, s) if v else None for t, s, v in zip(texts, found, known, strict=True)], pa.string())
        return out

    added = "spans array<struct<kind: string, start: bigint, end: bigint>>" + (", redacted string" if redact is not None else "")
    return map_batches(df, (text_col,), keep, added, fn)
