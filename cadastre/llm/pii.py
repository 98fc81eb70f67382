"""Personal data: base patterns, and the same patterns behind disguises.

A text goes through a cascade of transducers, each of which rewrites some
characters and keeps, for every character it puts out, the source characters it
came from: look-alike and invisible characters become what they look like;
``(at)``, ``[dot]`` and the words ``at``, ``dot`` become the signs; spelled digits become
digits, ``plus`` a sign.  The base patterns then run over the normalised text, and what
they find there is mapped back to spans of the source.

A span is added where the match holds a rewritten or removed character and is not a base
span of its kind.  A disguised host ends in letters.  Bare words count only where they are no
prose: ``at`` before a host with a disguised dot (``look at example.com`` is none),
``dot`` in a host that ends in a common top-level domain, or before a disguised sign.

Defined cases: a null or empty text has no spans; spans are in code points, end
exclusive, and may overlap between kinds and between base and added ones; rows are scanned one by one, so
repeated rows repeat; a text is read a bounded number of times, however long its
runs of letters or digits; ``keep`` columns pass through, other columns, also of
clashing names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches, texts_of

#: Order of the kinds.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Letters of other scripts that look like a Latin one.
_ALIKE = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ο": "o", "ν": "v", "α": "a", "ι": "i", "ρ": "p", "ϲ": "c", "ɑ": "a", "ɡ": "g", "ı": "i", "ⅼ": "l",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "․": ".", "。": ".", "·": ".",
}
#: Characters that are not seen.
_UNSEEN = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
#: The digits from zero to nine in English, Spanish, French and German.
_SPELLED = (
    "zero one two three four five six seven eight nine",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "null eins zwei drei vier fünf sechs sieben acht neun",
)
_DIGIT = {w: str(i) for words in _SPELLED for i, w in enumerate(words.split())} | {"oh": "0", "zwo": "2"}
_TIMES = {"double": 2, "triple": 3}
#: The ends of hosts that a bare word for a dot may stand in.
_TOP = frozenset("com org net edu gov mil int info biz io co ai app dev eu us uk ca au nz ie de at ch fr be nl lu it es pt mx br ar cl pl se no dk fi cz ru jp cn in kr".split())
_AT, _DOT = "at|arroba|arobase", "dot|punto|point|punkt"
_OPEN, _SHUT = r"[(\[{<]", r"[)\]}>]"
_WORD = "|".join(sorted([*_DIGIT, *_TIMES], key=len, reverse=True))
_GAP = r"(?:\x20?[,-]\x20?|\x20)"


def luhn(digits: str) -> bool:
    """The check digit of a card number holds."""
    own = [int(d) for d in digits[::-1]]
    return sum(own[::2] + [2 * d - 9 * (d > 4) for d in own[1::2]]) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        host = _HOST.match(text, at + 1) if at > done else None
        if host:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                done = host.end()
                out.append((start, done))
        at = text.find("@", at + 1)
    return out


def _ips(text: str) -> list[tuple[int, int]]:
    """Each chain of numbers and dots, four numbers at a time."""
    out = []
    for m in _CHAIN.finditer(text):  # every number is read once, with the dots that follow it
        if m.end() - m.start() < 7:
            continue
        parts, at = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                out.append((at, end))
            at = end + 1
    return out


def _cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def _phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= sum(c in "0123456789" for c in m.group()) <= 15]


def identifiers(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of what the base patterns find, sorted."""
    found = []
    if "@" in text:
        found += [(0, *s) for s in _emails(text)]
    if "." in text:
        found += [(1, *s) for s in _ips(text)]
    found += [(2, *s) for s in _cards(text)]
    if "+" in text:
        found += [(3, *s) for s in _phones(text)]
    return found


class Tape(NamedTuple):
    """A normalised text: of each character, the source characters from ``start``
    to ``end`` it stands for, and how it came to be (0: as in the source, 1:
    rewritten, 2: from a bare word that prose holds too)."""

    text: str
    start: np.ndarray
    end: np.ndarray
    how: np.ndarray

    @classmethod
    def of(cls, text: str) -> Tape:
        at = np.arange(len(text))
        return cls(text, at, at + 1, np.zeros(len(text), np.int8))

    def rewritten(self, edits: list[tuple[int, int, str, int]]) -> Tape:
        """The tape after (from, to, new, how) edits, in order and apart.  New
        characters stand for all source characters of what they replace."""
        if not edits:
            return self
        lo, hi = np.array([e[:2] for e in edits]).T
        size, by = np.array([len(e[2]) for e in edits]), np.array([e[3] for e in edits], np.int8)
        text, at = [], 0
        for a, b, new, _ in edits:
            text += [self.text[at:a], new]
            at = b
        edge = np.zeros(len(self.text) + 1, np.int8)
        edge[lo] += 1
        np.subtract.at(edge, hi, 1)
        stays = np.cumsum(edge[:-1]) == 0
        # where each edit's characters go: after what stays and what is new before it
        first = lo - (np.cumsum(hi - lo) - (hi - lo)) + np.cumsum(size) - size
        own = np.repeat(first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        old = np.ones(int(stays.sum() + size.sum()), bool)
        old[own] = False

        def placed(kept: np.ndarray, new: np.ndarray) -> np.ndarray:
            out = np.empty(len(old), kept.dtype)
            out[old], out[own] = kept[stays], np.repeat(new, size)
            return out

        return Tape("".join([*text, self.text[at:]]), placed(self.start, self.start[lo]), placed(self.end, self.end[hi - 1]), placed(self.how, by))


@functools.cache
def _looks() -> dict[str, str]:
    """What each character looks like: those above, digits of every script, and
    width and font variants of ASCII letters, digits and signs."""
    table = _ALIKE | dict.fromkeys(_UNSEEN, "")
    for code in range(0x80, 0x20000):
        c = chr(code)
        kind = unicodedata.decomposition(c).split(" ")[0]
        if unicodedata.category(c) == "Nd":
            table.setdefault(c, str(unicodedata.decimal(c)))
        elif kind in ("<wide>", "<font>", "<narrow>", "<small>", "<noBreak>"):
            plain = unicodedata.normalize("NFKC", c)
            if len(plain) == 1 and plain.isascii():
                table.setdefault(c, plain)
    return table


_SIGNS = re.compile(rf"\s?{_OPEN}\s?(?:(?P<at>{_AT}|@)|(?P<dot>{_DOT}|\.)|(?P<dash>dash|hyphen|-)|(?P<under>underscore|_))\s?{_SHUT}\s?", re.IGNORECASE)
_BARE_DOT = re.compile(rf"(?<=[A-Za-z0-9])\x20(?:{_DOT})\x20(?=[A-Za-z0-9])", re.IGNORECASE)
_BARE_AT = re.compile(rf"(?<=[A-Za-z0-9])\x20(?:{_AT})\x20(?=[A-Za-z0-9-]{{1,63}}\.[A-Za-z0-9])", re.IGNORECASE)
_RUN = re.compile(rf"(?<![^\W_])(?:{_WORD})(?:{_GAP}(?:{_WORD})|(?<=[A-Za-z])\.(?:{_WORD}))*(?![^\W_])", re.IGNORECASE)
_SPELL = re.compile(rf"({_WORD})(?![^\W_])", re.IGNORECASE)
_PLUS = re.compile(r"(?<![^\W_])plus\x20?(?=[0-9])", re.IGNORECASE)
_MIXED = re.compile(r"(?<![\w|])[0-9OoIl|]{2,}+(?![\w|])")
_LETTER = re.compile(r"[OoIl|]")
#: A text without any of these, in small letters, has nothing to rewrite.
_SUSPECT = (
    re.compile(rf"{_OPEN}\s?(?:{_AT}|@|{_DOT}|\.|dash|hyphen|-|underscore|_)\s?{_SHUT}"), re.compile(rf"\x20(?:{_DOT})\x20"),
    re.compile(r"[0-9][oil|]|[oil|][0-9]"), re.compile(rf"(?:{_WORD}|plus)(?:\x20|,|-)\x20?(?:[0-9]|(?:{_WORD})(?![^\W_]))"))


def _odd(text: str) -> list[str]:
    """The look-alikes that a text holds."""
    return [] if text.isascii() else sorted(set(text) & _looks().keys())


def look_alikes(tape: Tape) -> Tape:
    """Characters as they look; what is not seen goes."""
    looks, own = _looks(), _odd(tape.text)
    if not own:
        return tape
    found = re.finditer("[" + "".join(map(re.escape, own)) + "]", tape.text)
    return tape.rewritten([(m.start(), m.end(), looks[m.group()], 1) for m in found])


def signs(tape: Tape) -> Tape:
    """Signs that are spelled, in brackets or bare, as signs."""
    sign = {"at": "@", "dot": ".", "dash": "-", "under": "_"}
    tape = tape.rewritten([(m.start(), m.end(), sign[m.lastgroup], 1) for m in _SIGNS.finditer(tape.text)])
    tape = tape.rewritten([(m.start(), m.end(), ".", 2) for m in _BARE_DOT.finditer(tape.text)])
    return tape.rewritten([(m.start(), m.end(), "@", 2) for m in _BARE_AT.finditer(tape.text)])


def digits(tape: Tape) -> Tape:
    """Digits that are spelled, one after the other, as a number; letters among digits as
    the digits they look like; ``plus`` before a number as the sign."""
    edits = []
    for m in _RUN.finditer(tape.text):
        times, gap = 1, m.start()
        for w in _SPELL.finditer(tape.text, *m.span()):
            word = w[1].lower()
            dotted = tape.text[gap : w.start()] == "."
            if not dotted and gap < w.start():
                edits.append((gap, w.start(), "", 1))
            edits.append((w.start(), w.end(), _DIGIT[word] * times if word in _DIGIT else "", 1))
            times, gap = _TIMES.get(word, 1), w.end()
    tape = tape.rewritten(edits)
    mixed = [m for m in _MIXED.finditer(tape.text) if not m.group().isdigit() and any(c.isdigit() for c in m.group())]
    letters = [x for m in mixed for x in _LETTER.finditer(tape.text, *m.span())]
    tape = tape.rewritten([(x.start(), x.end(), "0" if x.group() in "Oo" else "1", 1) for x in letters])
    return tape.rewritten([(m.start(), m.end(), "+", 1) for m in _PLUS.finditer(tape.text)])


def _plausible(address: str, how: np.ndarray) -> bool:
    """Whether a disguised address is one: its host ends in letters, in a known end after
    a bare dot; a bare ``at`` needs a disguised dot after it, a bare dot before the sign a disguised sign."""
    at, last = address.index("@"), address[address.rindex(".") + 1 :]
    if not (last.isalpha() and 2 <= len(last) <= 24) or (how[at + 1 :] == 2).any() and last.lower() not in _TOP:
        return False
    return how[at + 1 :].any() if how[at] == 2 else how[at] == 1 or not (how[:at] == 2).any()


def disguised(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in the source of identifiers that hold a rewritten character."""
    small = text.lower()
    if not any(s.search(small) for s in _SUSPECT) and not _odd(text):
        return []
    tape = digits(signs(look_alikes(Tape.of(text))))
    out = []
    for kind, lo, hi in identifiers(tape.text):
        how = tape.how[lo:hi]
        if not how.any() and tape.end[hi - 1] - tape.start[lo] == hi - lo:  # every character its own
            continue
        if kind == 0 and not _plausible(tape.text[lo:hi], how):
            continue
        out.append((kind, int(tape.start[lo]), int(tape.end[hi - 1])))
    return out


def scan_text(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(kind, start, end) of the base spans, and of those that the transducers add."""
    if not text:
        return [], []
    base = identifiers(text)
    return base, sorted(set(disguised(text)) - set(base))


def scan(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), redact: str | None = None) -> DataFrame:
    """``keep`` columns, ``spans`` and ``hidden``: arrays of (kind, start, end), the
    base spans and the added ones.  With ``redact``, also ``redacted``: the text
    with the union of all spans replaced by that string (a null text stays null)."""
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def cut(text: str, spans: list[tuple[int, int, int]]) -> str:
        out, at = [], 0
        for a, b in sorted((a, b) for _, a, b in spans):
            if b > at:
                if a >= at:
                    out += [text[at:a], redact]
                at = b
        return "".join([*out, text[at:]])

    def fn(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = texts_of(batch.column(0))
        found = [scan_text(t) for t in texts]
        out = {name: pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in both[i]] for both in found], pa.list_(kind))
               for i, name in enumerate(("spans", "hidden"))}
        if redact is not None:
            known = batch.column(0).is_valid().to_pylist()
            out["redacted"] = pa.array([cut(t, a + b) if v else None for t, (a, b), v in zip(texts, found, known, strict=True)], pa.string())
        return out

    spans = "array<struct<kind: string, start: bigint, end: bigint>>"
    return map_batches(df, (text_col,), keep, f"spans {spans}, hidden {spans}" + (", redacted string" if redact is not None else ""), fn)
