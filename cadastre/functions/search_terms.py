"""Search arguments: F7 clamp_limit, F8 uf filter, F9 contains pattern,
F10 prefix terms, and the name tokeniser shared by Q8/Q10/K4."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import WHITESPACE, _col

DEFAULT_LIMIT = 20
MAX_LIMIT = 100
MIN_TERM_LENGTH = 3

# Characters removed from each query word (boolean-mode operators).
OPERATOR_CHARACTERS = '+-<>()~*"@'

# Token boundary for names: anything that is not a letter, digit or underscore.
TOKEN_SPLIT = r"[^\p{L}\p{N}_]+"


def clamp_limit(limit: int | None) -> int:
    """limit <= 0 or > 100 → 20."""
    if limit is None or limit <= 0 or limit > MAX_LIMIT:
        return DEFAULT_LIMIT
    return int(limit)


def clamped_limit(c) -> Column:
    """F7 over a column of limits."""
    return F.when(_col(c).between(1, MAX_LIMIT), _col(c)).otherwise(F.lit(DEFAULT_LIMIT))


def uf_condition(uf: str | None, column: str = "uf") -> Column | None:
    """F8: optional equality on the upper-cased argument (the column is not upper-cased)."""
    if not uf:
        return None
    return F.col(column) == F.lit(uf.upper())


def contains_pattern(q: str) -> str:
    """'%' + lower(q) + '%'; the user's '%' and '_' stay wildcards."""
    return "%" + q.lower() + "%"


def _strip_operators(w: Column) -> Column:
    return F.translate(w, OPERATOR_CHARACTERS, "")


def query_words(q) -> Column:
    """Whitespace-separated words of a query column, operators deleted."""
    t = F.btrim(_col(q), F.lit(WHITESPACE))
    words = F.filter(F.split(t, "[" + "".join(_re_escape(c) for c in WHITESPACE) + "]+"), lambda w: w != "")
    return F.transform(words, _strip_operators)


def _re_escape(ch: str) -> str:
    return "\\" + ch if ch in "\\^]-[" else ch


def prefix_terms(q) -> Column:
    """F10 as a column function: the boolean-mode query, or NULL when rejected
    (no word left, or any word shorter than three characters)."""
    words = query_words(q)
    ok = (F.size(words) > 0) & F.forall(words, lambda w: F.char_length(w) >= MIN_TERM_LENGTH)
    return F.when(ok, F.array_join(F.transform(words, lambda w: F.concat(F.lit("+"), w, F.lit("*"))), " "))


def prefix_terms_py(q: str) -> list[str] | None:
    """F10 for one driver-side query string: the terms, or None when rejected."""
    out = []
    for w in q.split():
        w = "".join(ch for ch in w if ch not in OPERATOR_CHARACTERS)
        if len(w) < MIN_TERM_LENGTH:
            return None
        out.append(w)
    return out or None


def name_tokens(c) -> Column:
    """Lower-cased word tokens of a name column (empty tokens removed)."""
    return F.filter(F.split(F.lower(_col(c)), TOKEN_SPLIT), lambda t: t != "")


@functools.cache
def _accents() -> tuple[str, str]:
    """Every letter that Unicode decomposes into a base letter and marks, and that base."""
    accented, plain = [], []
    for code in range(0x80, 0x10000):
        c = chr(code)
        parts = unicodedata.normalize("NFD", c)
        if len(parts) > 1 and c == c.lower() and all(unicodedata.category(m).startswith("M") for m in parts[1:]):
            accented.append(c)
            plain.append(parts[0])
    return "".join(accented), "".join(plain)


def without_accents(c) -> Column:
    """Lower case without accents, whether they are part of a letter or
    marks of their own, as an accent-insensitive collation compares names."""
    accented, plain = _accents()
    return F.regexp_replace(F.translate(F.lower(_col(c)), accented, plain), r"\p{M}+", "")


def without_accents_py(q: str) -> str:
    """:func:`without_accents` of a driver-side query string."""
    folded = q.lower().translate(str.maketrans(*_accents()))
    return "".join(ch for ch in folded if not unicodedata.category(ch).startswith("M"))
