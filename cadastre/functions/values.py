"""Value typing of positional text fields: S11 sanitize_null, S12 sanitize_zero,
S13 canonical_text and F11 bulk_tsv_value.

All are built-in column expressions (codegen'd, no Python per row).  Parsing
is guarded by a regular expression first so that the outcome is the same on
every engine (Spark's and DuckDB's lenient casts differ on '5.0', '1_000').
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import DECIMAL, INTEGER, NUMERIC, TEXT, TableSpec

# The whitespace set a Unicode TrimSpace removes.
WHITESPACE = " \t\n\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

# Strict base-10 integer, and a plain decimal number (optional exponent).
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c) -> Column:
    return F.btrim(_col(c), F.lit(WHITESPACE))


def blank_to_null(c) -> Column:
    """Trimmed text, '' → NULL."""
    return F.nullif(trim_ws(c), F.lit(""))


def parse_integer(c) -> Column:
    t = trim_ws(c)
    return F.when(t.rlike(INTEGER_PATTERN), t.try_cast("bigint"))


def _number_text(c) -> Column:
    return F.replace(trim_ws(c), F.lit(","), F.lit("."))


def parse_numeric(c) -> Column:
    """Decimal comma → dot (every comma), then decimal(15,2) rounded half-up; bad → NULL."""
    t = _number_text(c)
    return F.when(t.rlike(NUMBER_PATTERN), t.try_cast(DECIMAL))


def sanitize_value(c, kind: str) -> Column:
    """Typed value of one raw field, NULL when blank or unparsable."""
    if kind == NUMERIC:
        return parse_numeric(c)
    if kind == INTEGER:
        return parse_integer(c)
    return blank_to_null(c)


def zero_value(c, kind: str) -> Column:
    """As S11 but NULL becomes 0, 0.00 or ''."""
    v = sanitize_value(c, kind)
    if kind == NUMERIC:
        return F.coalesce(v, F.lit(0).cast(DECIMAL))
    if kind == INTEGER:
        return F.coalesce(v, F.lit(0).cast("bigint"))
    return F.coalesce(v, F.lit(""))


def canonical_of_typed(c, kind: str) -> Column:
    """S13 on an already typed column: '' for NULL, 2-decimal text, plain digits, text."""
    c = _col(c)
    if kind == TEXT:
        return F.coalesce(c, F.lit(""))
    return F.coalesce(c.cast("string"), F.lit(""))


def canonical_text(c, kind: str) -> Column:
    """S13 on a raw field."""
    return canonical_of_typed(sanitize_value(c, kind), kind)


def sanitize(df: DataFrame, spec: TableSpec, nulls: str = "null") -> DataFrame:
    """S11/S12 over every declared column; other columns pass through untouched."""
    fn = sanitize_value if nulls == "null" else zero_value
    typed = {c: fn(c, k).alias(c) for c, k in spec.columns}
    return df.select(*[typed.get(c, F.col(c)) for c in df.columns])


def canonical(df: DataFrame, spec: TableSpec) -> DataFrame:
    """S13 over every declared column of a raw (all-string) frame."""
    out = {c: canonical_text(c, k).alias(c) for c, k in spec.columns}
    return df.select(*[out.get(c, F.col(c)) for c in df.columns])


def escape_bulk_text(c) -> Column:
    """Escape backslash, tab, newline, carriage return and NUL for tab-separated bulk text."""
    c = _col(c)
    for raw, esc in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"), ("\x00", "\\0")):
        c = F.replace(c, F.lit(raw), F.lit(esc))
    return c


def bulk_tsv_value(c, kind: str) -> Column:
    """``\\N`` for blank/unparsable, the (comma→dot) text itself otherwise, escaped."""
    t = trim_ws(c)
    if kind == NUMERIC:
        n = _number_text(c)
        v = F.when(n.rlike(NUMBER_PATTERN), n)
    elif kind == INTEGER:
        v = F.when(t.rlike(INTEGER_PATTERN) & t.try_cast("bigint").isNotNull(), t)
    else:
        v = F.nullif(t, F.lit(""))
    return F.coalesce(escape_bulk_text(v), F.lit("\\N"))
