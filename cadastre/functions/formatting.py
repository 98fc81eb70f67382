"""Presentation of profile and search rows: F3 address_line, F4 phone_label,
F5 opt-in default, F6 zero-value projection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import _col


def _txt(c) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def address_line(tipo, logradouro, numero, complemento) -> Column:
    """'{tipo} {logradouro}, {numero} {complemento}', NULL parts as '' and no trimming."""
    return F.format_string("%s %s, %s %s", _txt(tipo), _txt(logradouro), _txt(numero), _txt(complemento))


def phone_label(ddd, fone) -> Column:
    """'({ddd}) {fone}', NULL parts as ''."""
    return F.format_string("(%s) %s", _txt(ddd), _txt(fone))


def opt_in_default(c) -> Column:
    """no simples row, or a NULL flag, reads as 'N'."""
    return F.coalesce(_col(c), F.lit("N"))


def zero_text(c) -> Column:
    """NULL text → ''."""
    return _txt(c)


def zero_int(c) -> Column:
    """NULL integer → 0."""
    return F.coalesce(_col(c), F.lit(0).cast("bigint"))
