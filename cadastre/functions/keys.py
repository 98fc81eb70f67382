"""Key handling: F1 cnpj_clean, F2 cnpj_parts / cnpj_full, F12 client_key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import WHITESPACE, _col

KEY_LENGTH = 14


def cnpj_clean(c) -> Column:
    """drop every character outside [a-zA-Z0-9] (no upper-casing, no check digits)."""
    return F.regexp_replace(_col(c), r"[^a-zA-Z0-9]", "")


def cnpj_is_valid(clean) -> Column:
    return F.char_length(_col(clean)) == KEY_LENGTH


def cnpj_parts(clean) -> dict[str, Column]:
    """8/4/2 split of a cleaned 14-character key."""
    c = _col(clean)
    return {
        "cnpj_basico": F.substring(c, 1, 8),
        "cnpj_ordem": F.substring(c, 9, 4),
        "cnpj_dv": F.substring(c, 13, 2),
    }


def cnpj_full(basico="cnpj_basico", ordem="cnpj_ordem", dv="cnpj_dv") -> Column:
    """concatenation of the three parts (NULL if any part is NULL)."""
    return F.concat(_col(basico), _col(ordem), _col(dv))


def client_key(forwarded_for, remote_addr) -> Column:
    """first hop of a forwarded-for list (trimmed) when the header is set,
    else the host part of ``host:port`` / ``[host]:port``, else the raw address."""
    xff = _col(forwarded_for)
    addr = _col(remote_addr)
    first_hop = F.btrim(F.split_part(xff, F.lit(","), F.lit(1)), F.lit(WHITESPACE))
    host = (
        F.when(addr.rlike(r"^\[[^\]]*\]:[^:\[\]]*$"), F.regexp_extract(addr, r"^\[([^\]]*)\]", 1))
        .when(addr.rlike(r"^[^:\[\]]*:[^:\[\]]*$"), F.regexp_extract(addr, r"^([^:]*):", 1))
        .otherwise(addr)
    )
    return F.when(F.coalesce(xff, F.lit("")) != "", first_hop).otherwise(host)
