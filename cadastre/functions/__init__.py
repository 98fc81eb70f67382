"""Column functions (S11-S13, F1-F12): pure built-in expressions."""

from .formatting import address_line, opt_in_default, phone_label, zero_int, zero_text
from .keys import client_key, cnpj_clean, cnpj_full, cnpj_is_valid, cnpj_parts
from .search_terms import (
    clamp_limit,
    contains_pattern,
    name_tokens,
    prefix_terms,
    prefix_terms_py,
    query_words,
    uf_condition,
    without_accents,
    without_accents_py,
)
from .values import (
    blank_to_null,
    bulk_tsv_value,
    canonical,
    canonical_of_typed,
    canonical_text,
    parse_integer,
    parse_numeric,
    sanitize,
    sanitize_value,
    trim_ws,
    zero_value,
)
