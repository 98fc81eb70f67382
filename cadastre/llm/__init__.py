"""Operators of a training-data pipeline: de-duplication, tokenizing, packing,
scanning, language and licence identification, exact vector search.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface (any DataFrame, column names as
parameters); :mod:`cadastre.llm.queries` holds the thin registered queries.

Conventions shared by all operators: a row is never identified by its position
or by an assumed unique id, so repeated rows and null ids are ordinary input;
output columns are the named key columns plus the operator's own, so other
input columns (also of clashing names) never interfere; an empty table gives
an empty result of the same schema.
"""
