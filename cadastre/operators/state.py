"""State operators: U1 insert_ignore, U2 latest_by_key, U3 append_multiset,
U4 classify, U5 change_log, U6 apply_changes and the single-join
``diff`` they share inside the tracked upsert (U8).

Skew: one key may carry a large share of an input (duplicates inside a
snapshot).  De-duplication therefore uses ``min_by``/``max_by`` aggregates,
which combine partially on the map side before the shuffle, instead of a
``row_number`` window that would pull a hot key's rows into one task.  After
de-duplication every key is unique on both sides, so the keyed joins cannot
skew on a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import canonical_of_typed
from ..schema import TEXT, TableSpec

NEW, CHANGED, UNCHANGED, ABSENT, REJECTED = "new", "changed", "unchanged", "absent", "rejected"


def first_by_key(df: DataFrame, keys: list[str], order: list[str], keep_order: bool = False) -> DataFrame:
    """One row per key: the row with the smallest ``order`` tuple (first wins)."""
    payload = [c for c in df.columns if c not in keys and (keep_order or c not in order)]
    rank = F.struct(*[F.col(c) for c in order])
    row = F.struct(*[F.col(c) for c in payload]) if payload else F.lit(None)
    out = df.groupBy(*keys).agg(F.min_by(row, rank).alias("_row"))
    return out.select(*keys, *[F.col("_row")[c].alias(c) for c in payload])


def last_by_key(df: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """One row per key, the one with the largest ``seq`` tuple (last inserted wins)."""
    payload = [c for c in df.columns if c not in keys and c not in seq]
    rank = F.struct(*[F.col(c) for c in seq])
    out = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in payload]), rank).alias("_row"))
    return out.select(*keys, *[F.col("_row")[c].alias(c) for c in payload])


latest_by_key = last_by_key


def insert_ignore(state: DataFrame, incoming: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Add incoming rows whose key is unseen; stored rows win; inside the
    input the first row by ``order`` (file, ordinal) wins, without an order the
    smallest by its values.  Keyless → append."""
    if not keys:
        return append_multiset(state, incoming)
    cols = state.columns
    if order:
        inc = first_by_key(incoming, keys, order)
    else:  # no order known: the smallest row by its values, so that a retry gives the same
        inc = first_by_key(incoming, keys, [c for c in incoming.columns if c not in keys], keep_order=True)
    fresh = inc.join(state.select(*keys), keys, "left_anti")
    return state.unionByName(fresh.select(*cols))


def append_multiset(state: DataFrame, incoming: DataFrame) -> DataFrame:
    """Keyless table, plain append; duplicates are kept."""
    return state.unionByName(incoming.select(*state.columns))


def _equal(old: Column, new: Column, kind: str) -> Column:
    """Equality of the S13 comparison forms of two typed values."""
    if kind == TEXT:
        return F.coalesce(old, F.lit("")) == F.coalesce(new, F.lit(""))
    return old.eqNullSafe(new)


def _sides(state: DataFrame, incoming: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both inputs of the comparison, and the columns they join on."""
    keys = list(spec.keys)
    other = [c for c in spec.column_names if c not in keys]
    row_id = ["_rid"] if "_rid" in incoming.columns else []
    o = state.select(*keys, *[F.col(c).alias("o_" + c) for c in other], F.lit(True).alias("_old"))
    if row_id:
        # Stored rows carry _rid = 0 like every complete incoming key, so this is the
        # keyed join, and the partitioning from de-duplication is used as it is.  (A
        # literal would be taken out of the join's keys, and the snapshot be shuffled again.)
        o = o.withColumn("_rid", F.pmod(F.hash(*keys), F.lit(1)).cast("bigint"))
    n = incoming.select(*keys, *row_id, *[F.col(c).alias("n_" + c) for c in other], F.lit(True).alias("_new"))
    return o, n, keys + row_id


def _classified(j: DataFrame, spec: TableSpec) -> DataFrame:
    """``_ndiff`` (differing columns, in comparison form) and ``_class`` of joined rows."""
    ndiff = F.lit(0)
    for c in spec.column_names:
        if c not in spec.keys:
            ndiff = ndiff + F.when(_equal(F.col("o_" + c), F.col("n_" + c), spec.type_of(c)), 0).otherwise(1)
    incomplete = F.lit(False)
    for k in spec.keys:
        incomplete = incomplete | F.col(k).isNull()
    j = j.drop("_rid").withColumn("_ndiff", ndiff)
    cls = (
        F.when(incomplete, F.lit(REJECTED))
        .when(F.col("_old").isNull(), F.lit(NEW))
        .when(F.col("_new").isNull(), F.lit(ABSENT))
        .when(F.col("_ndiff") == 0, F.lit(UNCHANGED))
        .otherwise(F.lit(CHANGED))
    )
    return j.withColumn("_class", cls)


def diff(state: DataFrame, incoming: DataFrame, spec: TableSpec) -> DataFrame:
    """One full outer join of stored and incoming rows on the key.

    Output: the key, ``o_<col>`` / ``n_<col>`` for every other column, the
    presence flags and ``_class`` (new / changed / unchanged / absent).
    ``incoming`` must be unique per key (see ``first_by_key``).
    """
    o, n, on = _sides(state, incoming, spec)
    return _classified(o.join(n, on, "full_outer"), spec)


def compare_incoming(state: DataFrame, incoming: DataFrame, spec: TableSpec) -> DataFrame:
    """``diff`` without the absent rows: each incoming row beside the stored row
    of its key.  What a load needs, as absent rows stay where they are."""
    o, n, on = _sides(state, incoming, spec)
    return _classified(n.join(o, on, "left"), spec)


def class_count_exprs(with_log: bool = True) -> list[Column]:
    """Aggregates of a ``diff``: incoming / new / changed / unchanged / kept-absent /
    rejected rows and (``with_log``) the number of change-log entries."""
    c = F.col("_class")
    aggs = [
        F.count_if(c != ABSENT).alias("incoming"),
        F.count_if(c == NEW).alias("new"),
        F.count_if(c == CHANGED).alias("changed"),
        F.count_if(c == UNCHANGED).alias("unchanged"),
        F.count_if(c == ABSENT).alias("kept_absent"),
        F.count_if(c == REJECTED).alias("rejected"),
    ]
    if with_log:
        aggs.append(F.coalesce(F.sum(F.when(c == CHANGED, F.col("_ndiff"))), F.lit(0)).cast("bigint").alias("log_rows"))
    return aggs


def classify_counts(d: DataFrame, table: str, spec: TableSpec | None = None) -> DataFrame:
    """U4 summary: incoming / new / changed / unchanged counts (and kept-absent
    rows); with ``spec`` also the number of change-log entries, in the same pass."""
    return d.agg(F.lit(table).alias("tabela"), *class_count_exprs(spec is not None))


def classify(state: DataFrame, incoming: DataFrame, spec: TableSpec) -> DataFrame:
    """U4: each incoming row with its class."""
    d = diff(state, incoming, spec).where(F.col("_class") != ABSENT)
    return d.select(*spec.keys, "_class")


def _entries(spec: TableSpec) -> Column:
    """(campo, old, new) in comparison form for every non-key column of a diff row."""
    other = [c for c in spec.column_names if c not in spec.keys]
    return F.array(
        *[
            F.struct(
                F.lit(c).alias("campo"),
                canonical_of_typed(F.col("o_" + c), spec.type_of(c)).alias("valor_antigo"),
                canonical_of_typed(F.col("n_" + c), spec.type_of(c)).alias("valor_novo"),
            )
            for c in other
        ]
    )


def change_entries(d: DataFrame, spec: TableSpec, competencia: str, detected_at: str) -> DataFrame:
    """U5 from a ``diff``: one row per differing column of a changed row,
    values in comparison form.  Built as one filtered array per row and a
    single ``explode`` — no unpivot of unchanged columns."""
    keys = list(spec.keys)
    entries = _entries(spec)
    changed = d.where(F.col("_class") == CHANGED).select(
        F.col(keys[0]).alias("cnpj_basico"),
        F.explode(F.filter(entries, lambda e: e["valor_antigo"] != e["valor_novo"])).alias("e"),
    )
    return changed.select(
        "cnpj_basico",
        F.lit(spec.name).alias("tabela"),
        F.col("e.campo").alias("campo"),
        F.col("e.valor_antigo").alias("valor_antigo"),
        F.col("e.valor_novo").alias("valor_novo"),
        F.lit(competencia).alias("competencia"),
        F.lit(detected_at).cast("timestamp_ntz").alias("detectado_em"),
    )


def change_log(state: DataFrame, incoming: DataFrame, spec: TableSpec, competencia: str, detected_at: str) -> DataFrame:
    """The field-level change log of one snapshot against the stored state."""
    return change_entries(diff(state, incoming, spec), spec, competencia, detected_at)


def rejected_rows(d: DataFrame, spec: TableSpec) -> DataFrame:
    """Incoming rows of a ``diff`` whose key was incomplete."""
    keys = list(spec.keys)
    other = [c for c in spec.column_names if c not in keys]
    return d.where(F.col("_class") == REJECTED).select(*keys, *[F.col("n_" + c).alias(c) for c in other])


def state_after(d: DataFrame, spec: TableSpec) -> DataFrame:
    """U6 from a ``diff``: the incoming row where present, else the stored one
    (rows with an incomplete key are not part of the state)."""
    keys = list(spec.keys)
    other = [c for c in spec.column_names if c not in keys]
    take_new = F.col("_new").isNotNull()
    return d.where(F.col("_class") != REJECTED).select(
        *keys, *[F.when(take_new, F.col("n_" + c)).otherwise(F.col("o_" + c)).alias(c) for c in other]
    )


def apply_changes(state: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Changed rows fully overwritten, new rows added, rows absent from
    the snapshot kept: ``incoming ∪ (state ⋉̸ incoming)``."""
    kept = state.join(incoming.select(*keys), keys, "left_anti")
    return incoming.select(*state.columns).unionByName(kept)
