"""Name search: Q7 contains, Q8 prefix, Q9 cascade, Q10 typo-tolerant.

Plan shape.  A predicate ``A(razao_social) OR B(nome_fantasia)`` across the
company ⟕ branch join cannot be pushed below the join, so every search is
split into two single-table branches (company names, branch names) that are
filtered at the scan first and joined afterwards, then united.  Because every
search returns a top-k by ``cnpj`` (k ≤ 100, F7), each branch is cut to its
own top-k before the union — the top-k of a union is the top-k of the
branches' top-ks — so the company join only ever sees k branch rows, which
makes its broadcast size-bounded by k.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clamp_limit, cnpj_full, contains_pattern, name_tokens, prefix_terms_py, uf_condition, without_accents, without_accents_py
from ..functions import zero_int, zero_text

KEYS3 = ["cnpj_basico", "cnpj_ordem", "cnpj_dv"]
MAX_K = 100
DOC_COLUMNS = ["cnpj", "razao_social", "nome_fantasia", "uf", "cnae"]


def _doc(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        cnpj_full().alias("cnpj"),
        zero_text("razao_social").alias("razao_social"),
        zero_text("nome_fantasia").alias("nome_fantasia"),
        zero_text("uf").alias("uf"),
        zero_int("cnae_fiscal_principal").alias("cnae"),
        *extra,
    )


def _branches(tables: dict[str, DataFrame], uf: str | None) -> DataFrame:
    e = tables["estabelecimento"].select(*KEYS3, "nome_fantasia", "uf", "cnae_fiscal_principal")
    cond = uf_condition(uf)
    return e if cond is None else e.where(cond)


def _companies(tables: dict[str, DataFrame]) -> DataFrame:
    return tables["empresa"].select("cnpj_basico", "razao_social")


def _top(df: DataFrame, k: int, order: list[Column] | None = None) -> DataFrame:
    """The first k rows by ``order``.  Spark plans it as one top-k per partition
    and a merge of at most k x partitions rows."""
    return df.orderBy(*(order or [F.col(c) for c in KEYS3])).limit(k)


def _with_company_names(top: DataFrame, companies: DataFrame, k: int = MAX_K) -> DataFrame:
    """Attach razao_social to a top-k of branch rows (two-phase search).

    The top-k (≤ k ≤ 100 rows, F7) is computed once and brought back as the
    search answer itself; its company keys then become a literal ``IN`` filter
    that reaches the parquet scan of the company table, where the key-range
    layout (K2) skips every row group but the matching ones.  No shuffle of
    the company table, no second evaluation of the branch search.
    """
    rows = top.collect()
    if len(rows) > k:
        raise ValueError(f"top-k produced {len(rows)} rows, more than {k}")
    spark = top.sparkSession
    keys = sorted({r["cnpj_basico"] for r in rows if r["cnpj_basico"] is not None})
    names = companies.where(F.col("cnpj_basico").isin(keys)) if keys else companies.where(F.lit(False))
    local = spark.createDataFrame(rows, top.schema)
    return local.join(F.broadcast(names), "cnpj_basico", "left")


def two_branch_search(
    tables: dict[str, DataFrame],
    company_match: Column | None,
    branch_match: Column | None,
    uf: str | None,
    limit: int,
) -> DataFrame:
    """Union (distinct) of branches matched on their own name and branches of
    companies matched on theirs; top ``limit`` by key, 5 search columns."""
    k = clamp_limit(limit)
    branches = _branches(tables, uf)
    companies = _companies(tables)
    parts = []
    if branch_match is not None:
        b = _top(branches.where(branch_match), k)
        parts.append(_with_company_names(b, companies, k))
    if company_match is not None:
        # Matched companies have no size bound (a common word): no hint, AQE
        # broadcasts them only if the measured size is under its threshold.
        c = companies.where(company_match)
        parts.append(_top(branches.join(c, "cnpj_basico", "inner"), k))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p.select(*u.columns))
    u = u.dropDuplicates(KEYS3)
    return _doc(_top(u, k))


def search_contains(
    tables: dict[str, DataFrame], q: str, uf: str | None = None, limit: int = 20, fold_accents: bool = False
) -> DataFrame:
    """Q7: case-insensitive LIKE '%q%' on either name (wildcards kept), F8, F7;
    with ``fold_accents`` accents make no difference either (B10)."""
    text, pattern = (without_accents, contains_pattern(without_accents_py(q))) if fold_accents else (F.lower, contains_pattern(q))
    return two_branch_search(tables, text("razao_social").like(pattern), text("nome_fantasia").like(pattern), uf, limit)


def tokens_match_prefixes(column, terms: list[str]) -> Column:
    """Every term is a prefix of some token of ``column`` (tokens lower-cased)."""
    toks = name_tokens(column)
    cond = F.lit(True)
    for t in terms:
        cond = cond & F.exists(toks, _starts_with(t))
    return cond


def _starts_with(t: str):
    return lambda x: x.startswith(F.lit(t))


def _distance_to(w: str):
    return lambda x: word_distance(x, w)


def search_prefix(tables: dict[str, DataFrame], q: str, uf: str | None = None, limit: int = 20, fold_accents: bool = False) -> DataFrame | None:
    """Q8: F10 terms, every term prefixes a token of the same column; branch A on
    nome_fantasia, branch B on razao_social; distinct union; None if F10 rejects."""
    terms = prefix_terms_py(without_accents_py(q) if fold_accents else q)
    if terms is None:
        return None
    terms = [t.lower() for t in terms]
    text = without_accents if fold_accents else F.col
    return two_branch_search(
        tables, tokens_match_prefixes(text("razao_social"), terms), tokens_match_prefixes(text("nome_fantasia"), terms), uf, limit
    )


# ---- Q10 ---------------------------------------------------------------------------------------


def max_distance(n: int) -> int:
    """Allowed edits by query-word length: 0 below 5, 1 for 5-8, 2 from 9."""
    return 0 if n < 5 else 1 if n <= 8 else 2


def word_distance(token: Column, word: str) -> Column:
    """Accepted distance of ``token`` to the query ``word`` or NULL.

    Levenshtein within ``max_distance``; additionally a same-length 5-8
    character anagram at distance 2 (a transposition) is accepted as 2.
    """
    d = F.levenshtein(token, F.lit(word), 2)  # -1 beyond two edits: no rule accepts more
    n = len(word)
    ok = (d >= 0) & (d <= max_distance(n))
    if 5 <= n <= 8:
        same_letters = F.array_sort(F.split(token, "")) == F.array_sort(F.split(F.lit(word), ""))
        ok = ok | ((d == 2) & (F.char_length(token) == n) & same_letters)
    return F.when(ok, d)


def fuzzy_column_score(column, words: list[str]) -> Column:
    """Score of one name column, NULL unless every word matches some token."""
    toks = name_tokens(column)
    return score_from_distances([F.array_min(F.transform(toks, _distance_to(w))) for w in words])


def score_from_distances(dists: list[Column]) -> Column:
    """Σ 1/(1+d) in word order, +0.5 when every d = 0; NULL unless every word matched."""
    total = F.lit(0.0)
    for d in dists:
        total = total + F.lit(1.0) / (F.lit(1.0) + d)
    exact = F.lit(True)
    for d in dists:
        exact = exact & (d == 0)
    all_matched = F.lit(True)
    for d in dists:
        all_matched = all_matched & d.isNotNull()
    return F.when(all_matched, total + F.when(exact, F.lit(0.5)).otherwise(F.lit(0.0)))


def fuzzy_words(q: str) -> list[str]:
    return [w.lower() for w in q.split() if w]


def search_fuzzy(tables: dict[str, DataFrame], q: str, uf: str | None = None, limit: int = 20, fold_accents: bool = False) -> DataFrame:
    """Q10 (scan form): typo-tolerant name search ranked by score desc, cnpj."""
    words = fuzzy_words(without_accents_py(q) if fold_accents else q)
    text = without_accents if fold_accents else F.col
    k = clamp_limit(limit)
    branches = _branches(tables, uf)
    companies = _companies(tables)
    order = [F.desc("score"), *[F.col(c) for c in KEYS3]]
    b = branches.withColumn("score", fuzzy_column_score(text("nome_fantasia"), words)).where(F.col("score").isNotNull())
    b = _with_company_names(_top(b, k, order), companies, k)
    c = companies.withColumn("_cscore", fuzzy_column_score(text("razao_social"), words)).where(F.col("_cscore").isNotNull())
    c = branches.join(c, "cnpj_basico", "inner")
    c = c.withColumn("score", F.greatest(F.col("_cscore"), F.coalesce(fuzzy_column_score(text("nome_fantasia"), words), F.lit(0.0))))
    c = _top(c.drop("_cscore"), k, order)
    u = b.unionByName(c.select(*b.columns))
    best = u.groupBy(*KEYS3).agg(F.max_by(F.struct(*[x for x in u.columns if x not in KEYS3]), F.col("score")).alias("r"))
    best = best.select(*KEYS3, "r.*")
    return _doc(_top(best, k, order), "score")


def search(
    tables: dict[str, DataFrame],
    q: str,
    uf: str | None = None,
    limit: int = 20,
    ranked: bool = False,
    prefix_index: bool = True,
    fold_accents: bool = False,
) -> DataFrame:
    """Q9 cascade: ranked engine if asked → prefix if F10 accepts (and an index
    exists) → contains.  ``source`` names the branch that answered."""
    if ranked:
        return search_fuzzy(tables, q, uf, limit, fold_accents).drop("score").withColumn("source", F.lit("fuzzy"))
    if prefix_index:
        p = search_prefix(tables, q, uf, limit, fold_accents)
        if p is not None:
            return p.withColumn("source", F.lit("prefix"))
    return search_contains(tables, q, uf, limit, fold_accents).withColumn("source", F.lit("contains"))
