"""Search access paths: K3 trigram postings and K4 token postings, and the
indexed forms of Q7 (contains), Q8 (prefix) and Q10 (typo-tolerant).

Every run writes the documents that it made or changed once, numbered and in
folders of 131,072 (a *block*), with all that a search answers: the branch's key,
its uf, activity and both names.  A posting is one row per (term, block) with the
places of the documents that have the term, so that it holds four bytes a
document; files are sorted by term, a very common term is spread over several,
and a vocabulary holds the postings of each term.  A search takes its rarest term,
reads only that term's postings (a filter that reaches the scan) and the blocks
they name, applies the exact predicate there and takes the first k keys: one
plan with one ordered limit.  The tables themselves are not read, and nothing
comes to the driver but the sizes of the query's terms.

Terms are those of the names as they are and without accents (B10), so that one
index answers both kinds of search.

Postings follow the data: every run, batch or stream, that makes or changes
documents adds, in its own commit, those documents as they are now with their
postings, and a *dead* posting for each term of a document as it was before.  A
posting holds unless there is a dead one of the same term and numbered document;
an anti-join of the term's own postings takes the others out, so no more than the
term's range is read however many postings are outdated.  If a run changed
documents without postings, the index is behind the data: searches scan, and the
next run that indexes writes all postings anew.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clamp_limit, contains_pattern, name_tokens, prefix_terms_py, uf_condition, without_accents, without_accents_py
from ..functions.posting_lists import BLOCK_BITS, GRAM, LISTS, lists_of
from ..operators.search import (
    DOC_COLUMNS,
    KEYS3,
    _doc,
    _top,
    fuzzy_column_score,
    fuzzy_words,
    max_distance,
    search_contains,
    search_fuzzy,
    tokens_match_prefixes,
    word_distance,
)
from ..schema import TABLES
from .store import SNAPSHOT, Store, Transaction

KINDS = ("gram", "token")
SHOWN = ["uf", "razao_social", "nome_fantasia", "cnae_fiscal_principal"]
INDEXED = ("empresa", "estabelecimento")
#: Words near a misspelt one that a search names as literals; more are joined.
NEAR_WORDS = 500
#: Postings of a term that are sent to every task, so that only their blocks are read.
FEW = 200_000
#: Places in a list ascend: their differences are kept, in the few bits that each takes.
LIST_FILES = {"parquet.writer.version": "v2", "parquet.enable.dictionary#docs.list.element": "false", "compression": "zstd"}
#: Numbered documents: the run that wrote them, their number in it, and its block.
_SHOWN_OF = {**dict.fromkeys([*KEYS3, "uf", "nome_fantasia", "cnae_fiscal_principal"], "estabelecimento"), "razao_social": "empresa"}
DOCUMENT = T.StructType([T.StructField(c, TABLES[_SHOWN_OF[c]].struct[c].dataType if c in _SHOWN_OF else T.LongType())
                         for c in ("run", "doc", *KEYS3, *SHOWN, "block")])


def trigrams_py(q: str) -> list[str]:
    low = q.lower()
    return sorted({low[i : i + GRAM] for i in range(len(low) - GRAM + 1)})


def documents(tables: dict[str, DataFrame], delta: dict[str, DataFrame | None] | None = None) -> DataFrame:
    """Key and shown columns of every branch; with ``delta``, of the branches
    that are new or changed themselves or through their company."""
    e = tables["estabelecimento"].select(*KEYS3, "uf", "nome_fantasia", "cnae_fiscal_principal")
    emp = tables["empresa"].select("cnpj_basico", "razao_social")
    if delta is not None and None not in (delta.get("estabelecimento", 0), delta.get("empresa", 0)):
        own, of = delta.get("estabelecimento"), delta.get("empresa")
        parts = []
        if own is not None:
            parts.append(e.join(own.select(*KEYS3), KEYS3, "left_semi"))
        if of is not None:
            parts.append(e.join(of.select("cnpj_basico"), "cnpj_basico", "left_semi"))
        e = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]).dropDuplicates(KEYS3)
    return e.join(emp, "cnpj_basico", "left").select(*KEYS3, *SHOWN)


def _texts(kind: str) -> list[Column]:
    """What the terms of both names are made of, as they are and without accents;
    names of ASCII letters have none."""
    names = [F.col(c) for c in ("razao_social", "nome_fantasia")]
    folded = [F.when(F.octet_length(c) != F.char_length(c), without_accents(c)) for c in names]
    if kind == "gram":
        return [F.lower(c).alias(f"_t{i}") for i, c in enumerate([*names, *folded])]
    none = F.array().cast("array<string>")
    return [F.concat(*[F.coalesce(name_tokens(c), none) for c in (*names, *folded)]).alias("_words")]


def numbered(docs: DataFrame, run: int = 0) -> DataFrame:
    """Documents with their number in this run; to be written before it is used."""
    docs = docs.select(F.lit(run).cast("bigint").alias("run"), F.monotonically_increasing_id().alias("doc"), *KEYS3, *SHOWN)
    return docs.withColumn("block", F.shiftright("doc", BLOCK_BITS)).select(*DOCUMENT.names)


def postings(docs: DataFrame, kind: str, before: DataFrame | None = None) -> DataFrame:
    """One row per (term, block) of numbered documents.  ``before`` holds those
    which they replace: all of their postings are dead."""
    rows = docs.withColumn("alive", F.lit(True))
    if before is not None:
        rows = rows.unionByName(before.withColumn("alive", F.lit(False)))
    return rows.select("run", "doc", "alive", *_texts(kind)).mapInArrow(lists_of(kind), LISTS)


def _laid_out(df: DataFrame) -> DataFrame:
    return df.repartition("term", F.pmod("block", F.lit(16))).sortWithinPartitions("term", "run", "block")


def _vocabulary(df: DataFrame) -> DataFrame:
    """Postings of each term, sorted by (length, term) so a length window skips row groups."""
    vocab = df.groupBy("term").agg(F.sum(F.size("docs")).alias("docs")).withColumn("len", F.char_length("term"))
    return vocab.repartitionByRange("len", "term").sortWithinPartitions("len", "term")


@dataclass
class SearchIndex:
    """The folders of each posting table, one or more runs' together."""

    spark: SparkSession
    paths: dict[str, list[str]]

    def read(self, name: str) -> DataFrame:
        paths = self.paths[name]
        if name != "document":
            return self.spark.read.parquet(*paths)
        # (the runs' folders lie beside each other)
        return self.spark.read.schema(DOCUMENT).option("basePath", paths[0].rsplit("/", 1)[0]).parquet(*paths).select(*DOCUMENT.names)

    def current(self, kind: str, terms: Column, size: int, holds: Column, words: DataFrame | None = None) -> DataFrame:
        """The documents that some terms' postings name (of ``words`` only, if
        given) and a condition holds for, without those whose posting is dead.
        ``size``: how many postings the terms have."""
        lists = self.read(kind).where(terms)
        if words is not None:
            lists = lists.join(words, "term", "left_semi")

        def named(alive: bool) -> DataFrame:
            each = lists.where(F.col("alive") == alive).select("run", "block", F.explode("docs").alias("_at"))
            return each.select("run", "block", (F.shiftleft("block", BLOCK_BITS) + F.col("_at")).alias("doc"))

        found, on = named(True), ["run", "block", "doc"]
        if len(self.paths[kind]) > 1:
            found = found.join(named(False), on, "left_anti")
        docs = self.read("document").join(F.broadcast(found) if size <= FEW else found, on, "left_semi")
        return docs.where(holds)


def build_index(spark: SparkSession, tables: dict[str, DataFrame], base: str) -> SearchIndex:
    """K3 + K4 of all documents, outside any store."""
    idx = SearchIndex(spark, {"document": [f"{base.rstrip('/')}/document"]})
    numbered(documents(tables)).write.mode("overwrite").partitionBy("block").parquet(*idx.paths["document"])
    for kind in KINDS:
        path = f"{base.rstrip('/')}/{kind}"
        _laid_out(postings(idx.read("document"), kind)).write.mode("overwrite").options(**LIST_FILES).parquet(path)
        idx.paths[kind] = [path]
        _vocabulary(idx.read(kind)).write.mode("overwrite").parquet(f"{path}_vocabulary")
        idx.paths[f"{kind}_vocabulary"] = [f"{path}_vocabulary"]
    return idx


def _replaced(idx: SearchIndex, docs: DataFrame) -> DataFrame:
    """The newest numbered document before ``docs`` of each of their keys."""
    before = idx.read("document").join(docs.select(*KEYS3), KEYS3, "left_semi")
    if len(idx.paths["document"]) > 1:
        rest = [c for c in before.columns if c not in KEYS3]
        before = before.groupBy(*KEYS3).agg(F.max_by(F.struct(*rest), "run").alias("_row")).select(*KEYS3, "_row.*")
    return before.select(*DOCUMENT.names)


def index_changes(tx: Transaction) -> int:
    """Documents that this run made or changed and their postings, published with
    its commit; all documents, if the index is behind the data.  Nothing is
    written if there are none.  Returns the postings."""
    if not tx.delta.keys() & set(INDEXED):
        return 0
    store, base = tx.store, tx.store.commits()
    idx = committed_index(store, base)
    commits = [c for c in base if c["item"] not in {i["item"] for i in tx.items if i["kind"] == SNAPSHOT}]
    commits += [{"version": tx.version, "competencia": tx.competencia, **i} for i in tx.items]
    now = {t: store.read(t, TABLES[t].struct, commits) for t in INDEXED}
    add = tx.write_table if idx is None else tx.append
    add("index/document", numbered(documents(now, tx.delta if idx else None), tx.version), partition_by="block")
    docs = SearchIndex(store.spark, {"document": [tx.path("index/document")]}).read("document")
    before, n = None, 0
    if idx:  # looked up once for both kinds
        _replaced(idx, docs).write.mode("overwrite").parquet(path := tx.draft("index"))
        before = store.spark.read.schema(DOCUMENT).parquet(path)
    for kind in KINDS:
        rows = postings(docs, kind, before)
        add(f"index/{kind}", _laid_out(rows), rows=-1, options=LIST_FILES)
        written = store.spark.read.parquet(tx.path(f"index/{kind}"))
        add(f"index/{kind}_vocabulary", _vocabulary(written))
        size = store.spark.read.parquet(tx.path(f"index/{kind}_vocabulary")).agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]
        tx.set_rows(f"index/{kind}", size)
        n += size
    return n


def committed_index(store: Store, commits: list[dict]) -> SearchIndex | None:
    """The index at one version of the store; None if there is none, or if it is
    behind the data."""
    parts = {n: store.parts(f"index/{n}", commits) for n in ("document", *KINDS, *(f"{k}_vocabulary" for k in KINDS))}
    if not all(parts.values()):
        return None
    data = max((c["version"] for t in INDEXED for c in store.parts(t, commits)), default=0)
    if max(c["version"] for c in parts[KINDS[0]]) < data:
        return None
    return SearchIndex(store.spark, {n: [p for c in cs for p in c["paths"]] for n, cs in parts.items()})


# ---- searches ------------------------------------------------------------------------


def fetch(tables: dict[str, DataFrame], keys: list[tuple]) -> DataFrame:
    """Branches of a few keys with their company's name; the keys are literals
    that reach both scans."""
    spark = tables["empresa"].sparkSession
    roots = sorted({k[0] for k in keys})
    wanted = spark.createDataFrame(keys, "cnpj_basico string, cnpj_ordem string, cnpj_dv string")
    e = tables["estabelecimento"].select(*KEYS3, "nome_fantasia", "uf", "cnae_fiscal_principal").where(F.col("cnpj_basico").isin(roots))
    emp = tables["empresa"].select("cnpj_basico", "razao_social").where(F.col("cnpj_basico").isin(roots))
    return e.join(F.broadcast(wanted), KEYS3, "left_semi").join(F.broadcast(emp), "cnpj_basico", "left")


def _rarest(idx: SearchIndex, kind: str, conditions: list[Column]) -> tuple[Column, int]:
    """The condition with the fewest postings, and their number; none at all if
    a condition has none."""
    any_of = conditions[0]
    for c in conditions[1:]:
        any_of = any_of | c
    row = idx.read(f"{kind}_vocabulary").where(any_of).agg(
        *[F.sum(F.when(c, F.col("docs"))).alias(f"n{i}") for i, c in enumerate(conditions)]).first()
    if None in tuple(row):
        return F.lit(False), 0
    least = min(range(len(row)), key=row.__getitem__)
    return conditions[least], row[least]


def _located(uf: str | None, match: Column) -> Column:
    place = uf_condition(uf)
    return F.coalesce(match if place is None else match & place, F.lit(False))


def indexed_contains(
    tables: dict[str, DataFrame], idx: SearchIndex, q: str, uf: str | None = None, limit: int = 20, fold_accents: bool = False
) -> DataFrame:
    """K3: Q7 answered through trigram postings (queries under 3 characters or
    holding wildcards fall back to the scan form)."""
    own, text = (without_accents_py(q), without_accents) if fold_accents else (q, F.lower)
    if len(own) < GRAM or "%" in q or "_" in q:
        return search_contains(tables, q, uf, limit, fold_accents)
    pattern, terms = contains_pattern(own), [F.col("term") == g for g in trigrams_py(own)]
    match = text("razao_social").like(pattern) | text("nome_fantasia").like(pattern)
    hits = idx.current("gram", *_rarest(idx, "gram", terms), _located(uf, match))
    return _doc(_top(hits, clamp_limit(limit))).select(*DOC_COLUMNS)


def indexed_prefix(
    tables: dict[str, DataFrame], idx: SearchIndex, q: str, uf: str | None = None, limit: int = 20, fold_accents: bool = False
) -> DataFrame | None:
    """K4: Q8 answered through token postings (a prefix is a pushed-down
    ``startswith`` range on the sorted term)."""
    words = prefix_terms_py(without_accents_py(q) if fold_accents else q)
    if words is None:
        return None
    words, text = [t.lower() for t in words], without_accents if fold_accents else F.col
    match = tokens_match_prefixes(text("razao_social"), words) | tokens_match_prefixes(text("nome_fantasia"), words)
    hits = idx.current("token", *_rarest(idx, "token", [F.col("term").startswith(t) for t in words]), _located(uf, match))
    return _doc(_top(hits.dropDuplicates(KEYS3), clamp_limit(limit))).select(*DOC_COLUMNS)


def indexed_fuzzy(
    tables: dict[str, DataFrame], idx: SearchIndex, q: str, uf: str | None = None, limit: int = 20, fold_accents: bool = False
) -> DataFrame:
    """Q10 through the token postings: same rule and ranking as the scan form.
    Distances are measured over the vocabulary, in a window of lengths; the word
    that matches the fewest postings names those that are scored."""
    words, k = fuzzy_words(without_accents_py(q) if fold_accents else q), clamp_limit(limit)
    if not words:
        return search_fuzzy(tables, q, uf, limit, fold_accents)
    near: Callable[[str], Column] = lambda w: F.col("len").between(len(w) - max_distance(len(w)), len(w) + max_distance(len(w))) & (
        word_distance(F.col("term"), w).isNotNull())
    text = without_accents if fold_accents else F.col
    score = F.greatest(fuzzy_column_score(text("razao_social"), words), fuzzy_column_score(text("nome_fantasia"), words))
    rarest, size = _rarest(idx, "token", [near(w) for w in words])
    vocab = idx.read("token_vocabulary").where(rarest).select("term").distinct()
    some = [r["term"] for r in vocab.limit(NEAR_WORDS + 1).collect()]  # words of the vocabulary, not documents
    if len(some) <= NEAR_WORDS:
        hits = idx.current("token", F.col("term").isin(some), size, _located(uf, F.lit(True)))
    else:
        hits = idx.current("token", F.lit(True), size, _located(uf, F.lit(True)), vocab)
    scored = hits.withColumn("score", score).where(F.col("score").isNotNull()).dropDuplicates(KEYS3)
    return _doc(_top(scored, k, [F.desc("score"), *[F.col(c) for c in KEYS3]]), "score")
