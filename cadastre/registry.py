"""One entry point over a published store: the questions people ask of the
registry, each a DataFrame operator (nothing is collected here).

    reg = Registry(spark, "s3a://bucket/registry")
    reg.load_month(archives, "2026-09", detected_at="2026-09-03 10:15:22")
    reg.profiles(requests_df).show()
    reg.search("padaria", uf="sp", limit=20).show()
    reg.history(requests_df).show()
    reg.stats("estimate")
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .operators.joins import profile, profiles, registry_view
from .operators.ledger import latest_processed
from .operators.reads import change_history, company_history, search_documents, stats_exact, stats_final, stats_from_commits, stats_from_sketches
from .operators.search import search, search_contains
from .plans.colocated import attach, colocated_profiles, colocated_view, write_colocated
from .plans.indexes import committed_index, indexed_contains, indexed_fuzzy, indexed_prefix
from .plans.places import read_places, search_place, write_places
from .plans.run_month import run_month
from .plans.sinks import export_index
from .plans.store import Store
from .plans.upsert import read_change_log, read_sketches
from .schema import MONTH_LEDGER, TABLES
from .session import scratch_path


COLOCATED, PLACES = "layout/colocated", "layout/places"


class Registry:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.store = Store(spark, base)
        self.base = base.rstrip("/")

    # ---- state -------------------------------------------------------------------
    def tables(self) -> dict[str, DataFrame]:
        """Every table at one consistent committed version."""
        commits = self.store.commits()
        return {t: self.store.read(t, TABLES[t].struct, commits) for t in TABLES}

    def load_month(self, archives: list[str], month: str, detected_at: str, force: bool = False) -> dict:
        """Load one month's archives, with the postings (K3/K4) and the
        export (K5) of what it changes; with nothing pending neither is touched."""
        return run_month(self.spark, self.store, archives, month, detected_at, scratch_path(self.spark, "staging"), force=force)

    def reset_month(self, month: str) -> int:
        """Drop one month's ledger rows (a new version) so the month loads
        again; the data tables and the postings are untouched."""
        from pyspark.sql import functions as F

        from .schema import FILE_LEDGER

        commits = self.store.commits()
        tx = self.store.begin(None)
        files = self.store.read("file_ledger", FILE_LEDGER, commits)
        months = self.store.read("month_ledger", MONTH_LEDGER, commits)
        tx.write_table("file_ledger", files.where(F.col("data_month") != month))
        tx.write_table("month_ledger", months.where(F.col("data_month") != month))
        return tx.commit()

    def lay_out(self) -> int:
        """K2: write the co-located and by-place copies of the published state and
        publish them.  They answer until a later run changes the data."""
        tables, tx = self.tables(), self.store.begin(None)
        write_colocated(tables, tx.path(COLOCATED), version=tx.base)
        write_places(tables, tx.path(PLACES))
        tx.link(COLOCATED)
        tx.link(PLACES)
        return tx.commit()

    def _layout(self, item: str, commits: list[dict]) -> str | None:
        """The folder of a layout that is as new as the data."""
        parts = self.store.parts(item, commits)
        data = max((c["version"] for t in ("empresa", "estabelecimento", "simples") for c in self.store.parts(t, commits)), default=0)
        return parts[0]["paths"][0] if parts and parts[0]["version"] > data else None

    # ---- questions -----------------------------------------------------------------
    def view(self) -> DataFrame:
        """J1, without an exchange if the co-located layout is up with the data."""
        at = self._layout(COLOCATED, self.store.commits())
        return registry_view(self.tables()) if at is None else colocated_view(attach(self.spark, at), self.tables())

    def profile(self, cnpj: str) -> DataFrame:
        """One key: literal filters reach the scans (key-range layout skips files)."""
        return profile(self.tables(), cnpj)

    def profiles(self, requests: DataFrame, column: str = "requested") -> DataFrame:
        at = self._layout(COLOCATED, self.store.commits())
        return profiles(self.tables(), requests, column) if at is None else colocated_profiles(attach(self.spark, at), requests, column)

    def search_in(self, uf: str, q: str, limit: int = 20) -> DataFrame:
        """Q7 in one place, from its folder only if the by-place layout is up with the data."""
        commits = self.store.commits()
        at = self._layout(PLACES, commits)
        if at is not None:
            return search_place(read_places(self.spark, at), q, uf, limit)
        return search_contains({t: self.store.read(t, TABLES[t].struct, commits) for t in ("empresa", "estabelecimento")}, q, uf, limit)

    def history_of(self, cnpj: str) -> DataFrame:
        """Q4 for one company: literal key filter on the company-sorted log files."""
        return company_history(read_change_log(self.store), cnpj)

    def history(self, requests: DataFrame, column: str = "requested") -> DataFrame:
        return change_history(read_change_log(self.store), requests, column)

    def search(self, q: str, uf: str | None = None, limit: int = 20, ranked: bool = False, fold_accents: bool = False) -> DataFrame:
        """Q9 cascade through the K3/K4 postings, or by scan if there are none or
        they are behind the data; ``ranked`` asks for Q10.  ``fold_accents``
        compares names without accents, as an accent-insensitive collation does."""
        from pyspark.sql import functions as F

        commits = self.store.commits()
        t = {n: self.store.read(n, TABLES[n].struct, commits) for n in ("empresa", "estabelecimento")}
        source = lambda df, name: df.withColumn("source", F.lit(name))
        idx = committed_index(self.store, commits)
        if idx is None:
            return search(t, q, uf, limit, ranked, fold_accents=fold_accents)
        if ranked:
            return source(indexed_fuzzy(t, idx, q, uf, limit, fold_accents).drop("score"), "fuzzy")
        p = indexed_prefix(t, idx, q, uf, limit, fold_accents)
        return source(p, "prefix") if p is not None else source(indexed_contains(t, idx, q, uf, limit, fold_accents), "contains")

    def stats(self, how: str = "exact"):
        t = self.tables()
        if how == "estimate":
            return stats_from_commits(self.store.commits())
        if how == "final":
            return stats_final(t)
        if how == "approximate":  # from the sketches stored with each load
            return stats_from_sketches(read_sketches(self.store))
        months = self.store.read("month_ledger", MONTH_LEDGER)
        return stats_exact(t, latest_processed(months, ["seq"]))

    def export_search_documents(self, path: str) -> None:
        export_index(search_documents(self.tables(), ordered=False), path)
