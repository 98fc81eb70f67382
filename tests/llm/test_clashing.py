"""Columns of any names beside the text, kept or not, and rows that tie."""

import pytest
from pyspark.sql import functions as F

from cadastre.llm import ngram_join, packing, pii, substring_dedup, suffix_dedup

import public_tokenizers

JSON = public_tokenizers.path("byte_bpe_50k.json")
NAMES = ("_text", "_runs", "_key", "key", "runs", "text_hash", "_row", "row", "n", "_pieces", "k0", "block", "bucket")


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(1, "one two three"), (2, "w " * 80), (3, "w " * 80), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for c in NAMES:
        df = df.withColumn(c, F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")))
    return df


KEEP = ("doc_id", *NAMES)


@pytest.mark.parametrize("remove", [substring_dedup.remove, suffix_dedup.remove])
def test_removal_keeps_them(clashing, remove):
    got = remove(clashing, keep=KEEP).collect()
    assert len(got) == 5 and all(r[c] == f"{c}-{r['doc_id']}" for r in got for c in NAMES)
    own = {r["doc_id"]: r["n_removed"] for r in remove(clashing).collect()}
    assert {r["doc_id"]: r["n_removed"] for r in got} == own


def test_removal_keeps_the_text(clashing):
    got = substring_dedup.remove(clashing, keep=("text", "doc_id")).collect()
    assert {r["doc_id"]: (r["text"], r["kept_text"]) for r in got}[2] == ("w " * 80, "") and len(got) == 5


def test_sifting_changes_nothing(clashing):
    rows = lambda df: sorted(map(repr, df.collect()))
    for keep in (("doc_id",), ("text", "doc_id"), KEEP):
        assert rows(substring_dedup.remove(clashing, keep=keep, sift=True)) == rows(substring_dedup.remove(clashing, keep=keep))
    assert substring_dedup.remove(clashing.limit(0), sift=True).collect() == []


def test_packing_keeps_them(clashing):
    got = packing.pack(clashing, JSON, keep=KEEP).collect()
    shown = {c: "bucket_kept" if c == "bucket" else c for c in NAMES}  # the pieces have a bucket of their own
    assert {r["doc_id"] for r in got} == {1, 2, 3, 4, 5} and all(r[shown[c]] == f"{c}-{r['doc_id']}" for r in got for c in NAMES)


def test_representatives_pass_them(clashing):
    got = ngram_join.representatives(clashing).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 2, 4, 5] and all(r[c] == f"{c}-{r['doc_id']}" for r in got for c in NAMES)


def test_personal_data_keeps_them(clashing):
    assert pii.scan(clashing, keep=KEEP).select(*NAMES).count() == 5


def test_one_id_and_text_with_other_columns(spark):
    """Of rows that agree in id and text the first by all columns stays, whatever the partitions."""
    rows = [(1, "a b c d e f", lang) for lang in ("fr", "de", None, "en")] + [(1, "a b c d e f", "de")]
    for parts in (1, 3):
        df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(parts)
        assert [tuple(r) for r in ngram_join.representatives(df).collect()] == [(1, "a b c d e f", None)]


def test_packing_renames_what_clashes(clashing):
    got = packing.pack(clashing.withColumn("doc_tokens", F.lit("x")), JSON, keep=("doc_id", "doc_tokens")).collect()
    assert {r["doc_tokens_kept"] for r in got} == {"x"} and all(r["doc_tokens"] >= 1 for r in got)
