"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and read again as the next one's input.

Every stage but the last returns the columns of documents.  Nulls in other
columns, repeated rows and clashing names pass through, and columns that
documents has beside its own are dropped by the first stage; an empty table stays
empty.  Very long texts are worked on whole; each stage's operator defines what it
does with odd texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastre.llm import langid, ngram_join, packing, secret_scan, substring_dedup
from cadastre.llm.common import discard, staged, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near duplicates share this many in a hundred of their five-word shingles.
SHINGLE, SIMILAR = 5, 80


def _documents(df: DataFrame, text: str) -> DataFrame:
    """The columns of documents, with another column as the text."""
    return df.select("doc_id", F.col(text).alias("text"), "lang", "source", F.length(text).cast("bigint").alias("n_chars"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: a null text, or no letter in it.  With no
    language to learn from, the others stay.  Rows repeat as they are; ties between
    languages do not matter, as only the absence of letters drops a text."""
    model = langid.learn(docs.where(~langid.held_out()))
    return langid.predict(docs, model, keep=COLUMNS, has_letter="has_letter").where("has_letter").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, that of the smallest id;
    of rows with one id and text the first by all columns.  Texts without words stay."""
    return ngram_join.representatives(docs.select(*COLUMNS), n=SHINGLE, percent=SIMILAR)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts words in repeated 35-word windows; a document of which nothing is left goes."""
    found = substring_dedup.remove(docs, keep=COLUMNS, sift=True)  # near copies are gone: few texts hold a repeat
    kept = found.where((F.col("n_removed") == 0) | (F.col("kept_text") != ""))
    return _documents(kept.withColumn("new", F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept_text"))), "new")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks what the scan reports; no document goes, rows repeat, a null text stays null."""
    return _documents(secret_scan.scan(docs, keep=COLUMNS, redact="[SECRET]"), "redacted")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left; the pieces carry their ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("secret_scans", secrets),
    ("packing", pack),
]

#: Mixture inference, compressed sizes and tokenizer ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that packing gives, from the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)  # nothing reads it again
    return docs
