"""The registered queries of the operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, embedding_dedup, hard_negatives, langid, license_scan, ngram_join, oracles, packing, pii, secret_scan, substring_dedup, suffix_dedup, topk
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle.strip()
        return fn

    return deco


@register("op1_embedding_near_dedup", oracles.OP1)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.links(table(spark, sf_dir, "embeddings"))


@register("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, decoded=True)
    return both.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def _span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@register("op3_secret_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    base = _span_list(F.filter("spans", lambda s: s["kind"] != "novel"))
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(base, 256).alias("base_sha256"),
        _span_list(F.col("spans")).alias("spans"), count("novel"))


@register("op4_language_mixture")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out())
    model = langid.learn(docs.where(~F.col("held_out")))
    return langid.predict(docs, model, keep=("doc_id", "held_out"))


@register("op5_substring_dedup", oracles.OP5)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op7_exact_top_k", oracles.OP7)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@register("op8_ngram_jaccard_join", oracles.OP8)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@register("op9_suffix_dedup", oracles.OP9)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op10_power_of_two_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path, with_ids=False)


@register("op6_license_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = license_scan.scan(docs, license_scan.learn(docs))
    return found.select("doc_id", "n_paragraphs", "n_predicted",
                        F.array_join(F.array_sort(F.array_distinct("licenses.family")), ",").alias("families"), "licenses")


@register("op11_hard_negatives", oracles.OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


@register("op12_cross_tokenizer")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


@register("op13_personal_data")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    of = lambda k: F.array_sort(F.filter(F.concat("spans", "hidden"), lambda s: s["kind"] == k))
    both = F.concat(*map(of, pii.KINDS))
    return found.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(_span_list(F.col("spans")), 256).alias("base_sha256"),
                        _span_list(both).alias("spans"), F.size("hidden").cast("bigint").alias("n_hidden"))
