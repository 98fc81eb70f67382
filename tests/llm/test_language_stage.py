"""The language stage where no language can be learned."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from cadastre.llm import langid

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.mark.parametrize("lang", [None, "und"])
def test_documents_stay_without_a_label(spark, odd_rows, lang):
    rows = [*odd_rows, (80, "a clean document of some words"), (81, "12 34 ..."), (82, "\u00d7\u00f7 \u20ac"), (83, "")]
    docs = spark.createDataFrame([(i, t, lang, None, None) for i, t in rows], SCHEMA).repartition(3)
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.language_id(spark, docs, "").collect()]
    assert sorted(kept, key=repr) == sorted(((i, t) for i, t in rows if any(c.isalpha() for c in t or "")), key=repr)


def test_documents_stay_without_an_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("doc_id", F.lit(None).cast("bigint"))
    want = docs.where("text rlike '[a-zA-Z]'").count()
    assert corpus_pipeline.language_id(spark, docs, "").count() == want > 0


def test_has_letter_is_only_a_column_more(spark, docs_of, odd_rows):
    model = langid.learn(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    plain = langid.predict(docs_of(odd_rows), model)
    more = langid.predict(docs_of(odd_rows), model, has_letter="letter")
    assert plain.columns == more.columns[:-1]
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, more.drop("letter").collect()))
    assert all((r["lang_pred"] != langid.UND) == r["letter"] for r in more.collect())
