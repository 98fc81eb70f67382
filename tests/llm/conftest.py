import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) pairs, with clashing extra columns."""
    from pyspark.sql import functions as F

    def make(rows, parts=3):
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
        for extra in ("ids", "n_words", "component_id", "length", "lang_pred", "_pieces", "spans"):
            df = df.withColumn(extra, F.lit("x"))
        return df

    return make


#: Empty, blank, odd, tied and repeated texts that every operator takes.
ODD = [None, "", " ", "  \n ", "a", "a b", "É", "1234 ...", "x\x1cy z", "same text here now", "same text here now", "日本語 テキスト"]


@pytest.fixture(scope="session")
def odd_rows():
    return [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, "no id"), (9, "same text here now")]
