"""The pipeline's stages against brute-force versions, on the small table."""

import random

import corpus_pipeline
from cadastre.llm import packing, secret_scan
from test_duplicates import brute_classes, brute_windows

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(900_001, None), (900_002, ""), (900_003, "12 34 ..."), (900_004, "a"), (None, "no id but words"), (900_005, "x y z"), (900_005, "x y z"),
           (900_006, "token = \"0641917ea4e9feb9cda83477b57ac2654884f485\" here")]
    docs = docs.union(spark.createDataFrame([(*r, None, None, None) for r in odd], SCHEMA))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "ngram_jaccard_join", "substring_dedup", "secret_scans", "packing"]
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        before = _rows(at)
        out = stage(spark, at, SF)
        if name != "packing":
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        out.write.parquet(path := str(tmp_path / name))
        out = spark.read.parquet(path)
        if name == "language_id":
            assert sorted(_rows(out), key=repr) == sorted((r for r in before if any(c.isalpha() for c in r[1] or "")), key=repr)
        elif name == "ngram_jaccard_join":
            first = {d: c for d, _, c in brute_classes(before, 5, 80)}
            assert sorted(_rows(out), key=repr) == sorted({r for r in before if first[r[0]] == r[0]}, key=repr)
        elif name == "substring_dedup":
            want = [(d, t) for d, _, gone, t in brute_windows(before) if t or not gone]
            assert sorted(((d, " ".join((t or "").split())) for d, t in _rows(out)), key=repr) == sorted(((d, " ".join(t.split())) for d, t in want), key=repr)
        elif name == "secret_scans":
            words = secret_scan.identifier_dictionary()
            after = dict(_rows(out))
            assert len(after) == len(before)
            for d, t in before:
                assert ("[SECRET]" in after[d]) == bool(secret_scan.scan_text(t, words))
                assert not [s for s in secret_scan.scan_text(after[d], words) if s[1] < 3]
        else:
            got = {}
            for r in out.collect():
                got.setdefault(r["doc_id"], []).append(r["length"])
            assert got.keys() == {d for d, _ in before}
            assert all(sorted(v, reverse=True) == packing.piece_lengths(sum(v), 2048) for v in got.values())
        at = out


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_order_of_rows_is_no_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    some = docs.collect()
    random.Random(1).shuffle(some)
    again = spark.createDataFrame(some, docs.schema).repartition(5)
    for _, stage in corpus_pipeline.STAGES[:3]:
        assert sorted(_rows(stage(spark, docs, SF)), key=repr) == sorted(_rows(stage(spark, again, SF)), key=repr)
