"""What operators and the pipeline leave on disk."""

import os
import time

import corpus_pipeline
from cadastre.llm import common


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for i in range(files.size()) if (f := files.apply(i).getName()).startswith("shuffle_")}


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    out = common.staged(spark.range(0, 40_000, 1, 4).repartition(3, "id"), "moved")
    for _ in range(50):  # they are deleted in the background
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and out.count() == 40_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_the_pipeline_keeps_its_last_table_only(spark, monkeypatch):
    seen = []

    def stage(spark, docs, sf_dir):
        seen.append(docs.inputFiles())
        return docs.withColumn(f"n{len(seen)}", docs["doc_id"] + len(seen))

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("a", stage), ("b", stage), ("c", stage)])
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    there = [all(os.path.exists(f.removeprefix("file:").replace("///", "/")) for f in files) for files in seen]
    assert there == [True, False, False] and out.select("n1", "n2", "n3").count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
