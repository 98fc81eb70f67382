"""Blocks of vectors: what is sent to compare them, and what is found."""

import numpy as np
from pyspark.sql import functions as F

from cadastre.llm import embedding_dedup


def shuffled(spark, since=-1):
    """The newest stage, and bytes written to shuffles by those after ``since`` (the driver remembers 1000)."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    none = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, none, None)
    of = {s.stageId(): s.shuffleWriteBytes() for s in map(stages.apply, range(stages.size()))}
    return max(of, default=-1), sum(n for k, n in of.items() if k > since)


def test_vectors_are_not_dealt_to_every_block(spark, monkeypatch):
    """Vectors without structure: each block is compared with every other."""
    x = np.random.default_rng(8).normal(size=(1200, 64)).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>").repartition(4)
    sent = {}
    for held in (1200, 20):
        monkeypatch.setattr(embedding_dedup, "HELD", held)
        monkeypatch.setattr(embedding_dedup, "CELL_ROWS", 300)
        before, _ = shuffled(spark)
        assert embedding_dedup.links(rows).agg(F.sum("n_links"), F.count("*")).first()[:] == (0, 1200)
        sent[held] = shuffled(spark, before)[1]
    assert 0 < sent[20] < 2 * sent[1200]


def test_links_between_blocks_of_double_vectors(spark, monkeypatch):
    """Blocks of few bytes; vectors of double precision are compared as they are."""
    monkeypatch.setattr(embedding_dedup, "BLOCK_BYTES", 300)
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", 9)
    rng = np.random.default_rng(9)
    base = rng.normal(size=(6, 8))
    x = np.concatenate([base[rng.integers(0, 6, 80)] + rng.normal(size=(80, 8)) * 0.1, rng.normal(size=(40, 8))])
    x[1] = x[0] * 3
    got = embedding_dedup.links(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>").repartition(3)).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    low = np.arange(len(x))
    while ((new := np.where(near, low[None, :], len(x)).min(axis=1)) != low).any():
        low = new
    assert sorted(tuple(r)[:3] for r in got) == [(i, int(near[i].sum()) - 1, int(low[i])) for i in range(len(x))]
