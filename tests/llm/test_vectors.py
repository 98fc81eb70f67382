"""Vector operators against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastre.llm import embedding_dedup, queries, topk, vectors

SF = "/root/testdata/sf0.001"


def brute_links(rows, least=0.95):
    good = [v if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v) else None for _, v in rows]
    unit = [None if v is None else np.array(v, float) / np.linalg.norm(v) for v in good]
    n, up = len(rows), list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    count = [0] * n
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                count[i] += 1
                count[j] += 1
                up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(d, low.get(root(i), d))
    return sorted(((d, count[i], low.get(root(i)), d is not None and low[root(i)] == d) for i, (d, _) in enumerate(rows)), key=repr)


def vector_rows(seed, n=150):
    rng = np.random.default_rng(seed)
    out = []
    base = [rng.normal(size=16).astype(np.float32) for _ in range(8)]
    for i in range(n):
        if i % 3 == 0:
            v = rng.normal(size=16)
        else:
            b = base[rng.integers(0, 8)]
            v = b + rng.normal(size=16) * rng.choice([0, 0.05, 0.2, 0.3])
        out.append((1000 + i, [float(x) for x in np.float32(v)]))
    nan, inf = float("nan"), float("inf")
    return out + [(1, None), (2, []), (3, [0.0] * 16), (4, [1.0, None] + [0.0] * 14), (5, [nan] * 16), (6, [inf] * 16), (7, [1.0, 2.0]), (8, [2.0, 4.0]),
                  out[4], (None, out[5][1]), (None, None), (9, out[7][1]), (1004, out[8][1])]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    for extra in ("label", "copies", "digest", "rank", "score"):
        df = df.withColumn(extra, F.lit("x"))
    return df


@pytest.mark.parametrize(("held", "cell"), [(2048, 4096), (10, 7)])
def test_links(spark, monkeypatch, held, cell):
    monkeypatch.setattr(embedding_dedup, "HELD", held)
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", cell)
    rows = vector_rows(3)
    got = [tuple(r) for r in embedding_dedup.links(frame(spark, rows)).collect()]
    assert sorted(got, key=repr) == brute_links(rows)


def test_visits_lose_no_link():
    rng = np.random.default_rng(4)
    x = embedding_dedup.unit(rng.normal(size=(400, 8)))
    y = embedding_dedup.unit(x + rng.normal(size=x.shape) * 0.1)
    both = np.concatenate([x, y])
    centres = embedding_dedup.spherical_kmeans(both[:200], 20)
    home, may = embedding_dedup.visits(both, centres, 0.95)
    i, j = np.nonzero(np.triu(both @ both.T >= 0.95, 1))
    assert len(i)
    for a, b in zip(i, j, strict=True):
        assert home[a] == home[b] or may[a, home[b]] or may[b, home[a]]


def test_join_labels():
    linked = np.zeros((3, 5), bool)
    linked[0, [1, 3]] = linked[1, [3, 4]] = True
    assert embedding_dedup.join_labels(np.arange(5), linked).tolist() == [0, 1, 2, 1, 1]


def brute_top(rows, asks, k=20, scale=64):
    good = [(d, [math.floor(scale * x) for x in v]) for d, v in rows
            if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for d, v in {(d, tuple(v)) for d, v in good if d is not None and asks(d)}:
        found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i is None, i) for i, w in good if i != d and len(w) == len(v))[:k]
        out |= {(d, r, i, -s) for r, (s, _, i) in enumerate(found, 1)}
    return sorted(out, key=repr)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES", 7)
    monkeypatch.setattr(topk, "SLICE", 40)
    monkeypatch.setattr(vectors, "STREAMED", 16)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.float32(rng.integers(-3, 4, 6) / 4)]) for i in range(120)] + vector_rows(6, 30)
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 5 == 0, k=9).collect()
    assert sorted({tuple(r) for r in got}, key=repr) == brute_top(rows, lambda d: d % 5 == 0, 9)


def test_top_k_of_huge_components(spark):
    rows = [(i, [float(np.float32(x)) for x in (1e18 * i, -3e17, 1.5)]) for i in range(6)]
    got = topk.top_k(frame(spark, rows), F.col("vec_id") == 0, k=3).collect()
    assert sorted({tuple(r) for r in got}, key=repr) == sorted(
        {(d, r, i, max(-(2**63), min(2**63 - 1, s))) for d, r, i, s in brute_top(rows, lambda d: d == 0, 3)}, key=repr)


def test_queries(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = [tuple(r) for r in queries.QUERIES["op1_embedding_near_dedup"](spark, SF).collect()]
    assert sorted(got, key=repr) == brute_links(rows)
    got = [tuple(r) for r in queries.QUERIES["op7_exact_top_k"](spark, SF).collect()]
    assert sorted(got, key=repr) == brute_top(rows, lambda d: d % 20 == 0)


def test_empty(spark):
    empty = frame(spark, [])
    assert embedding_dedup.links(empty).collect() == []
    assert topk.top_k(empty, F.col("vec_id") % 2 == 0).collect() == []
