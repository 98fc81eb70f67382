"""Hard-negative mining against brute force."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastre.llm import hard_negatives, queries, vectors

SF = "/root/testdata/sf0.001"
LONG = 2**63


def brute(rows, asks, scale=256, k=5, percent=80):
    good = []
    for d, label, v in rows:
        if label is None or v is None or not len(v) or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((d, str(label), tuple(math.floor(scale * x) for x in v)))
    out = collections.Counter()
    for d, label, v in set(good):
        if d is None or not asks(d):
            continue
        scored = [(max(-LONG, min(LONG - 1, sum(a * b for a, b in zip(v, w, strict=True)))), i, m)
                  for i, m, w in good if i != d and len(w) == len(v)]
        first = lambda x: (-x[0], x[1] is None, x[1])
        for p, pid, _ in sorted([x for x in scored if x[2] == label], key=first)[:k]:
            found = sorted([x for x in scored if x[2] != label and percent * p <= 100 * x[0] <= 100 * p], key=first)[:k]
            out.update((d, pid, r, nid, p, n) for r, (n, nid, _) in enumerate(found, 1))
    return out


def rows_of(seed, n=260, d=24):
    """Crowded vectors with ties, equal rows, and odd ones."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(6, d)) + 0.5
    out = []
    for i in range(n):
        v = base[rng.integers(6)] + rng.normal(size=d) * rng.choice([0, 0.05, 0.4])
        out.append((1000 + i, int(rng.integers(4)), [float(x) for x in np.float32(v)]))
    nan, inf = float("nan"), float("inf")
    out += [(1, 0, None), (2, 1, []), (3, 2, [0.0] * d), (4, 0, [1.0, None] + [0.0] * (d - 2)), (5, 1, [nan] * d), (10, 1, [inf] * d),
            (20, 0, [1.0, 2.0]), (21, 0, [1.0, 2.0]), (22, 1, [1.0, 1.5]), (30, None, out[3][2]), (None, 1, out[3][2]), (None, 1, out[3][2]),
            (None, None, None), out[10], out[10], out[11], (1020, 3, out[5][2]), (40, 2, [-x for x in out[4][2]])]
    return out


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").repartition(3)
    for extra in ("a", "scores", "block", "copies", "rank", "id"):
        df = df.withColumn(extra, F.lit("x"))
    return df


def mined(df, every=10, **more):
    return collections.Counter(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % every == 0, F.col("label"), **more).collect())


@pytest.mark.parametrize(("slice_bytes", "read", "streamed"), [(16 << 20, (64, 4096), 2048), (6000, (4, 8), 7)])
def test_mine(spark, monkeypatch, slice_bytes, read, streamed):
    monkeypatch.setattr(hard_negatives, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(hard_negatives, "READ", read)
    monkeypatch.setattr(vectors, "STREAMED", streamed)
    rows = rows_of(1)
    assert mined(frame(spark, rows)) == brute(rows, lambda d: d % 10 == 0)


@pytest.mark.parametrize("d", [1, 3, 9, 70])
def test_vectors_of_any_length(spark, d):
    rng = np.random.default_rng(d)
    rows = [(i, int(rng.integers(3)), [float(x) for x in np.float32(rng.normal(size=d))]) for i in range(90)]
    assert mined(frame(spark, rows), scale=64.0) == brute(rows, lambda x: x % 10 == 0, scale=64)


def test_huge_components(spark):
    rows = [(i, i % 3, [float(np.float32(x)) for x in (1e17 * (i % 7), -3e16, 1.5 * i)]) for i in range(40)]
    assert mined(frame(spark, rows)) == brute(rows, lambda d: d % 10 == 0)


def test_a_row_that_is_a_third_of_the_table(spark):
    rows = rows_of(2, 120) + [(1003, 2, rows_of(2, 120)[3][2])] * 60
    assert mined(frame(spark, rows)) == brute(rows, lambda d: d % 10 == 0)


def sliced(x, size=16):
    mean, dev = hard_negatives.summarised(x, hard_negatives.lengths(x.shape[1], size))
    return mean, dev


def asked(x, i, label="1"):
    mean, dev = sliced(x[i : i + 1])
    steps = hard_negatives.levels(mean, dev, hard_negatives.lengths(x.shape[1], mean.shape[1]))
    return hard_negatives.Asked(i, label, x[i], [(m[0], s[0]) for m, s in steps])


def test_bounds_hold_and_narrow():
    rng = np.random.default_rng(3)
    x = np.floor(256 * (rng.normal(size=(300, 64)) + np.repeat(rng.normal(size=16), 4)))
    own = hard_negatives.Slice(np.arange(300), ["0"] * 300, x, *sliced(x))
    exact, wide = x @ x[7], []
    for level in range(3):
        low, high = own.bounds(asked(x, 7), level, np.arange(300))
        assert (low <= exact).all() and (exact <= high).all()
        wide.append((high - low).mean())
    assert wide[0] > wide[1] > wide[2]


def test_few_exact_vectors_are_read():
    """Where segments tell vectors apart, few are scored exactly."""
    rng = np.random.default_rng(4)
    x = np.floor(256 * np.repeat(rng.normal(size=(5000, 16)), 4, axis=1) + rng.normal(size=(5000, 64)))
    labels = [str(i % 2) for i in range(5000)]
    own = hard_negatives.Slice(np.arange(5000), labels, x, *sliced(x))
    for i in range(0, 5000, 500):
        ask = asked(x, i, labels[i])
        rows = own.rows(ask, True)
        (score, at), = own.best(ask, rows, [(-LONG, LONG - 1)], 5)
        want = sorted(((-int(x[own.order[r]] @ x[i]), int(own.ids[r])) for r in rows))[:5]
        assert [(-int(s), int(own.ids[r])) for s, r in zip(score, at, strict=True)] == want
    assert own.read < 0.05 * 10 * 2500


def test_query(spark):
    rows = [(d, (lab + 1) % 10 if lab is not None and d % 7 == 0 else lab, v)
            for d, lab, v in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    got = collections.Counter(tuple(r) for r in queries.QUERIES["op11_hard_negatives"](spark, SF).collect())
    assert got == brute(rows, lambda d: d % 100 == 0)


def test_empty(spark):
    assert not mined(frame(spark, []))
