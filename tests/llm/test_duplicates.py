"""N-gram join, substring and suffix de-duplication against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from cadastre.llm import ngram_join, queries, sketch, substring_dedup, suffix_dedup
from cadastre.llm.components import components

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_classes(rows, n=3, percent=90):
    sets = []
    for _, text in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        near = Counter(j for g in s for j in where[g] if j < i)
        for j, both in near.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def brute_windows(rows, size=35):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (d, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def brute_strings(rows, size=400):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + size] for b in data for i in range(len(b) - size + 1))
    out = []
    for (d, _), b in zip(rows, data, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((d, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def make_rows(seed, docs=60, vocabulary=400):
    """Random texts with exact and near copies, shared passages, repeats inside a text."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéñz") for _ in range(rng.randint(1, 9))) for _ in range(vocabulary)]
    passage = [[rng.choice(vocab) for _ in range(rng.choice([30, 36, 60, 150]))] for _ in range(4)]
    out = []
    for _ in range(docs):
        kind = rng.random()
        if out and kind < 0.45:
            w = rng.choice(out).split(" ")
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                w[rng.randrange(len(w))] = rng.choice(vocab).upper()
        elif kind < 0.5:
            w = [rng.choice(vocab)] * rng.randint(1, 120)
        else:
            w = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 5, 34, 35, 80, 200]))]
        if rng.random() < 0.5:
            at = rng.randrange(len(w) + 1)
            w[at:at] = rng.choice(passage)
        out.append(rng.choice([" ", " ", " ", "\n"]).join(w) if rng.random() < 0.9 else " ".join(w) + "  \t")
    return list(enumerate(out, 1000))


@pytest.fixture(params=[1, 2, "odd"])
def rows(request, odd_rows):
    return odd_rows + make_rows(3, 25) if request.param == "odd" else make_rows(request.param)


def test_classes(docs_of, rows):
    got = ngram_join.classes(docs_of(rows)).drop("text_hash").collect()
    assert sorted(map(tuple, got), key=repr) == brute_classes(rows)


def test_representatives(docs_of, rows):
    got = ngram_join.representatives(docs_of(rows)).collect()
    words = {d: c for d, _, c in brute_classes(rows, 5, 80)}
    want = {(d, t) for d, t in rows if words[d] == d}
    assert {(r["doc_id"], r["text"]) for r in got} == want and len(got) == len(want)


def test_classes_in_blocks(docs_of):
    rows = []
    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    for i in range(90):  # one crowd: chains of small changes, larger than a block
        w = list(base)
        w[i % 60] = f"x{rng.randrange(3)}"
        if i % 7 == 0:
            w[5:15] = [f"y{i}{k}" for k in range(10)]
        rows.append((i, " ".join(w)))
        if i % 10 == 0:
            base[rng.randrange(60)] = f"z{i}"
    got = ngram_join.classes(docs_of(rows), block_rows=8).drop("text_hash").collect()
    assert sorted(map(tuple, got), key=repr) == brute_classes(rows)


def test_t_occurrence_and_parts():
    rng = random.Random(1)
    for _ in range(60):
        sets = []
        for _ in range(rng.randint(1, 6)):
            base = [rng.getrandbits(64) for _ in range(rng.choice([1, 2, 3, 9, 10, 11, 21, 60, 200]))]
            for _ in range(rng.randint(1, 12)):
                s = set(base)
                for _ in range(rng.randint(0, max(1, len(base) // 8))):
                    s.discard(rng.choice(base)) if rng.random() < 0.5 and len(s) > 1 else s.add(rng.getrandbits(64))
                sets.append(tuple(sorted(s)))
        sets = [np.array(x, np.uint64) for x in dict.fromkeys(sets)]
        parts, least = zip(*((set(p.tolist()), m) for p, m in (ngram_join.part_signatures(s, 90) for s in sets)), strict=True)
        groups = ngram_join.t_occurrence(sets, 90)
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                both = len(np.intersect1d(a, b))
                if 100 * both >= 90 * (len(a) + len(b) - both):
                    assert len(parts[i] & parts[j]) >= max(least[i], least[j]) and groups.of[i] == groups.of[j]


def test_components(spark):
    rng = random.Random(9)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(None, 5), (7, None), (8, 8)]
    up = {}
    for a, b in links:
        if a is not None and b is not None and a != b:
            for x in (a, b):
                up.setdefault(x, {x})
            if up[a] is not up[b]:
                both = up[a] | up[b]
                for x in both:
                    up[x] = both
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a int, b int")).collect()}
    assert got == {x: min(s) for x, s in up.items()}
    assert components(spark.createDataFrame([], "a int, b int")).collect() == []


def test_windows(docs_of, rows):
    got = substring_dedup.remove(docs_of(rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_windows(rows)


def test_windows_settled_apart(docs_of, monkeypatch):
    monkeypatch.setattr(substring_dedup, "FLUSH", 50)
    rows = make_rows(6, 40)
    got = substring_dedup.remove(docs_of(rows, 5), size=8, gram=3).collect()
    assert sorted(map(tuple, got), key=repr) == brute_windows(rows, 8)


def test_sketch_never_misses(spark, docs_of):
    rows = make_rows(8, 30)
    hashes = np.random.default_rng(1).integers(0, 2**63, 5000, np.uint64)
    many = np.concatenate([hashes, hashes[:700], hashes[:50]])

    def give(batch):
        yield many[: len(many) // 2]
        yield many[len(many) // 2 :]

    two, three = sketch.merged(docs_of(rows, 1).select("text"), give, 16, (2, 3))
    assert sketch.reaches(two, hashes[:700], 16).all() and sketch.reaches(three, hashes[:50], 16).all()
    assert sketch.reaches(two, hashes[700:], 16).mean() < 0.1


def test_equal_strings():
    rng = np.random.default_rng(2)
    for trial in range(30):
        base = rng.integers(97, 97 + rng.integers(1, 4), 300).astype(np.uint8)
        text = np.concatenate([base[rng.integers(0, 150) :] for _ in range(8)])
        for i in rng.integers(0, len(text), trial):
            text[i] ^= 1
        length = int(rng.choice([40, 61, 100]))
        at = np.arange(len(text) - length + 1)
        bucket = rng.integers(0, 2, len(at))
        group = suffix_dedup.equal_strings(text, at, bucket, length)
        want, got = {}, {}
        for i, b in zip(at.tolist(), bucket.tolist(), strict=True):
            want.setdefault((b, text[i : i + length].tobytes()), set()).add(i)
            got.setdefault(int(group[i]), set()).add(i)
        assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


@pytest.mark.parametrize("hot", [1000, 3, 2])
def test_strings(docs_of, rows, hot):
    got = suffix_dedup.remove(docs_of(rows), hot=hot).collect()
    assert sorted(((*r[:4], bytes(r[4])) for r in got), key=repr) == brute_strings(rows)


def test_strings_settled_apart(docs_of, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "FLUSH_BYTES", 3000)
    rows = make_rows(7, 50)
    for hot in (3, 1000):
        got = suffix_dedup.remove(docs_of(rows, 6), length=150, hot=hot).collect()
        assert sorted(((*r[:4], bytes(r[4])) for r in got), key=repr) == brute_strings(rows, 150)


def test_queries(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op8_ngram_jaccard_join"](spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == brute_classes(rows)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = queries.QUERIES["op5_substring_dedup"](spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((*r[:3], sha(r[3].encode())) for r in brute_windows(rows)), key=repr)
    got = queries.QUERIES["op9_suffix_dedup"](spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((*r[:4], sha(r[4])) for r in brute_strings(rows)), key=repr)


@pytest.mark.parametrize("fn", [ngram_join.classes, substring_dedup.remove, suffix_dedup.remove])
def test_empty_table(docs_of, fn):
    assert fn(docs_of([])).collect() == []
