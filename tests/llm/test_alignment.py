"""Cross-tokenizer alignment against whole texts encoded by the libraries."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cadastre.llm import alignment, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    return tok, sentencepiece.SentencePieceProcessor(model_file=B)


def cuts(text, tok, sp):
    """[(id, start, end)] of A and of B over the bytes of space+text; none if either differs."""
    if not text:
        return [], []
    whole = (" " + text).encode()
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(own)))}
    a = [(i, bytes(byte[c] for c in tok.id_to_token(i))) for i in tok.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(sp.id_to_piece(i)[1:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode())
         for i in sp.encode(text)]
    if any(b"".join(t for _, t in x) != whole for x in (a, b)):
        return [], []

    def spans(x):
        out, at = [], 0
        for i, t in x:
            out.append((i, at, at + len(t)))
            at += len(t)
        return out

    return spans(a), spans(b)


def brute(rows, kind="end"):
    tok, sp = libraries()
    docs, pairs = [], collections.Counter()
    for d, text in rows:
        a, b = cuts(text, tok, sp)
        common = sorted({e for *_, e in a} & {e for *_, e in b})
        group = lambda e: sum(c < e for c in common)
        a_in, b_in = [[] for _ in common], [[] for _ in common]
        for into, tokens in ((a_in, a), (b_in, b)):
            g = 0
            for i, _, e in tokens:
                into[g].append(i)
                g += e == common[g]
        if kind == "end":
            ends = {e: i for i, _, e in b}
            links = [(i, ends[e]) for i, _, e in a if e in ends]
        elif kind == "overlap":
            links = [(i, j) for i, s, e in a for j, t, f in b if max(s, t) < min(e, f)]
        else:
            links = [(i, j) for x, y in zip(a_in, b_in, strict=True) for i in x for j in y]
        pairs.update(links)
        text_ = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in zip(a_in, b_in, strict=True))
        docs.append((d, len(a), len(b), len(common), links, hashlib.sha256(text_.encode()).hexdigest() if a else ""))
    most = collections.Counter()
    for (_, j), n in pairs.items():
        most[j] = max(most[j], n)
    return [(d, a, b, g, len(ls), sum(pairs[x] == most[x[1]] for x in ls), sum(pairs[x] for x in ls), sha)
            for d, a, b, g, ls, sha in docs], {(i, j, n, n == most[j]) for (i, j), n in pairs.items()}


ODD = ["a▁b", "▁", " lead", "trail ", "two  blanks in a row", "tab\tand\nline", "<|endoftext|> <s> </s> <0x0A> <unk>", "x\0y z", "日本語 と 混ぜる text",
       " nbsp  em", "a ́b", "é é ﬁ", "🙂 👩‍👩‍👧 smile", "don't they're 12345 ...", "w" * 3000, " ", "\n\n", "x\x1c y\x85 z", "a b " * 40]


def columns(df):
    return df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("kind", alignment.KINDS)
def test_align(spark, docs_of, odd_rows, kind):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(ODD)]
    want, pairs = brute(rows, kind)
    docs = docs_of(rows).withColumn("count", F.lit("x")).withColumn("bunch", F.lit(None).cast("string"))
    got = [tuple(r) for r in columns(alignment.align(docs, A, B, kind=kind)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {tuple(r) for r in alignment.id_pairs(docs, A, B, kind=kind).collect()} == pairs


def test_small_bunches(spark, monkeypatch):
    """Texts of many bunches, and a task's memory that starts afresh, change nothing."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    monkeypatch.setattr(alignment, "BUNCH", 500)
    monkeypatch.setattr(alignment, "REMEMBERED", 300)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert sorted(tuple(r) for r in columns(alignment.align(df, A, B)).collect()) == sorted(brute(rows)[0])


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in columns(queries.QUERIES["op12_cross_tokenizer"](spark, SF)).collect()]
    assert sorted(got) == sorted(brute(rows)[0])


@pytest.mark.parametrize("kind", alignment.KINDS)
def test_links(spark, kind):
    text = "Überraschung: tokenization of naïve 日本 words\tdon't agree"
    got = alignment.links(spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id bigint, text string"), A, B, kind=kind).collect()
    a, b = cuts(text, *libraries())
    found = {r["doc_id"]: r["links"] for r in got}
    assert found[2] == found[3] == []
    for x in found[1]:
        (i, s, e), (j, t, f) = a[x["a_index"]], b[x["b_index"]]
        assert (i, j, max(0, min(e, f) - max(s, t))) == (x["a_id"], x["b_id"], x["shared"])
    if kind == "overlap":
        assert len(found[1]) == sum(max(s, t) < min(e, f) for _, s, e in a for _, t, f in b)


class Counted:
    """A library's tokenizer that counts the texts it is given."""

    def __init__(self, own):
        self.own, self.texts = own, 0

    def encode_batch_fast(self, texts, **named):
        self.texts += len(texts)
        return self.own.encode_batch_fast(texts, **named)

    def encode(self, texts, **named):
        self.texts += len(texts)
        return self.own.encode(texts, **named)


def test_pieces_go_to_the_libraries_many_at_once():
    """New pieces are no text each (F2: that took most of the time), and get what they get alone."""
    words = [f"{w}{i}{mark}" for i in range(60) for w, mark in zip(
        ["don", "'s", "über", "日本", "\u200b", "\u0301", "<|endoftext|>", "x\0y", "a.\nB", "🙂", "᠎", "<s>", "ﬁ", "\ufeff", "\xad", "0x20"],
        ["'t", ",", "", "語", "", "", "", ".", "\n\nA", "👩‍👧", "", "</s>", "...", "-", "é", "%"], strict=True)]
    own = alignment.Aligner(A, B, "end")
    alone = [own.encode([w]) for w in words]
    own.a, own.b = Counted(own.a), Counted(own.b)
    a, a_at, b, b_at, good = own.encode(words, joined=True)
    assert own.a.texts < len(words) / 100 and own.b.texts < len(words) / 100
    for i, (x, _, y, _, fine) in enumerate(alone):
        assert a[a_at[i] : a_at[i + 1]].tolist() == x.tolist() and b[b_at[i] : b_at[i + 1]].tolist() == y.tolist() and good[i] == fine[0]
    texts = [" ".join(words), "a▁b ▁ x", None, "", "two  blanks " + words[0], words[1]]
    found = own.numbers(pa.array(texts))
    assert own.a.texts < len(words) / 50 and [len(n) for n in found] == [len(words), 3, 0, 0, 2, 1]
    spelt = [b";".join(own.groups[n][1:] for n in ns.tolist()).decode() for ns in found]
    for text, got, ns in zip(texts, spelt, found, strict=True):
        want = brute([(0, text or "")])[0][0][-1]
        assert (hashlib.sha256(got.encode()).hexdigest() if len(ns) and own.good[ns].all() else "") == want


def test_product_is_a_matrix_product():
    rng = np.random.default_rng(1)
    x, y = rng.random((7, 11)) < 0.3, rng.random((11, 5)) < 0.3

    def rows(m):
        return alignment.Incidence(np.concatenate([[0], np.cumsum(m.sum(axis=1))]), np.nonzero(m)[1], m.shape[1])

    i, j, v = alignment.product(rows(x), rows(y))
    want = x.astype(int) @ y.astype(int)
    made = np.zeros_like(want)
    made[i, j] = v
    assert (made == want).all() and (v > 0).all()
    i, j, v = alignment.product(rows(x), alignment.transposed(rows(x)))
    made = np.zeros((7, 7), int)
    made[i, j] = v
    assert (made == x.astype(int) @ x.T.astype(int)).all()


def test_very_long_text(spark):
    rows = [(1, "word " * 200_000 + "x" * 50_000), (2, "word one")]
    got = sorted(tuple(r) for r in columns(alignment.align(spark.createDataFrame(rows, "doc_id bigint, text string"), A, B)).collect())
    assert got == sorted(brute(rows)[0])


def test_empty(spark, docs_of):
    assert alignment.align(docs_of([]), A, B).collect() == []
    assert alignment.id_pairs(docs_of([]), A, B).collect() == []
