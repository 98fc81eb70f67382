"""BPE, secret scan, language mixture and packing against brute force."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from cadastre.llm import bpe, langid, packing, queries, secret_scan

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tik():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _texts(n=300):
    rng = random.Random(5)
    alphabet = list("aaabcdeé ß  \n\t.,;!'0123") + [" ", "\x1c", "日", "本", "😀", "'ll", " the", "<|endoftext|>", "\r\n", "   ", "AA", "ñ"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(n)] + [
        " " * k for k in range(12)] + ["a" * k for k in range(40)] + ["don't we'll I'VE  x", "x" * 50_000, "word " * 20_000]


def test_pieces_give_the_library_ids(tik):
    own = bpe.PieceCoder(bpe.tokenizer_of_ranks(P.path("byte_bpe_50k.tiktoken"), P.PATTERN), most=200)
    texts = _texts()
    for _ in range(2):  # a cold and a warm cache, small enough to start afresh
        for t, ids in zip(texts, own.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == tik.encode_ordinary(t), repr(t[:80])


def test_every_character_as_the_library(tik):
    own = bpe.PieceCoder(bpe.tokenizer_of_ranks(P.path("byte_bpe_50k.tiktoken"), P.PATTERN))
    chars = [chr(c) for c in range(0x3400) if not 0xD800 <= c < 0xE000]
    texts = [f"ab{c}cd {c}1{c} .{c}," for c in chars]
    bad = [c for c, t, ids in zip(chars, texts, own.encode(texts), strict=True)
           if np.frombuffer(ids, "<u4").tolist() != tik.encode_ordinary(t)]
    assert not bad, [hex(ord(c)) for c in bad]


def test_encode_decode(spark, docs_of, odd_rows, tik):
    path = P.path("byte_bpe_50k.tiktoken")
    df = bpe.encode(docs_of(odd_rows), path, P.PATTERN, keep=("doc_id", "text"), spans=True)
    rows = bpe.decode(df, path, keep=("doc_id", "text", "ids", "char_start", "char_end"), text=True).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        text = r["text"] or ""
        assert list(r["ids"]) == tik.encode_ordinary(text)
        assert bytes(r["decoded"]) == text.encode() and r["decoded_text"] == text
        data = tik.decode_with_offsets(list(r["ids"]))[1] if text else []
        assert list(r["char_start"]) == data
        for i, a, b in zip(r["ids"], r["char_start"], r["char_end"], strict=True):
            piece = tik.decode_single_token_bytes(i)
            assert piece in text[a:b].encode()


def test_decode_of_part_of_a_character(spark, tik):
    ids = tik.encode_ordinary("日本")
    df = spark.createDataFrame([(1, ids[:1]), (2, None), (3, [])], "doc_id bigint, ids array<int>")
    got = {r["doc_id"]: r["decoded_text"] for r in bpe.decode(df, P.path("byte_bpe_50k.tiktoken"), text=True).collect()}
    assert "�" in got[1] and got[2] == "" and got[3] == ""


def test_op2_query(spark, tik):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.QUERIES["op2_byte_bpe"](spark, SF).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        ids = tik.encode_ordinary(text or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_packing(spark, docs_of, odd_rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    long = [(100, "word and more. " * 3000), (101, "tok " * 2047)]
    rows = packing.pack(docs_of(odd_rows + long), P.path("byte_bpe_50k.json")).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    texts = dict(odd_rows + long)
    by = {}
    for r in rows:
        assert r["offset"] == 0 and r["length"] & (r["length"] - 1) == 0 and r["length"] <= 2048
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        by.setdefault(r["doc_id"], []).append(r)
    copies = {i: sum(1 for j, _ in odd_rows + long if j == i) for i in by}
    for i, parts in by.items():
        ids = [*tok.encode(texts[i] or "", add_special_tokens=False).ids, 1]
        assert {p["doc_tokens"] for p in parts} == {len(ids)}
        assert sum(p["length"] for p in parts) == len(ids) * copies[i]
        for p in parts:
            want = np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes()
            assert bytes(p["ids"]) == want


def _brute_spans(text):
    out = []
    pats = [("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", lambda m: len(m[2]) >= 6),
            ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24)]
    for k, (kind, pat, ok) in enumerate(pats):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pat, text, re.ASCII) if ok(m)]
    return [x[2] for x in sorted(out)]


def test_secret_base_spans():
    rng = random.Random(2)
    words = ["password", "Token", "API_KEY", "apikey", "secret", "=", ":", " ", '"', "AKIA", "ABCDEFGH12345678", "deadbeef0123456789ab", "c0ffee", "x", "é", "\n", "K", "ſecret"]
    for _ in range(3000):
        text = "".join(rng.choice(words) for _ in range(rng.randint(0, 14)))
        got = [f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in secret_scan.scan_text(text, b"x " * 50) if k < 3]
        assert got == _brute_spans(text), text


def test_secret_novelty(spark, docs_of, odd_rows):
    key = "q7Zk3P0xVb9LmT4sWd8Yc2Rf6Hj1"
    rows = [*odd_rows, (50, f"the private key {key} is here"), (51, "token importlib_asyncio_threading1 is plain"),
            (52, f"{key} {key} {key} secret {key} again"), (53, "password=hunter22 end")]
    got = {r["doc_id"]: r for r in secret_scan.scan(docs_of(rows), redact="[SECRET]").collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in got[50]["spans"]] == [("novel", 16, 16 + len(key))]
    assert got[50]["redacted"] == "the private key [SECRET] is here"
    assert got[51]["spans"] == []  # made of common identifiers
    assert got[52]["spans"] == []  # repeats its surroundings
    assert got[53]["redacted"] == "[SECRET] end" and got[0]["redacted"] is None and got[1]["redacted"] == ""


def test_op3_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.QUERIES["op3_secret_scan"](spark, SF).collect()}
    for i, text in rows:
        want = _brute_spans(text or "")
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [s for s in got[i]["spans"].split(",") if s and not s.startswith("novel")] == want


def test_op4_query_accuracy(spark):
    rows = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.QUERIES["op4_language_mixture"](spark, SF).collect()
    assert len(got) == len(rows)
    out = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in out} == {i for i in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    right = [r["lang_pred"] == rows[r["doc_id"]]["lang"] for r in out if r["lang_pred"] != "und"]
    assert sum(right) >= 0.97 * len(right)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_odd_rows_and_mixtures(spark, docs_of, odd_rows):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.learn(docs)
    some = {r["lang"]: r["text"] for r in docs.where("length(text) between 1500 and 4000").collect()}
    rows = [*odd_rows, (60, some["de"][:1400] + " " + some["es"][:1400])]
    got = {}
    for r in langid.predict(docs_of(rows), model).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i in (0, 1, 2, 3, 7):
        assert {r["lang_pred"] for r in got[i]} == {"und"} and got[i][0]["score"] == 0
    for i in (4, 6, 11):
        assert got[i][0]["lang_pred"] in some
    assert {x["lang"] for x in got[60][0]["languages"]} == {"de", "es"}
    assert 0.3 < got[60][0]["score"] < 0.7
    empty = langid.predict(docs_of(odd_rows), langid.learn(docs.limit(0))).collect()
    assert {r["lang_pred"] for r in empty} == {"und"}


@pytest.mark.parametrize("fn", [
    lambda d: bpe.decode(bpe.encode(d, P.path("byte_bpe_50k.tiktoken"), P.PATTERN), P.path("byte_bpe_50k.tiktoken")),
    lambda d: packing.pack(d, P.path("byte_bpe_50k.json")), secret_scan.scan])
def test_empty_table(docs_of, fn):
    assert fn(docs_of([])).collect() == []
