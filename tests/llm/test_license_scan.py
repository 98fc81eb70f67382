"""Licence scan: planted notices, passages not learned from, clean prose."""

import pytest

from cadastre.llm import license_scan, queries

SF = "/root/testdata/sf0.01"
#: Notices that the test documents hold, by family.
NOTICES = {
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "This work is licensed under the GNU General Public License, version 3.": "gpl",
    "Licensed under the Apache License, Version 2.0.": "apache",
    "Released under the MIT License.": "mit",
}


@pytest.fixture(scope="module")
def model(spark):
    return license_scan.learn(spark.read.parquet(f"{SF}/documents.parquet"))


def test_query_finds_the_notices_and_nothing_else(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.QUERIES["op6_license_scan"](spark, SF).collect()
    assert len(got) == len(texts)
    wrong = 0
    for r in got:
        want = {f for n, f in NOTICES.items() if n in (texts[r["doc_id"]] or "")}
        wrong += set(filter(None, r["families"].split(","))) != want
    assert wrong <= 2, wrong


def test_odd_rows_and_other_passages(spark, docs_of, odd_rows, model):
    prose = "the quick brown fox jumps over the lazy dog and " * 30
    rows = [*odd_rows,
            (70, prose + "this program is free software you can redistribute it and or modify it under the terms of the GNU General Public License " + prose),
            (71, "x\nSPDX-License-Identifier: MPL-2.0\ny"), (72, "Permission to use the license software copy granted any free notice public"),
            (73, "Redistribution and use in source and binary forms, with or without modification, are permitted\n\nPublic domain is a term."),
            (74, prose * 5)]
    got = {}
    for r in license_scan.scan(docs_of(rows), model).collect():
        got.setdefault(r["doc_id"], []).append(r)
    family = lambda i: {x["family"] for x in got[i][0]["licenses"]}
    assert family(70) == {"gpl"} and family(71) == {"mpl"} and family(73) == {"bsd"}
    assert not family(72) and not family(74)
    assert got[0][0]["n_paragraphs"] == 0 and got[1][0]["n_paragraphs"] == 0 and got[73][0]["n_paragraphs"] == 2
    assert not any(r["licenses"] for i in range(12) for r in got[i])
    span = got[71][0]["licenses"][0]
    assert rows[-4][1].encode()[span["start"] : span["end"]].decode() == "SPDX-License-Identifier: MPL-2.0"


def test_empty(docs_of):
    empty = docs_of([])
    assert license_scan.scan(empty, license_scan.learn(empty)).collect() == []
