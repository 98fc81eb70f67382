"""Licence scan: notices wrapped over lines, as in source files and READMEs."""

import textwrap

import pytest

from cadastre.llm import license_scan

NOTICES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
           "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
           "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
           "subject to the following conditions:",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
           "that the above copyright notice and this permission notice appear in all copies.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
           "conditions are met:",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
           "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
}


@pytest.fixture(scope="module")
def model(spark):
    return license_scan.learn(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_wrapped_headers(spark, docs_of, model):
    rows, want = [], {}
    for family, notice in NOTICES.items():
        if family not in license_scan.TEMPLATES:
            continue
        for width in (45, 60, 79):
            for mark, first, last in (("", "", ""), ("# ", "", ""), (" * ", "/*\n", "\n */"), ("// ", "", "")):
                body = "\n".join(mark + x for x in textwrap.wrap(notice, width - len(mark)))
                for lead in ("", f"{mark}Copyright (c) 2020 The Authors\n{mark}\n", f"{mark}Copyright (c) 2020 The Authors\n"):
                    want[len(rows)] = family
                    rows.append((len(rows), f"{first}{lead}{body}{last}\n\nint main() {{ return 0; }}\n"))
    got = {r["doc_id"]: {x["family"] for x in r["licenses"]} for r in license_scan.scan(docs_of(rows), model).collect()}
    assert len(rows) >= 36
    assert not [(rows[i][1], got[i]) for i, f in want.items() if got[i] != {f}]


def test_a_notice_on_its_own_line_is_found_once(docs_of, model):
    text = "some words of a text\nReleased under the MIT License.\nand other words of it"
    (row,) = license_scan.scan(docs_of([(1, text)]), model).collect()
    assert [(x["family"], text[x["start"] : x["end"]]) for x in row["licenses"]] == [("mit", "Released under the MIT License")]
    assert row["n_paragraphs"] == 1


def test_paragraphs(docs_of, model):
    rows = [(1, "a b\nc d\n\ne f\n *\ng h"), (2, "a\n\n\n"), (3, "\n"), (4, "a"), (5, "a")]
    got = {r["doc_id"]: r["n_paragraphs"] for r in license_scan.scan(docs_of(rows, 1), model).collect()}
    assert got == {1: 3, 2: 1, 3: 0, 4: 1, 5: 1}
