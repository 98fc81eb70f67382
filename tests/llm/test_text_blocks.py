"""Blocks of a large component: what is sent to search them, and what is found."""

import random

from cadastre.llm import ngram_join
from test_duplicates import brute_classes
from test_vector_blocks import shuffled


def crowd(n, words=120):
    """Texts that share most of their words, so that they may link, but few do."""
    rng = random.Random(n)
    base = [f"w{i}" for i in range(words)]
    out = []
    for i in range(n):
        w = list(base)
        for k in range(0, words, 40):
            w[(k + rng.randrange(40))] = f"x{rng.randrange(n)}"
        if i % 40 == 39:
            w = list(old)
            w[7] = "again"
        out.append((i, " ".join(w)))
        old = w
    return out


def test_a_text_is_not_sent_to_every_block(docs_of, spark):
    rows, sent, found = crowd(360), {}, {}
    for size in (400, 8):
        before, _ = shuffled(spark)
        found[size] = sorted(map(tuple, ngram_join.classes(docs_of(rows), block_rows=size).drop("text_hash").collect()), key=repr)
        sent[size] = shuffled(spark, before)[1]
    assert found[400] == found[8] == brute_classes(rows)
    assert sent[8] < 2 * sent[400]
