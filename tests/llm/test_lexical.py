import math
import random
import re
from collections import Counter

import pytest

from advisorium.llm import lexical
from tests.llm.conftest import LONG

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    """(item, rank, doc_id, score) by scoring every document; ids null last."""
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, total = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, bag in bags:
            m = 100 - 50 + (50 * bag.total() * n_docs) // total
            score = 0
            for t in set(terms(text)):
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 20 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, n + 1, None if none else i, -s) for n, (s, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def words(generator, n):
    return " ".join(generator.choice(["the", "of", "Alpha", "beta2", "ÉTÉ", "naïve", "x_y", "don't", "日本"] + [f"w{i}" for i in range(60)])
                    for _ in range(n))


@pytest.mark.parametrize("block_docs, k", [(8192, 50), (7, 5), (1, 1)])
def test_against_scoring_of_all(spark, block_docs, k):
    generator = random.Random(8)
    docs = [(n, words(generator, generator.choice([1, 3, 8, 8, 8, 30, 200]))) for n in range(300)]
    docs += [(n, docs[3][1]) for n in range(400, 460)]  # a group of copies: ties
    docs += [(7, "alpha beta2"), (7, "alpha beta2"), (500, None), (501, ""), (502, "-- !"), (None, "alpha naïve"), (None, None),
             (503, LONG + "alpha")]
    items = [(n, words(generator, 6)) for n in range(20)] + [(3, "alpha alpha"), (3, "alpha alpha"), (50, None), (51, "unheardof"),
                                                             (52, "ALPHA été lorem"), (None, "the of")]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id bigint, text string, term string, m int")
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, rank string")
    got = lexical.search(lexical.build(frame, block_docs=block_docs), asked, k).collect()
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=repr) == brute(docs, items, k)


def test_many_queries_and_text_ids(spark):
    generator = random.Random(9)
    docs = [(f"d{n}", words(generator, 12)) for n in range(120)]
    items = [(f"q{n}", words(generator, 4)) for n in range(600)]
    frame = spark.createDataFrame(docs, "name string, body string")
    asked = spark.createDataFrame(items, "q string, words string")
    got = lexical.search(lexical.build(frame, "name", "body"), asked, 3, "q", "words", "name").collect()
    want = []
    for item, rank, place, score in brute([(n, t) for n, (_, t) in enumerate(sorted(docs))], items, 3):
        want.append((item, rank, sorted(docs)[place][0], score))
    assert sorted((r.q, r["rank"], r.name, r.score) for r in got) == sorted(want)


def test_no_rows(spark):
    frame = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    asked = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert lexical.search(lexical.build(frame.limit(0)), asked).collect() == []
    assert lexical.search(lexical.build(frame), asked.limit(0)).collect() == []
    assert lexical.search(lexical.build(spark.createDataFrame([(1, None), (2, "!")], frame.schema)), asked).collect() == []
    assert [tuple(r) for r in lexical.search(lexical.build(frame), asked).collect()] == [(1, 1, 1, 287 * (1_000_000_000 // 3000) * 2)]
