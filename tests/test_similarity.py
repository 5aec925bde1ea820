"""Text and vector similarity against plain calculations."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from advisorium.functions.stop_words import ENGLISH
from advisorium.operators import similarity


def plain_terms(text):
    import re

    words = [w for w in re.findall(r"\w\w+", text.lower()) if w not in ENGLISH]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain_scores(new, old, max_features):
    """(score, position) per new text by the formula, one pair at a time."""
    counts = {p: Counter(plain_terms(t)) for p, t in old}
    total, df = Counter(), Counter()
    for c in counts.values():
        total.update(c)
        df.update(c.keys())
    vocabulary = sorted(total, key=lambda t: (-total[t], t))[:max_features]
    idf = {t: math.log((1 + len(old)) / (1 + df[t])) + 1 for t in vocabulary}

    def vector(count):
        w = {t: n * idf[t] for t, n in count.items() if t in idf}
        length = math.sqrt(sum(v * v for v in w.values()))
        return {t: v / length for t, v in w.items()} if length else {}

    vectors = {p: vector(c) for p, c in counts.items()}
    best = {}
    for key, text in new:
        v = vector(Counter(plain_terms(text)))
        scored = [(round(sum(x * o.get(t, 0) for t, x in v.items()), 9), -p) for p, o in vectors.items()]
        top = max(scored)
        best[key] = (top[0], -top[1])
    return best


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    words = [f"w{n}" for n in range(40)] + ["the", "and", "élan", "übung", "of"]
    make = lambda low, high: " ".join(rng.choice(words) for _ in range(rng.randint(low, high)))
    old = [(10 * n, make(3, 30)) for n in range(25)]
    new = [(n, make(1, 40)) for n in range(60)] + [(60, old[3][1]), (61, "nothing known here"), (62, ""), (63, "the and of")]
    return new, old


def run(spark, new, old, **options):
    existing = spark.createDataFrame(old, "position long, text string")
    items = spark.createDataFrame(new, "key long, text string").repartition(5)
    index = similarity.fit(existing, "text", "position", max_features=options.pop("max_features", 5000))
    return {r.key: (r.score, r.position) for r in similarity.score(items, index, "key", "text", **options).collect()}


@pytest.mark.parametrize("max_features", [5000, 50, 7])
def test_scores_equal_the_formula(spark, texts, max_features):
    new, old = texts
    expected = plain_scores(new, old, max_features)
    found = run(spark, new, old, max_features=max_features)
    assert set(found) == set(expected)
    for key, (score, position) in expected.items():
        assert found[key][0] == pytest.approx(score, abs=1e-8)
        assert found[key][1] == (position if score else 0)
    assert found[60][0] == pytest.approx(1.0) and found[61] == found[62] == found[63] == (0.0, 0)


def test_near_copies_among_many(spark):
    """Long texts that share much with one entry, hot terms in all of them, ties among copies of an entry."""
    rng = random.Random(11)
    rare = [f"r{n}" for n in range(400)]
    old = [(n, " ".join(["hot"] * rng.randint(0, 3) + rng.sample(rare, 12))) for n in range(150)]
    old += [(1000 + n, old[7][1]) for n in range(20)]
    new = [(n, " ".join(rng.sample(rare, 5)) + " hot " + old[n][1]) for n in range(100)] + [(500 + n, "hot") for n in range(50)]
    expected, found = plain_scores(new, old, 5000), run(spark, new, old)
    for key, (score, position) in expected.items():
        assert found[key] == (pytest.approx(score, abs=1e-8), position)


def test_counts_grow_by_appending(spark, texts):
    _, old = texts
    frame = lambda rows: spark.createDataFrame(rows, "position long, text string")
    parts = [similarity.counted(frame(rows), "text", "position") for rows in (old[:9], old[9:10], old[10:])]
    rows = lambda index: sorted(tuple(r) for r in index.postings.collect())
    whole = similarity.fit(frame(old), "text", "position", 40)
    grown = similarity.weighed(similarity.merged(*parts), 40)
    assert rows(grown) == rows(whole)
    assert sorted(map(tuple, grown.vocabulary.collect())) == sorted(map(tuple, whole.vocabulary.collect()))
    assert grown.first.scalar() is not None and spark.range(1).select(grown.first.scalar()).first()[0] == old[0][0]


def test_first_existing_row_wins_a_tie(spark):
    old = [(5, "alpha beta"), (3, "alpha beta"), (9, "gamma")]
    assert run(spark, [(1, "alpha beta")], old)[1] == (pytest.approx(1.0), 3)


def test_nothing_to_compare_to(spark):
    existing = spark.createDataFrame([], "position long, text string, scenario string")
    items = spark.createDataFrame([(1, "some words")], "key long, text string")
    row = similarity.duplicates(items, existing, "key", "text", "text", "position", "scenario").first()
    assert (row.score, row.position, row.closest, row.is_duplicate) == (0.0, None, "", False)


def test_columns_are_carried_along(spark):
    existing = spark.createDataFrame([(1, "alpha")], "position long, text string")
    items = spark.createDataFrame([(1, "alpha", "src", 1.5)], "key long, text string, source string, n double")
    index = similarity.fit(existing, "text", "position")
    row = similarity.score(items, index, "key", "text", keep=("source", "n")).first()
    assert row.asDict() == {"key": 1, "source": "src", "n": 1.5, "score": 1.0, "position": 1}


def test_scoring_does_not_shuffle_texts(spark, texts):
    new, old = texts
    existing = spark.createDataFrame(old, "position long, text string")
    items = spark.createDataFrame(new, "key long, text string")
    scored = similarity.score(items, similarity.fit(existing, "text", "position"), "key", "text")
    assert "__text" not in scored._jdf.queryExecution().toString()  # texts became weights where they lay


def test_repeated_and_null_keys(spark):
    existing = spark.createDataFrame([(1, "alpha beta gamma"), (2, "delta epsilon")], "position long, text string")
    items = spark.createDataFrame([(1, "alpha beta"), (1, "delta"), (None, "gamma"), (None, None)], "key long, text string")
    index = similarity.fit(existing, "text", "position")
    rows = similarity.score(items, index, "key", "text", keep=("text",)).collect()
    got = sorted((repr(r.key), r.text or "", r.score > 0, r.position) for r in rows)
    assert got == [("1", "alpha beta", True, 1), ("1", "delta", True, 2), ("None", "", False, 1), ("None", "gamma", True, 1)]


@pytest.mark.parametrize("options", [{}, {"pivots": 1, "ring_rows": 1, "slice_rows": 1}])
def test_vectors_of_other_widths_and_repeated_keys(spark, options):
    old = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0, 1.0]), (4, [None, 1.0])], "position long, v array<float>")
    new = spark.createDataFrame([(7, [1.0, 0.1]), (7, [0.1, 1.0]), (None, [0.0, 2.0]), (8, [1.0]), (9, None)], "key long, v array<float>")
    got = similarity.nearest_vectors(new, old, "key", "v", "position", **options).collect()
    assert sorted((repr(r.key), r.position) for r in got) == [("7", 1), ("7", 2), ("None", 2)]


def test_stop_words():
    from advisorium.functions.stop_words import ENGLISH

    assert len(ENGLISH) == 318 and {"whereupon", "thru", "amongst", "nevertheless"} < set(ENGLISH)


def cosine(a, b):
    length = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
    return sum(x * y for x, y in zip(a, b)) / length if length else 0.0


@pytest.mark.parametrize("options", [{}, {"pivots": 3, "ring_rows": 2, "slice_rows": 3}])
def test_nearest_vectors(spark, options):
    rng = random.Random(3)
    vector = lambda: [rng.uniform(-1, 1) for _ in range(4)]
    old = [(n, vector()) for n in range(20)]
    new = [(n, vector()) for n in range(30)] + [(30, old[4][1]), (31, [0.0] * 4)]
    found = similarity.nearest_vectors(
        spark.createDataFrame(new, "key long, v array<float>"), spark.createDataFrame(old, "position long, v array<float>"),
        "key", "v", "position", **options)
    for row in found.collect():
        scores = {p: cosine(new[row.key][1], v) for p, v in old}
        assert row.score == pytest.approx(max(scores.values()), abs=1e-5)
        assert scores[row.position] == pytest.approx(row.score, abs=1e-5)
    assert found.count() == 32


@pytest.mark.parametrize("options", [{}, {"pivots": 4, "ring_rows": 8, "slice_rows": 10}])
def test_clustered_vectors_against_all_pairs(spark, options):
    rng = random.Random(13)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(8)]
    near = lambda c: [x + rng.gauss(0, 0.05) for x in c]
    old = [(n, near(centres[n % 8])) for n in range(200)] + [(300 + n, [2 * x for x in centres[0]]) for n in range(30)]
    old += [(250, [0.0] * 6), (240, [0.0] * 6), (9, None), (8_000, [float("nan")] * 6), (8_001, [1.0])]
    new = [(n, near(centres[n % 8])) for n in range(80)] + [(90, centres[0]), (91, [0.0] * 6), (92, [-x for x in centres[1]]), (93, None)]
    got = similarity.nearest_vectors(
        spark.createDataFrame(new, "key long, v array<double>"), spark.createDataFrame(old, "position long, v array<double>"),
        "key", "v", "position", **options).collect()
    usable = [(p, v) for p, v in old if v and len(v) == 6 and not any(math.isnan(x) for x in v)]
    want = {k: max((round(cosine(v, w), 9), -p) for p, w in usable) for k, v in new if v}
    assert {r.key: (round(r.score, 9), -r.position) for r in got} == want


def test_vectors_of_length_zero_only(spark):
    frame = lambda rows, key: spark.createDataFrame(rows, f"{key} long, v array<double>")
    got = similarity.nearest_vectors(frame([(1, [1.0, 2.0])], "key"), frame([(5, [0.0, 0.0]), (4, [0.0, 0.0])], "position"), "key", "v", "position")
    assert [tuple(r) for r in got.collect()] == [(1, 0.0, 4)]
    got = similarity.nearest_vectors(frame([(1, [1.0, 2.0])], "key"), frame([(5, None)], "position"), "key", "v", "position")
    assert [tuple(r) for r in got.collect()] == [(1, None, None)]


def test_second_pass_only_raises_low_scores(spark):
    scored = spark.createDataFrame([(1, 0.8, 1), (2, 0.2, 1), (3, 0.2, 1), (4, 0.2, 1)], "key long, score double, position long")
    semantic = spark.createDataFrame([(1, 0.9, 7), (2, 0.9, 7), (3, 0.1, 7)], "key long, score double, position long")
    rows = similarity.second_pass(scored, semantic, "key").orderBy("key").collect()
    assert [(r.score, r.position, r.raised) for r in rows] == [(0.8, 1, False), (0.9, 7, True), (0.2, 1, False), (0.2, 1, False)]


def test_terms_skip_stop_words_before_pairs(spark):
    df = spark.createDataFrame([("The cache of a region; x é-ß Über_1",)], "t string")
    assert similarity.with_terms(df, "t").first().terms == ["cache", "region", "über_1", "cache region", "region über_1"]
    assert similarity.with_terms(df.select(F.lit("").alias("t")), "t").first().terms == []


def test_memory_follows_neither_rows_nor_lengths(spark, monkeypatch):
    """Texts are weighed in slices of bounded words; the slices change nothing."""
    import pyarrow as pa

    lists = [["a"] * n for n in (0, 3, 2, 0, 7, 1, 1, 1, 0)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array(lists, pa.list_(pa.string()))], ["key", "words"])
    monkeypatch.setattr(similarity, "WORDS_AT_ONCE", 5)
    slices = list(similarity._sliced([batch, batch.slice(0, 0), batch.slice(2, 3)]))
    assert [r for s in slices for r in s.column(0).to_pylist()] == [*range(10), 2, 3, 4]
    sizes = [[len(words or ()) for words in s.column(1).to_pylist()] for s in slices]
    assert sizes == [[0, 3, 2, 0], [7], [1, 1, 1, 0, 0], [2, 0], [7]]

    rows = [(n % 40, " ".join(f"word{(n * k) % 23}" for k in range(n % 11))) for n in range(120)] + [(None, None), (1, "")]
    new = spark.createDataFrame(rows, "ord int, text string").coalesce(2)
    old = spark.createDataFrame([(n, f"word{n} word{n + 1} word{2 * n}") for n in range(15)], "position int, text string")
    score = lambda: sorted(map(str, similarity.score(new, similarity.fit(old, "text", "position"), "ord", "text").collect()))
    small = score()
    monkeypatch.undo()
    assert small == score() and len(small) == len(rows)
