import random
import zlib

import pytest

from advisorium.llm import toxicity


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_against_edit_distance():
    lexicon = toxicity.Lexicon({"grumbly": 4.0, "snorkel": 3.0, "blatherer": 3.5, "grumble": 3.0})
    generator = random.Random(5)
    for _ in range(3000):
        word = list(generator.choice(sorted(lexicon.terms)))
        for _ in range(generator.randint(0, 3)):
            at = generator.randrange(len(word) + 1)
            word[at:at + generator.randint(0, 1)] = generator.choice(["", "a", "r", "0"])
        word = "".join(word)
        for edits in (1, 2):
            want = sorted((edit_distance(word, t), t) for t in lexicon.terms if edit_distance(word, t) <= edits)
            assert sorted(lexicon.near(word, edits)) == want
        best = min((edit_distance(word, t) for t in lexicon.terms), default=9)
        assert (lexicon.match(word) is not None) == (best <= 1)


def test_context():
    reader = toxicity.Reader(toxicity.Lexicon({"grumbly": 4.0, "blath*": 2.0}, ["grumblx"]))
    assert reader.hits("You Grumbly, BLATHERER grumbli grumblx")[1] == [(1, "grumbly", 0), (2, "blath*", 0), (3, "grumbly", 1)]
    quoted, direct = (toxicity.described(t, reader) for t in ('they wrote "you are grumbly" once', "they wrote you are grumbly once"))
    assert quoted[0] == 0 < direct[0] and quoted[1] > 0 == direct[1] and direct[6] > 0
    assert toxicity.described("", reader)[:8] == [0.0] * 8


def test_long_quotations():
    """Over 400 characters, over line ends, and after a capital whose lower case is longer."""
    filler = "tree " * 100
    for text in (f'she wrote "{filler}grumbly"', 'she wrote "tree\ngrumbly"', 'İ wrote "grumbly"', f"„{filler}\ngrumbly“"):
        places = toxicity.quoted_places(text)
        assert toxicity.TOKEN.findall(text.lower()).index("grumbly") in places
    between = f'"{filler}" you grumbly "{filler}"'
    assert 101 not in toxicity.quoted_places(between) and {0, 99, 102} <= toxicity.quoted_places(between)
    assert toxicity.quoted_places('“never closed grumbly "tree" night') == {3}


@pytest.fixture
def corpus(spark):
    generator = random.Random(2)
    common = ["tree", "house", "river", "cloud", "green", "under", "stone", "night"]
    rows, labels = [], []
    for number in range(600):
        words = [generator.choice(common) for _ in range(generator.randint(5, 60))]
        toxic = number % 4 == 1
        if toxic:
            for bad in generator.sample(["grumbly", "snorkel", "blatherer", "wretchy"], 3):
                words.insert(generator.randrange(len(words)), bad)
        rows.append((number, " ".join(words), "old"))
        labels.append((number, int(toxic)))
    rows += [(1000, "you grumbli snorkell tree", "x"), (1001, None, "x"), (None, "tree house", "x"), (1002, "", None), (1, "tree", "x")]
    labels += [(None, 1), (3, None), (5, 1)]
    return (spark.createDataFrame(rows, "doc_id bigint, text string, score string"),
            spark.createDataFrame(labels, "doc_id bigint, toxic int"))


def test_held_out_rows_and_odd_rows(corpus):
    docs, labels = corpus
    got = toxicity.score(docs, labels).collect()
    assert len(got) == docs.count()
    truth = {i: i % 4 == 1 for i in range(600)}
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    right = sum((r.predicted == 1) == truth[r.doc_id] for r in held if r.doc_id in truth and r.text != "tree")
    assert right >= 0.97 * sum(r.doc_id in truth for r in held)
    odd = {r.doc_id: r for r in got if r.doc_id is None or r.doc_id >= 1000}
    assert odd[1000].predicted == 1 and all(odd[k].predicted == 0 for k in (1001, 1002, None))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_held_out_labels_do_not_matter(corpus):
    from pyspark.sql import functions as F

    docs, labels = corpus
    other = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [sorted((r.text or "", r.score) for r in toxicity.score(docs, x).collect()) for x in (labels, other)]
    assert scores[0] == scores[1]


def test_no_labels_and_no_rows(corpus):
    docs, labels = corpus
    assert {r.score for r in toxicity.score(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), labels).collect() == []
    kept = toxicity.clean(docs, labels)
    assert kept.columns == docs.columns and kept.where("text LIKE '%blatherer%'").count() == 0
