"""Indexed substring search finds what the scan finds."""

import random

import pytest

from advisorium.operators import filters, trigrams


@pytest.fixture(scope="module")
def entries(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abäß 漢-%_.\n") for _ in range(rng.randint(0, 12)))
    rows = [(str(n), word(), rng.choice([None, word()]), word()) for n in range(300)] + [("x", "Größe ÄB", "", None), ("y", None, None, None)]
    return spark.createDataFrame(rows, "id string, scenario string, recommendation_description_detailed string, recommendation_action string")


def test_search_equals_the_scan(spark, entries, tmp_path):
    path = str(tmp_path / "index")
    trigrams.write_index(entries, path)
    for term in ("aba", "äß ", "ab%", "a_b", "größe", "ÄB", "ab", "", "漢", "aaaa", "b\na", "nowhere"):
        for columns in (trigrams.SEARCHED, ("scenario",)):
            want = sorted(r.id for r in filters.search_text(entries, term, columns).collect())
            assert sorted(r.id for r in trigrams.search(entries, path, term, columns).collect()) == want, term
    assert trigrams.search(entries.limit(0), path, "abc").count() == 0


def test_a_search_reads_its_own_postings(spark, entries, tmp_path):
    path = str(tmp_path / "index")
    trigrams.write_index(entries, path)
    plan = trigrams.holding(spark, path, "abab")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(trigram" in plan
    assert trigrams._grams("abab") == ["aba", "bab"]


def test_blocks_are_bounded_and_stay_where_they_are(spark, entries, tmp_path, monkeypatch):
    """A row of the index holds the ids of a block, each once; blocks of few letters find the same."""
    monkeypatch.setattr(trigrams, "LETTERS_AT_ONCE", 40)
    path = str(tmp_path / "index")
    trigrams.write_index(entries.unionAll(entries.where("id = 'x'")).coalesce(2), path)
    index = spark.read.parquet(path)
    assert index.columns == ["trigram", "ids"] and all(len(r.ids) <= 41 for r in index.collect())
    files = index.select("trigram", "ids", "_metadata.file_path").collect()
    for file in {r.file_path for r in files}:
        names = [r.trigram for r in files if r.file_path == file]
        assert names == sorted(names, key=str.encode)
    assert len(files) > 2 * len({(r.file_path, r.trigram) for r in files})  # several blocks in a file
    for term in ("aba", "äß ", "größe", "漢", "b\na"):
        want = sorted(r.id for r in filters.search_text(entries, term, trigrams.SEARCHED).collect())
        assert sorted(r.id for r in trigrams.search(entries, path, term).collect()) == want, term
