import random

import pytest

from advisorium.llm import near_copies
from tests.llm.test_simhash import roots


def brute_shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)} - {()}


def brute_kept(rows):
    sets = [brute_shingles(t) for _, t in rows]
    near = [(a, b) for a in range(len(rows)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
    groups = {}
    for i, root in roots(near, range(len(rows))).items():
        groups.setdefault(root, []).append(i)
    return sorted(min(g, key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i)) for g in groups.values()), near


@pytest.fixture
def corpus():
    """Groups of copies with a few words changed, so that similarities lie on both sides of the limit."""
    generator = random.Random(11)
    rows = [(None, None), (7, " \n"), (8, ""), (9, "A b"), (3, "a  B"), (None, "a b")]
    for number in range(60):
        words = [f"w{generator.randrange(3000)}" for _ in range(generator.choice([30, 120, 400]))]
        rows.append((1000 - number, " ".join(words)))
        for _ in range(generator.choice([0, 1, 6])):
            copy = words.copy()
            for at in generator.sample(range(len(words)), generator.randint(1, max(1, len(words) // 40))):
                copy[at] = f"x{generator.random()}"
            rows.append((2000 + len(rows), " ".join(copy)))
    return rows


@pytest.mark.parametrize("section", [512, 2])
def test_kept_against_all_pairs(spark, corpus, section):
    """With buckets whole and cut into sections."""
    want, near = brute_kept(corpus)
    fps = [near_copies.shingles((t or "").encode()) for _, t in corpus]
    assert len(near) > 50 and len(want) < len(corpus) and all(len(f) == len(brute_shingles(t)) for f, (_, t) in zip(fps, corpus))
    frame = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(corpus)], "doc_id bigint, text string, row int")
    got = near_copies.kept(frame, section=section)
    assert got.columns == frame.columns
    assert sorted(r.row for r in got.collect()) == want
    assert near_copies.kept(frame.limit(0)).collect() == []


def test_stage_drops_copies_that_simhash_leaves(spark):
    """Two texts of similarity 0.8 or more whose 64-bit fingerprints are over two bits apart."""
    import corpus_pipeline
    from advisorium.llm import simhash

    words = [f"w{i}" for i in range(200)]
    copy = [*words[:60], "other", *words[60:120], "new", *words[120:]]
    rows = [(1, " ".join(words), ), (2, " ".join(copy))]
    a, b = (simhash.fingerprint(t.encode()) for _, t in rows)
    assert (a ^ b).bit_count() > 2 and brute_kept(rows)[0] == [0]
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), None)
    assert [r.doc_id for r in got.collect()] == [1]


def test_fingerprints_within_two_bits_are_candidates(spark):
    """Texts that share no band meet through their fingerprints; the exact sets decide."""
    from pyspark.sql import functions as F

    from advisorium.llm import simhash

    generator = random.Random(4)
    words = [f"w{generator.randrange(3000)}" for _ in range(600)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"]), " ".join(words[::-1])]
    fps = [simhash.fingerprint(t.encode()) for t in texts]
    assert (fps[0] ^ fps[1]).bit_count() <= 2
    signed = [(n, fp - (1 << 64) if fp >> 63 else fp, 596, [100 + n], t) for n, (fp, t) in enumerate(zip(fps, texts))]
    signed.append((3, signed[0][1], 2, [103], "no copy"))  # the same fingerprint, another text
    signed = spark.createDataFrame(signed, "row_id bigint, fp bigint, size int, bands array<bigint>, text string")
    found = near_copies.links(signed, F.col("text"), near_copies.WORDS, near_copies.SIMILARITY).distinct().collect()
    assert [tuple(r) for r in found] == [(1, 0)]


def test_tables_have_as_many_files_as_the_input_asks_for(spark, corpus, tmp_path):
    """Not as many as there are shuffle partitions: each file costs a task and processes of its own."""
    from pathlib import Path

    from advisorium.llm.shared import FOLDER

    want, _ = brute_kept(corpus)
    frame = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(corpus)], "doc_id bigint, text string, row int").coalesce(1)
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key, None) for key in settings}
    token = FOLDER.set(str(tmp_path))
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        got = near_copies.kept(frame)
        assert sorted(r.row for r in got.collect()) == want
        most = 2 * spark.sparkContext.defaultParallelism
        files = {path.name: len(list(path.glob("part-*"))) for path in Path(tmp_path).iterdir()}
    finally:
        FOLDER.reset(token)
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
    assert most < 64 and len(files) > 10 and max(files.values()) <= most and got.rdd.getNumPartitions() <= most
