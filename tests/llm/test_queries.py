"""The registered corpus queries against their SQL, and the pipeline against plain Python."""

import pytest

from advisorium.llm.queries import ORACLES, QUERIES
from checks.compare import connect, difference
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    assert difference(QUERIES[name], ORACLES[name], spark, connect(SMALL), SMALL) is None


def test_names_and_columns(spark):
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert QUERIES["op1_main_text"](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/pages.parquet").count()


def test_pipeline(spark):
    import corpus_pipeline
    from advisorium.llm import toxicity
    from advisorium.llm.exact_dedup import LOWER
    from tests.llm.test_near_copies import brute_kept

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    toxic = {r.doc_id for r in toxicity.score(docs, labels).collect() if r.predicted}
    best = {}
    for r in docs.collect():
        if r.doc_id not in toxic:
            key = r.text.encode().translate(LOWER)
            best[key] = max(best.get(key, (-1, "")), (r.doc_id, r.text))
    rows = sorted(best.values())
    kept, near = brute_kept(rows)
    assert near
    got = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in got.select("doc_id").distinct().collect()} == {rows[i][0] for i in kept}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "packing"]


def test_a_pipeline_run_leaves_other_results_alone(spark):
    """A query that was built before a run of the pipeline still finds its tables."""
    import corpus_pipeline

    packed = QUERIES["op2_packing"](spark, SMALL)
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40)
    kept = corpus_pipeline.drop_near_copies(spark, documents, SMALL).count()
    assert corpus_pipeline.drop_copies(spark, documents, SMALL).count() >= kept
    assert packed.select("doc_id").distinct().count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()


@pytest.mark.parametrize("rows", [[], [(None, None, None), (1, "", "x"), (1, None, None), (2, "one two three four five six", "y")] * 3])
def test_pipeline_of_awkward_rows(spark, rows):
    """No rows, nulls, repeated rows, extra columns with the names of results, through all stages."""
    import corpus_pipeline

    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept string, row string"
    docs = spark.createDataFrame([(i, t, "en", s, 1, s, s, s) for i, t, s in rows], schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).collect(), schema)
        assert docs.columns == [f.split()[0] for f in schema.split(", ")]
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert len(got) == (2 if rows else 0)
