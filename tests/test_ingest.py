"""The batch run on a small fixture: outcomes, options, metrics."""

import json

import pytest
from pyspark.sql import functions as F

from advisorium.plans import ingest

AT = "2024-02-01 00:00:00"
UUID = "00000000-0000-0000-0000-{:012d}"


def response(n, **changes):
    entry = {"id": UUID.format(n), "service_name": "s3", "scenario": f"Finding {n}", "risk_detail": "cost", **changes}
    return json.dumps({k: v for k, v in entry.items() if v is not None})


ITEMS = [  # source, ord, title, body
    ("a", 1, "alpha beta", "gamma"),            # new, promoted
    ("a", 2, "Alpha beta ", " gamma"),          # copy of 1
    ("a", 3, "old", "known text"),              # seen before
    ("b", 4, "old", "known text"),              # same text, other source: new
    ("a", 5, "bucket versioning", "disabled"),  # duplicate of an existing entry
    ("a", 6, "delta", "one"),                   # skipped
    ("a", 7, "epsilon", "two"),                 # not JSON
    ("a", 8, "zeta", "three"),                  # invalid twice
    ("a", 9, "eta", "four"),                    # valid at the second try
    ("a", 10, "theta bucket", "five"),          # too similar to promote: staged
    ("a", 11, "iota", "six"),                   # id already in the catalogue: staged
    ("a", 12, "kappa", "seven"),                # same id as 1: staged
    ("a", 13, "lambda", "eight"),               # no response
    ("a", 14, "mu", "nine"),                    # no service name: invalid
]
RESPONSES = [
    (1, response(1), None), (4, response(4), None), (5, response(5), None), (6, '{"skip": true}', response(6)), (7, "sorry", response(7)),
    (8, response(8, risk_detail=None), response(8, build_priority=9)), (9, response(9, scenario=""), "```json\n" + response(9) + "\n```"),
    (10, response(10), None), (11, response(11), None), (12, response(1), None), (14, response(14, service_name=None), None)]
EXPECTED = {1: "promoted", 2: "seen", 3: "seen", 4: "promoted", 5: "duplicate", 6: "skipped", 7: "convert_failed", 8: "validation_failed",
            9: "promoted", 10: "staged", 11: "staged", 12: "staged", 13: "convert_failed", 14: "validation_failed"}


@pytest.fixture(scope="module")
def inputs(spark):
    items = spark.createDataFrame(ITEMS, "source_id string, ord long, title string, body string")
    from advisorium.functions import text

    items = items.withColumn("content_hash", text.content_hash("title", "body"))
    seen = items.filter("ord = 3").select("source_id", "content_hash")
    existing = spark.createDataFrame(
        [(1, "Versioning", "bucket versioning disabled"), (2, "Other", "theta bucket policy wide open")], "position long, scenario string, text string")
    responses = spark.createDataFrame(RESPONSES, "ord long, response string, retry_response string")
    catalog = spark.createDataFrame([(UUID.format(11),)], "id string")
    return items, seen, existing, responses, catalog


def outcomes(inputs, **options):
    return ingest.run(*inputs, F.to_timestamp(F.lit(AT)), **options)


def test_every_item_has_its_outcome(inputs):
    rows = outcomes(inputs).collect()
    assert {r.ord: r.outcome for r in rows} == EXPECTED and len(rows) == len(ITEMS)
    found = {r.ord: r for r in rows}
    assert found[5].score == 1.0 and found[5].position == 1 and found[1].score == 0.0
    assert sorted(r.ord for r in rows if r.retried) == [8, 9, 14]
    assert found[9].recommendation_id == UUID.format(9) and found[8].recommendation_id is None
    assert {r.outcome for r in rows} <= set(ingest.OUTCOMES)


def test_metrics_add_up(inputs):
    done = outcomes(inputs)
    metrics = ingest.run_metrics(done).first().asDict()
    assert metrics == {
        "items_fetched": 14, "items_filtered_seen": 2, "items_filtered_dedup": 1, "items_converted": 8, "items_convert_failed": 2,
        "items_convert_skipped": 1, "items_validated": 6, "items_validation_failed": 2, "items_staged": 3, "items_auto_promoted": 3, "items_retried": 3}
    parts = ("items_filtered_seen", "items_filtered_dedup", "items_converted", "items_convert_failed", "items_convert_skipped")
    assert sum(metrics[p] for p in parts) == metrics["items_fetched"]
    yields = {r.source_id: (r.parsed, r.seen, r.duplicate, r.novel) for r in ingest.source_yield(done).collect()}
    assert yields == {"a": (13, 2, 1, 10), "b": (1, 0, 0, 1)}


def test_dry_run_marks_nothing(inputs):
    found = {r.ord: r.outcome for r in outcomes(inputs, dry_run=True).collect()}
    assert found[1] == found[2] == "dry_run" and found[3] == "seen" and found[5] == "duplicate" and found[13] == "dry_run"


def test_without_conversion_and_promotion(inputs):
    assert {r.outcome for r in outcomes(inputs, convert=False).collect()} == {"seen", "duplicate", "not_converted"}
    found = [r.outcome for r in outcomes(inputs, auto_promote=False).collect()]
    assert "promoted" not in found and found.count("staged") == 6


def test_cap_per_source(inputs):
    found = {r.ord: r.outcome for r in outcomes(inputs, max_items=4).collect()}
    assert sum(o != "capped" for o in found.values()) == 5
    assert {n: o for n, o in found.items() if o != "capped"} == {n: EXPECTED[n] for n in (1, 2, 3, 4, 5)}
    capped = ingest.source_yield(outcomes(inputs, max_items=4)).filter("source_id = 'a'").first()
    assert capped.parsed == 4


def test_only_finished_items_are_remembered(inputs):
    done = outcomes(inputs)
    hashes = {r.content_hash: r.ord for r in done.collect() if r.ord not in (2, 3)}
    kept = sorted(hashes[r.content_hash] for r in ingest.newly_seen(done, AT).filter("source_id = 'a'").collect())
    assert kept == [1, 5, 6, 9, 10, 11, 12]
    every = ingest.newly_seen(done, AT, every_item=True).filter("source_id = 'a'")
    assert every.count() == 11


def test_records_of_a_run(inputs):
    """Staged records carry the recommendation and the closest scenario; promoted entries are whole."""
    items, _, existing, _, _ = inputs
    done = outcomes(inputs).cache()
    staged = ingest.staged_records(done, items.withColumn("url", F.concat(F.lit("https://x/"), "ord")), existing, "ingest", F.to_timestamp(F.lit(AT)))
    rows = {r.source_url: r for r in staged.collect()}
    assert set(rows) == {"https://x/10", "https://x/11", "https://x/12"}
    row = rows["https://x/10"]
    assert (row.source_id, row.staged_by, row.closest_existing) == ("a", "ingest", "Other") and row.recommendation.id == UUID.format(10)
    assert row.dedup_score == round(row.dedup_score, 4) > 0 and row.staged_at.startswith("2024-02-01")
    entries = ingest.promoted_entries(done).collect()
    assert sorted(e.id for e in entries) == [UUID.format(n) for n in (1, 4, 9)] and all(e.scenario for e in entries)
    dry = outcomes(inputs, dry_run=True)
    assert dry.schema["recommendation"].dataType == done.schema["recommendation"].dataType
    assert dry.filter("recommendation IS NOT NULL").count() == 0


def test_items_from_whole_texts(spark):
    rows = spark.createDataFrame([("s", 1, "Title\nbody\nmore"), ("s", 2, "only a title"), ("s", 3, "")], "src string, n long, t string")
    items = ingest.raw_items(rows, "src", "n", "t").orderBy("ord").collect()
    assert [(i.title, i.body) for i in items] == [("Title", "body\nmore"), ("only a title", ""), ("", "")]
