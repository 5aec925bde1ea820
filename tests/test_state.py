"""Counters, retention, health, review and findings."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from advisorium import model
from advisorium.operators import findings, health, ranking, review, summaries
from advisorium.sources import writers

START = datetime(2024, 1, 1)
LOG = "source_id string, ts timestamp, error boolean, items int, not_modified boolean"


def log_of(spark, **sources):
    """One letter per fetch: e error, n nothing, i items, u unchanged."""
    rows = []
    for source, letters in sources.items():
        for n, letter in enumerate(letters):
            rows.append((source, START + timedelta(hours=n), letter == "e", 2 if letter == "i" else 0, letter == "u"))
    return spark.createDataFrame(rows, LOG)


def counters(df, **options):
    return {r.source_id: (r.consecutive_errors, r.consecutive_empty) for r in ranking.trailing_counters(df, **options).collect()}


def test_trailing_counters(spark):
    log = log_of(spark, a="iee", b="nnn", c="nen", d="enn", e="eee", f="ini", g="nun", h="eu")
    expected = {"a": (2, 0), "b": (0, 3), "c": (0, 1), "d": (0, 2), "e": (3, 0), "f": (0, 0), "g": (0, 2), "h": (0, 0)}
    assert counters(log) == expected
    assert counters(log, not_modified_is_empty=True) == {**expected, "g": (0, 3), "h": (0, 1)}
    assert counters(log.drop("not_modified"))["g"] == (0, 3)


def test_yield_and_error_checks(spark):
    state = ranking.trailing_counters(log_of(spark, bad="eee", quiet="nnn", fine="i"))
    errors = {r.message: r.severity for r in health.fetch_errors(state).collect()}
    assert errors == {"Source 'bad' has had 3 consecutive fetch errors": "ERROR",
                      "Source 'quiet': consecutive errors = 0": "OK", "Source 'fine': consecutive errors = 0": "OK"}
    yields = {r.message: r.severity for r in health.zero_yield(state).collect()}
    assert yields["Source 'quiet' has returned 0 items for 3 consecutive runs"] == "WARNING"


def test_latest_state_keeps_last_given_values(spark):
    rows = [("s", START, "e1", "m1"), ("s", START + timedelta(1), "", None), ("s", START + timedelta(2), None, "m2"), ("t", START, None, "")]
    df = spark.createDataFrame(rows, "source_id string, ts timestamp, etag string, last_modified string")
    found = {r.source_id: r for r in ranking.latest_state(df).collect()}
    assert (found["s"].etag, found["s"].last_modified, found["s"].last_fetched_at) == ("e1", "m2", START + timedelta(2))
    assert (found["t"].etag, found["t"].last_modified) == (None, None)


def test_stale_check(spark):
    config = spark.createDataFrame([("new", True), ("old", None), ("off", False), ("never", True), ("odd", True)], "source_id string, enabled boolean")
    state = spark.createDataFrame([("new", "2024-01-09T00:00:00Z"), ("old", "2024-01-01T12:00:00Z"), ("odd", "not a date")], "source_id string, last_fetched_at string")
    found = {r.message: r.severity for r in health.stale_sources(config, state, "2024-01-10 00:00:00").collect()}
    assert found == {"Source 'new' fetched recently": "OK", "Source 'old' last fetched 8 days ago": "WARNING",
                     "Source 'never' has never been fetched": "WARNING", "Source 'odd' has invalid last_fetched_at": "WARNING"}


def test_state_integrity(spark):
    df = spark.createDataFrame([('{"sources": {}}',), ('{"runs": []}',), ("[1]",), ("{ broken",)], "value string")
    found = [(r.severity, r.message) for r in health.state_integrity(df).collect()]
    assert found == [("OK", "State file is valid"), ("CRITICAL", "State file has invalid structure"),
                     ("CRITICAL", "State file has invalid structure"), ("CRITICAL", "State file is not valid JSON")]


RUN = "run_day date, items_converted long, items_convert_failed long, items_validated long, items_validation_failed long"


def runs_of(spark, *rows):
    return spark.createDataFrame([((START + timedelta(days=n)).date(), *row) for n, row in enumerate(rows)], RUN)


@pytest.mark.parametrize("run,expected", [
    ((9, 1, 10, 0), [("run_quality", "OK")]), ((1, 3, 10, 1), [("low_conversion_rate", "WARNING")]),
    ((0, 0, 0, 0), [("run_quality", "OK")]), ((1, 9, 1, 1), [("low_conversion_rate", "WARNING"), ("schema_failures", "ERROR")]),
])
def test_run_quality(spark, run, expected):
    rows = health.run_quality(runs_of(spark, (0, 9, 0, 9), run)).collect()
    assert [(r.check, r.severity) for r in rows] == expected


def test_run_quality_without_runs(spark):
    assert [tuple(r) for r in health.run_quality(spark.createDataFrame([], RUN)).collect()] == [
        ("run_quality", "OK", "No runs recorded yet")]


def test_run_history(spark):
    runs = runs_of(spark, *[(n, 0, 0, 0) for n in range(6)])
    newest = spark.createDataFrame([((START + timedelta(days=50)).date(), 99, 0, 0, 0)], RUN)
    assert [r.items_converted for r in writers.with_run(runs, newest, 3).collect()] == [99, 5, 4]
    assert ranking.latest_run(runs).first().items_converted == 5
    assert ranking.latest_run(runs.limit(0)).count() == 0
    rates = summaries.run_rates(runs_of(spark, (1, 3, 9, 1), (0, 0, 0, 0))).collect()
    assert [(r.conversion_rate, r.schema_failure_rate) for r in rates] == [(0.25, 0.1), (None, None)]


def test_report_takes_the_worst_severity(spark):
    make = lambda severity: spark.createDataFrame([("c", s, "m") for s in severity], "check string, severity string, message string")
    results = health.report(one=make(["OK", "ERROR"]), two=make(["WARNING"]))
    assert [tuple(r) for r in health.overall(results).collect()] == [("c", 3, "ERROR")]


def test_staging_overflow(spark):
    assert health.staging_overflow(spark.range(99)).first().severity == "OK"
    row = health.staging_overflow(spark.range(100)).first()
    assert (row.severity, row.message) == ("WARNING", "Staging has 100 unreviewed items (threshold: 100)")


def test_promotion(spark):
    staged = spark.createDataFrame([
        ("new", "s3", 0.1), ("like", "s3", 0.30), ("noservice", "", 0.1), ("known", "s3", 0.1), ("none", "s3", None)], "id string, service_name string, dedup_score double")
    catalog = spark.createDataFrame([("known",)], "id string")
    found = {r.id: (r.outcome, r.reason) for r in review.promotion_outcomes(staged, catalog).collect()}
    assert found == {"new": ("promoted", "new"), "like": ("staged", "not eligible"), "noservice": ("staged", "no service"),
                     "known": ("staged", "duplicate id"), "none": ("staged", "not eligible")}


def test_promotion_of_a_repeated_id_takes_the_first(spark):
    staged = spark.createDataFrame([("x", n, "s3", 0.1) for n in (5, 3, 9)], "id string, ord int, service_name string, dedup_score double")
    catalog = spark.createDataFrame([], "id string")
    rows = review.promotion_outcomes(staged, catalog, order="ord").collect()
    assert sorted((r.ord, r.outcome) for r in rows) == [(3, "promoted"), (5, "staged"), (9, "staged")]


def test_review(spark):
    staged = spark.createDataFrame([("a", "s3"), ("b", "iam"), ("c", ""), ("d", "s3"), ("e", "s3")], "id string, service_name string")
    catalog = spark.createDataFrame([("d", "s3"), ("z", "s3")], "id string, service_name string")
    decisions = spark.createDataFrame([("a", "promote", None), ("b", "reject", "why"), ("c", "promote", None), ("d", "promote", None), ("q", "promote", None)],
                                      "id string, action string, reason string")
    results = review.decide(staged, decisions, catalog)
    assert {r.id: r.result for r in results.collect()} == {
        "a": "promoted", "b": "rejected", "c": "no service", "d": "duplicate id", "q": "not found"}
    assert results.filter("id = 'b'").first().given_reason == "why"
    assert sorted(r.id for r in review.after_promotion(staged, results).collect()) == ["c", "d", "e"]
    assert {r.service_name: r.n for r in review.catalog_counts(catalog, staged, results).collect()} == {"s3": 3}


RULES = [("r2", 2, "has Elastic IP here", "cost", None, "do"), ("r1", 1, "an ELASTIC ip", "security", 3, "fix"), ("r3", 3, "Elastic IP", None, 1, "x")]


def rules_of(spark):
    return spark.createDataFrame(RULES, "id string, ord int, scenario string, risk_detail string, risk_value int, recommendation_action string")


def test_first_rule(spark):
    pick = lambda *t, **k: findings.rule_for(rules_of(spark), *t, **k).first().rule
    assert pick("Elastic IP").id == "r2" and pick("elastic ip", ignore_case=True).id == "r1"
    assert pick("Elastic IP", "here").id == "r2" and pick("nothing") is None


def test_findings(spark):
    resources = spark.createDataFrame([(1, True, START, True), (2, False, START + timedelta(days=80), False), (3, None, START + timedelta(days=95), True)],
                                      "resource_id long, encrypted boolean, created timestamp, running boolean")
    rule, none = findings.rule_for(rules_of(spark), "here"), findings.rule_for(rules_of(spark), "absent")
    ids = lambda df: sorted(r.resource_id for r in df.collect())
    off = findings.attribute_off(resources, rule, "encrypted", "ec2", "volume")
    assert ids(off) == ["2", "3"] and off.first().severity == 1 and off.first().details == {"encrypted": "false"}
    assert off.schema.simpleString() == model.FINDING.simpleString()
    assert ids(findings.attribute_off(resources, none, "encrypted", "ec2", "volume")) == []
    used = spark.createDataFrame([(1,), (1,), (9,)], "resource_id long")
    assert ids(findings.unassociated(resources, used, rule, "ec2", "address")) == ["2", "3"]
    as_of = F.to_timestamp(F.lit("2024-04-01 12:00:00"))
    old = findings.too_old(resources, rule, "created", as_of, 90, "iam", "key")
    assert ids(old) == ["1"] and old.first().details["age_days"] == "91" and old.first().severity == 2
    running = findings.running_candidates(resources, rule, "running", "ec2", "instance")
    assert ids(running) == ["1", "3"]
    assert [tuple(r) for r in findings.by_risk(findings.all_findings(off, running)).collect()] == [("cost", 4)]


def test_sustained_metric(spark):
    rows = [("low", START + timedelta(hours=h), 1.0) for h in range(72)]
    rows += [("spike", START + timedelta(hours=h), 9.0 if h == 40 else 1.0) for h in range(72)]
    rows += [("gap", START + timedelta(hours=h), 1.0) for h in range(72) if not 24 <= h < 48]
    rows += [("before", START + timedelta(hours=h), 9.0) for h in range(-5, 0)] + [("before", START + timedelta(hours=h), 1.0) for h in range(72)]
    df = spark.createDataFrame(rows, "resource_id string, ts timestamp, value double")
    found = findings.sustained_metric(df, "2024-01-04 00:00:00", 3, below=5.0).collect()
    assert sorted(r.resource_id for r in found) == ["before", "low"]
    assert [r.resource_id for r in findings.sustained_metric(df, "2024-01-04 00:00:00", 3, above=0.5).filter("resource_id = 'spike'").collect()] == ["spike"]
