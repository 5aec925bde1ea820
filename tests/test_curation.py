"""Functions, classification, filling, validation and import."""

import json

import pytest
from pyspark.sql import functions as F

from advisorium import model
from advisorium.functions import rule_tables, text
from advisorium.functions.rules import PatternRule, needed_text
from advisorium.operators import enrich, filters, project, quality, ranking, summaries
from advisorium.plans import curation
from advisorium.sources import files
from tests.conftest import recommendation


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def lit(value):
    return F.lit(value).cast("string")


def test_cleaning(spark):
    clean = lambda v: one(spark, text.clean_text(lit(v)))
    assert [clean(v) for v in ("  a b  ", "", " \t\n", "TK", " tk ", None)] == ["a b", None, None, None, None, None]
    number = lambda v: one(spark, text.safe_int(lit(v)))
    assert [number(v) for v in (" 12 ", "3.5", "x", "", "-4", None)] == [12, None, None, None, -4, None]
    key = lambda v: one(spark, text.storage_key(lit(v)))
    assert [key(v) for v in ("ALB/ELB", "Route 53", "a\\b*c", "", None, "é_1.x")] == ["alb-elb", "route-53", "a-bc", "unknown", "unknown", "é_1.x"]


def test_normalising(spark):
    risk = lambda v: one(spark, text.normalise_risk(lit(v)))
    assert [risk(v) for v in (" Cost ,SECURITY ", "Cost", "", None)] == ["cost, security", "cost", "operations", "operations"]
    category = lambda v: one(spark, text.normalise_category(lit(v)))
    assert [category(v) for v in ("Network", " STORAGE", " Odd One ", "", None)] == ["networking", "storage", "Odd One", None, None]
    links = one(spark, text.http_links(lit(" https://b "), lit("TK"), lit("ftp://x")))
    assert links == ["https://b"]
    assert one(spark, text.first_risk(lit("cost , security"))) == "cost"


def test_markup_and_dates(spark):
    strip = lambda v: one(spark, text.strip_html(lit(v)))
    assert strip("<p>a&amp;b</p>\n <b>&quot;c&quot;</b>&nbsp;&amp;copy;") == 'a&b "c" &copy;'
    assert strip("<h1>a &amp</h1>&copy&amp;lt &ampx &amp;amp; &quot&quot") == 'a & ©&lt &ampx &amp; ""'
    assert strip(None) == ""
    assert one(spark, text.strip_html(lit("&eacute;&#x41;&hellip;"), text.html_unescape())) == "éA…"
    date = lambda v: one(spark, text.iso_timestamp(text.feed_date(lit(v))))
    assert date("Wed, 15 Jan 2025 10:00:00 GMT") == "2025-01-15T10:00:00Z"
    assert date("Wed, 5 Jan 2025 10:00:00 +0200") == "2025-01-05T08:00:00Z"
    assert date("nonsense") is None
    parsed = lambda v: one(spark, text.iso_timestamp(text.parse_iso(lit(v))))
    assert [parsed("2025-01-01T00:00:00Z"), parsed("2025-01-01T02:00:00+02:00"), parsed("x")] == ["2025-01-01T00:00:00Z"] * 2 + [None]
    age = one(spark, text.age_days(F.to_timestamp(lit("2025-01-01 12:00:00")), F.to_timestamp(lit("2025-01-03 11:59:59"))))
    assert age == 1


def test_hash_and_ids_are_stable(spark):
    import hashlib

    expected = hashlib.sha256("title|body é".encode()).hexdigest()
    assert one(spark, text.content_hash(lit(" Title\n"), lit("Body É "))) == expected
    ids = [one(spark, text.stable_id(lit(v), lit("b"))) for v in ("a", "a", "c", None)]
    assert ids[0] == ids[1] != ids[2] and all(len(i) == 36 for i in ids)


@pytest.mark.parametrize("scenario,expected", [
    ("Stop the EC2 host", "ec2"), ("gp2 volume without IOPS", "ebs"), ("Bucket is public", "s3"),
    ("Lambda behind CloudFront", "cloudfront"), ("lambda memory", "lambda"), ("Use a savings plan for ec2", None),
    ("Put a load balancer in front", "alb/elb"), ("unrelated words", None), ("CloudWatch logs to CloudTrail", "cloudtrail"),
    ("open SSH on a port", "networking"), ("certificate will expire", "acm"), ("Redis é", "elasticache"), ("the policy allows *:*", "iam"),
])
def test_service_rules(frame, scenario, expected):
    rows = frame([recommendation(scenario=scenario, alert_criteria=None, recommendation_action=None,
                                 recommendation_description_detailed=None)], model.RECOMMENDATION)
    assert enrich.classified_service(rows).first().classified == expected


def test_needed_text_is_part_of_every_match():
    assert needed_text(r"\bauto.?scaling\b") == "scaling"
    assert needed_text(r"s3.*acl") == "acl"
    assert needed_text(r"(?:a|b)c") is None and needed_text(r"\*:\*") is None
    assert needed_text(r"colou?r") == "colo" and needed_text(r"ab{0,2}c") in ("a", None)
    assert needed_text(r"\blambda\b(?!.*cloudfront)") == "lambda"


def test_reclassify_records_the_move(frame):
    rows = frame([recommendation(id="a", service_name="general", scenario="DynamoDB table"),
                  recommendation(id="b", service_name="general", scenario="nothing", alert_criteria="", recommendation_action="",
                                 recommendation_description_detailed=""),
                  recommendation(id="c", service_name="iam", scenario="DynamoDB table")], model.RECOMMENDATION)
    moved = enrich.record_move(enrich.reclassify(rows), "classifier", F.to_timestamp(F.lit("2026-02-01 00:00:00")))
    again = enrich.record_move(moved, "classifier", F.to_timestamp(F.lit("2026-02-01 00:00:00")))
    found = {r.id: r for r in again.collect()}
    assert [found[i].service_name for i in "abc"] == ["dynamodb", "general", "iam"]
    assert found["a"].metadata.contributors == ["someone", "classifier"]
    assert found["a"].metadata.updated_at == "2026-02-01T00:00:00Z" and found["b"].metadata.contributors == ["someone"]


@pytest.mark.parametrize("scenario,risk,alert,action", [
    ("Unused EBS disk", "cost", "EBS volume has been unattached for more than 7 days", "Review resource usage and delete"),
    ("Idle alternate", "cost", "NAT Gateway has processed less than 1GB", "Review resource usage and delete"),
    ("Idle thing", "security", "Resource has been idle or unused", "Review resource usage and delete"),
    ("No encryption", "security, cost", "Resource is not encrypted", "Enable encryption using"),
    ("Audit trail", "security", "Logging or auditing is not enabled", "Review and update security configuration"),
    ("Anything", "cost", "Resource cost could be optimized", "Review resource configuration for cost"),
    ("Previous one", "cost", "Resource is using a previous generation", "Review resource configuration for cost"),
    ("Slow cache", "performance", "Cache hit ratio is below", "Review cache configuration"),
    ("Failover", "reliability", "Failover mechanism is not", "Implement redundancy"),
    ("An advantage", "operations", "Resource is missing required tags", "Apply required tags"),
    ("Plain", "operations", "Condition detected: Plain", "Review and update configuration following"),
    (None, None, "Condition detected: ", "Review and update configuration following"),
])
def test_derived_texts(frame, scenario, risk, alert, action):
    rows = frame([recommendation(scenario=scenario, risk_detail=risk)], model.RECOMMENDATION)
    row = rows.select(enrich.derived_alert().alias("alert"), enrich.derived_action().alias("action")).first()
    assert row.alert.startswith(alert) and row.action.startswith(action)


def test_derived_text_tables_are_complete():
    sizes = [len(t) for t in (rule_tables.ALERT_OUTCOMES, rule_tables.ALERT_OUTCOMES_COMPACT,
                              rule_tables.ACTION_OUTCOMES, rule_tables.ACTION_OUTCOMES_COMPACT)]
    # One more outcome each comes from the default.
    assert sizes == [32, 11, 20, 7]
    assert len(rule_tables.SERVICE_RULES) == 28 and len(rule_tables.GENERAL_PATTERNS) == 13


@pytest.mark.parametrize("scenario,risk,priority,expected", [
    ("test", "security", None, (2, 3, 3)), ("test", "cost", None, (2, 1, 3)), ("test", "reliability, cost", None, (2, 1, 3)),
    ("test", "performance", None, (2, 2, 2)), ("enable it", None, 0, (1, 3, 3)), ("migration to enable", "cost", 1, (3, 2, 2)),
    ("x", "security", 3, (2, 1, 1)), ("x", "security", -1, (2, 3, 3)),
])
def test_derived_numbers(frame, scenario, risk, priority, expected):
    rows = frame([recommendation(scenario=scenario, risk_detail=risk, build_priority=priority)], model.RECOMMENDATION)
    assert tuple(rows.select(enrich.derived_effort(), enrich.derived_risk(), enrich.derived_value()).first()) == expected


def test_fill_changes_only_what_is_missing(frame):
    rows = frame([recommendation(id="full"), recommendation(id="blank", alert_criteria=" \n", effort_level=None, risk_value=0)],
                 model.RECOMMENDATION)
    found = {r.id: r for r in enrich.fill_missing(rows).collect()}
    assert not found["full"].modified and found["full"].alert_criteria == "Versioning is off"
    assert found["blank"].modified and found["blank"].risk_value == 0
    # "enabled" contains "enable", so the effort is low.
    assert found["blank"].effort_level == 1
    assert found["blank"].alert_criteria == "Security configuration does not meet best practices"


def test_validation(frame):
    rows = frame([
        recommendation(), recommendation(id="NOT-A-UUID", build_priority=99), recommendation(scenario="", risk_detail=None),
        recommendation(id=None), recommendation(action_value=-1)], model.RECOMMENDATION)
    found = [sorted(r.messages) for r in quality.validity(rows).collect()]
    assert found[0] == []
    assert found[1] == ["Field 'build_priority' value 99 exceeds maximum 3", "Field 'id' does not match UUID format: NOT-A-UUID"]
    assert found[2] == ["Missing required field: risk_detail", "Missing required field: scenario"]
    assert found[3] == ["Missing required field: id"]
    assert found[4] == ["Field 'action_value' value -1 is below minimum 0"]


def test_strict_validation(frame):
    bad = recommendation(
        service_name="Route 53", risk_detail="cost, fun", references=["no link"] * 11, tags=["a", "a"], cve_references=["CVE-1"],
        architectural_patterns=[("", "other", None)], aws_doc_url="nope", compliance_frameworks=["x", "x"])
    good = recommendation(cve_references=["CVE-2024-12"], aws_doc_url="https://d",
                          architectural_patterns=[("Saga", "related_to", None)])
    rows = frame([{**bad, "id": "0" * 8 + "-0000-0000-0000-" + "0" * 12}, good], model.RECOMMENDATION)
    found = [(r.field, r.rule) for r in quality.violations(rows, strict=True).collect()]
    assert sorted(found) == sorted([
        ("service_name", "pattern"), ("risk_detail", "pattern"), ("references", "maxItems"), ("references", "uri"),
        ("tags", "uniqueItems"), ("compliance_frameworks", "uniqueItems"), ("cve_references", "pattern"),
        ("architectural_patterns", "required"), ("architectural_patterns", "enum"), ("aws_doc_url", "pattern")])
    assert quality.violations(rows).count() == 0


def test_type_check(spark):
    entries = [("ok", recommendation()), ("bool", {"build_priority": True, "scenario": None}),
               ("bad", {"scenario": 3, "build_priority": "1", "tags": "x", "metadata": [], "effort_level": 1.5, "other": 1})]
    df = spark.createDataFrame([(n, json.dumps(e)) for n, e in entries], "id string, entry string")
    found = {(r.id, r.field) for r in quality.type_errors(df, "entry").collect()}
    assert found == {("bad", f) for f in ("scenario", "build_priority", "tags", "metadata", "effort_level")}


def test_responses(spark):
    fenced = '```json\n{"id": "a", "build_priority": 2}\n```'
    cases = [fenced, '```\n{"id": "b"}', ' {"id":"c"} ', '{"skip": true}', '{"skip": false, "id": "d"}', "no", "[1]", None, '{"skip": null, "id":"e"}']
    df = spark.createDataFrame([(n, c) for n, c in enumerate(cases)], "n int, response string")
    rows = enrich.parse_responses(df).orderBy("n").collect()
    assert [r.status for r in rows] == ["converted"] * 3 + ["skipped", "converted"] + ["failed"] * 3 + ["converted"]
    assert [r.recommendation.id if r.recommendation else None for r in rows] == ["a", "b", "c", None, "d", None, None, None, "e"]
    assert rows[0].recommendation.build_priority == 2


def test_skip_is_true_by_its_type(spark):
    falsy, truthy = ("false", "null", "0", "0.0", '""', "[]", "{}"), ("true", "1", "-0.5", '"false"', '"0"', "[0]", '{"a": 1}')
    df = spark.createDataFrame([(f'{{"skip": {v}, "id": "x"}}', v in truthy) for v in falsy + truthy], "response string, skip boolean")
    assert all((r.status == "skipped") == r.skip for r in enrich.parse_responses(df).collect())


def test_csv_to_published_table(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        "service_name,scenario,alert_criteria,risk_detail,rec_category,build_priority,effort_level,link_1,link_2,link_3,output (pro / con) \n"
        "general,A DynamoDB table,,Cost,Network,1,x,http://a,TK,https://b,pro\n"
        ",Only a scenario,crit,,,9,2,,,,\n"
        ",,,,,,,,,,\n")
    at = F.to_timestamp(F.lit("2026-02-01 00:00:00"))
    done = curation.curate(files.read_csv(spark, str(tmp_path / "in.csv")), at, "import", "CSV")
    row = done.valid.first()
    assert (row.service_name, row.category, row.build_priority, row.effort_level, row.status) == ("dynamodb", "networking", 1, 2, "open")
    assert row.references == ["http://a", "https://b"] and row.output_notes == "pro"
    assert row.alert_criteria == "Resource cost could be optimized" and row.metadata.contributors == ["import"]
    rejected = done.rejected.first()
    assert rejected.service_name == "general" and rejected.risk_detail == "operations" and [e.rule for e in rejected.errors] == ["maximum"]
    again = curation.curate(files.read_csv(spark, str(tmp_path / "in.csv")), at, "import", "CSV")
    assert again.valid.first().id == row.id
    curation.publish(done.valid, str(tmp_path / "out"))
    assert [r.id for r in files.read_service(spark, str(tmp_path / "out"), "dynamodb").collect()] == [row.id]


def test_orders(frame):
    rows = frame([
        recommendation(id="a", build_priority=None, effort_level=None, risk_detail="cost", action_value=3),
        recommendation(id="b", build_priority=2, effort_level=0, risk_detail="cost", action_value=2),
        recommendation(id="c", build_priority=0, effort_level=1, risk_detail="cost", action_value=3),
        recommendation(id="d", build_priority=2, effort_level=1, risk_detail="cost, security", action_value=2)], model.RECOMMENDATION)
    ids = lambda df: [r.id for r in df.collect()]
    assert ids(ranking.service_listing(rows, "s3")) == ["c", "b", "d", "a"]
    assert ids(ranking.cost_opportunities(rows)) == ["b", "c", "d", "a"]
    assert ids(ranking.cost_opportunities(rows, zero_effort_last=True)) == ["c", "d", "a", "b"]
    assert ids(ranking.by_priority(rows)) == ["c", "b", "d", "a"]
    assert ids(ranking.by_priority(rows, zero_last=True)) == ["b", "d", "a", "c"]
    assert ids(filters.quick_wins(rows)) == ["c"]
    assert ids(filters.search_listing(rows, "VERSION_NG", 2)) == ["a", "b"]
    assert [tuple(r) for r in summaries.by_each_risk(rows).collect()] == [("cost", 4), ("security", 1)]


def test_displays(frame):
    rows = frame([recommendation(scenario="x" * 80, build_priority=None)], model.RECOMMENDATION)
    row = project.service_display(rows).first()
    assert row.priority == "P?" and row.scenario == "x" * 65 + "..."
    block = rows.select(project.context_block().alias("b")).first().b
    assert block.startswith("**S3**: xxx") and block.endswith("Risk: security\n\n")


def test_rules_are_data(frame):
    rows = frame([recommendation(scenario="eins zwei"), recommendation(scenario="zwei drei")], model.RECOMMENDATION)
    rules = (PatternRule("one", (r"\beins\b", "never")), PatternRule("two", ("zwei",)))
    assert [r.classified for r in enrich.classified_service(rows, rules, ()).collect()] == ["one", "two"]
    assert [r.classified for r in enrich.classified_service(rows, rules, ("drei",)).collect()] == ["one", None]
