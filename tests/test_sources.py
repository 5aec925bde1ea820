"""Readers and writers on small files."""

import json

import pytest
from pyspark.sql import functions as F

from advisorium import model
from advisorium.operators import extract, filters, project, quality
from advisorium.sources import files, writers
from tests.conftest import recommendation


@pytest.fixture
def catalog_dir(tmp_path):
    folder = tmp_path / "catalog"
    folder.mkdir()
    entries = [recommendation(), recommendation(id="2" * 8 + "-2222-3333-4444-555555555555", scenario="Second")]
    (folder / "s3.json").write_text(json.dumps({"service": "s3", "count": 2, "misconfigurations": entries}, indent=1))
    (folder / "none.json").write_text(json.dumps({"service": "none"}))
    (folder / "notes.txt").write_text("not a catalogue")
    return folder


def test_catalog_scan_keeps_order_and_ignores_other_files(spark, catalog_dir):
    rows = files.read_catalog(spark, str(catalog_dir)).orderBy("file_name", "pos").collect()
    assert [(r.file_name, r.pos, r.scenario) for r in rows] == [
        ("s3.json", 0, "Bucket versioning is not enabled"), ("s3.json", 1, "Second")]
    assert rows[0].metadata.contributors == ["someone"] and rows[0].detection_methods is None


def test_missing_folder_is_empty(spark, tmp_path):
    assert files.read_catalog(spark, str(tmp_path / "nowhere")).count() == 0


def test_any_shape(spark, tmp_path):
    (tmp_path / "wrapped.json").write_text(json.dumps({"misconfigurations": [recommendation(scenario="a")]}))
    (tmp_path / "list.json").write_text(json.dumps([recommendation(scenario="b"), recommendation(scenario="c")]))
    (tmp_path / "single.json").write_text(json.dumps(recommendation(scenario="d")))
    rows = files.read_any_shape(spark, str(tmp_path)).collect()
    assert sorted((r.file_name, r.scenario) for r in rows) == [
        ("list.json", "b"), ("list.json", "c"), ("single.json", "d"), ("wrapped.json", "a")]


def test_envelope_count_check(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"service": "a", "count": 1, "misconfigurations": [recommendation()]}))
    (tmp_path / "b.json").write_text(json.dumps({"service": "b", "count": 3, "misconfigurations": [recommendation()]}))
    rows = quality.count_mismatches(files.read_envelopes(spark, str(tmp_path))).collect()
    assert [(r.service, r["count"], r.held) for r in rows] == [("b", 3, 1)]


def test_csv_scan(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        'service_name,scenario,risk_detail,rec_category,build_priority,link_1,link_2,link_3,output (pro / con) \n'
        's3,"Has a ""quote"", a comma\nand a line",,Network,1,http://a,TK,https://b,pro\n'
        ',,,,,,,,\n'
        'tk,TK,cost,,,,,,\n'
        ',Only a scenario,"Cost ,Security",Odd Name ,x,,,,\n')
    rows = files.read_csv(spark, str(tmp_path / "in.csv"))
    assert rows.count() == 2


def test_sources(spark, tmp_path):
    source = {"id": "a", "name": "A", "type": "rss", "url": "http://x", "categories": ["cost"], "enabled": True,
              "fetch_config": {"max_items": 5}}
    config = {"version": "1", "sources": [
        source, {**source, "id": "b", "type": "html", "enabled": False}, {**source, "id": "c", "type": "ftp"},
        {**source, "id": "d", "categories": []}, source, {"id": "e", "name": "E"}]}
    (tmp_path / "sources.json").write_text(json.dumps(config))
    sources = files.read_sources(spark, str(tmp_path / "sources.json"))
    assert sources.filter("id = 'a'").first().fetch_config.max_items == 5
    assert sorted(r.id for r in filters.enabled_sources(sources).collect()) == ["a", "a", "c", "d", "e"]
    assert [r.id for r in filters.enabled_sources(sources, "rss", ["d", "b"]).collect()] == ["d"]
    found = {(r.id, r.rule): r.message for r in quality.source_errors(sources).collect()}
    assert set(found) == {("a", "duplicate"), ("c", "type"), ("d", "empty"), ("e", "fields")}
    assert found["e", "fields"] == "missing fields: type, url, categories, enabled"


FEED = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0"><channel><title>Feed</title>{items}</channel></rss>"""
ITEM = ("<item><title>Item {n}</title><link>https://e.org/{n}</link><description>{body}</description>"
        "<pubDate>Wed, 15 Jan 2025 10:00:00 GMT</pubDate><category>One</category><category>Two</category></item>")


def test_feed_scan_and_cap(spark, tmp_path):
    (tmp_path / "a.xml").write_text(FEED.format(items="".join(ITEM.format(n=n, body="x" * 60) for n in range(7))))
    (tmp_path / "b.xml").write_text(FEED.format(items=ITEM.format(n=9, body="short")))
    rows = files.read_feeds(spark, str(tmp_path), max_items=5).collect()
    by_feed = sorted((r.feed[-5:], r.title) for r in rows)
    assert by_feed == [("a.xml", f"Item {n}") for n in range(5)] + [("b.xml", "Item 9")]
    assert rows[0].category == ["One", "Two"]


ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>F</title>
<entry><title type="html">An &lt;b&gt;entry&lt;/b&gt;</title><link rel="self" href="https://e.org/self"/><link href="https://e.org/1"/>
<summary>short</summary><content type="html">&lt;p&gt;{body}&lt;/p&gt;</content><updated>2025-01-15T10:00:00Z</updated>
<author><name>Ann</name></author><category term="x"/><category term="y"/></entry></feed>"""
FULL = ("<rss xmlns:content='c' xmlns:dc='d'><channel><item><title>T</title><link>https://e.org/2</link><description>d</description>"
        "<content:encoded><![CDATA[<p>{body}</p>]]></content:encoded><dc:creator>Bob</dc:creator></item></channel></rss>")


def test_both_kinds_of_feed(spark, tmp_path):
    (tmp_path / "atom.xml").write_text(ATOM.format(body="a" * 60))
    (tmp_path / "full.xml").write_text(FULL.format(body="b" * 60))
    rows = files.read_feeds(spark, str(tmp_path))
    items = {i.title: i for i in extract.feed_items(rows, F.col("feed"), F.lit("S"), F.array(F.lit("cost"))).collect()}
    atom, full = items["An <b>entry</b>"], items["T"]
    assert (atom.url, atom.body, atom.published_at) == ("https://e.org/1", "a" * 60, "2025-01-15T10:00:00Z")
    assert atom.raw_metadata == {"tags": "x, y", "author": "Ann"}
    assert (full.url, full.body, full.raw_metadata["author"]) == ("https://e.org/2", "b" * 60, "Bob")


def test_rule_file_scan(spark, tmp_path):
    root = tmp_path / "repo"
    (root / "rules" / "deep").mkdir(parents=True)
    (root / "rules" / "b.yaml").write_text("name: b")
    (root / "rules" / "deep" / "a.yaml").write_text("name: a")
    (root / "rules" / "c.json").write_text("{}")
    (root / "other.yaml").write_text("name: other")
    rows = files.read_rule_files(spark, str(root), "*.yaml", "rules/")
    assert sorted(r.path for r in rows.collect()) == ["rules/b.yaml", "rules/deep/a.yaml"]
    assert [r.path for r in files.read_rule_files(spark, str(root), "*.yaml", "rules/", max_files=1).collect()] == ["rules/b.yaml"]


def test_staged_scan_skips_broken_files(spark, tmp_path):
    record = {"staged_at": "t", "source_id": "s", "dedup_score": 0.1234, "closest_existing": "c",
              "recommendation": recommendation()}
    (tmp_path / "one.json").write_text(json.dumps(record))
    (tmp_path / "two.json").write_text(json.dumps({**record, "recommendation": {"scenario": "no id"}}))
    (tmp_path / "three.json").write_text("{ broken")
    rows = files.read_staged(spark, str(tmp_path)).orderBy("id").collect()
    assert [(r.id, r.scenario) for r in rows] == [
        ("11111111-2222-3333-4444-555555555555", "Bucket versioning is not enabled"), ("two", "no id")]
    assert files.read_staged(spark, str(tmp_path / "none")).count() == 0


def test_table_build_replaces_and_rejects_repeated_ids(spark, frame, tmp_path):
    path = str(tmp_path / "table")
    writers.build_table(frame([recommendation(), recommendation(id="x")], model.RECOMMENDATION), path)
    writers.build_table(frame([recommendation()], model.RECOMMENDATION), path)
    table = spark.read.parquet(path)
    assert table.count() == 1 and len(table.columns) == 25
    row = table.first()
    assert row.created_at == "2026-01-01T00:00:00Z" and row.contributors == ["someone"] and row.detection_methods == []
    with pytest.raises(writers.RepeatedIds):
        writers.build_table(frame([recommendation(), recommendation()], model.RECOMMENDATION), path)
    assert spark.read.parquet(path).count() == 1


def test_partitioned_tables(spark, frame, tmp_path):
    rows = frame([recommendation(id="a", service_name="ALB/ELB", risk_detail="cost, security"),
                  recommendation(id="b", service_name="s3", category=None)], model.RECOMMENDATION)
    writers.write_by_service(rows, str(tmp_path / "services"))
    assert [r.id for r in files.read_service(spark, str(tmp_path / "services"), "ALB/ELB").collect()] == ["a"]
    plan = files.read_service(spark, str(tmp_path / "services"), "s3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(service_key" in plan
    writers.write_by_category(rows, str(tmp_path / "categories"))
    groups = spark.read.parquet(str(tmp_path / "categories")).select("group_key", "id").collect()
    assert sorted(map(tuple, groups)) == [("cost", "a"), ("security", "a"), ("security", "b"), ("storage", "a")]


def test_envelopes_are_ordered_rows_of_any_number(spark, frame, tmp_path):
    rows = frame([recommendation(id=f"{n:03}") for n in range(50)] + [recommendation(id="z", service_name="iam"), recommendation(id="y", service_name=None)],
                 model.RECOMMENDATION)
    found = writers.envelope_entries(rows).collect()
    assert sorted((r.service or "", r.position, r.entry.id) for r in found) == sorted(
        [("iam", 0, "z"), ("", 0, "y"), *[("s3", n, f"{n:03}") for n in range(50)]])
    writers.write_envelopes(rows.repartition(7), str(tmp_path / "out"))
    headers = spark.read.json(str(tmp_path / "out" / "headers")).collect()
    assert sorted((r.service or "", r["count"]) for r in headers) == [("", 1), ("iam", 1), ("s3", 50)] or len(headers) == 3
    whole = writers.read_envelope(spark, str(tmp_path / "out"), "s3", model.RECOMMENDATION).collect()
    assert [(r.position, r.entry.id) for r in whole] == [(n, f"{n:03}") for n in range(50)]
    assert whole[7].entry.metadata.contributors == ["someone"] and whole[7].entry.references == ["https://example.org/versioning"]


def test_context_blocks_follow_each_other(frame):
    rows = frame([recommendation(id=f"{n:03}", scenario="x" * (n % 9)) for n in range(60)] + [recommendation(id="a", service_name="iam")], model.RECOMMENDATION)
    found = project.service_contexts(rows, "Use:").collect()
    for service in ("s3", "iam"):
        text = "Use:"
        for r in sorted((r for r in found if r.service_name == service), key=lambda r: r.position):
            assert r.offset == len(text)
            text += r.block


def test_exports(spark, frame, tmp_path):
    rows = project.flatten(frame([recommendation(scenario='say "hi",\nbye')], model.RECOMMENDATION))
    writers.export_csv(rows, str(tmp_path / "csv"))
    back = spark.read.csv(str(tmp_path / "csv"), header=True, multiLine=True, escape='"').first()
    assert back.scenario == 'say "hi",\nbye' and json.loads(back.tags) == ["versioning", "s3"]
    findings = frame([{"rule_id": "r", "resource_id": "x", "details": {"a": "1"}}], model.FINDING)
    writers.write_findings(findings, str(tmp_path / "report"), "2026-01-01")
    assert spark.read.json(str(tmp_path / "report" / "summary")).first().total_findings == 1
    assert spark.read.json(str(tmp_path / "report" / "findings")).first().details.a == "1"
    writers.append_staged(rows.select("id"), str(tmp_path / "staged"))
    writers.append_staged(rows.select("id"), str(tmp_path / "staged"))
    assert spark.read.parquet(str(tmp_path / "staged")).count() == 2


def test_flat_table_extra_fields(frame):
    rows = frame([recommendation(aws_doc_url="https://d", metadata=None)], model.RECOMMENDATION)
    flat = project.flatten(rows, extra=True)
    assert len(flat.columns) == 29
    row = flat.first()
    assert row.aws_doc_url == "https://d" and row.created_at is None and row.contributors == []
    assert flat.filter(F.col("references").isNull()).count() == 0
