"""Queries of operators that work on dates, paths, configurations and states, over the given tables."""

import uuid

from pyspark.sql import functions as F

from advisorium.functions import text
from advisorium.operators import enrich, extract, filters, health, joins, project, quality, trigrams
from advisorium.plans.ingest import raw_items as raw_items_of
from advisorium.sources import buckets, files
from advisorium.sources.scratch import scratch_root
from advisorium.streaming import ingest as streaming
from checks.registry import query
from checks.views import ENTRIES_SQL, RAW_ITEMS_SQL, entries, raw_items, seen, table, view, with_views

R = with_views("recs")

# the feed date of an event: two written forms, an ISO form, and one that is none
_PRINTED = """SELECT event_id, ts, CASE event_id % 4 WHEN 0 THEN {day} || ' ' || {clock} || ' GMT' WHEN 1 THEN 'Mon, ' || {day} || ' ' || {clock} || ' +0000'
 WHEN 2 THEN {iso} ELSE 'soon' END AS printed FROM {events}"""
_DUCK = _PRINTED.format(day="strftime(ts, '%-d %b %Y')", clock="strftime(ts, '%H:%M:%S')", iso="strftime(ts, '%Y-%m-%dT%H:%M:%S')", events="events")
_SPARK = _PRINTED.format(day="date_format(ts, 'd MMM yyyy')", clock="date_format(ts, 'HH:mm:ss')",
                         iso="date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")", events="parquet.`{}/events.parquet`")


@query("c12_feed_dates", f"""SELECT event_id, CASE WHEN printed <> 'soon' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS published
FROM ({_DUCK}) p""")
def _feed_dates(spark, sf):
    printed = spark.sql(_SPARK.format(sf))
    return printed.select("event_id", F.date_format(text.feed_date("printed"), "yyyy-MM-dd HH:mm:ss").alias("published"))


@query("c13_as_json", """SELECT doc_id, '{"lang":"' || lang || '","n":' || n_chars || '}' AS about, '["' || lang || '","' || source || '"]' AS tags FROM documents""")
def _as_json(spark, sf):
    return project.as_json(table(spark, sf, "documents").select(
        "doc_id", F.struct("lang", F.col("n_chars").alias("n")).alias("about"), F.array("lang", "source").alias("tags")))


@query("c16_base_name", "SELECT page_id, list_last(string_split(url, '/')) AS name FROM pages")
def _base_name(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.base_name("url").alias("name"))


@query("c17_given", R + """SELECT id, coalesce(category, '') <> '' AS categorised, length(scenario) > 0 AS named,
 CASE WHEN length(scenario) > 40 THEN left(scenario, 40) || '..' ELSE scenario END AS short FROM recs""")
def _given(spark, sf):
    return view(spark, sf, "recs").select(
        "id", text.non_empty("category").alias("categorised"), text.has_items(F.split("scenario", "")).alias("named"),
        text.shorten("scenario", 40).alias("short"))


# sources of the configuration, with some of each fault
_SOURCES = """SELECT CASE WHEN doc_id % 50 = 7 THEN 'shared' ELSE 's' || doc_id END AS id, 'Source ' || doc_id AS name,
 CASE doc_id % 10 WHEN 3 THEN 'ftp' WHEN 4 THEN 'rss' ELSE 'html' END AS type, CASE WHEN doc_id % 12 <> 0 THEN 'https://example.org/' || doc_id END AS url,
 doc_id % 9 AS n_categories, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE doc_id % 7 <> 1 END AS enabled FROM {}"""


def _sources(spark, sf):
    rows = spark.sql(_SOURCES.format(f"parquet.`{sf}/documents.parquet`"))
    return rows.withColumn("categories", F.array_repeat(F.lit("cost"), F.col("n_categories").cast("int")))


@query("f12_enabled_sources", f"SELECT id, name FROM ({_SOURCES.format('documents')}) s WHERE coalesce(enabled, true) AND type = 'rss'")
def _enabled(spark, sf):
    return filters.enabled_sources(_sources(spark, sf), "rss").select("id", "name")


@query("q8_source_errors", f"""WITH s AS ({_SOURCES.format('documents')}),
g AS (SELECT *, array_to_string(list_filter([CASE WHEN url IS NULL THEN 'url' END, CASE WHEN enabled IS NULL THEN 'enabled' END], lambda x: x IS NOT NULL), ', ') AS missing FROM s)
SELECT id, 'missing fields: ' || missing AS message FROM g WHERE missing <> ''
UNION ALL SELECT id, 'invalid type: ' || type FROM g WHERE missing = '' AND type = 'ftp'
UNION ALL SELECT id, '''categories'' must be a non-empty list' FROM g WHERE missing = '' AND n_categories = 0
UNION ALL SELECT id, 'duplicate id: ' || id FROM g WHERE missing = '' GROUP BY id HAVING count(*) > 1""")
def _source_errors(spark, sf):
    return quality.source_errors(_sources(spark, sf)).select("id", "message")


@query("q9_count_mismatches", """SELECT source AS service, count(*) + max(doc_id) % 2 AS count, count(*) AS held FROM documents
GROUP BY source HAVING max(doc_id) % 2 = 1""")
def _mismatches(spark, sf):
    held = table(spark, sf, "documents").groupBy(F.col("source").alias("service")).agg(
        (F.count(F.lit(1)) + F.max("doc_id") % 2).alias("count"), F.collect_list("doc_id").alias("misconfigurations"))
    return quality.count_mismatches(held).select("service", "count", F.col("held").cast("long").alias("held"))


_STATE = """SELECT event_id, CASE event_id % 5 WHEN 0 THEN '{"sources": {"a": 1}}' WHEN 1 THEN '{"other": 1}' WHEN 2 THEN '[1]' WHEN 3 THEN 'broken {' ELSE '{"sources": []}' END AS value FROM {events}"""


@query("h5_state_integrity", """SELECT severity, message, count(*) AS n FROM (SELECT CASE WHEN event_id % 5 IN (0, 4) THEN 'OK' ELSE 'CRITICAL' END AS severity,
 CASE event_id % 5 WHEN 1 THEN 'State file has invalid structure' WHEN 2 THEN 'State file has invalid structure' WHEN 3 THEN 'State file is not valid JSON'
 ELSE 'State file is valid' END AS message FROM events) t GROUP BY 1, 2""")
def _state(spark, sf):
    documents = spark.sql(_STATE.replace("{events}", f"parquet.`{sf}/events.parquet`"))
    return health.state_integrity(documents).groupBy("severity", "message").agg(F.count(F.lit(1)).alias("n"))


@query("u3_insert_if_absent", R + """SELECT id, service_name FROM recs WHERE category IS NOT NULL
UNION ALL SELECT id, min_by(service_name, ord) FROM (SELECT id, 'late' AS service_name, 2 AS ord FROM recs UNION ALL
 SELECT id, 'new', 1 FROM recs WHERE build_priority = 1) n WHERE id NOT IN (SELECT id FROM recs WHERE category IS NOT NULL) GROUP BY id""")
def _insert(spark, sf):
    recs = view(spark, sf, "recs")
    new = recs.select("id", F.lit("late").alias("service_name"), F.lit(2).alias("ord")).unionAll(
        recs.filter("build_priority = 1").select("id", F.lit("new"), F.lit(1)))
    return joins.insert_if_absent(recs.filter("category IS NOT NULL").select("id", "service_name"), new)


@query("e7_record_move", "WITH " + ENTRIES_SQL + """SELECT id, CASE WHEN n % 5 <> 0 THEN '2024-01-01T00:00:00Z' END AS created_at,
 CASE WHEN n % 2 = 0 THEN CASE WHEN n % 5 <> 0 THEN 'reviewer,mover' ELSE 'mover' END WHEN n % 5 <> 0 THEN 'reviewer' END AS people,
 n % 2 = 0 AS updated FROM entries""")
def _moved(spark, sf):
    rows = entries(spark, sf).withColumn("moved", F.col("n") % 2 == 0)
    moved = enrich.record_move(rows, "mover", F.to_timestamp(F.lit("2026-01-05 00:00:00")))
    return moved.select("id", F.col("metadata.created_at").alias("created_at"), F.array_join("metadata.contributors", ",").alias("people"),
                        F.coalesce(F.col("metadata.updated_at").startswith("2026-01-05"), F.lit(False)).alias("updated"))

# Streams ----------------------------------------------------------------------------------------


def _stream(spark, sf_dir, name):
    """The rows of a table as a stream; the pattern matches its file or folder alone."""
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


@query("t2_stream_items", "WITH " + RAW_ITEMS_SQL + "SELECT min(ord) AS ord, source_id, content_hash FROM raw_items GROUP BY source_id, content_hash")
def _stream_items(spark, sf):
    root = f"{scratch_root(spark)}/stream-{uuid.uuid4().hex}"
    items = raw_items_of(_stream(spark, sf, "documents"), "lang", "doc_id", "text").select("source_id", "content_hash", "ord")
    kept = table(spark, sf, "documents").count()  # of a source no hash is pushed out here
    streaming.start_ingest(items, root, f"{root}/check", keep=kept).awaitTermination()
    return spark.read.schema(items.schema).parquet(f"{root}/items").select("ord", "source_id", "content_hash")


@query("t3_stream_counters", with_views("fetch_log").rstrip() + """, e AS (SELECT source_id, max(ts) FILTER (WHERE NOT error) AS success,
 max(ts) FILTER (WHERE error OR items > 0) AS non_empty FROM fetch_log GROUP BY 1)
SELECT source_id, count(*) FILTER (WHERE error AND (success IS NULL OR ts > success)) AS consecutive_errors,
 count(*) FILTER (WHERE NOT error AND items = 0 AND (non_empty IS NULL OR ts > non_empty)) AS consecutive_empty
FROM fetch_log JOIN e USING (source_id) GROUP BY 1""")
def _stream_counters(spark, sf):
    check = f"{scratch_root(spark)}/counters-{uuid.uuid4().hex}"
    kind = F.col("event_type")
    log = _stream(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("source_id"), "ts", kind.isin("error", "click").alias("error"),
        F.when(kind == "purchase", 1).otherwise(0).alias("items"))
    streaming.start_counters(log, check).awaitTermination()
    return streaming.read_counters(spark, check).select("source_id", "consecutive_errors", "consecutive_empty")


# Shapes of sources ------------------------------------------------------------------------------

def _named():
    return F.lit("docs"), F.lit("Documents"), F.array(F.lit("security"))


_HASH = "sha256(lower({0}) || '|' || lower({1}))"
_RULE = "'Rule ' || CAST(doc_id AS VARCHAR)", "'Text ' || md5(text)"


@query("x6_rule_items", f"""SELECT 'docs' AS source_id, {_RULE[0]} AS title, {_RULE[1]} AS body, {_HASH.format(*_RULE)} AS content_hash,
 'yaml' AS file_type, CASE WHEN doc_id % 3 = 0 THEN 'high' END AS severity FROM documents""")
def _rule_items(spark, sf):
    content = F.concat(F.lit("title: Rule "), F.col("doc_id").cast("string"), F.lit("\ndescription: Text "), F.md5("text"),
                       F.when(F.col("doc_id") % 3 == 0, "\nseverity: high\n").otherwise("\n"))
    rules = table(spark, sf, "documents").select(
        F.concat(F.lit("rules/"), F.col("doc_id").cast("string"), F.lit(".yaml")).alias("path"), content.alias("content"), F.lit("https://x").alias("url"))
    items = extract.rule_items(rules, *_named())
    return items.select("source_id", "title", "body", "content_hash", F.col("raw_metadata")["file_type"].alias("file_type"),
                        F.col("raw_metadata")["severity"].alias("severity"))


_FEED = "'Entry ' || CAST(doc_id AS VARCHAR)", "'Text ' || md5(text) || ' & ' || md5(lang)"


@query("x5_feed_items", f"""SELECT {_FEED[0]} AS title, {_FEED[1]} AS body, {_HASH.format(*_FEED)} AS content_hash, lang || ', ' || source AS tags
FROM documents WHERE doc_id % 4 <> 0""")
def _feed_items(spark, sf):
    text_of = F.concat(F.lit("<p>Text <b>"), F.md5("text"), F.lit("</b>\n &amp; "), F.md5("lang"), F.lit("</p>"))
    made = table(spark, sf, "documents").select(
        F.concat(F.lit(" Entry "), F.col("doc_id").cast("string"), F.lit("\n")).alias("title"), F.lit("https://x").alias("link"),
        F.when(F.col("doc_id") % 4 == 0, "too short").otherwise(text_of).alias("description"), F.lit("").alias("content"),
        F.lit(None).cast("string").alias("pubDate"), F.lit(None).cast("string").alias("author"), F.array("lang", "source").alias("category"))
    items = extract.feed_items(made, *_named())
    return items.select("title", "body", "content_hash", F.col("raw_metadata")["tags"].alias("tags"))


@query("q2_type_errors", """SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 5 = 1 THEN 'build_priority' ELSE 'scenario' END AS field
FROM documents WHERE doc_id % 5 IN (1, 2)""")
def _type_errors(spark, sf):
    n = F.col("doc_id") % 5
    value = F.concat(F.lit('{"id": "x", "build_priority": '), F.when(n == 1, '"high"').when(n == 3, "true").otherwise(F.col("doc_id").cast("string")),
                     F.lit(', "scenario": '), F.when(n == 2, F.concat(F.lit("["), F.col("doc_id").cast("string"), F.lit("]")))
                     .when(n == 4, "null").otherwise(F.concat(F.lit('"'), F.md5("text"), F.lit('"'))), F.lit("}"))
    rows = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), value.alias("json"))
    return quality.type_errors(rows, "json").select("id", "field")


@query("e8_csv_entries", """SELECT CASE WHEN doc_id % 5 = 0 THEN 'general' ELSE lang END AS service_name, 'Scenario ' || CAST(doc_id AS VARCHAR) AS scenario,
 CASE WHEN doc_id % 3 = 0 THEN 'done' ELSE 'open' END AS status, CASE WHEN doc_id % 4 = 0 THEN CAST(doc_id % 7 AS INT) END AS build_priority,
 CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END AS links FROM documents""")
def _csv_entries(spark, sf):
    n, word = F.col("doc_id"), F.col("doc_id").cast("string")
    rows = table(spark, sf, "documents").select(
        F.when(n % 5 == 0, " ").otherwise(F.concat(F.lit(" "), "lang", F.lit("\n"))).alias("service_name"),
        F.concat(F.lit("Scenario "), word, F.lit(" ")).alias("scenario"), F.when(n % 3 == 0, "done").otherwise("TK").alias("status"),
        F.when(n % 4 == 0, (n % 7).cast("string")).otherwise("many").alias("build_priority"),
        F.when(n % 2 == 0, "https://example.org/a").otherwise("none").alias("link_1"), F.lit("").alias("link_2"))
    made = enrich.entries_from_csv(rows, F.to_timestamp(F.lit("2024-01-31 00:00:00")), "import", "file")
    return made.select("service_name", "scenario", "status", "build_priority", F.size("references").alias("links"))


@query("s7_read_pages", "SELECT page_id, url, md5(html) AS html_md5 FROM pages")
def _read_pages(spark, sf):
    return files.read_pages(spark, f"{sf}/pages.parquet").select("page_id", "url", F.md5(F.col("html").cast("binary")).alias("html_md5"))


@query("s3_read_service", R + "SELECT id, scenario, risk_detail FROM recs WHERE service_name = 'de'")
def _read_service(spark, sf):
    from advisorium.sources import writers

    path = f"{scratch_root(spark)}/services-{uuid.uuid4().hex}"
    writers.write_by_service(view(spark, sf, "recs"), path)
    return files.read_service(spark, path, "de").select("id", "scenario", "risk_detail")


# Histories and indexes --------------------------------------------------------------------------


@query("j4_bucketed_history", "WITH " + RAW_ITEMS_SQL + """SELECT ord, i.source_id, i.content_hash FROM raw_items i
WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.source_id = i.source_id AND s.content_hash = i.content_hash)""")
def _bucketed_history(spark, sf):
    keys, path = ["source_id", "content_hash"], f"{scratch_root(spark)}/history-{uuid.uuid4().hex}"
    history = seen(spark, sf)
    buckets.append(history, path, keys, 8)
    return joins.unseen(raw_items(spark, sf), buckets.opened(spark, path, history.schema, keys, 8)).select("ord", *keys)


_HOLDS = "contains(lower(scenario), '{0}') OR contains(lower(recommendation_description_detailed), '{0}') OR contains(lower(recommendation_action), '{0}')"


@query("f6_indexed_search", R + "SELECT id, 'there' AS term FROM recs WHERE " + _HOLDS.format("there")
       + " UNION ALL SELECT id, 'th' FROM recs WHERE " + _HOLDS.format("th"))
def _indexed_search(spark, sf):
    rows, path = view(spark, sf, "recs"), f"{scratch_root(spark)}/trigrams-{uuid.uuid4().hex}"
    trigrams.write_index(rows, path)
    found = lambda term: trigrams.search(rows, path, term).select("id", F.lit(term.lower()).alias("term"))
    return found("THERE").unionByName(found("th"))
