"""Catalogue queries: projections, filters, counts, listings, set operations."""

from pyspark.sql import functions as F

from advisorium.functions import text
from advisorium.operators import filters, joins, project, ranking, summaries
from advisorium.sources import writers
from checks.registry import query
from checks.views import ENTRIES_SQL, entries, table, view, with_views

R = with_views("recs")
E = "WITH " + ENTRIES_SQL


def recs(spark, sf):
    return view(spark, sf, "recs")


def simple(name, sql, run):
    query(name, R + sql)(lambda spark, sf: run(recs(spark, sf)))


# Scans and sinks ------------------------------------------------------------------------------

simple("s3_single_service", "SELECT id, scenario, risk_detail FROM recs WHERE service_name = 'de'",
       lambda df: filters.in_services(df, "de").select("id", "scenario", "risk_detail"))
simple("k2_service_counts", "SELECT service_name AS service_key, count(*) AS count FROM recs GROUP BY 1",
       writers.service_counts)
simple("k2_service_envelopes", """SELECT service_name AS service, row_number() OVER (PARTITION BY service_name ORDER BY id) - 1 AS position,
       count(*) OVER (PARTITION BY service_name) AS count, id, scenario, alert_criteria, recommendation_action,
       recommendation_description_detailed, risk_detail, build_priority, effort_level, action_value, risk_value, category FROM recs""",
       lambda df: writers.envelope_entries(df).join(
           df.groupBy(F.col("service_name").alias("service")).agg(F.count(F.lit(1)).alias("count")), "service").select(
           "service", "position", "count", "entry.id", "entry.scenario", "entry.alert_criteria", "entry.recommendation_action",
           "entry.recommendation_description_detailed", "entry.risk_detail", "entry.build_priority", "entry.effort_level",
           "entry.action_value", "entry.risk_value", "entry.category"))
_GROUPS = """, g AS (SELECT DISTINCT id, name FROM (SELECT id, category AS name FROM recs UNION ALL
 SELECT id, trim(unnest(string_split(risk_detail, ','))) FROM recs) t WHERE name IS NOT NULL AND name <> '')
"""
simple("k3_category_rows", _GROUPS + "SELECT id, name AS \"group\" FROM g",
       lambda df: writers.category_rows(df).select("id", "group"))
simple("k4_catalog_index", _GROUPS + """SELECT 'total' AS kind, 'all' AS name, count(*) AS n FROM recs
UNION ALL SELECT 'service', service_name, count(*) FROM recs GROUP BY 2
UNION ALL SELECT 'category', name, count(*) FROM g GROUP BY 2""", writers.catalog_index)

# Projections ----------------------------------------------------------------------------------


@query("p1_flatten", E + """SELECT id, service_name, scenario, alert_criteria, recommendation_action, risk_detail, build_priority,
 action_value, effort_level, risk_value, recommendation_description_detailed, category,
 CASE WHEN n % 5 <> 0 THEN '2024-01-01T00:00:00Z' END AS created_at, CASE WHEN n % 5 <> 0 THEN src END AS source,
 array_to_string(refs, ',') AS refs, array_to_string(tags, ',') AS tag_list, array_to_string(methods, ',') AS methods,
 array_to_string(patterns, ',') AS patterns, CASE WHEN n % 5 <> 0 THEN 'reviewer' ELSE '' END AS people FROM entries""")
def _flatten(spark, sf):
    join = lambda c, name: F.array_join(c, ",").alias(name)
    return project.flatten(entries(spark, sf)).select(
        "id", "service_name", "scenario", "alert_criteria", "recommendation_action", "risk_detail", "build_priority",
        "action_value", "effort_level", "risk_value", "recommendation_description_detailed", "category", "created_at",
        "source", join("references", "refs"), join("tags", "tag_list"), join("detection_methods.method", "methods"),
        join("architectural_patterns.pattern_name", "patterns"), join("contributors", "people"))


simple("p2_comparison_text", """SELECT id, concat_ws(' ', nullif(scenario, ''), nullif(alert_criteria, ''), nullif(recommendation_action, ''),
 nullif(recommendation_description_detailed, '')) AS text FROM recs""",
       lambda df: df.select("id", project.comparison_text().alias("text")))
_CLASS_TEXT = """lower(coalesce(scenario, '') || ' ' || coalesce(alert_criteria, '') || ' ' || coalesce(recommendation_action, '')
 || ' ' || coalesce(recommendation_description_detailed, ''))"""
simple("p3_classification_text", f"SELECT id, {_CLASS_TEXT} AS text FROM recs",
       lambda df: df.select("id", project.classification_text(project.COMPARED).alias("text")))
_LABEL = "CASE build_priority WHEN 0 THEN 'critical' WHEN 1 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END"
simple("p4_priority_label", f"SELECT id, {_LABEL} AS priority FROM recs",
       lambda df: df.select("id", project.priority_label().alias("priority")))
simple("p5_insight_rows", f"""SELECT id, 'cost_optimization' AS category, 'cloud:' || service_name AS resource_type, scenario AS title,
 recommendation_action AS recommendation, {_LABEL} AS priority, 'catalogue' AS source FROM recs WHERE risk_detail LIKE '%cost%'""",
       lambda df: project.insight_rows(filters.risk_contains(df, "cost"), "cost_optimization", "cloud", "catalogue"))


@query("p6_detector_rules", E + """SELECT id, 'check-' || service_name || '-check' AS rule_name, left(scenario, 256) AS description,
 'CUSTOM' AS owner, 'checker' AS identifier, alert_criteria, 'rule ' || id AS detection_details
FROM entries WHERE list_contains(methods, 'CloudWatch Metric') AND alert_criteria <> ''""")
def _detectors(spark, sf):
    rules = project.detector_rules(entries(spark, sf), "CloudWatch Metric", "check", "CUSTOM", "checker")
    field = lambda n: F.get_json_object("input_parameters", f"$.{n}").alias(n)
    return rules.select("id", "rule_name", "description", "owner", "identifier",
                        field("alert_criteria"), field("detection_details"))


_BLOCK = """'**' || upper(service_name) || '**: ' || scenario || chr(10) || 'Action: ' || recommendation_action || chr(10)
 || 'Risk: ' || risk_detail || chr(10) || chr(10)"""
simple("p7_context_blocks", f"SELECT id, {_BLOCK} AS block FROM recs WHERE service_name IN ('en', 'fr') AND build_priority <= 1",
       lambda df: filters.priority_at_most(filters.in_services(df, "en", "fr"), 1).select("id", project.context_block().alias("block")))
simple("p7_service_contexts", f"""SELECT service_name, row_number() OVER w - 1 AS position, block,
 CAST(10 + coalesce(sum(length(block)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset
FROM (SELECT id, service_name, {_BLOCK} AS block FROM recs) b WINDOW w AS (PARTITION BY service_name ORDER BY id)""".replace(
           "OVER (w ROWS", "OVER (PARTITION BY service_name ORDER BY id ROWS"),
       lambda df: project.service_contexts(df, "Use these:"))
simple("p8_question_answers", """SELECT id AS conv_id, 0 AS turn, 'user' AS role,
 'I use ' || service_name || '. Are there any issues with: ' || scenario || '?' AS text FROM recs
UNION ALL SELECT id, 1, 'assistant', 'Based on best practices, this configuration has the following issue: ' || scenario || '.' || chr(10)
 || 'Risk Type: ' || risk_detail || chr(10) || 'Severity: ' || coalesce(CAST(risk_value AS VARCHAR), '') || chr(10) || 'Recommendation: '
 || recommendation_action || chr(10) || 'Detailed Explanation: ' || recommendation_description_detailed FROM recs""",
       project.question_answers)
simple("p10_display_truncation", """SELECT id, service_name, CASE WHEN length(scenario) > 70 THEN left(scenario, 70) || '...' ELSE scenario END AS scenario,
 risk_detail FROM recs""", project.search_display)
simple("p11_priority_display", """SELECT id, 'P' || coalesce(CAST(build_priority AS VARCHAR), '?') AS priority,
 CASE WHEN length(scenario) > 65 THEN left(scenario, 65) || '...' ELSE scenario END AS scenario, risk_detail FROM recs""",
       project.service_display)

# Filters --------------------------------------------------------------------------------------


def listed(name, where, keep):
    """A filter query; the comparison lists the ids and a few columns."""
    sql = f"SELECT id, service_name, risk_detail, build_priority FROM recs WHERE {where}"
    simple(name, sql, lambda df: keep(df).select("id", "service_name", "risk_detail", "build_priority"))


listed("f1_risk_contains", "risk_detail LIKE '%security%'", lambda df: filters.risk_contains(df, "security"))
listed("f1_has_risk", "list_contains(string_split(risk_detail, ', '), 'cost')", lambda df: filters.has_risk(df, "cost"))
listed("f2_priority_at_most", "build_priority <= 1", lambda df: filters.priority_at_most(df, 1))
listed("f3_in_services", "service_name IN ('fr', 'es')", lambda df: filters.in_services(df, "fr", "es"))
simple("f4_search_listing", """SELECT id, service_name, scenario, risk_detail FROM recs
WHERE scenario ILIKE '%nat%' OR recommendation_action ILIKE '%nat%' ORDER BY id LIMIT 20""",
       lambda df: filters.search_listing(df, "nat"))
listed("f5_search_text", "contains(lower(scenario), 'tion') OR contains(lower(recommendation_description_detailed), 'tion')",
       lambda df: filters.search_text(df, "TION"))
listed("f6_search_three_fields", """contains(lower(scenario), 'here') OR contains(lower(recommendation_description_detailed), 'here')
 OR contains(lower(recommendation_action), 'here')""",
       lambda df: filters.search_text(df, "here", ("scenario", "recommendation_description_detailed", "recommendation_action")))
listed("f7_faceted", """service_name = 'en' AND risk_detail LIKE '%cost%' AND build_priority = 2 AND
 (contains(lower(scenario), 'th') OR contains(lower(recommendation_description_detailed), 'th') OR contains(lower(recommendation_action), 'th'))""",
       lambda df: filters.faceted(df, "en", "cost", 2, "th"))
listed("f8_non_empty", "alert_criteria <> ''", lambda df: filters.with_text(df, "alert_criteria"))


@query("f8_with_items", E + "SELECT id, len(methods) AS n FROM entries WHERE len(methods) > 0")
def _with_items(spark, sf):
    return filters.with_items(entries(spark, sf), "detection_methods").select("id", F.size("detection_methods").alias("n"))


listed("f9_security_critical", "risk_detail LIKE '%security%' AND risk_value >= 2", filters.security_critical)
listed("f10_quick_wins", "coalesce(build_priority, 99) <= 1 AND coalesce(effort_level, 99) <= 1", filters.quick_wins)
listed("f11_urgent_cost", "risk_detail LIKE '%cost%' AND build_priority = 0", filters.urgent_cost)


@query("f11_security_with_remediation", E + "SELECT id, scenario FROM entries WHERE risk_detail LIKE '%security%' AND n_remediation > 0")
def _with_remediation(spark, sf):
    return filters.security_with_remediation(entries(spark, sf)).select("id", "scenario")


listed("f14_blank", "regexp_replace(coalesce(alert_criteria, ''), '\\s', '', 'g') = ''",
       lambda df: filters.blank_rows(df, "alert_criteria"))

# Joins and set operations ----------------------------------------------------------------------


@query("j1_unnest_methods", E + "SELECT id, unnest(methods) AS method FROM entries")
def _unnest(spark, sf):
    return joins.unnest(entries(spark, sf), "detection_methods", "m", "id").select("id", "m.method")


simple("j5_insert_if_absent", """SELECT id, 'old' AS origin FROM recs WHERE category IS NOT NULL
UNION ALL SELECT id, 'new' FROM recs WHERE category IS NULL AND risk_detail LIKE '%o%'""",
       lambda df: joins.insert_if_absent(
           df.filter("category IS NOT NULL").select("id", F.lit("old").alias("origin")),
           filters.risk_contains(df, "o").unionByName(filters.risk_contains(df, "cost")).select(
               "id", F.lit("new").alias("origin"), F.col("id").cast("long").alias("ord"))))


@query("j8_risk_coverage", with_views("recs", "sources_v") + """, k AS (SELECT unnest(['cost','security','operations','performance','reliability']) AS risk),
e AS (SELECT trim(unnest(string_split(risk_detail, ','))) AS risk FROM recs), s AS (SELECT trim(unnest(string_split(categories, ','))) AS risk FROM sources_v)
SELECT risk, (SELECT count(*) FROM e WHERE e.risk = k.risk) AS entries, (SELECT count(*) FROM s WHERE s.risk = k.risk) AS sources FROM k""")
def _coverage(spark, sf):
    sources = view(spark, sf, "sources_v").withColumn("categories", text.risks_of("categories"))
    return joins.risk_coverage(recs(spark, sf), sources)


@query("u1_concatenate", R + "SELECT id, scenario FROM recs UNION ALL SELECT CAST(item_id AS VARCHAR), text FROM benchmark")
def _concatenate(spark, sf):
    more = table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("id"), F.col("text").alias("scenario"))
    return recs(spark, sf).select("id", "scenario").unionByName(more)


simple("u5_distinct_categories", "SELECT DISTINCT category FROM recs WHERE category IS NOT NULL",
       lambda df: df.filter("category IS NOT NULL").select("category").distinct())

# Counts -----------------------------------------------------------------------------------------

simple("a1_by_service", "SELECT service_name, count(*) AS n FROM recs GROUP BY 1", summaries.by_service)
simple("a2_by_category", "SELECT category, count(*) AS n FROM recs WHERE category IS NOT NULL GROUP BY 1", summaries.by_category)
simple("a3_by_priority", "SELECT build_priority, count(*) AS n FROM recs WHERE build_priority IS NOT NULL GROUP BY 1", summaries.by_priority)
simple("a4_by_risk_bucket", """SELECT CASE WHEN risk_detail LIKE '%cost%' THEN 'cost' WHEN risk_detail LIKE '%security%' THEN 'security'
 WHEN risk_detail LIKE '%performance%' THEN 'performance' WHEN risk_detail LIKE '%reliability%' THEN 'reliability'
 WHEN risk_detail LIKE '%operations%' THEN 'operations' ELSE 'other' END AS risk_type, count(*) AS n FROM recs GROUP BY 1""",
       summaries.by_risk_bucket)
simple("a5_by_each_risk", "SELECT trim(unnest(string_split(risk_detail, ','))) AS risk_type, count(*) AS n FROM recs GROUP BY 1",
       summaries.by_each_risk)
_STATS = """SELECT 'total' AS dimension, 'entries' AS key, count(*) AS n FROM recs
UNION ALL SELECT 'service', coalesce(service_name, 'unknown'), count(*) FROM recs GROUP BY 2
UNION ALL SELECT 'category', category, count(*) FROM recs WHERE category <> '' GROUP BY 2
UNION ALL SELECT 'priority', CAST(build_priority AS VARCHAR), count(*) FROM recs WHERE build_priority IS NOT NULL GROUP BY 2
UNION ALL SELECT 'risk', trim(unnest(string_split(risk_detail, ','))), count(*) FROM recs GROUP BY 2"""
simple("a6_statistics", _STATS, summaries.statistics)
simple("o6_ordered_statistics", _STATS, summaries.ordered_statistics)
simple("a7_risky_services", "SELECT service_name, count(*) AS n FROM recs WHERE risk_detail LIKE '%security%' GROUP BY 1",
       lambda df: summaries.risky_services(df, "security"))


@query("a8_by_pattern", E + "SELECT unnest(patterns) AS pattern_name, count(*) AS n FROM entries GROUP BY 1")
def _by_pattern(spark, sf):
    return summaries.by_pattern(entries(spark, sf))


simple("a9_import_summary", """, s AS (SELECT *, CASE WHEN build_priority = 0 THEN 'open' WHEN build_priority = 1 THEN 'done' END AS status FROM recs)
SELECT 'total_entries' AS dimension, 'all' AS key, count(*) AS n FROM s
UNION ALL SELECT 'total_services', 'all', count(DISTINCT service_name) FROM s
UNION ALL SELECT 'status', coalesce(status, 'unknown'), count(*) FROM s GROUP BY 2
UNION ALL SELECT 'service', service_name, count(*) FROM s GROUP BY 2
UNION ALL SELECT 'risk', trim(unnest(string_split(risk_detail, ','))), count(*) FROM s GROUP BY 2""",
       lambda df: summaries.import_summary(df.withColumn(
           "status", F.when(F.col("build_priority") == 0, "open").when(F.col("build_priority") == 1, "done"))))
simple("a16_total", "SELECT count(*) AS n FROM recs", summaries.total)

# Listings ---------------------------------------------------------------------------------------

simple("o1_service_listing", "SELECT id, scenario, risk_detail, build_priority FROM recs WHERE service_name = 'en'",
       lambda df: ranking.service_listing(df, "en"))
simple("o2_top_services", "SELECT service_name, count(*) AS n FROM recs GROUP BY 1 ORDER BY n DESC, service_name LIMIT 10",
       ranking.top_services)


def ranked(name, where, run):
    """An ordered listing; the comparison ignores order, the tests check it."""
    simple(name, f"SELECT id, effort_level, action_value FROM recs WHERE {where}",
           lambda df: run(df).select("id", "effort_level", "action_value"))


_COST = "risk_detail LIKE '%cost%' AND action_value >= 2"
ranked("o3_cost_opportunities", _COST, ranking.cost_opportunities)
ranked("o4_cost_opportunities_zero_last", _COST,
       lambda df: ranking.cost_opportunities(df, zero_effort_last=True))
ranked("o5_by_priority", "true", ranking.by_priority)
simple("o7_distinct_services", "SELECT DISTINCT service_name FROM recs", ranking.distinct_services)

# Scalar functions -------------------------------------------------------------------------------

simple("c1_clean_text", """SELECT id, CASE WHEN upper(trim(alert_criteria, chr(9)||chr(10)||chr(13)||' ')) NOT IN ('', 'TK')
 THEN trim(alert_criteria, chr(9)||chr(10)||chr(13)||' ') END AS cleaned FROM recs""",
       lambda df: df.select("id", text.clean_text("alert_criteria").alias("cleaned")))
simple("c2_safe_int", "SELECT id, build_priority AS padded, CAST(NULL AS INT) AS decimal, CAST(id AS INT) AS plain FROM recs",
       lambda df: df.select("id", text.safe_int(F.concat(F.lit(" "), F.col("build_priority").cast("string"), F.lit("\t"))).alias("padded"),
                            text.safe_int(F.concat("id", F.lit(".5"))).alias("decimal"), text.safe_int("id").alias("plain")))
simple("c3_storage_key", """SELECT id, CASE WHEN scenario = '' THEN 'unknown' ELSE lower(regexp_replace(translate(scenario, '/\\ ', '---'),
 '[^\\p{L}\\p{N}_.-]', '', 'g')) END AS key FROM recs""",
       lambda df: df.select("id", text.storage_key("scenario").alias("key")))
simple("c4_normalise_risk", """SELECT id, CASE WHEN coalesce(category, '') = '' THEN 'operations'
 ELSE array_to_string(list_transform(string_split(lower(trim(category || ' , ' || risk_detail)), ','), lambda x: trim(x)), ', ') END AS risk FROM recs""",
       lambda df: df.select("id", text.normalise_risk(F.concat("category", F.lit(" , "), "risk_detail")).alias("risk")))
simple("c5_normalise_category", """SELECT id, CASE lower(c) WHEN 'network' THEN 'networking' WHEN 'storage' THEN 'storage' ELSE c END AS category
FROM (SELECT id, trim(CASE build_priority WHEN 0 THEN ' Network' WHEN 1 THEN 'STORAGE ' ELSE category END) AS c FROM recs) t""",
       lambda df: df.select("id", text.normalise_category(
           F.when(F.col("build_priority") == 0, " Network").when(F.col("build_priority") == 1, "STORAGE ")
           .otherwise(F.col("category"))).alias("category")))
simple("c6_http_links", """SELECT id, array_to_string(list_filter([CASE WHEN effort_level = 1 THEN 'http://a/' || id END, trim(alert_criteria, chr(10)||' '),
 CASE WHEN risk_value = 2 THEN 'https://b/' || id END], lambda x: x LIKE 'http%'), ' ') AS links FROM recs""",
       lambda df: df.select("id", F.array_join(text.http_links(
           F.when(F.col("effort_level") == 1, F.concat(F.lit(" http://a/"), "id")), F.col("alert_criteria"),
           F.when(F.col("risk_value") == 2, F.concat(F.lit("https://b/"), "id"))), " ").alias("links")))
simple("c9_stable_id", """SELECT id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS uuid
FROM (SELECT id, sha256(service_name || chr(31) || scenario) AS h FROM recs) t""",
       lambda df: df.select("id", text.stable_id("service_name", "scenario").alias("uuid")))
simple("c15_first_risk", "SELECT id, string_split(risk_detail, ', ')[1] AS risk FROM recs",
       lambda df: df.select("id", text.first_risk("risk_detail").alias("risk")))
