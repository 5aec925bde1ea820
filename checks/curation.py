"""Validation, classification and filling queries."""

import re

from pyspark.sql import functions as F

from advisorium.functions import rule_tables
from advisorium.functions.rules import PatternRule
from advisorium.operators import enrich, quality
from checks.registry import query
from checks.views import view, with_views

DQ = with_views("recs_dq")
R = with_views("recs")
_UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def checked(name, sql, run):
    query(name, DQ + sql)(lambda spark, sf: run(view(spark, sf, "recs_dq")))


def on_recs(name, sql, run):
    query(name, R + sql)(lambda spark, sf: run(view(spark, sf, "recs")))


# Validation -------------------------------------------------------------------------------------

_REQUIRED = "\nUNION ALL ".join(
    f"SELECT id, '{f}' AS field, 'required' AS rule, 'Missing required field: {f}' AS message FROM recs_dq WHERE coalesce({f}, '') = ''"
    for f in ("id", "service_name", "scenario", "risk_detail"))
_RANGE = """SELECT id, 'build_priority' AS field, 'maximum' AS rule,
 'Field ''build_priority'' value ' || build_priority || ' exceeds maximum 3' AS message FROM recs_dq WHERE build_priority > 3"""
_BAD_UUID = f"""SELECT id, 'id' AS field, 'uuid' AS rule, 'Field ''id'' does not match UUID format: ' || id AS message
FROM recs_dq WHERE NOT regexp_matches(id, '{_UUID}')"""
_STRICT = """SELECT id, 'service_name' AS field, 'pattern' AS rule, 'Field ''service_name'' does not match pattern: ' || service_name AS message
FROM recs_dq WHERE NOT regexp_matches(service_name, '^[a-z][a-z0-9-]*$')
UNION ALL SELECT id, 'risk_detail', 'pattern', 'Field ''risk_detail'' does not match pattern: ' || risk_detail FROM recs_dq
WHERE NOT regexp_matches(risk_detail, '^(cost|security|operations|performance|reliability)(,\\s*(cost|security|operations|performance|reliability))*$')"""

checked("q1_required", _REQUIRED, lambda df: quality.rule_violations(df, quality.required_errors()))
checked("q3_enum", """SELECT id, 'service_name' AS field, 'enum' AS rule, 'Field ''service_name'' has invalid value ''' || service_name
 || '''. Allowed values: [''en'', ''fr'']' AS message FROM recs_dq WHERE service_name NOT IN ('en', 'fr')""",
        lambda df: quality.rule_violations(df, quality.enum_errors({"service_name": ("en", "fr")})))
checked("q4_ranges", _RANGE, lambda df: quality.rule_violations(df, quality.range_errors({"build_priority": (0, 3)})))
checked("q5_uuid", _BAD_UUID, lambda df: quality.rule_violations(df, quality.uuid_errors()))
_ALL = "\nUNION ALL ".join((_REQUIRED, _RANGE, _BAD_UUID))
checked("q6_validity", f""", e AS ({_ALL}) SELECT r.id, r.scenario, count(e.id) AS n_errors, count(e.id) = 0 AS is_valid
FROM recs_dq r LEFT JOIN e ON e.id = r.id GROUP BY 1, 2""",
        lambda df: quality.validity(df).select("id", "scenario", F.size("messages").cast("long").alias("n_errors"), "is_valid"))
checked("q6_violations", _ALL, quality.violations)
checked("q7_strict", _ALL + "\nUNION ALL " + _STRICT, lambda df: quality.violations(df, strict=True))
# every id of eight characters or fewer stands twice
query("q10_repeated_ids", with_views("recs_dq") + """SELECT id, count(*) AS n FROM (SELECT id FROM recs_dq UNION ALL
 SELECT id FROM recs_dq WHERE length(id) < 9) t GROUP BY 1 HAVING count(*) > 1""")(
    lambda spark, sf: quality.repeated_ids(view(spark, sf, "recs_dq").select("id").transform(
        lambda ids: ids.unionAll(ids.filter(F.length("id") < 9))), "id"))
_FILES = f""", e AS ({_ALL}), v AS (SELECT r.service_name, r.id, EXISTS (SELECT 1 FROM e WHERE e.id = r.id) AS bad FROM recs_dq r),
f AS (SELECT service_name AS file, count(*) AS entries, CAST(sum(CASE WHEN bad THEN 0 ELSE 1 END) AS BIGINT) AS valid_entries FROM v GROUP BY 1)
"""
checked("a14_file_totals", _FILES + "SELECT file, entries, valid_entries, entries = valid_entries AS is_valid FROM f",
        lambda df: quality.file_totals(df, "service_name"))
checked("a14_validation_totals", _FILES + """SELECT count(*) AS files, CAST(sum(CASE WHEN entries = valid_entries THEN 1 ELSE 0 END) AS BIGINT) AS valid_files,
 CAST(sum(entries) AS BIGINT) AS entries, CAST(sum(valid_entries) AS BIGINT) AS valid_entries FROM f""",
        lambda df: quality.validation_totals(df, "service_name"))

# Classification ---------------------------------------------------------------------------------

KEEP = (r"\blicense\b",)
RULES = (
    PatternRule("german", (r"\bund\b", r"\bder\b")),
    PatternRule("french", (r"\bles\b", r"\bune\b")),
    PatternRule("spanish", (r"\blos\b", r"\bdel\b")),
    PatternRule("plain", (r"\bthis\b(?!.*with)",)),
)


def _word(*words):
    return r"(^|[^\p{L}\p{N}_])(" + "|".join(words) + r")([^\p{L}\p{N}_]|$)"


_TEXT = """lower(coalesce(scenario, '') || ' ' || coalesce(alert_criteria, '') || ' ' || coalesce(recommendation_action, '')
 || ' ' || coalesce(recommendation_description_detailed, ''))"""
# The lookahead holds for the last "this" of a line when no "with" follows it.
_CLASSES = f""", c AS (SELECT *, {_TEXT} AS txt FROM recs), k AS (SELECT *, CASE
 WHEN regexp_matches(txt, '{_word("license")}') THEN NULL
 WHEN regexp_matches(txt, '{_word("und", "der")}') THEN 'german'
 WHEN regexp_matches(txt, '{_word("les", "une")}') THEN 'french'
 WHEN regexp_matches(txt, '{_word("los", "del")}') THEN 'spanish'
 WHEN len(list_filter(string_split(txt, chr(10)), lambda l: regexp_matches(regexp_replace(l, '^.*with', 'h'), '{_word("this")}'))) > 0 THEN 'plain'
 END AS classified FROM c)
"""
on_recs("e1_classify", _CLASSES + "SELECT id, classified FROM k",
        lambda df: enrich.classified_service(df, RULES, KEEP).select("id", "classified"))
on_recs("u6_service_move", _CLASSES + """SELECT id, CASE WHEN service_name = 'en' AND classified IS NOT NULL THEN classified ELSE service_name END AS service_name,
 service_name = 'en' AND classified IS NOT NULL AS moved FROM k""",
        lambda df: enrich.reclassify(df, RULES, KEEP, "en").select("id", "service_name", "moved"))


def _sql_pattern(pattern):
    """A rule pattern for an engine without look-ahead and with ASCII word boundaries."""
    before, after, between = r"(^|[^\p{L}\p{N}_])", r"([^\p{L}\p{N}_]|$)", r"[^\p{L}\p{N}_\n]"
    pattern = pattern.replace(r"\b(?!\s*bucket)", r"\b")
    if pattern.startswith(r"\b"):
        pattern = before + pattern[2:]
    if pattern.endswith(r"\b"):
        pattern = pattern[:-2] + after
    return pattern.replace(r"\b.*", between + ".*")


def _sql_found(patterns):
    """Condition that any pattern is found; a look-ahead for a later word looks at line ends."""
    tests = []
    for pattern in patterns:
        ahead = re.fullmatch(r"(.*)\(\?!\.\*(\w+)\)", pattern)
        if ahead:
            word = _sql_pattern(ahead[1])
            tests.append(f"len(list_filter(string_split(txt, chr(10)), lambda l: regexp_matches(regexp_replace(l, '^.*{ahead[2]}', 'h'), '{word}'))) > 0")
        else:
            tests.append(f"regexp_matches(txt, '{_sql_pattern(pattern)}')")
    return "(" + " OR ".join(tests) + ")"


query("e1_standard_rules", with_views("recs_named").rstrip() + f", c AS (SELECT id, {_TEXT} AS txt FROM recs_named) SELECT id, CASE WHEN "
      + _sql_found(rule_tables.GENERAL_PATTERNS) + " THEN NULL " + " ".join(
          f"WHEN {_sql_found(r.patterns)} THEN '{r.target}'" for r in rule_tables.SERVICE_RULES) + " END AS classified FROM c")(
    lambda spark, sf: enrich.classified_service(view(spark, sf, "recs_named")).select("id", "classified"))

# Filling ----------------------------------------------------------------------------------------


def _sql_tree(outcomes, otherwise):
    """CASE expression of an outcome table for the comparison engine."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    any_of = lambda words: "(" + " OR ".join(f"contains(lower(scenario), {quote(w)})" for w in words) + ")"
    lines = []
    for scope, words, outcome in outcomes:
        terms = {"any": [], "idle": [any_of(rule_tables.IDLE_WORDS)]}.get(scope, [f"contains(risk_detail, {quote(scope)})"])
        terms = terms + ([any_of(words)] if words else [])
        lines.append(f"WHEN {' AND '.join(terms) or 'true'} THEN {quote(outcome)}")
    return "CASE " + "\n".join(lines) + f" ELSE {otherwise} END"


_FALLBACK = f"'{rule_tables.ALERT_PREFIX}' || left(scenario, {rule_tables.ALERT_PREFIX_CHARS})"
_DEFAULT = f"'{rule_tables.DEFAULT_ACTION}'"
_ALERT = _sql_tree(rule_tables.ALERT_OUTCOMES, _FALLBACK)
_ALERT_C = _sql_tree(rule_tables.ALERT_OUTCOMES_COMPACT, _FALLBACK)
_ACTION = _sql_tree(rule_tables.ACTION_OUTCOMES, _DEFAULT)
_ACTION_C = _sql_tree(rule_tables.ACTION_OUTCOMES_COMPACT, _DEFAULT)
on_recs("e2_alert_criteria", f"SELECT id, {_ALERT} AS alert FROM recs",
        lambda df: df.select("id", enrich.derived_alert().alias("alert")))
on_recs("e3_alert_criteria_compact", f"SELECT id, {_ALERT_C} AS alert FROM recs",
        lambda df: df.select("id", enrich.derived_alert(rule_tables.ALERT_OUTCOMES_COMPACT).alias("alert")))
on_recs("e4_action", f"SELECT id, {_ACTION} AS action, {_ACTION_C} AS compact FROM recs",
        lambda df: df.select("id", enrich.derived_action().alias("action"),
                             enrich.derived_action(rule_tables.ACTION_OUTCOMES_COMPACT).alias("compact")))
_PRIORITY = "CASE WHEN build_priority = 0 THEN 3 WHEN build_priority = 1 THEN 2 WHEN build_priority >= 2 THEN 1"
_EFFORT = """CASE WHEN regexp_matches(lower(scenario), 'migration|refactor|architecture|redesign') THEN 3
 WHEN regexp_matches(lower(scenario), 'enable|configure|tag|update|delete|remove|disable') THEN 1 ELSE 2 END"""
_RISK = f"""{_PRIORITY} WHEN contains(risk_detail, 'security') THEN 3 WHEN contains(risk_detail, 'cost') THEN 1
 WHEN contains(risk_detail, 'reliability') THEN 3 ELSE 2 END"""
_VALUE = f"""{_PRIORITY} WHEN contains(risk_detail, 'security') THEN 3 WHEN contains(risk_detail, 'cost') THEN 3
 WHEN contains(risk_detail, 'reliability') THEN 3 ELSE 2 END"""
on_recs("e5_numbers", f"SELECT id, {_EFFORT} AS effort, {_RISK} AS risk, {_VALUE} AS value FROM recs",
        lambda df: df.select("id", enrich.derived_effort().alias("effort"), enrich.derived_risk().alias("risk"),
                             enrich.derived_value().alias("value")))
_BLANK = "regexp_replace(coalesce({}, ''), '\\s', '', 'g') = ''"
_NO_ALERT, _NO_ACTION = _BLANK.format("alert_criteria"), _BLANK.format("recommendation_action")
on_recs("e6_fill_missing", f"""SELECT id, CASE WHEN {_NO_ALERT} THEN {_ALERT} ELSE alert_criteria END AS alert_criteria,
 CASE WHEN {_NO_ACTION} THEN {_ACTION} ELSE recommendation_action END AS recommendation_action,
 coalesce(effort_level, {_EFFORT}) AS effort_level, coalesce(risk_value, {_RISK}) AS risk_value, coalesce(action_value, {_VALUE}) AS action_value,
 {_NO_ALERT} OR {_NO_ACTION} OR effort_level IS NULL OR risk_value IS NULL OR action_value IS NULL AS modified FROM recs""",
        lambda df: enrich.fill_missing(df).select(
            "id", "alert_criteria", "recommendation_action", "effort_level", "risk_value", "action_value", "modified"))


@query("e9_parse_responses", with_views("responses") + """SELECT id,
 CASE CAST(id AS BIGINT) % 4 WHEN 2 THEN 'skipped' WHEN 3 THEN 'failed' ELSE 'converted' END AS status,
 CASE WHEN CAST(id AS BIGINT) % 4 < 2 THEN json_extract_string(body, '$.id') END AS rec_id,
 CASE WHEN CAST(id AS BIGINT) % 4 < 2 THEN json_extract_string(body, '$.service_name') END AS service
FROM (SELECT id, CASE WHEN json_valid(b) THEN b ELSE '{}' END AS body FROM (SELECT id, trim(replace(replace(response, '```json', ''), '```', ''), chr(10)) AS b FROM responses) t) u""")
def _responses(spark, sf):
    parsed = enrich.parse_responses(view(spark, sf, "responses"))
    return parsed.select("id", "status", F.col("recommendation.id").alias("rec_id"), F.col("recommendation.service_name").alias("service"))


@query("e10_backfill", with_views("recs") + f""", f AS (SELECT id, service_name, scenario, CASE WHEN CAST(id AS BIGINT) % 2 = 0 THEN '' ELSE id END AS given,
 risk_detail, build_priority, alert_criteria AS old_alert, effort_level AS old_effort FROM recs)
SELECT id, CASE WHEN given <> '' THEN given ELSE substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) END AS rec_id,
 coalesce(nullif(old_alert, ''), {_ALERT_C}) AS alert_criteria, {_ACTION_C} AS recommendation_action, coalesce(old_effort, {_EFFORT}) AS effort_level,
 {_RISK} AS risk_value, '2024-02-01T00:00:00Z' AS created_at, 'tester' AS people, 0 AS n_tags
FROM (SELECT *, sha256(service_name || chr(31) || scenario) AS h FROM f) t""")
def _backfill(spark, sf):
    rows = view(spark, sf, "recs").withColumns({
        "key": F.col("id"), "id": F.when(F.col("id").cast("long") % 2 == 0, "").otherwise(F.col("id")),
        "recommendation_action": F.lit(None).cast("string"), "risk_value": F.lit(None).cast("int"),
        "metadata": F.lit(None).cast("struct<created_at:string,updated_at:string,contributors:array<string>,source:string>"),
        "tags": F.lit(None).cast("array<string>")})
    filled = enrich.backfill(rows, F.to_timestamp(F.lit("2024-02-01 00:00:00")), "tester")
    return filled.select(
        F.col("key").alias("id"), F.col("id").alias("rec_id"), "alert_criteria", "recommendation_action", "effort_level", "risk_value",
        "metadata.created_at", F.array_join("metadata.contributors", ",").alias("people"), F.size("tags").alias("n_tags"))
