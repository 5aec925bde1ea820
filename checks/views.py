"""Views that give the driver tables the shapes the operators work on.

Each is one SQL text that both engines read; ``@name@`` stands for a table. Columns that hold
arrays or structs are added per engine, by the same rule.
"""

from pyspark.sql import functions as F

from advisorium.plans.ingest import raw_items as raw_items_of

_RECS = """
SELECT CAST(d.doc_id AS VARCHAR(20)) AS id, d.lang AS service_name,
       substring(d.text, 1, 200) AS scenario,
       CASE WHEN d.doc_id % 3 = 1 THEN '  ' WHEN d.doc_id % 3 = 2 OR d.doc_id % 6 = 3 THEN substring(d.text, 1301, 200)
         END AS alert_criteria,
       substring(d.text, 201, 300) AS recommendation_action,
       substring(d.text, 501) AS recommendation_description_detailed,
       coalesce(nullif(concat_ws(', ',
         CASE WHEN l.quality = 0 THEN 'cost' END,
         CASE WHEN l.toxic = 1 THEN 'security' END,
         CASE WHEN d.n_chars > 5000 THEN 'performance' END,
         CASE WHEN d.doc_id % 7 = 0 THEN 'reliability' END), ''), 'operations') AS risk_detail,
       CASE WHEN l.quality IS NOT NULL THEN CAST(d.doc_id % 4 AS INT) END AS build_priority,
       CASE WHEN d.doc_id % 11 <> 0 THEN CAST(d.doc_id % 4 AS INT) END AS effort_level,
       CASE WHEN d.doc_id % 13 <> 0 THEN CAST(d.doc_id % 3 + 1 AS INT) END AS action_value,
       CASE WHEN d.doc_id % 17 <> 0 THEN CAST(d.doc_id % 4 AS INT) END AS risk_value,
       CASE WHEN d.doc_id % 5 < 2 THEN d.source END AS category
       {extra}
FROM @documents@ d LEFT JOIN @labels@ l ON d.doc_id = l.doc_id
"""

TEXTS = {
    "recs": _RECS.format(extra=""),
    # recs with its number and the source of its document, for the columns that hold arrays
    "recs_plus": _RECS.format(extra=", d.doc_id AS n, d.source AS src"),
    # recs with words of the standard rules, each in every sixteenth text
    "recs_named": """
SELECT id, service_name, concat(CASE CAST(id AS BIGINT) % 16 WHEN 0 THEN 'EC2 instance type ' WHEN 1 THEN 'old volume ' WHEN 2 THEN 'S3 bucket policy '
         WHEN 3 THEN 'aurora cluster ' WHEN 4 THEN 'DynamoDB table ' WHEN 5 THEN 'lambda timeout ' WHEN 6 THEN 'CloudFront origin '
         WHEN 7 THEN 'load balancer ' WHEN 8 THEN 'one VPC subnet ' WHEN 9 THEN 'IAM user with MFA ' WHEN 10 THEN 'Fargate task '
         WHEN 11 THEN 'a dns zone ' WHEN 12 THEN 'kinesis shard ' WHEN 13 THEN 'redis node ' ELSE '' END, scenario) AS scenario,
       alert_criteria, recommendation_action, recommendation_description_detailed, risk_detail
FROM (@recs@) recs
""",
    "recs_dq": """
SELECT CASE WHEN CAST(id AS BIGINT) % 2 = 0 THEN concat(substring(md5(id), 1, 8), '-', substring(md5(id), 9, 4), '-',
         substring(md5(id), 13, 4), '-', substring(md5(id), 17, 4), '-', substring(md5(id), 21, 12)) ELSE id END AS id,
       CASE WHEN CAST(id AS BIGINT) % 8 = 0 THEN upper(service_name) ELSE service_name END AS service_name,
       CASE WHEN CAST(id AS BIGINT) % 9 = 0 THEN '' ELSE scenario END AS scenario,
       CASE WHEN CAST(id AS BIGINT) % 10 = 0 THEN 'unknown' WHEN CAST(id AS BIGINT) % 10 = 1 THEN NULL
         ELSE risk_detail END AS risk_detail,
       CAST(CAST(id AS BIGINT) % 6 AS INT) AS build_priority, category
FROM (@recs@) recs
""",
    "responses": """
SELECT id, CASE CAST(id AS BIGINT) % 4
         WHEN 0 THEN concat('```json', chr(10), '{"id":"', id, '","service_name":"', service_name, '"}', chr(10), '```')
         WHEN 1 THEN concat('{"id":"', id, '","service_name":"', service_name, '"}')
         WHEN 2 THEN '{"skip": true, "reason": "off topic"}'
         ELSE concat('not json ', id) END AS response
FROM (@recs@) recs
""",
    # responses with a second try: complete for two ids in three, still broken for the rest
    "conversions": """
SELECT CAST(id AS BIGINT) AS ord, response,
       CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN concat('{"id":"', id, '","service_name":"cost"}')
         ELSE concat('{"id":"', substring(md5(id), 1, 8), '-', substring(md5(id), 9, 4), '-', substring(md5(id), 13, 4), '-',
           substring(md5(id), 17, 4), '-', substring(md5(id), 21, 12),
           '","service_name":"svc","scenario":"Finding ', id, '","risk_detail":"cost"}') END AS retry_response
FROM (@responses@) responses
""",
    "runs": """
SELECT CAST(ts AS DATE) AS run_day,
       CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS items_converted,
       CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS items_convert_failed,
       CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS items_validated,
       CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS items_validation_failed
FROM @events@ GROUP BY CAST(ts AS DATE)
""",
    "fetch_log": """
SELECT CAST(user_id AS VARCHAR(20)) AS source_id, ts, event_type IN ('error', 'click') AS error,
       CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS items,
       CASE WHEN event_type = 'view' THEN concat('e', CAST(event_id AS VARCHAR(20))) ELSE '' END AS etag,
       CASE WHEN event_type = 'signup' THEN concat('m', CAST(event_id AS VARCHAR(20))) END AS last_modified
FROM @events@
""",
    "source_state": """
SELECT concat(CAST(user_id AS VARCHAR(20)), '-', event_type) AS source_id, max(ts) AS last_ts
FROM @events@ GROUP BY user_id, event_type
""",
    "source_config": """
SELECT concat(CAST(user_id AS VARCHAR(20)), '-', event_type) AS source_id, true AS enabled
FROM (SELECT user_id, @each_event_type@ AS event_type FROM (SELECT DISTINCT user_id FROM @events@) u) t
UNION ALL
SELECT concat('-', CAST(user_id AS VARCHAR(20))) AS source_id, CAST(NULL AS BOOLEAN) AS enabled
FROM (SELECT DISTINCT user_id FROM @events@) v
""",
    "staged_v": """
SELECT id, service_name, scenario, risk_detail, service_name AS source_id,
       round((CAST(id AS BIGINT) % 100) / 100.0, 4) AS dedup_score, recommendation_action AS closest_existing
FROM (@recs@) recs
""",
    # the catalogue the staged records may collide with
    "catalog_ids": """
SELECT id, service_name FROM (@recs@) recs WHERE category IS NOT NULL
""",
    "decisions": """
SELECT id, CASE WHEN CAST(id AS BIGINT) % 5 = 0 THEN 'reject' ELSE 'promote' END AS action,
       CASE WHEN CAST(id AS BIGINT) % 5 = 0 THEN 'not useful' END AS reason
FROM (@recs@) recs WHERE build_priority IS NOT NULL
""",
    "sources_v": """
SELECT d.source AS id,
       concat_ws(', ', CASE WHEN max(l.toxic) = 1 THEN 'security' END, CASE WHEN min(l.quality) = 0 THEN 'cost' END,
         CASE WHEN max(d.n_chars) > 10000 THEN 'performance' END, 'other') AS categories
FROM @documents@ d LEFT JOIN @labels@ l ON d.doc_id = l.doc_id GROUP BY d.source
""",
    "resources": """
SELECT o_orderkey AS resource_id, (o_orderstatus <> 'O') AS encrypted, o_orderdate AS created,
       (o_orderstatus = 'P') AS running, o_totalprice AS usage,
       CASE o_orderstatus WHEN 'F' THEN 'en' WHEN 'O' THEN 'de' ELSE 'fr' END AS service
FROM @orders@
""",
    "rules_v": """
SELECT id, service_name, scenario, risk_detail, risk_value, recommendation_action, CAST(id AS BIGINT) AS ord
FROM (@recs@) recs
""",
    "metrics": """
SELECT user_id AS resource_id, ts, value FROM @events@
""",
}


_EVENT_TYPES = "'signup', 'error', 'click', 'view', 'purchase'"


def _fill(name, table, each="unnest([{}])"):
    text = TEXTS[name].replace("@each_event_type@", each.format(_EVENT_TYPES))
    while "@" in text:
        start = text.index("@")
        end = text.index("@", start + 1)
        inner = text[start + 1:end]
        text = text[:start] + (TEXTS[inner] if inner in TEXTS else table(inner)) + text[end + 1:]
    return text


def with_views(*names):
    """``WITH`` clause of the comparison engine defining the named views."""
    return "WITH " + ",\n".join(f"{name} AS ({_fill(name, lambda t: t)})" for name in names) + "\n"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark, sf_dir, name):
    return spark.sql(_fill(name, lambda t: f"parquet.`{sf_dir}/{t}.parquet`", "explode(array({}))"))


def entries(spark, sf_dir):
    """recs_plus with its array and struct columns, in the shape of nested entries."""
    rows = view(spark, sf_dir, "recs_plus")
    n, none = F.col("n"), F.lit(None).cast("string")
    keep = lambda *items: F.array_compact(F.array(*items))
    method = lambda when, name: F.when(when, F.struct(F.lit(name).alias("method"), F.concat(F.lit("rule "), "id").alias("details")))
    pattern = lambda when, name: F.when(when, F.struct(
        name.alias("pattern_name"), F.lit("related_to").alias("relationship"), none.alias("description")))
    return rows.withColumns({
        "references": F.when(n % 2 == 0, F.array(F.concat(F.lit("https://example.org/"), "id"))),
        "tags": F.array("service_name", "src"),
        "detection_methods": keep(method(n % 3 == 0, "CloudWatch Metric"), method(n % 6 == 0, "CLI Command")),
        "architectural_patterns": keep(
            pattern(n % 4 == 0, F.concat(F.lit("pattern-"), (n % 5).cast("string"))), pattern(n % 8 == 0, F.lit("pattern-9"))),
        "remediation_examples": keep(F.when(n % 2 == 1, F.struct(
            F.lit("bash").alias("language"), F.lit("run").alias("code"), none.alias("description")))),
        "compliance_mappings": F.when(n % 9 == 0, F.array(F.lit("CIS"))),
        "metadata": F.when(n % 5 != 0, F.struct(
            F.lit("2024-01-01T00:00:00Z").alias("created_at"), none.alias("updated_at"),
            F.array(F.lit("reviewer")).alias("contributors"), F.col("src").alias("source"))),
        "output_notes": none, "notes": none, "pattern_implementation_guidance": none,
    })


# The same entries for the comparison engine, arrays as lists of names.
ENTRIES_SQL = f"""entries AS (SELECT r.*,
  CASE WHEN n % 2 = 0 THEN ['https://example.org/' || id] ELSE [] END AS refs,
  [service_name, src] AS tags,
  list_filter([CASE WHEN n % 3 = 0 THEN 'CloudWatch Metric' END, CASE WHEN n % 6 = 0 THEN 'CLI Command' END], lambda x: x IS NOT NULL) AS methods,
  list_filter([CASE WHEN n % 4 = 0 THEN 'pattern-' || CAST(n % 5 AS VARCHAR) END, CASE WHEN n % 8 = 0 THEN 'pattern-9' END], lambda x: x IS NOT NULL) AS patterns,
  CASE WHEN n % 2 = 1 THEN 1 ELSE 0 END AS n_remediation
FROM ({_fill("recs_plus", lambda t: t)}) r)
"""


def raw_items(spark, sf_dir):
    return raw_items_of(table(spark, sf_dir, "documents"), "lang", "doc_id", "text")


_WS = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '||chr(160)"
RAW_ITEMS_SQL = f"""raw_items AS (SELECT source_id, ord, title, body,
  sha256(lower(trim(title, {_WS})) || '|' || lower(trim(body, {_WS}))) AS content_hash
FROM (SELECT lang AS source_id, doc_id AS ord,
  CASE WHEN instr(text, chr(10)) > 0 THEN left(text, instr(text, chr(10)) - 1) ELSE text END AS title,
  CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS body
  FROM documents) t),
seen AS (SELECT DISTINCT source_id, content_hash FROM raw_items WHERE ord IN (SELECT doc_id FROM labels))
"""


def seen(spark, sf_dir):
    """State of earlier runs: the hashes of all labelled documents."""
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("ord"))
    items = raw_items(spark, sf_dir).join(labelled, "ord", "left_semi")
    return items.select("source_id", "content_hash").distinct()


def existing(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("position"), F.col("text").alias("scenario"), "text")
