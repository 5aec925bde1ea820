"""Ingest, state, review and health queries."""

from pyspark.sql import functions as F

from advisorium.functions import text
from advisorium.operators import health, joins, ranking, review, summaries
from advisorium.plans import ingest
from advisorium.sources import writers
from advisorium.sources.scratch import written
from checks.registry import query
from checks.text import tfidf_sql
from checks.views import RAW_ITEMS_SQL, existing, raw_items, seen, view, with_views

I = "WITH " + RAW_ITEMS_SQL
AS_OF = "2024-01-31 00:00:00"

# Items ------------------------------------------------------------------------------------------


@query("j4_unseen", I + "SELECT ord, i.source_id, i.content_hash FROM raw_items i WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.source_id = i.source_id AND s.content_hash = i.content_hash)")
def _unseen(spark, sf):
    return joins.unseen(raw_items(spark, sf), seen(spark, sf)).select("ord", "source_id", "content_hash")


@query("t4_fresh_items", I + """SELECT min(ord) AS ord FROM raw_items i
WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.source_id = i.source_id AND s.content_hash = i.content_hash) GROUP BY source_id, content_hash""")
def _fresh(spark, sf):
    return ingest.fresh_items(raw_items(spark, sf), seen(spark, sf))


@query("w1_first_items", I + "SELECT source_id, ord FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY ord) AS r FROM raw_items) t WHERE r <= 50")
def _first(spark, sf):
    return ranking.first_items(raw_items(spark, sf), 50).select("source_id", "ord")


@query("w2_keep_first", I + "SELECT source_id, content_hash, min(ord) AS ord FROM raw_items GROUP BY 1, 2")
def _keep_first(spark, sf):
    return ranking.first_by_id(raw_items(spark, sf).select("source_id", "content_hash", "ord"), ["source_id", "content_hash"])


@query("w3_newest_hashes", """WITH s AS (SELECT CAST(user_id AS VARCHAR) AS source_id, md5(CAST(event_id AS VARCHAR)) AS content_hash, ts AS seen_at FROM events)
SELECT source_id, content_hash FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY seen_at DESC, content_hash DESC) AS r FROM s) t WHERE r <= 40""")
def _newest(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    state = events.select(F.col("user_id").cast("string").alias("source_id"),
                          F.md5(F.col("event_id").cast("string").cast("binary")).alias("content_hash"), F.col("ts").alias("seen_at"))
    return ranking.newest_hashes(state, 40).select("source_id", "content_hash")


# Runs -------------------------------------------------------------------------------------------

N = with_views("runs")
query("w4_last_runs", N + "SELECT CAST(run_day AS VARCHAR) AS run_day, items_converted FROM runs ORDER BY run_day DESC LIMIT 10")(
    lambda spark, sf: ranking.last_runs(view(spark, sf, "runs"), 10).select(F.col("run_day").cast("string"), "items_converted"))
query("w5_latest_run", N + "SELECT CAST(run_day AS VARCHAR) AS run_day, items_converted, items_validated FROM runs ORDER BY run_day DESC LIMIT 1")(
    lambda spark, sf: ranking.latest_run(view(spark, sf, "runs")).select(F.col("run_day").cast("string"), "items_converted", "items_validated"))


@query("k8_append_run", N + """, a AS (SELECT * FROM runs UNION ALL SELECT DATE '2024-02-01', 1, 0, 1, 0)
SELECT CAST(run_day AS VARCHAR) AS run_day, items_converted FROM a ORDER BY run_day DESC LIMIT 20""")
def _append_run(spark, sf):
    runs = view(spark, sf, "runs")
    run = spark.sql("""SELECT DATE '2024-02-01' AS run_day, 1L AS items_converted, 0L AS items_convert_failed,
                       1L AS items_validated, 0L AS items_validation_failed""")
    return writers.with_run(runs, run, 20).select(F.col("run_day").cast("string"), "items_converted")


query("a12_run_rates", N + """SELECT CAST(run_day AS VARCHAR) AS run_day,
 round(items_converted / nullif(items_converted + items_convert_failed, 0), 6) AS conversion_rate,
 round(items_validation_failed / nullif(items_validated + items_validation_failed, 0), 6) AS schema_failure_rate FROM runs""")(
    lambda spark, sf: summaries.run_rates(view(spark, sf, "runs")).withColumn("run_day", F.col("run_day").cast("string")))

# Source counters --------------------------------------------------------------------------------

L = with_views("fetch_log") + """, ends AS (SELECT source_id, max(CASE WHEN NOT error THEN ts END) AS ok, max(CASE WHEN error OR items > 0 THEN ts END) AS busy
 FROM fetch_log GROUP BY 1),
counters AS (SELECT l.source_id, CAST(sum(CASE WHEN error AND (ok IS NULL OR ts > ok) THEN 1 ELSE 0 END) AS BIGINT) AS consecutive_errors,
 CAST(sum(CASE WHEN NOT error AND items = 0 AND (busy IS NULL OR ts > busy) THEN 1 ELSE 0 END) AS BIGINT) AS consecutive_empty
 FROM fetch_log l JOIN ends USING (source_id) GROUP BY 1)
"""


def _counters(spark, sf):
    return ranking.trailing_counters(view(spark, sf, "fetch_log"))


query("w6_trailing_counters", L + "SELECT source_id, consecutive_errors, consecutive_empty FROM counters")(
    lambda spark, sf: _counters(spark, sf).select("source_id", "consecutive_errors", "consecutive_empty"))
query("w8_latest_state", with_views("fetch_log") + """SELECT source_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_fetched_at,
 arg_max(etag, ts) FILTER (WHERE etag <> '') AS etag, arg_max(last_modified, ts) FILTER (WHERE last_modified <> '') AS last_modified
FROM fetch_log GROUP BY 1""")(
    lambda spark, sf: ranking.latest_state(view(spark, sf, "fetch_log")).withColumn(
        "last_fetched_at", F.date_format("last_fetched_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")))

# Health -----------------------------------------------------------------------------------------

_H1 = """SELECT 'source_yields_zero' AS "check", CASE WHEN consecutive_empty >= 3 THEN 'WARNING' ELSE 'OK' END AS severity,
 CASE WHEN consecutive_empty >= 3 THEN 'Source ''' || source_id || ''' has returned 0 items for ' || consecutive_empty || ' consecutive runs'
 ELSE 'Source ''' || source_id || ''': consecutive empty = ' || consecutive_empty END AS message FROM counters"""
_H2 = """SELECT 'http_errors' AS "check", CASE WHEN consecutive_errors >= 3 THEN 'ERROR' ELSE 'OK' END AS severity,
 CASE WHEN consecutive_errors >= 3 THEN 'Source ''' || source_id || ''' has had ' || consecutive_errors || ' consecutive fetch errors'
 ELSE 'Source ''' || source_id || ''': consecutive errors = ' || consecutive_errors END AS message FROM counters"""
query("h1_zero_yield", L + _H1)(lambda spark, sf: health.zero_yield(_counters(spark, sf)))
query("h2_fetch_errors", L + _H2)(lambda spark, sf: health.fetch_errors(_counters(spark, sf)))

_STATE_TEXT = "CASE WHEN source_id LIKE '1%-error' THEN 'broken' ELSE strftime(last_ts, '%Y-%m-%dT%H:%M:%SZ') END"
_STALE = f""", st AS (SELECT source_id, {_STATE_TEXT} AS last_fetched_at FROM source_state),
kn AS (SELECT c.source_id, st.last_fetched_at, try_cast(replace(st.last_fetched_at, 'Z', '') AS TIMESTAMP) AS f
 FROM source_config c LEFT JOIN st ON c.source_id = st.source_id)
"""
_H3 = f"""SELECT 'stale_source' AS "check", CASE WHEN f IS NULL OR f < TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY THEN 'WARNING' ELSE 'OK' END AS severity,
 'Source ''' || source_id || ''' ' || CASE WHEN coalesce(last_fetched_at, '') = '' THEN 'has never been fetched' WHEN f IS NULL THEN 'has invalid last_fetched_at'
 WHEN f < TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY THEN 'last fetched ' || CAST(floor(epoch(TIMESTAMP '{AS_OF}' - f) / 86400) AS BIGINT) || ' days ago'
 ELSE 'fetched recently' END AS message FROM kn"""


def _state(spark, sf):
    rows = view(spark, sf, "source_state")
    broken = F.col("source_id").like("1%-error")
    return rows.select("source_id", F.when(broken, "broken").otherwise(text.iso_timestamp("last_ts")).alias("last_fetched_at"))


def _stale(spark, sf):
    return health.stale_sources(view(spark, sf, "source_config"), _state(spark, sf), AS_OF)


S = with_views("source_state", "source_config")
query("h3_stale_sources", S + _STALE + _H3)(_stale)
query("j6_config_state", S + _STALE + "SELECT source_id, last_fetched_at FROM kn")(
    lambda spark, sf: view(spark, sf, "source_config").select("source_id").join(_state(spark, sf), "source_id", "left"))
query("c10_parse_iso", S + _STALE + "SELECT source_id, strftime(f, '%Y-%m-%dT%H:%M:%SZ') AS parsed FROM kn")(
    lambda spark, sf: view(spark, sf, "source_config").select("source_id").join(_state(spark, sf), "source_id", "left").select(
        "source_id", text.iso_timestamp(text.parse_iso("last_fetched_at")).alias("parsed")))
query("c11_age_days", f"SELECT event_id, CAST(floor(epoch_us(TIMESTAMP '{AS_OF}' - ts + INTERVAL 0 DAY) / 86400000000) AS BIGINT) AS age FROM events".replace(
    f"epoch_us(TIMESTAMP '{AS_OF}' - ts + INTERVAL 0 DAY)", f"(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(ts))"))(
    lambda spark, sf: spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id", text.age_days("ts", F.lit(AS_OF).cast("timestamp")).alias("age")))

G = with_views("staged_v")
_H4 = """SELECT 'staging_overflow' AS "check", CASE WHEN count(*) >= 100 THEN 'WARNING' ELSE 'OK' END AS severity,
 CASE WHEN count(*) >= 100 THEN 'Staging has ' || count(*) || ' unreviewed items (threshold: 100)' ELSE 'Staging has ' || count(*) || ' items' END AS message FROM staged_v"""
query("h4_staging_overflow", G + _H4)(lambda spark, sf: health.staging_overflow(view(spark, sf, "staged_v")))
query("a15_staging_size", G + "SELECT count(*) AS n, CASE WHEN count(*) >= 100 THEN 'WARNING' ELSE 'OK' END AS severity FROM staged_v")(
    lambda spark, sf: summaries.staging_size(view(spark, sf, "staged_v")))

_H6 = """, r AS (SELECT * FROM runs ORDER BY run_day DESC LIMIT 1), x AS (SELECT items_converted / nullif(items_converted + items_convert_failed, 0) AS c,
 items_validation_failed / nullif(items_validated + items_validation_failed, 0) AS v, items_converted AS n, items_converted + items_convert_failed AS t FROM r),
h6 AS (SELECT 'low_conversion_rate' AS "check", 'WARNING' AS severity, 'LLM conversion rate was ' || CAST(round_even(c * 100, 0) AS INT) || '% in last run (' || n || '/' || t || ')' AS message FROM x WHERE c < 0.5
UNION ALL SELECT 'schema_failures', 'ERROR', 'Schema validation failure rate ' || CAST(round_even(v * 100, 0) AS INT) || '% in last run' FROM x WHERE v > 0.1)
"""
_H6_ALL = """SELECT "check", severity, message FROM h6 UNION ALL SELECT 'run_quality', 'OK', 'Last run quality is acceptable' WHERE NOT EXISTS (SELECT 1 FROM h6)"""
query("h6_run_quality", N + _H6 + _H6_ALL)(lambda spark, sf: health.run_quality(view(spark, sf, "runs")))


def _report(spark, sf):
    counters = written(_counters(spark, sf), "counters")  # two checks read it
    return health.report(
        sources=health.zero_yield(counters), errors=health.fetch_errors(counters), stale=_stale(spark, sf),
        staging=health.staging_overflow(view(spark, sf, "staged_v")), quality=health.run_quality(view(spark, sf, "runs")))


_VIEWS = with_views("source_state", "source_config", "staged_v", "runs").rstrip() + _STALE.rstrip() + ",\n" + L[len("WITH "):].rstrip() + _H6
_UNION = f"""SELECT 'sources' AS chosen, * FROM ({_H1}) a UNION ALL SELECT 'errors', * FROM ({_H2}) b UNION ALL SELECT 'stale', * FROM ({_H3}) c
UNION ALL SELECT 'staging', * FROM ({_H4}) d UNION ALL SELECT 'quality', * FROM ({_H6_ALL}) e"""
query("h7_report", _VIEWS + _UNION)(_report)
query("h7_overall", _VIEWS + f"""SELECT "check", count(*) AS results, ['OK','WARNING','ERROR','CRITICAL'][CAST(max(list_position(['OK','WARNING','ERROR','CRITICAL'], severity)) AS INT)] AS severity
FROM ({_UNION}) u GROUP BY 1""")(lambda spark, sf: health.overall(_report(spark, sf)))

# Staging and review -----------------------------------------------------------------------------

_LISTING = "SELECT id, source_id, service_name, scenario, risk_detail, closest_existing, dedup_score FROM staged_v"
query("s10_staged_scan", G + "SELECT id, source_id, service_name, scenario, risk_detail, dedup_score, closest_existing FROM staged_v")(
    lambda spark, sf: view(spark, sf, "staged_v").select(
        "id", "source_id", "service_name", "scenario", "risk_detail", F.col("dedup_score").cast("double"), "closest_existing"))
query("p9_staged_listing", G + _LISTING)(
    lambda spark, sf: review.staged_listing(view(spark, sf, "staged_v").withColumn("dedup_score", F.col("dedup_score").cast("double"))))
query("f13_staged_for_service", G + _LISTING + " WHERE service_name = 'fr'")(
    lambda spark, sf: review.staged_listing(view(spark, sf, "staged_v").withColumn("dedup_score", F.col("dedup_score").cast("double")), "fr"))

C = with_views("staged_v", "catalog_ids", "decisions")
query("t6_promotion_outcomes", C + """SELECT s.id, CASE WHEN dedup_score < 0.3 AND c.id IS NULL THEN 'promoted' ELSE 'staged' END AS outcome,
 CASE WHEN dedup_score >= 0.3 THEN 'not eligible' WHEN c.id IS NULL THEN 'new' ELSE 'duplicate id' END AS reason
FROM staged_v s LEFT JOIN catalog_ids c ON c.id = s.id""")(
    lambda spark, sf: review.promotion_outcomes(view(spark, sf, "staged_v"), view(spark, sf, "catalog_ids")).select("id", "outcome", "reason"))
_DECIDED = """, z AS (SELECT d.id, d.action, d.reason AS given_reason, s.service_name, CASE WHEN s.id IS NULL THEN 'not found' WHEN d.action = 'reject' THEN 'rejected'
 WHEN c.id IS NOT NULL THEN 'duplicate id' ELSE 'promoted' END AS result
 FROM decisions d LEFT JOIN staged_v s ON s.id = d.id LEFT JOIN catalog_ids c ON c.id = d.id)
"""


def _decided(spark, sf):
    return review.decide(view(spark, sf, "staged_v"), view(spark, sf, "decisions"), view(spark, sf, "catalog_ids"))


query("t7_promote", C + _DECIDED + "SELECT * FROM z")(_decided)
query("t7_catalog_counts", C + _DECIDED + """SELECT service_name, count(*) AS n FROM (SELECT service_name FROM catalog_ids
UNION ALL SELECT service_name FROM z WHERE result = 'promoted') t GROUP BY 1""")(
    lambda spark, sf: review.catalog_counts(view(spark, sf, "catalog_ids"), view(spark, sf, "staged_v"), _decided(spark, sf)))
query("t8_after_review", C + _DECIDED + "SELECT s.id, s.scenario FROM staged_v s WHERE s.id NOT IN (SELECT id FROM z WHERE result IN ('promoted', 'rejected'))")(
    lambda spark, sf: review.after_promotion(view(spark, sf, "staged_v"), _decided(spark, sf)).select("id", "scenario"))


@query("t5_second_chance", with_views("conversions") + """SELECT ord, CASE WHEN ord % 4 = 2 THEN 'skipped' WHEN ord % 4 = 3 THEN 'convert_failed'
 WHEN ord % 3 = 0 THEN 'validation_failed' END AS stopped, CASE WHEN ord % 4 < 2 AND ord % 3 <> 0 THEN 'Finding ' || ord END AS scenario, ord % 4 < 2 AS retried
FROM conversions""")
def _second_chance(spark, sf):
    done = ingest.conversions(view(spark, sf, "conversions"), F.to_timestamp(F.lit(AS_OF)), "ingest")
    return done.select("ord", "stopped", F.col("recommendation.scenario").alias("scenario"), "retried")


# The whole run ----------------------------------------------------------------------------------

_ITEM_TEXT = "SELECT ord AS key, title || ' ' || body AS text FROM raw_items"
_RUN = ("WITH " + RAW_ITEMS_SQL.rstrip() + ",\n" + with_views("conversions", "catalog_ids")[len("WITH "):].rstrip() + ",\n"
        + tfidf_sql(_ITEM_TEXT, "SELECT item_id AS position, text FROM benchmark") + """, admitted AS (SELECT * FROM
 (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY ord) AS r FROM raw_items) t WHERE {cap}),
fresh AS (SELECT min(ord) AS ord FROM admitted a WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.source_id = a.source_id AND s.content_hash = a.content_hash)
 GROUP BY source_id, content_hash),
j AS (SELECT i.ord, i.source_id, a.ord IS NOT NULL AS adm, f.ord IS NOT NULL AS fr, round(b.score, 4) AS sc, b.position AS pos,
 substr(md5(CAST(i.ord AS VARCHAR)), 1, 8) || '-' || substr(md5(CAST(i.ord AS VARCHAR)), 9, 4) || '-' || substr(md5(CAST(i.ord AS VARCHAR)), 13, 4) || '-'
 || substr(md5(CAST(i.ord AS VARCHAR)), 17, 4) || '-' || substr(md5(CAST(i.ord AS VARCHAR)), 21, 12) AS rid
 FROM raw_items i LEFT JOIN admitted a ON a.ord = i.ord LEFT JOIN fresh f ON f.ord = i.ord LEFT JOIN best b ON b.key = i.ord),
outcomes AS (SELECT ord, source_id, CASE WHEN fr THEN sc END AS score, CASE WHEN fr THEN pos END AS position,
 fr AND sc < 0.7 AND ord % 4 < 2 AS retried, CASE WHEN NOT adm THEN 'capped' WHEN NOT fr THEN 'seen' WHEN sc >= 0.7 THEN 'duplicate'
 WHEN ord % 4 = 2 THEN 'skipped' WHEN ord % 4 = 3 THEN 'convert_failed' WHEN ord % 3 = 0 THEN 'validation_failed' WHEN sc < 0.3 THEN 'promoted' ELSE 'staged' END AS outcome,
 CASE WHEN fr AND sc < 0.7 AND ord % 4 < 2 AND ord % 3 <> 0 THEN rid END AS recommendation_id FROM j)
""")


def _outcomes(spark, sf, **options):
    return ingest.run(raw_items(spark, sf), seen(spark, sf), existing(spark, sf), view(spark, sf, "conversions"),
                      view(spark, sf, "catalog_ids"), F.to_timestamp(F.lit(AS_OF)), **options)


_ROWS = "SELECT ord, source_id, score, position, retried, recommendation_id, outcome FROM outcomes"
_cols = lambda df: df.select("ord", "source_id", "score", "position", "retried", "recommendation_id", "outcome")
query("t1_outcomes", _RUN.replace("{cap}", "true") + _ROWS)(lambda spark, sf: _cols(_outcomes(spark, sf)))
query("t1_outcomes_capped", _RUN.replace("{cap}", "r <= 60") + _ROWS)(lambda spark, sf: _cols(_outcomes(spark, sf, max_items=60)))
_among = lambda name, *of: f"count(*) FILTER (WHERE outcome IN ({', '.join(repr(o) for o in of)})) AS {name}"
query("a10_run_metrics", _RUN.replace("{cap}", "true") + "SELECT count(*) AS items_fetched, " + ", ".join((
    _among("items_filtered_seen", "seen"), _among("items_filtered_dedup", "duplicate"),
    _among("items_converted", "validation_failed", "promoted", "staged"), _among("items_convert_failed", "convert_failed"),
    _among("items_convert_skipped", "skipped"), _among("items_validated", "promoted", "staged"),
    _among("items_validation_failed", "validation_failed"), _among("items_staged", "staged"),
    _among("items_auto_promoted", "promoted"))) + ", count(*) FILTER (WHERE retried) AS items_retried FROM outcomes")(
    lambda spark, sf: ingest.run_metrics(_outcomes(spark, sf)))
query("a11_source_yield", _RUN.replace("{cap}", "true") + f"""SELECT source_id, count(*) AS parsed, {_among("seen", "seen")}, {_among("duplicate", "duplicate")},
 count(*) FILTER (WHERE outcome NOT IN ('seen', 'duplicate')) AS novel FROM outcomes GROUP BY 1""")(
    lambda spark, sf: ingest.source_yield(_outcomes(spark, sf)))


@query("k5_staged_records", _RUN.replace("{cap}", "true") + """SELECT source_id, 'ingest' AS staged_by, '2024-01-31T00:00:00' AS staged_day, score AS dedup_score,
 b.text AS closest_existing, recommendation_id AS id, 'Finding ' || CAST(ord AS VARCHAR) AS scenario, 'svc' AS service_name
FROM outcomes o JOIN benchmark b ON b.item_id = o.position WHERE outcome = 'staged'""")
def _staged_records(spark, sf):
    rows = ingest.staged_records(_outcomes(spark, sf), raw_items(spark, sf), existing(spark, sf), "ingest", F.to_timestamp(F.lit(AS_OF)))
    return rows.select("source_id", "staged_by", F.left("staged_at", F.lit(19)).alias("staged_day"), "dedup_score", "closest_existing",
                       "recommendation.id", "recommendation.scenario", "recommendation.service_name")
