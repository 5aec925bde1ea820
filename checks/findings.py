"""Findings queries: rules stamped on resources."""

from pyspark.sql import functions as F

from advisorium.operators import findings, joins
from checks.registry import query
from checks.views import table, view, with_views

BASE = with_views("resources", "rules_v", "metrics")
AS_OF = "2001-08-01 12:00:00"


def _rule(where):
    return f"(SELECT id, risk_detail, coalesce(risk_value, 1) AS severity, coalesce(risk_value, 2) AS severity_2 FROM rules_v WHERE {where} ORDER BY ord LIMIT 1)"


_TAG, _NAT = _rule("contains(lower(scenario), 'tag')"), _rule("contains(scenario, 'nat')")
_BOTH = _rule("contains(scenario, 'the') AND contains(scenario, 'and')")
_COLUMNS = "{rule}.id AS rule_id, '{kind}' AS resource_type, CAST(resource_id AS VARCHAR) AS resource_id, {rule}.risk_detail AS risk_type"
_OFF = f"SELECT {_COLUMNS.format(rule='t', kind='volume')}, t.severity FROM resources, {_TAG} t WHERE NOT encrypted"
_FREE = f"""SELECT {_COLUMNS.format(rule='t', kind='address')}, t.severity FROM resources r, {_NAT} t
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = r.resource_id)"""
_AGE = f"CAST(floor(epoch(TIMESTAMP '{AS_OF}' - created) / 86400) AS BIGINT)"
_OLD = f"SELECT {_COLUMNS.format(rule='t', kind='key')}, t.severity_2 AS severity FROM resources, {_BOTH} t WHERE {_AGE} > 900"
_RUN = f"SELECT {_COLUMNS.format(rule='t', kind='instance')}, t.severity FROM resources, {_TAG} t WHERE running"


def _shown(df, *more):
    return df.select("rule_id", "resource_type", "resource_id", "risk_type", "severity", *more)


def _checks(spark, sf):
    resources, rules = view(spark, sf, "resources"), view(spark, sf, "rules_v")
    used = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("resource_id"))
    tag, nat = findings.rule_for(rules, "TAG", ignore_case=True), findings.rule_for(rules, "nat")
    return {
        "off": findings.attribute_off(resources, tag, "encrypted", "svc", "volume"),
        "free": findings.unassociated(resources, used, nat, "svc", "address"),
        "old": findings.too_old(resources, findings.rule_for(rules, "the", "and"), "created",
                                F.lit(AS_OF).cast("timestamp"), 900, "svc", "key"),
        "running": findings.running_candidates(resources, tag, "running", "svc", "instance"),
    }


query("g1_attribute_off", BASE + _OFF)(lambda spark, sf: _shown(_checks(spark, sf)["off"]))
query("g2_unassociated", BASE + _FREE)(lambda spark, sf: _shown(_checks(spark, sf)["free"]))
query("g3_too_old", BASE + _OLD.replace(" FROM resources", f", {_AGE} AS age_days FROM resources"))(
    lambda spark, sf: _shown(_checks(spark, sf)["old"], F.col("details")["age_days"].cast("long").alias("age_days")))
query("g4_running_candidates", BASE + _RUN)(lambda spark, sf: _shown(_checks(spark, sf)["running"]))
_ALL = "\nUNION ALL ".join((_OFF, _FREE, _OLD, _RUN))
query("u2_all_findings", BASE + _ALL)(lambda spark, sf: _shown(findings.all_findings(*_checks(spark, sf).values())))
query("a13_findings_by_risk", BASE + f"SELECT coalesce(risk_type, 'unknown') AS risk_type, count(*) AS n FROM ({_ALL}) f GROUP BY 1")(
    lambda spark, sf: findings.by_risk(findings.all_findings(*_checks(spark, sf).values())))


@query("j2_match_rules", BASE + """SELECT resource_id, id AS rule_id, service, usage, scenario, recommendation_action
FROM resources JOIN rules_v ON service = service_name WHERE contains(scenario, 'ingly') AND usage < 5000""")
def _match(spark, sf):
    return joins.match_rules(view(spark, sf, "resources"), view(spark, sf, "rules_v"), "ingly", "usage", 5000.0)


@query("j3_first_rule", BASE + f"SELECT id, risk_detail, severity FROM {_NAT} t")
def _first_rule(spark, sf):
    rule = findings.rule_for(view(spark, sf, "rules_v"), "nat")
    return rule.select("rule.id", "rule.risk_detail", F.coalesce("rule.risk_value", F.lit(1)).alias("severity"))


@query("g5_sustained_metric", BASE + """, w AS (SELECT resource_id, value, CAST(floor((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(ts) - 1) / 86400000000) AS BIGINT) AS d
 FROM metrics WHERE ts >= TIMESTAMP '2024-01-24 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00')
SELECT resource_id, count(DISTINCT d) AS days_seen, min(value) AS low, max(value) AS high, count(*) AS readings
FROM w GROUP BY 1 HAVING count(DISTINCT d) = 7 AND max(value) < 350""")
def _sustained(spark, sf):
    return findings.sustained_metric(view(spark, sf, "metrics"), "2024-01-31 00:00:00", 7, below=350.0)
