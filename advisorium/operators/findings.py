"""Findings: catalogue rules stamped on the resources that break them."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from advisorium.functions import text


def rule_for(rules: DataFrame, *texts: str, ignore_case: bool = False, order="ord") -> DataFrame:
    """The first rule whose scenario contains all the texts: one row with a struct ``rule``."""
    scenario = F.lower("scenario") if ignore_case else F.col("scenario")
    for wanted in texts:
        rules = rules.filter(scenario.contains(wanted.lower() if ignore_case else wanted))
    rule = F.struct("id", "risk_detail", "risk_value", "scenario", "recommendation_action")
    return rules.agg(F.min_by(rule, F.col(order)).alias("rule"))


def stamp(resources: DataFrame, rule: DataFrame, service: str, resource_type: str, resource_id,
          details: Column, default_severity: int = 1) -> DataFrame:
    """A finding per resource. The rule is a scalar subquery; without a rule nothing is found."""
    marked = resources.withColumn("__rule", rule.scalar()).filter(F.col("__rule").isNotNull())
    return marked.select(
        F.col("__rule.id").alias("rule_id"),
        F.lit(service).alias("service"),
        F.lit(resource_type).alias("resource_type"),
        F.col(resource_id).cast("string").alias("resource_id"),
        F.col("__rule.risk_detail").alias("risk_type"),
        F.coalesce("__rule.risk_value", F.lit(default_severity)).alias("severity"),
        F.col("__rule.scenario").alias("scenario"),
        F.col("__rule.recommendation_action").alias("recommendation"),
        details.alias("details"),
    )


def _details(**values) -> Column:
    pairs = [x for name, c in values.items() for x in (F.lit(name), c.cast("string"))]
    return F.create_map(*pairs)


def attribute_off(resources: DataFrame, rule: DataFrame, flag: str, service: str, resource_type: str) -> DataFrame:
    """Findings for resources whose boolean attribute is false or missing."""
    off = resources.filter(~F.coalesce(F.col(flag), F.lit(False)))
    details = _details(**{flag: F.coalesce(F.col(flag), F.lit(False))})
    return stamp(off, rule, service, resource_type, "resource_id", details)


def unassociated(resources: DataFrame, associations: DataFrame, rule: DataFrame, service: str, resource_type: str) -> DataFrame:
    """Findings for resources that no association refers to.

    The referring ids are made distinct before the join, so a resource referred to very often
    costs no more than any other.
    """
    used = associations.select("resource_id").distinct()
    free = resources.join(used, "resource_id", "left_anti")
    return stamp(free, rule, service, resource_type, "resource_id", _details(associated=F.lit(False)))


def too_old(resources: DataFrame, rule: DataFrame, created: str, as_of, max_days: int, service: str, resource_type: str) -> DataFrame:
    """Findings for resources older than ``max_days`` whole days at ``as_of``."""
    aged = resources.withColumn("age_days", text.age_days(created, as_of)).filter(F.col("age_days") > max_days)
    details = _details(age_days=F.col("age_days"), created_date=text.iso_timestamp(created))
    return stamp(aged, rule, service, resource_type, "resource_id", details, default_severity=2)


def running_candidates(resources: DataFrame, rule: DataFrame, running: str, service: str, resource_type: str) -> DataFrame:
    """Findings for all running resources, as candidates that need their metric checked."""
    details = _details(state=F.lit("running"), note=F.lit("Further monitoring required to confirm low utilization"))
    return stamp(resources.filter(F.col(running)), rule, service, resource_type, "resource_id", details)


def all_findings(*checks: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), checks)


def by_risk(findings: DataFrame) -> DataFrame:
    risk = F.coalesce("risk_type", F.lit("unknown")).alias("risk_type")
    return findings.groupBy(risk).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "risk_type")


def sustained_metric(metrics: DataFrame, as_of, days: int, below=None, above=None) -> DataFrame:
    """Resources whose metric stayed under (or over) a limit on every one of the last ``days`` days.

    Readings collapse to one row per resource and day before the days are compared, so a
    resource with very many readings is reduced before any shuffle. A day without a reading
    does not count as quiet.
    """
    end = F.lit(as_of).cast("timestamp")
    recent = metrics.filter((F.col("ts") >= end - F.expr(f"INTERVAL {days} DAYS")) & (F.col("ts") < end))
    # Days are counted back from as_of, so that a window need not start at midnight.
    day = F.floor((F.unix_micros(end) - F.unix_micros(F.col("ts").cast("timestamp")) - 1) / F.lit(86_400_000_000)).alias("days_back")
    daily = recent.groupBy("resource_id", day).agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.count(F.lit(1)).alias("readings"))
    quiet = F.lit(True)
    if below is not None:
        quiet = quiet & (F.col("high") < below)
    if above is not None:
        quiet = quiet & (F.col("low") > above)
    summary = daily.groupBy("resource_id").agg(
        F.count(F.lit(1)).alias("days_seen"), F.every(quiet).alias("held"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("readings").alias("readings"))
    return summary.filter((F.col("days_seen") == days) & F.col("held")).drop("held")
