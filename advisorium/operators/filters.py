"""Row filters over recommendation tables."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from advisorium.functions import text


def risk_contains(df: DataFrame, risk: str, column="risk_detail") -> DataFrame:
    """Rows whose risk text contains ``risk`` as a substring; null never matches."""
    return df.filter(F.col(column).contains(risk))


def has_risk(df: DataFrame, risk: str, column="risk_detail") -> DataFrame:
    """Rows that list exactly ``risk`` among their comma-separated risks."""
    return df.filter(F.array_contains(text.risks_of(column), risk))


def priority_at_most(df: DataFrame, limit: int, column="build_priority") -> DataFrame:
    return df.filter(F.col(column) <= limit)


def in_services(df: DataFrame, *services: str, column="service_name") -> DataFrame:
    return df.filter(F.col(column).isin(*services))


def search_listing(df: DataFrame, term: str, limit: int = 20) -> DataFrame:
    """The first ``limit`` matches in scenario or action; % and _ in the term are wildcards."""
    pattern = f"%{term}%"
    hit = F.col("scenario").ilike(pattern) | F.col("recommendation_action").ilike(pattern)
    found = df.filter(hit).orderBy("id").limit(limit)
    return found.select("id", "service_name", "scenario", "risk_detail")


def search_text(df: DataFrame, term: str, columns=("scenario", "recommendation_description_detailed")) -> DataFrame:
    """Rows with ``term`` as a literal substring of any column, ignoring case."""
    needle = term.lower()
    hits = [F.lower(F.col(c)).contains(needle) for c in columns]
    return df.filter(reduce(lambda a, b: a | b, [F.coalesce(h, F.lit(False)) for h in hits]))


def faceted(df: DataFrame, service=None, risk=None, priority=None, term=None) -> DataFrame:
    """All given facets at once; a facet that is None does not restrict."""
    if service is not None:
        df = in_services(df, service)
    if risk is not None:
        df = risk_contains(df, risk)
    if priority is not None:
        df = df.filter(F.col("build_priority") == priority)
    if term:
        df = search_text(df, term, ("scenario", "recommendation_description_detailed", "recommendation_action"))
    return df


def with_items(df: DataFrame, column: str) -> DataFrame:
    return df.filter(text.has_items(column))


def with_text(df: DataFrame, column: str) -> DataFrame:
    return df.filter(text.non_empty(column))


def security_critical(df: DataFrame, min_risk: int = 2) -> DataFrame:
    return risk_contains(df, "security").filter(F.col("risk_value") >= min_risk)


def quick_wins(df: DataFrame, max_priority: int = 1, max_effort: int = 1) -> DataFrame:
    """Urgent entries of little effort; a missing number counts as 99."""
    priority = F.coalesce("build_priority", F.lit(99))
    effort = F.coalesce("effort_level", F.lit(99))
    return df.filter((priority <= max_priority) & (effort <= max_effort)).orderBy(priority, effort, "id")


def urgent_cost(df: DataFrame) -> DataFrame:
    return risk_contains(df, "cost").filter(F.col("build_priority") == 0)


def security_with_remediation(df: DataFrame, column="remediation_examples") -> DataFrame:
    return with_items(risk_contains(df, "security"), column)


def enabled_sources(sources: DataFrame, source_type=None, source_ids=None) -> DataFrame:
    """Enabled sources; a source that does not say counts as enabled."""
    kept = sources.filter(F.coalesce("enabled", F.lit(True)))
    if source_type:
        kept = kept.filter(F.col("type") == source_type)
    if source_ids:
        kept = kept.filter(F.col("id").isin(*source_ids))
    return kept


def blank_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(text.is_blank(column))


# Smallest title and body an extracted item needs, per kind of source.
MINIMUM_CONTENT = {"feed": (1, 50), "block": (1, 20), "section": (5, 50)}


def passes_content_gate(title, body, kind: str):
    """True when title and body are long enough for an item of this kind."""
    min_title, min_body = MINIMUM_CONTENT[kind]
    return (F.length(title) >= min_title) & (F.length(body) >= min_body)
