"""Classification and filling of missing fields by rule tables."""

from pyspark.sql import Column, DataFrame, functions as F

from advisorium import model
from advisorium.functions import rule_tables, text
from advisorium.functions.rules import contains_any, first_matching, first_outcome, literals_of, occurring
from advisorium.operators.project import CLASSIFIED, classification_text


def classified_service(df: DataFrame, rules=rule_tables.SERVICE_RULES, keep=rule_tables.GENERAL_PATTERNS) -> DataFrame:
    """Add ``classified``: the service of the first matching rule, null where a row stays."""
    present = [c for c in CLASSIFIED if c in df.columns]
    prepared = df.withColumn("__text", classification_text(present))
    prepared = prepared.withColumn("__held", occurring(F.col("__text"), literals_of(rules, keep)))
    chosen = first_matching(F.col("__text"), F.col("__held"), rules, keep)
    return prepared.withColumn("classified", chosen).drop("__text", "__held")


def reclassify(df: DataFrame, rules=rule_tables.SERVICE_RULES, keep=rule_tables.GENERAL_PATTERNS,
               from_service="general") -> DataFrame:
    """Move the matching entries of one service to the services of their rules.

    Moving is a change of one column; ``moved`` marks the rows. Entries already elsewhere stay.
    """
    marked = classified_service(df, rules, keep)
    moves = (F.col("service_name") == from_service) & F.col("classified").isNotNull()
    return (marked.withColumn("moved", F.coalesce(moves, F.lit(False)))
            .withColumn("service_name", F.when(F.col("moved"), F.col("classified")).otherwise(F.col("service_name")))
            .drop("classified"))


def record_move(df: DataFrame, contributor: str, at) -> DataFrame:
    """Update the metadata of moved entries; a contributor is listed once."""
    metadata = F.col("metadata")
    people = F.coalesce(metadata["contributors"], F.array().cast("array<string>"))
    updated = F.struct(
        metadata["created_at"].alias("created_at"),
        text.iso_timestamp(at).alias("updated_at"),
        F.when(F.array_contains(people, contributor), people)
         .otherwise(F.array_append(people, F.lit(contributor))).alias("contributors"),
        metadata["source"].alias("source"),
    )
    return df.withColumn("metadata", F.when(F.col("moved"), updated).otherwise(metadata))


def _scopes(scenario: Column, risk: Column) -> dict:
    scopes = {"idle": contains_any(scenario, rule_tables.IDLE_WORDS), "any": F.lit(True)}
    for name in ("security", "cost", "performance", "reliability"):
        scopes[name] = risk.contains(name)
    return scopes


def _given(c) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def derived_alert(outcomes=rule_tables.ALERT_OUTCOMES) -> Column:
    """Alert criteria from scenario and risk."""
    lowered = F.lower(_given("scenario"))
    start = F.left(_given("scenario"), F.lit(rule_tables.ALERT_PREFIX_CHARS))
    fallback = F.concat(F.lit(rule_tables.ALERT_PREFIX), start)
    return first_outcome(outcomes, lowered, _scopes(lowered, _given("risk_detail")), fallback)


def derived_action(outcomes=rule_tables.ACTION_OUTCOMES) -> Column:
    """Recommended action from scenario and risk."""
    lowered = F.lower(_given("scenario"))
    return first_outcome(outcomes, lowered, _scopes(lowered, _given("risk_detail")), F.lit(rule_tables.DEFAULT_ACTION))


def derived_effort() -> Column:
    lowered = F.lower(_given("scenario"))
    return (F.when(contains_any(lowered, rule_tables.HIGH_EFFORT_WORDS), 3)
            .when(contains_any(lowered, rule_tables.LOW_EFFORT_WORDS), 1).otherwise(2))


def _by_priority(otherwise: Column) -> Column:
    # Priority 0 rates 3, priority 1 rates 2, any lower priority rates 1.
    priority = F.col("build_priority")
    return F.when(priority == 0, 3).when(priority == 1, 2).when(priority >= 2, 1).otherwise(otherwise)


def _by_risk(ratings: dict) -> Column:
    risk = F.coalesce("risk_detail", F.lit("operations"))
    rated = F.lit(None).cast("int")
    for name, rating in reversed(ratings.items()):
        rated = F.when(risk.contains(name), rating).otherwise(rated)
    return F.coalesce(rated, F.lit(2))


def derived_risk() -> Column:
    # Risk rating by the first risk found.
    return _by_priority(_by_risk({"security": 3, "cost": 1, "reliability": 3, "performance": 2}))


def derived_value() -> Column:
    # Value rating by the first risk found.
    return _by_priority(_by_risk({"security": 3, "cost": 3, "reliability": 3, "performance": 2}))


def fill_missing(df: DataFrame, alerts=rule_tables.ALERT_OUTCOMES, actions=rule_tables.ACTION_OUTCOMES) -> DataFrame:
    """Fill blank texts and missing numbers; ``modified`` marks the rows that changed."""
    blanks = [text.is_blank("alert_criteria"), text.is_blank("recommendation_action")]
    nulls = [F.col(c).isNull() for c in ("effort_level", "risk_value", "action_value")]
    changed = blanks[0]
    for condition in blanks[1:] + nulls:
        changed = changed | condition
    return df.withColumns({
        "modified": changed,
        "alert_criteria": F.when(blanks[0], derived_alert(alerts)).otherwise(F.col("alert_criteria")),
        "recommendation_action": F.when(blanks[1], derived_action(actions)).otherwise(F.col("recommendation_action")),
        "effort_level": F.coalesce("effort_level", derived_effort()),
        "risk_value": F.coalesce("risk_value", derived_risk()),
        "action_value": F.coalesce("action_value", derived_value()),
    })


def backfill(df: DataFrame, at, contributor: str, id_from=("service_name", "scenario"),
             alerts=rule_tables.ALERT_OUTCOMES_COMPACT, actions=rule_tables.ACTION_OUTCOMES_COMPACT) -> DataFrame:
    """Complete converted entries: id, derived fields, metadata defaults and empty arrays."""
    now = text.iso_timestamp(at)
    metadata = F.col("metadata")
    columns = {
        "id": F.coalesce(F.nullif("id", F.lit("")), text.stable_id(*id_from)),
        "alert_criteria": F.coalesce(F.nullif("alert_criteria", F.lit("")), derived_alert(alerts)),
        "recommendation_action": F.coalesce(F.nullif("recommendation_action", F.lit("")), derived_action(actions)),
        "effort_level": F.coalesce("effort_level", derived_effort()),
        "risk_value": F.coalesce("risk_value", derived_risk()),
        "action_value": F.coalesce("action_value", derived_value()),
    }
    if "metadata" in df.columns:
        columns["metadata"] = F.struct(
            F.coalesce(metadata["created_at"], now).alias("created_at"),
            F.coalesce(metadata["updated_at"], now).alias("updated_at"),
            F.coalesce(metadata["contributors"], F.array(F.lit(contributor))).alias("contributors"),
            metadata["source"].alias("source"),
        )
    for c in ("references", "tags"):
        if c in df.columns:
            columns[c] = F.coalesce(F.col(c), F.array().cast("array<string>"))
    return df.withColumns(columns)


def entries_from_csv(rows: DataFrame, at, contributor: str, source: str) -> DataFrame:
    """Catalogue entries from imported CSV rows (see ``sources.files.read_csv``)."""
    now = text.iso_timestamp(at)
    given = {c.strip(): c for c in rows.columns}
    raw = lambda c: F.col(f"`{given[c]}`") if c in given else F.lit(None).cast("string")
    cleaned = lambda c: text.clean_text(raw(c))
    none = F.array().cast("array<string>")
    built = {
        "id": text.stable_id(*[raw(c) for c in sorted(given)]),
        "status": F.coalesce(cleaned("status"), F.lit("open")),
        "service_name": F.coalesce(cleaned("service_name"), F.lit("general")),
        "risk_detail": text.normalise_risk(raw("risk_detail")),
        "category": text.normalise_category(raw("rec_category")),
        "output_notes": cleaned("output (pro / con)"),
        "notes": cleaned("notes"),
        "references": text.http_links(raw("link_1"), raw("link_2"), raw("link_3")),
        "tags": none,
        "metadata": F.struct(now.alias("created_at"), now.alias("updated_at"),
                             F.array(F.lit(contributor)).alias("contributors"), F.lit(source).alias("source")),
    }
    for c in ("scenario", "alert_criteria", "recommendation_action", "recommendation_description_detailed"):
        built[c] = F.coalesce(cleaned(c), F.lit(""))
    for c in model.FLAT_INTEGERS:
        built[c] = text.safe_int(raw(c))
    return rows.select(*[
        built.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in model.RECOMMENDATION.fields
    ])


def _is_true(value, path):
    """Truth of a JSON value by its type: false, null, zero and what is empty are false, all else is true."""
    kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
    text_value = F.try_variant_get(value, path, "string")
    return F.coalesce(
        F.when(kind == "VOID", False).when(kind == "BOOLEAN", text_value == "true").when(kind == "STRING", text_value != "")
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), ~text_value.isin("[]", "{}"))
        .otherwise(F.try_variant_get(value, path, "double") != 0), F.lit(False))


def parse_responses(df: DataFrame, column="response") -> DataFrame:
    """Add ``status`` (converted, skipped, failed) and the parsed ``recommendation``.

    A response may be fenced; the fence lines are removed. A ``skip`` value that is true by its type drops it,
    anything but a JSON object has failed.
    """
    body = text.strip(F.col(column))
    unfenced = F.regexp_replace(F.regexp_replace(body, "^```[^\\n]*\\n?", ""), "\\n[ \\t\\r]*```[ \\t\\r]*$", "")
    fence_free = F.when(body.startswith("```"), unfenced).otherwise(body)
    parsed = df.withColumn("__json", fence_free).withColumn("__value", F.try_parse_json("__json"))
    is_object = F.coalesce(F.schema_of_variant("__value").startswith("OBJECT"), F.lit(False))
    skipped = _is_true("__value", "$.skip")
    status = F.when(~is_object, "failed").when(skipped, "skipped").otherwise("converted")
    recommendation = F.when(F.col("status") == "converted", F.from_json("__json", model.RECOMMENDATION))
    return (parsed.withColumn("status", status)
            .withColumn("recommendation", recommendation).drop("__json", "__value"))
