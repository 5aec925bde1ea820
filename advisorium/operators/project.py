"""Projections: flat table rows, display rows and export rows."""

from pyspark.sql import Column, DataFrame, functions as F

from advisorium import model
from advisorium.functions import text
from advisorium.operators.spread import placed


def flatten(entries: DataFrame, extra: bool = False) -> DataFrame:
    """Nested entries to the 25-column table: metadata lifted, missing arrays empty.

    Arrays and structs stay native; ``as_json`` turns them into text at the edge. ``extra``
    also keeps the four declared fields outside the table.
    """
    schema = {f.name: f.dataType for f in model.RECOMMENDATION.fields}
    columns = [F.col(c) for c in model.FLAT_TEXT[:6] + model.FLAT_INTEGERS + model.FLAT_TEXT[6:]]
    columns += [F.col(f"metadata.{c}").alias(c) for c in model.FLAT_METADATA]
    columns += [F.coalesce(F.col(c), F.array().cast(schema[c])).alias(c) for c in model.FLAT_ARRAYS]
    contributors = F.coalesce(F.col("metadata.contributors"), F.array().cast("array<string>"))
    columns.append(contributors.alias("contributors"))
    if extra:
        columns += [F.col(c) for c in model.FLAT_EXTRA]
    return entries.select(*columns)


def as_json(df: DataFrame) -> DataFrame:
    """Arrays and structs as JSON text, for sinks that hold only scalars."""
    nested = ("array", "struct", "map")
    return df.select(*[
        F.to_json(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.typeName() in nested else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


COMPARED = ("scenario", "alert_criteria", "recommendation_action", "recommendation_description_detailed")
CLASSIFIED = COMPARED + ("notes",)


def comparison_text(columns=COMPARED) -> Column:
    """The non-empty comparison fields joined with a space."""
    return F.concat_ws(" ", *[F.nullif(F.col(c), F.lit("")) for c in columns])


def classification_text(columns=CLASSIFIED) -> Column:
    """All classification fields joined and lower-cased; a missing field is empty text."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns]))


def priority_label(c="build_priority") -> Column:
    return F.when(F.col(c) == 0, "critical").when(F.col(c) == 1, "high").when(F.col(c) == 2, "medium").otherwise("low")


def priority_display(c="build_priority") -> Column:
    return F.concat(F.lit("P"), F.coalesce(F.col(c).cast("string"), F.lit("?")))


def insight_rows(df: DataFrame, category: str, type_prefix: str, source: str) -> DataFrame:
    """Rows in the shape cost-insight tools import."""
    return df.select(
        "id",
        F.lit(category).alias("category"),
        F.concat(F.lit(f"{type_prefix}:"), F.col("service_name")).alias("resource_type"),
        F.col("scenario").alias("title"),
        F.col("recommendation_action").alias("recommendation"),
        priority_label().alias("priority"),
        F.lit(source).alias("source"),
    )


def detector_rules(df: DataFrame, method: str, name_prefix: str, owner: str, identifier: str) -> DataFrame:
    """One detector skeleton per detection method of the given kind, for rows with criteria."""
    usable = df.filter(text.has_items("detection_methods") & text.non_empty("alert_criteria"))
    each = usable.select("id", "service_name", "scenario", "alert_criteria", F.explode("detection_methods").alias("m"))
    parameters = F.to_json(F.struct(
        F.col("alert_criteria").alias("alert_criteria"),
        F.coalesce("m.details", F.lit("")).alias("detection_details"),
    ))
    return each.filter(F.col("m.method") == method).select(
        "id",
        F.concat(F.lit(f"{name_prefix}-"), F.col("service_name"), F.lit("-check")).alias("rule_name"),
        F.left("scenario", F.lit(256)).alias("description"),
        F.lit(owner).alias("owner"),
        F.lit(identifier).alias("identifier"),
        parameters.alias("input_parameters"),
    )


def context_block() -> Column:
    """Three-line text block of a recommendation, for use in a prompt."""
    part = lambda c: F.coalesce(F.col(c), F.lit(""))
    return F.concat(
        F.lit("**"), F.upper(part("service_name")), F.lit("**: "), part("scenario"),
        F.lit("\nAction: "), part("recommendation_action"),
        F.lit("\nRisk: "), part("risk_detail"), F.lit("\n\n"),
    )


def service_contexts(df: DataFrame, preamble: str = "") -> DataFrame:
    """The context of each service as ordered blocks: service_name, position, offset, block.

    The context of a service is the preamble and then its blocks by id; ``offset`` is the character at which a block
    begins. A service of any size is a set of rows, of which a reader takes what a prompt can hold.
    """
    blocks = df.select("id", "service_name", context_block().alias("block"))
    found = placed(blocks, "service_name", ["id", F.xxhash64("block")], F.length("block"))
    return found.select("service_name", "position", (F.col("offset") + len(preamble)).alias("offset"), "block")


def question_answers(df: DataFrame) -> DataFrame:
    """A question and an answer turn per entry, in the layout of a conversation table."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    question = F.concat(F.lit("I use "), value("service_name"), F.lit(". Are there any issues with: "), value("scenario"), F.lit("?"))
    answer = F.concat(
        F.lit("Based on best practices, this configuration has the following issue: "), value("scenario"),
        F.lit(".\nRisk Type: "), value("risk_detail"),
        F.lit("\nSeverity: "), value("risk_value"),
        F.lit("\nRecommendation: "), value("recommendation_action"),
        F.lit("\nDetailed Explanation: "), value("recommendation_description_detailed"),
    )
    turns = F.array(
        F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role"), question.alias("text")),
        F.struct(F.lit(1).alias("turn"), F.lit("assistant").alias("role"), answer.alias("text")),
    )
    return df.select(F.col("id").alias("conv_id"), F.inline(turns))


def search_display(df: DataFrame) -> DataFrame:
    """Search hits as display lines, scenario cut to 70 characters."""
    return df.select("id", "service_name", text.shorten("scenario", 70, "...").alias("scenario"), "risk_detail")


def service_display(df: DataFrame) -> DataFrame:
    """Entries as display lines with P0-P3 or P?, scenario cut to 65 characters."""
    return df.select("id", priority_display().alias("priority"), text.shorten("scenario", 65, "...").alias("scenario"), "risk_detail")
