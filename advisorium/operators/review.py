"""Staging area and review: listing, promotion, rejection."""

from pyspark.sql import DataFrame, functions as F

from advisorium.functions import text
from advisorium.operators.spread import keep_first

AUTO_PROMOTE_BELOW = 0.30


def staged_rows(df: DataFrame, staged_by: str, at) -> DataFrame:
    """Staged records: envelope fields, score rounded to four places, and the recommendation."""
    return df.select(
        text.iso_timestamp(at).alias("staged_at"), F.lit(staged_by).alias("staged_by"),
        "source_id", F.col("url").alias("source_url"), F.round("score", 4).alias("dedup_score"),
        F.col("closest").alias("closest_existing"), "recommendation")


def staged_listing(staged: DataFrame, service=None) -> DataFrame:
    """Listing row per staged record; a missing text shows empty, a missing score zero."""
    if service is not None:
        staged = staged.filter(F.col("service_name") == service)
    shown = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return staged.select(
        "id", *[shown(c) for c in ("source_id", "service_name", "scenario", "risk_detail", "closest_existing")],
        F.coalesce("dedup_score", F.lit(0.0)).alias("dedup_score")).orderBy("id")


def promotion_outcomes(staged: DataFrame, catalog: DataFrame, below: float = AUTO_PROMOTE_BELOW,
                       score="dedup_score", key="id", order="id") -> DataFrame:
    """Add ``outcome``: promoted or staged, with the reason.

    A record is promoted when it is unlike anything known, names a service, and its id is new:
    neither in the catalogue nor given to an earlier record that is promoted.
    """
    eligible = F.coalesce(F.col(score) < below, F.lit(False)) & text.non_empty("service_name")
    firsts = keep_first(staged.filter(eligible).select(key, F.col(order).alias("__first")), [key], ["__first"])
    free = firsts.join(catalog.select(key), key, "left_anti").select(
        F.col(key).alias("__key"), "__first", F.lit(True).alias("__free"))
    is_first = (F.col(key) == F.col("__key")) & (F.col(order) == F.col("__first"))
    marked = staged.join(free, is_first, "left")
    promoted = eligible & F.coalesce("__free", F.lit(False))
    reason = (F.when(F.coalesce(F.col(score) >= below, F.lit(True)), "not eligible")
              .when(~text.non_empty("service_name"), "no service")
              .when(promoted, "new").otherwise("duplicate id"))
    return (marked.withColumn("outcome", F.when(promoted, "promoted").otherwise("staged"))
            .withColumn("reason", reason).drop("__key", "__first", "__free"))


def decide(staged: DataFrame, decisions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Result of every decision (id, action, reason): promoted, rejected or an error."""
    asked = decisions.select("id", "action", F.col("reason").alias("given_reason"))
    rows = asked.join(staged.select("id", "service_name", F.lit(True).alias("__staged")), "id", "left")
    rows = rows.join(catalog.select("id", F.lit(True).alias("__known")).distinct(), "id", "left")
    result = (F.when(F.col("__staged").isNull(), "not found")
              .when(F.col("action") == "reject", "rejected")
              .when(~text.non_empty("service_name"), "no service")
              .when(F.col("__known").isNotNull(), "duplicate id").otherwise("promoted"))
    return rows.select("id", "action", "given_reason", "service_name", result.alias("result"))


def after_promotion(staged: DataFrame, results: DataFrame) -> DataFrame:
    """The staged records that remain once promoted and rejected ones are gone."""
    gone = results.filter(F.col("result").isin("promoted", "rejected")).select("id")
    return staged.join(gone, "id", "left_anti")


def catalog_counts(catalog: DataFrame, staged: DataFrame, results: DataFrame) -> DataFrame:
    """Entries per service after the promoted records have joined the catalogue."""
    promoted = results.filter(F.col("result") == "promoted").select("id")
    added = staged.join(promoted, "id", "left_semi").select("service_name")
    services = catalog.select("service_name").unionByName(added)
    return services.groupBy("service_name").agg(F.count(F.lit(1)).alias("n"))


def second_chance(df: DataFrame, first_valid: str, second_valid: str, first: str, second: str) -> DataFrame:
    """The first valid of two conversion results; ``retried`` marks rows that needed the second."""
    return df.withColumns({
        "recommendation": F.when(F.col(first_valid), F.col(first)).when(F.col(second_valid), F.col(second)),
        "retried": ~F.col(first_valid),
        "is_valid": F.col(first_valid) | F.col(second_valid),
    })
