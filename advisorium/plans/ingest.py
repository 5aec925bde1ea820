"""Batch ingest: every item of a run ends in exactly one outcome.

The text is read once, hashed and scored where it lies; the narrow result is written, and all
later steps work on that.
Joins are on the item number or on (source, hash) pairs that were made distinct before, so
neither a hot source nor a large group of copies meets in one task.
"""

from pyspark.sql import DataFrame, functions as F

from advisorium import model
from advisorium.functions import text
from advisorium.operators import enrich, quality, similarity
from advisorium.operators.ranking import first_items
from advisorium.operators.review import AUTO_PROMOTE_BELOW, promotion_outcomes, staged_rows
from advisorium.operators.spread import spread_lookup
from advisorium.sources.scratch import written

# Outcomes of an item, in the order the steps decide them.
OUTCOMES = ("capped", "seen", "duplicate", "dry_run", "not_converted", "convert_failed", "skipped",
            "validation_failed", "promoted", "staged")

_ENTRY = [f.name for f in model.RECOMMENDATION.fields]


def fresh_items(keys: DataFrame, seen: DataFrame, dry_run: bool = False) -> DataFrame:
    """Numbers of the items not seen before: (ord).

    The second copy of an item in a run counts as seen, except in a dry run, which marks
    nothing. Copies are reduced to one row per (source, hash) before any join.
    """
    pair = ["source_id", "content_hash"]
    firsts = keys.groupBy(*pair).agg(F.min("ord").alias("ord"))
    # Not an anti join: that would be pushed below the aggregate, to all copies of a hot pair.
    known = seen.select(*pair).distinct().withColumn("__known", F.lit(True))
    new = firsts.join(known, pair, "left").filter(F.col("__known").isNull()).drop("__known")
    if not dry_run:
        return new.select("ord")
    return spread_lookup(keys, new.select(*pair), pair, ["ord"], how="inner").select("ord")


def conversions(responses: DataFrame, at, contributor: str) -> DataFrame:
    """Per item the recommendation of the first or the second response, or why there is none.

    ``responses`` has ord, response and retry_response. Both go through one pass; the second
    counts only when the first was converted but broke a rule.
    """
    tries = F.array(
        F.struct(F.lit(1).alias("attempt"), F.col("response").alias("text")),
        F.struct(F.lit(2).alias("attempt"), F.col("retry_response").alias("text")))
    each = responses.select("ord", F.inline(tries))
    parsed = enrich.parse_responses(each, "text").select(
        "ord", "attempt", F.col("status").alias("conversion"), "recommendation.*")
    filled = enrich.backfill(parsed, at, contributor)
    checked = quality.with_errors(filled)
    entry = F.struct(*_ENTRY)
    result = F.struct(F.col("conversion").alias("status"), (F.size("errors") == 0).alias("valid"), entry.alias("entry"))
    one = checked.select("ord", "attempt", result.alias("r")).groupBy("ord").agg(
        F.max_by("r", F.when(F.col("attempt") == 1, 1)).alias("a"),
        F.max_by("r", F.when(F.col("attempt") == 2, 1)).alias("b"))
    first, second = F.col("a.status") == "converted", F.col("b.status") == "converted"
    good_first, good_second = first & F.col("a.valid"), second & F.col("b.valid")
    why = (F.when(F.col("a.status") == "skipped", "skipped").when(~first, "convert_failed")
           .when(~good_first & ~good_second, "validation_failed"))
    return one.select(
        "ord", why.alias("stopped"),
        F.when(good_first, F.col("a.entry")).when(first & good_second, F.col("b.entry")).alias("recommendation"),
        (first & ~F.col("a.valid")).alias("retried"))


def run(items: DataFrame, seen: DataFrame, existing: DataFrame, responses: DataFrame, catalog: DataFrame, at,
        contributor: str = "ingest", max_items=None, threshold: float = similarity.DUPLICATE_THRESHOLD,
        dry_run: bool = False, convert: bool = True, auto_promote: bool = True,
        promote_below: float = AUTO_PROMOTE_BELOW) -> DataFrame:
    """Outcome of every item, with the recommendation that a converted one has become.

    ``items``: source_id, ord (unique), title, body, content_hash. ``seen``: source_id,
    content_hash. ``existing``: position, scenario, text. ``responses``: ord, response,
    retry_response. ``catalog``: id.
    """
    keys = items.select("ord", "source_id", "content_hash")
    admitted = first_items(keys, max_items)
    # Most items of a run are known from earlier ones, so only the new ones are read, scored and parsed.
    fresh = written(fresh_items(admitted, seen, dry_run), "fresh")
    index = similarity.fit(existing, "text", "position")
    title_body = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("body", F.lit("")))
    scores = similarity.score(items.join(fresh, "ord", "left_semi"), index, "ord", title_body)
    scored = written(scores.select("ord", F.round("score", 4).alias("score"), "position"), "scores")
    is_duplicate = F.col("score") >= threshold

    if dry_run or not convert:
        results = scored.withColumns({
            "outcome": F.when(is_duplicate, "duplicate").otherwise("dry_run" if dry_run else "not_converted"),
            "retried": F.lit(False), "recommendation_id": F.lit(None).cast("string"),
            "recommendation": F.lit(None).cast(model.RECOMMENDATION)})
    else:
        wanted = scored.filter(~is_duplicate).select("ord")
        converted = conversions(responses.join(wanted, "ord", "left_semi"), at, contributor)
        known = scored.join(converted, "ord", "left")
        known = known.withColumns({
            "stopped": F.when(is_duplicate, "duplicate").when(F.col("recommendation").isNull(),
                                                              F.coalesce("stopped", F.lit("convert_failed"))),
            "id": F.when(~is_duplicate, F.col("recommendation.id")),
            "service_name": F.col("recommendation.service_name")})
        # Later steps read this table; without it the responses are parsed again.
        known = written(known, "converted")
        below = promote_below if auto_promote else -1.0
        decided = promotion_outcomes(
            known.drop("recommendation").withColumn("__score", F.when(F.col("stopped").isNull(), F.col("score"))),
            catalog, below, score="__score", order="ord")
        results = decided.withColumns({
            "outcome": F.coalesce("stopped", "outcome"),
            "retried": F.coalesce("retried", F.lit(False)) & ~is_duplicate,
            "recommendation_id": F.when(F.col("stopped").isNull(), F.col("id"))})
        made = known.filter("stopped IS NULL").select("ord", "recommendation")
        results = results.join(made, "ord", "left")

    results = results.select("ord", "score", "position", "retried", "recommendation_id", "recommendation", "outcome")
    everything = keys.join(results, "ord", "left")
    if max_items:
        marks = admitted.select("ord", F.lit(True).alias("__admitted"))
        everything = everything.join(marks, "ord", "left")
        waiting = F.when(F.col("__admitted").isNull(), "capped").otherwise("seen")
    else:
        waiting = F.lit("seen")
    return everything.select(
        "ord", "source_id", "content_hash", "score", "position", "recommendation_id", "recommendation",
        F.coalesce("retried", F.lit(False)).alias("retried"),
        F.coalesce("outcome", waiting).alias("outcome"))


def staged_records(outcomes: DataFrame, items: DataFrame, existing: DataFrame, staged_by: str, at) -> DataFrame:
    """The records of a run that wait for review: where they come from, the closest existing scenario, the recommendation.

    ``outcomes`` from ``run``; ``items`` may have url; ``existing`` has position and scenario.
    """
    waiting = outcomes.filter("outcome = 'staged'").select("ord", "source_id", "score", "position", "recommendation")
    url = F.col("url") if "url" in items.columns else F.lit(None).cast("string")
    waiting = written(waiting.join(items.select("ord", url.alias("url")), "ord", "left"), "staged")
    return staged_rows(similarity.with_closest(waiting, existing, "position", "scenario", "ord"), staged_by, at)


def promoted_entries(outcomes: DataFrame) -> DataFrame:
    """The entries of a run that join the catalogue at once."""
    return outcomes.filter("outcome = 'promoted'").select("recommendation.*")


def run_metrics(outcomes: DataFrame) -> DataFrame:
    """Counters of a run. A retried item counts by its final outcome only."""
    among = lambda name, *names: F.sum(F.when(F.col("outcome").isin(*names), 1).otherwise(0)).alias(name)
    return outcomes.agg(
        F.count(F.lit(1)).alias("items_fetched"),
        among("items_filtered_seen", "seen"),
        among("items_filtered_dedup", "duplicate"),
        among("items_converted", "validation_failed", "promoted", "staged"),
        among("items_convert_failed", "convert_failed"),
        among("items_convert_skipped", "skipped"),
        among("items_validated", "promoted", "staged"),
        among("items_validation_failed", "validation_failed"),
        among("items_staged", "staged"),
        among("items_auto_promoted", "promoted"),
        F.sum(F.when(F.col("retried"), 1).otherwise(0)).alias("items_retried"),
    )


def source_yield(outcomes: DataFrame) -> DataFrame:
    """Items, seen, duplicate and novel per source."""
    among = lambda *names: F.sum(F.when(F.col("outcome").isin(*names), 1).otherwise(0))
    counted = outcomes.filter(F.col("outcome") != "capped").groupBy("source_id").agg(
        F.count(F.lit(1)).alias("parsed"), among("seen").alias("seen"), among("duplicate").alias("duplicate"))
    return counted.withColumn("novel", F.col("parsed") - F.col("seen") - F.col("duplicate"))


def newly_seen(outcomes: DataFrame, at, every_item: bool = False) -> DataFrame:
    """Hashes to remember after a run.

    Only finished items are remembered, so that a failed conversion is tried again;
    ``every_item`` remembers all that were processed.
    """
    final = ("duplicate", "skipped", "promoted", "staged")
    kept = outcomes.filter(~F.col("outcome").isin("capped", "seen", "dry_run") if every_item
                           else F.col("outcome").isin(*final))
    return kept.select("source_id", "content_hash", F.lit(at).cast("timestamp").alias("seen_at")).distinct()


def raw_items(rows: DataFrame, source_id, position, content) -> DataFrame:
    """Items from whole texts: the first line is the title, the rest the body."""
    column = lambda c: F.col(c) if isinstance(c, str) else c
    split_at = F.locate("\n", column(content))
    title = F.when(split_at > 0, F.left(column(content), split_at - 1)).otherwise(column(content))
    body = F.when(split_at > 0, F.substring(column(content), split_at + 1, F.length(column(content)))).otherwise(F.lit(""))
    shaped = rows.select(column(source_id).alias("source_id"), column(position).alias("ord"),
                         title.alias("title"), body.alias("body"))
    return shaped.withColumn("content_hash", text.content_hash("title", "body"))
