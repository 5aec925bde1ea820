"""Joins between catalogue, sources, state and new items."""

from pyspark.sql import DataFrame, functions as F

from advisorium import model
from advisorium.functions import text
from advisorium.operators.spread import keep_first, key_counts, spread_lookup, spread_product
from advisorium.sources.scratch import written


def unnest(df: DataFrame, column: str, alias: str, *keep: str) -> DataFrame:
    """One row per array element; rows with an empty or missing array drop out."""
    return df.select(*keep, F.explode(column).alias(alias))


def match_rules(resources: DataFrame, rules: DataFrame, rule_text: str, metric: str, below: float, pairs_per_task: int = 1_000_000) -> DataFrame:
    """Resources under a metric limit with every rule of their service that mentions a text.

    Both sides are filtered before they meet, and meet on the service, where every resource meets every rule. So the result
    of a service is dealt over tasks by its pairs, about ``pairs_per_task`` to each (see ``spread_product``).
    """
    wanted = rules.filter(F.col("scenario").contains(rule_text)).select(
        F.col("service_name").alias("service"), F.col("id").alias("rule_id"), "scenario", "recommendation_action")
    low = resources.filter(F.col(metric) < below).select("resource_id", "service", metric)
    return spread_product(wanted, low, "service", ["rule_id", "scenario"], ["resource_id", metric], pairs_per_task).select(
        "resource_id", "rule_id", "service", metric, "scenario", "recommendation_action")


def unseen(items: DataFrame, seen: DataFrame) -> DataFrame:
    """Items whose (source, hash) is not in the seen table.

    Copies of one item share their hash, so the check runs once per distinct pair and comes
    back to the rows over dealt keys.
    """
    keys = ["source_id", "content_hash"]
    # Not a semi join: that would be pushed below the distinct, to all copies of a hot pair.
    counts = written(key_counts(items, keys), "counts")
    known = counts.select(*keys).join(seen.select(*keys).distinct(), keys)
    marked = spread_lookup(items, known.withColumn("__known", F.lit(True)), keys, ["ord"], counts=counts)
    return marked.filter(F.col("__known").isNull()).drop("__known")


def insert_if_absent(existing: DataFrame, new: DataFrame, key="id", position="ord") -> DataFrame:
    """Existing rows plus the first new row of every id that does not exist yet."""
    added = keep_first(new, [key], [position]).join(existing.select(key), key, "left_anti")
    return existing.unionByName(added.select(*existing.columns))


def risk_coverage(df: DataFrame, sources: DataFrame) -> DataFrame:
    """Entries and configured sources per risk, scarcest first, including risks with none."""
    rows = df.select(F.explode(F.array_distinct(text.risks_of("risk_detail"))).alias("risk"))
    entries = rows.groupBy("risk").agg(F.count(F.lit(1)).alias("entries"))
    feeds = sources.select(F.explode(F.array_distinct("categories")).alias("risk"))
    feeds = feeds.groupBy("risk").agg(F.count(F.lit(1)).alias("sources"))
    spark = df.sparkSession
    risks = spark.createDataFrame([(r,) for r in model.RISKS], "risk string")
    counted = risks.join(entries, "risk", "left").join(feeds, "risk", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return counted.select("risk", zero("entries"), zero("sources")).orderBy("entries", "risk")
