"""Ordered listings, per-group limits and trailing-run counters."""

from pyspark.sql import DataFrame, functions as F

from advisorium.operators.filters import in_services, risk_contains
from advisorium.operators.spread import first_n_per_group, keep_first

# Retention limits of the pipeline state.
MAX_HASHES_PER_SOURCE = 10_000
MAX_RUNS = 100


def service_listing(df: DataFrame, service: str) -> DataFrame:
    """Entries of a service, most urgent first, unrated last."""
    rows = in_services(df, service).select("id", "scenario", "risk_detail", "build_priority")
    return rows.orderBy(F.col("build_priority").asc_nulls_last(), "id")


def top_services(df: DataFrame, n: int = 10) -> DataFrame:
    counts = df.groupBy("service_name").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.col("service_name").asc_nulls_last()).limit(n)


def cost_opportunities(df: DataFrame, min_value: int = 2, zero_effort_last: bool = False) -> DataFrame:
    """Cost entries of enough value, least effort first, then most value.

    A missing effort sorts last; ``zero_effort_last`` sends zero there as well.
    """
    effort = F.nullif("effort_level", F.lit(0)) if zero_effort_last else F.col("effort_level")
    rows = risk_contains(df, "cost").filter(F.col("action_value") >= min_value)
    return rows.orderBy(F.coalesce(effort, F.lit(99)), F.desc("action_value"), "id")


def by_priority(df: DataFrame, zero_last: bool = False) -> DataFrame:
    """All entries by priority; a missing one counts as 99, and so does 0 with ``zero_last``."""
    priority = F.nullif("build_priority", F.lit(0)) if zero_last else F.col("build_priority")
    return df.orderBy(F.coalesce(priority, F.lit(99)), "id")


def distinct_services(df: DataFrame) -> DataFrame:
    return df.select("service_name").distinct().orderBy(F.col("service_name").asc_nulls_last())


def first_items(items: DataFrame, n, source="source_id", position="ord") -> DataFrame:
    """The first ``n`` items of each source by position; 0 or None is unlimited."""
    return first_n_per_group(items, [source], [position], n, [position])


def first_by_id(df: DataFrame, ids, position="ord") -> DataFrame:
    return keep_first(df, ids, [position])


def newest_hashes(seen: DataFrame, n: int = MAX_HASHES_PER_SOURCE) -> DataFrame:
    """The newest ``n`` seen hashes of each source."""
    order = [F.desc("seen_at"), F.desc("content_hash")]
    return first_n_per_group(seen, ["source_id"], order, n, ["content_hash"])


def last_runs(runs: DataFrame, n: int = MAX_RUNS, ts="run_day") -> DataFrame:
    """The newest ``n`` runs, newest first."""
    return runs.orderBy(F.desc(ts)).limit(n)


def latest_run(runs: DataFrame, ts="run_day") -> DataFrame:
    """The newest run as one row; no row when there is no run."""
    row = F.struct(*runs.columns)
    picked = runs.agg(F.max_by(row, F.col(ts)).alias("run"))
    return picked.filter(F.col("run").isNotNull()).select("run.*")


def latest_state(log: DataFrame) -> DataFrame:
    """Newest state per source; etag and last_modified keep the last non-empty value."""
    def last_given(c):
        return F.max_by(F.col(c), F.when(F.col(c) != "", F.col("ts"))).alias(c)

    return log.groupBy("source_id").agg(
        F.max("ts").alias("last_fetched_at"), last_given("etag"), last_given("last_modified"))


def trailing_counters(log: DataFrame, not_modified_is_empty: bool = False) -> DataFrame:
    """Length of the trailing run of errors and of empty fetches per source.

    ``log`` has source_id, ts, error, items and optionally not_modified. A success ends a run of
    errors; items or an error end a run of empty fetches. An unchanged source counts as empty
    only with ``not_modified_is_empty``; otherwise it leaves the empty counter alone.
    """
    if "not_modified" not in log.columns:
        log = log.withColumn("not_modified", F.lit(False))
    rows = log.select(
        "source_id", "ts",
        F.col("error").alias("is_error"),
        (~F.col("error") & (F.col("items") == 0)
         & (F.lit(not_modified_is_empty) | ~F.col("not_modified"))).alias("is_empty"),
        (F.col("error") | (F.col("items") > 0)).alias("ends_empty"),
    )
    ends = rows.groupBy("source_id").agg(
        F.max(F.when(~F.col("is_error"), F.col("ts"))).alias("last_success"),
        F.max(F.when(F.col("ends_empty"), F.col("ts"))).alias("last_non_empty"),
        F.max("ts").alias("last_ts"),
    )
    after = lambda end: F.col(end).isNull() | (F.col("ts") > F.col(end))
    count = lambda cond: F.sum(F.when(cond, 1).otherwise(0))
    # Adaptive execution broadcasts the ends where they are small, and splits a hot source where not.
    marked = rows.join(ends, "source_id")
    return marked.groupBy("source_id").agg(
        count(F.col("is_error") & after("last_success")).alias("consecutive_errors"),
        count(F.col("is_empty") & after("last_non_empty")).alias("consecutive_empty"),
        F.max("last_success").alias("last_success"),
        F.max("last_non_empty").alias("last_non_empty"),
        F.max("last_ts").alias("last_ts"),
    )
