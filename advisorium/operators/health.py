"""Health checks over the state of the ingest: every check yields (check, severity, message)."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from advisorium import model
from advisorium.functions import text
from advisorium.operators.ranking import latest_run

# Limits of the checks.
EMPTY_LIMIT = 3
ERROR_LIMIT = 3
STALE_DAYS = 7
STAGING_LIMIT = 100
MIN_CONVERSION = 0.50
MAX_SCHEMA_FAILURES = 0.10


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _result(df, check, severity, message):
    check = F.lit(check) if isinstance(check, str) else check
    return df.select(check.alias("check"), severity.alias("severity"), message.alias("message"))


def zero_yield(counters: DataFrame, limit: int = EMPTY_LIMIT) -> DataFrame:
    """Sources that returned nothing several times in a row."""
    source, n = F.col("source_id"), F.col("consecutive_empty")
    bad = n >= limit
    return _result(
        counters, "source_yields_zero", F.when(bad, "WARNING").otherwise("OK"),
        F.when(bad, _text("Source '", source, "' has returned 0 items for ", n, " consecutive runs"))
         .otherwise(_text("Source '", source, "': consecutive empty = ", n)))


def fetch_errors(counters: DataFrame, limit: int = ERROR_LIMIT) -> DataFrame:
    """Sources that failed several times in a row."""
    source, n = F.col("source_id"), F.col("consecutive_errors")
    bad = n >= limit
    return _result(
        counters, "http_errors", F.when(bad, "ERROR").otherwise("OK"),
        F.when(bad, _text("Source '", source, "' has had ", n, " consecutive fetch errors"))
         .otherwise(_text("Source '", source, "': consecutive errors = ", n)))


def stale_sources(config: DataFrame, state: DataFrame, as_of, days: int = STALE_DAYS) -> DataFrame:
    """Enabled sources not fetched lately; ``last_fetched_at`` is an ISO text that may be broken."""
    enabled = config.filter(F.coalesce("enabled", F.lit(True))).select("source_id")
    known = enabled.join(state.select("source_id", "last_fetched_at"), "source_id", "left")
    end = F.lit(as_of).cast("timestamp")
    known = known.withColumn("fetched", text.parse_iso("last_fetched_at"))
    known = known.withColumn("age", text.age_days("fetched", end))
    source = F.col("source_id")
    never = ~text.non_empty("last_fetched_at")
    late = F.col("fetched") < end - F.expr(f"INTERVAL {days} DAYS")
    return _result(
        known, "stale_source", F.when(never | F.col("fetched").isNull() | late, "WARNING").otherwise("OK"),
        F.when(never, _text("Source '", source, "' has never been fetched"))
         .when(F.col("fetched").isNull(), _text("Source '", source, "' has invalid last_fetched_at"))
         .when(late, _text("Source '", source, "' last fetched ", F.col("age"), " days ago"))
         .otherwise(_text("Source '", source, "' fetched recently")))


def staging_overflow(staged: DataFrame, limit: int = STAGING_LIMIT) -> DataFrame:
    counted = staged.agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    return _result(
        counted, "staging_overflow", F.when(n >= limit, "WARNING").otherwise("OK"),
        F.when(n >= limit, _text("Staging has ", n, f" unreviewed items (threshold: {limit})"))
         .otherwise(_text("Staging has ", n, " items")))


def state_integrity(state_text: DataFrame, column="value") -> DataFrame:
    """State documents that are not JSON, or not an object with ``sources``."""
    parsed = state_text.select(F.try_parse_json(column).alias("v"))
    kind = F.schema_of_variant("v")
    shaped = kind.startswith("OBJECT") & F.try_variant_get("v", "$.sources", "variant").isNotNull()
    good = F.coalesce(shaped, F.lit(False))
    return _result(
        parsed, "state_corruption", F.when(good, "OK").otherwise("CRITICAL"),
        F.when(F.col("v").isNull(), "State file is not valid JSON")
         .when(~good, "State file has invalid structure").otherwise("State file is valid"))


def run_quality(runs: DataFrame, ts="run_day") -> DataFrame:
    """Conversion and schema failure rates of the newest run; one OK row when there is none."""
    newest = latest_run(runs, ts)
    tried = F.col("items_converted") + F.col("items_convert_failed")
    checked = F.col("items_validated") + F.col("items_validation_failed")
    converted = F.col("items_converted") / F.nullif(tried, F.lit(0))
    failed = F.col("items_validation_failed") / F.nullif(checked, F.lit(0))
    percent = lambda rate: _text(F.rint(rate * 100).cast("int"), "%")
    row = lambda check, severity, message: F.struct(
        F.lit(check).alias("check"), F.lit(severity).alias("severity"), message.alias("message"))
    problems = F.array_compact(F.array(
        F.when(converted < MIN_CONVERSION, row(
            "low_conversion_rate", "WARNING",
            _text("LLM conversion rate was ", percent(converted), " in last run (", F.col("items_converted"), "/", tried, ")"))),
        F.when(failed > MAX_SCHEMA_FAILURES, row(
            "schema_failures", "ERROR", _text("Schema validation failure rate ", percent(failed), " in last run"))),
    ))
    fine = F.array(row("run_quality", "OK", F.lit("Last run quality is acceptable")))
    rated = newest.select(F.inline(F.when(F.size(problems) > 0, problems).otherwise(fine)))
    none = runs.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == 0)
    nothing = _result(none, "run_quality", F.lit("OK"), F.lit("No runs recorded yet"))
    return rated.unionByName(nothing)


def report(**checks: DataFrame) -> DataFrame:
    """All results of the chosen checks in one table, with the name each was chosen by."""
    named = [df.withColumn("chosen", F.lit(name)) for name, df in checks.items()]
    return reduce(lambda a, b: a.unionByName(b), named)


def overall(results: DataFrame) -> DataFrame:
    """Number of results per check and the worst severity among them."""
    ranks = F.array(*[F.lit(s) for s in model.SEVERITIES])
    rank = F.array_position(ranks, F.col("severity"))
    worst = results.groupBy("check").agg(F.count(F.lit(1)).alias("results"), F.max(rank).alias("rank"))
    return worst.select("check", "results", F.element_at(ranks, F.col("rank").cast("int")).alias("severity"))
