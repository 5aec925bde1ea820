"""Counts over the catalogue. Every one is a partial aggregate before its only shuffle."""

from pyspark.sql import DataFrame, functions as F

from advisorium import model
from advisorium.functions import text
from advisorium.operators.filters import risk_contains


def _count(name="n"):
    return F.count(F.lit(1)).alias(name)


def by_service(df: DataFrame) -> DataFrame:
    return df.groupBy("service_name").agg(_count()).orderBy(F.desc("n"), F.col("service_name").asc_nulls_last())


def by_category(df: DataFrame) -> DataFrame:
    return df.filter(F.col("category").isNotNull()).groupBy("category").agg(_count()).orderBy(F.desc("n"), "category")


def by_priority(df: DataFrame) -> DataFrame:
    return df.filter(F.col("build_priority").isNotNull()).groupBy("build_priority").agg(_count()).orderBy("build_priority")


def risk_bucket(column="risk_detail"):
    """The single bucket of a row: the first risk it mentions, in a fixed order."""
    risk = F.col(column)
    first, *rest = model.RISK_BUCKET_ORDER
    bucket = F.when(risk.contains(first), first)
    for name in rest:
        bucket = bucket.when(risk.contains(name), name)
    return bucket.otherwise("other")


def by_risk_bucket(df: DataFrame) -> DataFrame:
    """Entries per risk, each entry counted once."""
    return df.groupBy(risk_bucket().alias("risk_type")).agg(_count()).orderBy(F.desc("n"), "risk_type")


def by_each_risk(df: DataFrame) -> DataFrame:
    """Entries per risk, an entry counted under every risk it lists."""
    rows = df.filter(text.non_empty("risk_detail")).select(F.explode(text.risks_of("risk_detail")).alias("risk_type"))
    return rows.groupBy("risk_type").agg(_count()).orderBy(F.desc("n"), "risk_type")


def _tally(df, pairs) -> DataFrame:
    """Count (dimension, key) pairs in one pass over the rows; null keys are left out."""
    each = df.select(F.inline(F.filter(pairs, lambda p: p["key"].isNotNull())))
    return each.groupBy("dimension", "key").agg(_count())


def _pair(dimension, key):
    return F.struct(F.lit(dimension).alias("dimension"), key.cast("string").alias("key"))


def _risk_pairs(dimension):
    given = F.when(text.non_empty("risk_detail"), text.risks_of("risk_detail"))
    return F.transform(F.coalesce(given, F.array().cast("array<string>")), lambda r: _pair(dimension, r))


def statistics(df: DataFrame) -> DataFrame:
    """Total and counts by service, category, risk and priority as (dimension, key, n) rows."""
    pairs = F.concat(
        F.array(
            _pair("total", F.lit("entries")),
            _pair("service", F.coalesce("service_name", F.lit("unknown"))),
            _pair("category", F.nullif("category", F.lit(""))),
            _pair("priority", F.col("build_priority")),
        ),
        _risk_pairs("risk"),
    )
    return _tally(df, pairs)


def ordered_statistics(df: DataFrame) -> DataFrame:
    """The statistics with the largest count of each dimension first."""
    return statistics(df).orderBy("dimension", F.desc("n"), "key")


def risky_services(df: DataFrame, risk: str) -> DataFrame:
    return by_service(risk_contains(df, risk))


def by_pattern(df: DataFrame) -> DataFrame:
    rows = df.select(F.explode("architectural_patterns").alias("p"))
    return rows.groupBy(F.col("p.pattern_name").alias("pattern_name")).agg(_count()).orderBy(F.desc("n"), "pattern_name")


def import_summary(df: DataFrame) -> DataFrame:
    """Totals, distinct services, and counts by status, risk and service of an import."""
    pairs = F.concat(
        F.array(
            _pair("total_entries", F.lit("all")),
            _pair("status", F.coalesce("status", F.lit("unknown"))),
            _pair("service", F.col("service_name")),
        ),
        _risk_pairs("risk"),
    )
    counts = _tally(df, pairs)
    services = counts.filter(F.col("dimension") == "service").agg(_count()).select(
        F.lit("total_services").alias("dimension"), F.lit("all").alias("key"), "n")
    return counts.unionByName(services)


def total(df: DataFrame) -> DataFrame:
    return df.agg(_count())


def staging_size(staged: DataFrame, limit: int = 100) -> DataFrame:
    counted = staged.agg(_count())
    return counted.select("n", F.when(F.col("n") >= limit, "WARNING").otherwise("OK").alias("severity"))


def run_rates(runs: DataFrame) -> DataFrame:
    """Conversion rate and schema failure rate per run; null when nothing was attempted."""
    def rate(part, rest):
        return F.col(part) / F.nullif(F.col(part) + F.col(rest), F.lit(0))

    return runs.select(
        "run_day",
        F.round(rate("items_converted", "items_convert_failed"), 6).alias("conversion_rate"),
        F.round(rate("items_validation_failed", "items_validated"), 6).alias("schema_failure_rate"),
    )
