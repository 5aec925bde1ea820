"""Writers. Partitioned tables are rebalanced first, so a hot key becomes several files of
bounded size instead of one task's work, and small keys share tasks."""

from pyspark.sql import DataFrame, functions as F, types as T

from advisorium.functions import text
from advisorium.operators import quality
from advisorium.operators.project import as_json, flatten
from advisorium.operators.ranking import MAX_RUNS, last_runs
from advisorium.operators.spread import placed


class RepeatedIds(ValueError):
    """The key of a table occurs more than once."""


def require_unique(df: DataFrame, key="id") -> DataFrame:
    """``df`` itself; raises when an id occurs twice."""
    example = quality.repeated_ids(df.select(key), key).limit(1).collect()
    if example:
        raise RepeatedIds(f"{key} {example[0][key]!r} occurs {example[0]['n']} times")
    return df


def build_table(entries: DataFrame, path: str) -> None:
    """Flatten entries and replace the table; a repeated id aborts before anything is written."""
    flatten(require_unique(entries)).write.mode("overwrite").parquet(path)


def keyed_by_service(df: DataFrame) -> DataFrame:
    return df.withColumn("service_key", text.storage_key("service_name"))


def write_by_service(df: DataFrame, path: str) -> None:
    keyed = keyed_by_service(df).hint("rebalance", F.col("service_key"))
    keyed.write.mode("overwrite").partitionBy("service_key").parquet(path)


def service_counts(df: DataFrame) -> DataFrame:
    """Service key and number of entries of every service folder."""
    return keyed_by_service(df).groupBy("service_key").agg(F.count(F.lit(1)).alias("count"))


def envelope_entries(df: DataFrame) -> DataFrame:
    """The entries of all service envelopes: service, position (from 0, by id), entry.

    With ``service_counts`` this is the content of the envelopes, whatever the size of a service: a row per entry, in an
    order that several tasks can write and one reader can follow.
    """
    entry = F.struct("id", *[c for c in df.columns if c != "id"])
    rows = df.select(F.col("service_name").alias("service"), "id", entry.alias("entry"))
    return placed(rows, "service", ["id", F.xxhash64("entry")]).select("service", "position", "entry")


def write_envelopes(df: DataFrame, path: str) -> None:
    """Envelopes for JSON export: ``entries`` (a folder per service, files of ordered JSON lines) and ``headers`` (service, count)."""
    entries = envelope_entries(df).withColumn("service_key", text.storage_key("service"))
    ranged = entries.repartitionByRange("service_key", "position").sortWithinPartitions("service_key", "position")
    ranged.write.mode("overwrite").partitionBy("service_key").json(f"{path}/entries")
    headers = df.groupBy(F.col("service_name").alias("service")).agg(F.count(F.lit(1)).alias("count"))
    headers.withColumn("service_key", text.storage_key("service")).write.mode("overwrite").json(f"{path}/headers")


def read_envelope(spark, path: str, service: str, entry_type) -> DataFrame:
    """position and entry of one written envelope, in order; only the files of that service are read."""
    rows = spark.read.schema(T.StructType([T.StructField("service", T.StringType()), T.StructField("position", T.LongType()),
                                           T.StructField("entry", entry_type), T.StructField("service_key", T.StringType())]))
    found = rows.json(f"{path}/entries").filter((F.col("service_key") == text.storage_key(F.lit(service))) & (F.col("service") == service))
    return found.select("position", "entry").orderBy("position")


def category_rows(df: DataFrame) -> DataFrame:
    """Every entry once under its category and once under each of its risks."""
    risks = F.when(text.non_empty("risk_detail"), text.risks_of("risk_detail"))
    groups = F.concat(
        F.array_compact(F.array(F.nullif("category", F.lit("")))),
        F.coalesce(risks, F.array().cast("array<string>")))
    return df.withColumn("group", F.explode(F.array_distinct(groups)))


def write_by_category(df: DataFrame, path: str) -> None:
    keyed = category_rows(df).withColumn("group_key", text.storage_key("group"))
    keyed.hint("rebalance", F.col("group_key")).write.mode("overwrite").partitionBy("group_key").parquet(path)


def catalog_index(df: DataFrame) -> DataFrame:
    """Header of the unified catalogue: the total, the services and the categories as rows."""
    total = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit("total").alias("kind"), F.lit("all").alias("name"), "n")
    services = df.groupBy("service_name").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("service").alias("kind"), F.col("service_name").alias("name"), "n")
    groups = category_rows(df.select("category", "risk_detail")).groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    groups = groups.select(F.lit("category").alias("kind"), F.col("group").alias("name"), "n")
    return total.unionByName(services).unionByName(groups)


def append_staged(staged: DataFrame, path: str) -> None:
    staged.write.mode("append").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; arrays and structs as JSON text."""
    as_json(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_findings(findings: DataFrame, path: str, scan_date: str) -> None:
    """Findings as JSON lines under ``findings`` and one summary row under ``summary``."""
    findings.write.mode("overwrite").json(f"{path}/findings")
    summary = findings.agg(F.count(F.lit(1)).alias("total_findings"))
    summary.select(F.lit(scan_date).alias("scan_date"), "total_findings").write.mode("overwrite").json(f"{path}/summary")


def with_run(runs: DataFrame, run: DataFrame, keep: int = MAX_RUNS, ts="run_day") -> DataFrame:
    """The run table with one more run, cut to the newest ``keep``."""
    return last_runs(runs.unionByName(run), keep, ts)
