"""Readers. All use declared schemas, so nothing is inferred and nothing is read twice."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from advisorium import model
from advisorium.functions import text
from advisorium.operators.spread import first_n_per_group


def _empty_if_missing(spark, read, schema):
    """The frame ``read()`` yields, or an empty one when the path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or no rows where it does not exist yet."""
    return _empty_if_missing(spark, lambda: spark.read.schema(schema).parquet(path), schema)


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Service files as they are: service, count, misconfigurations, and the file name."""
    schema = T.StructType([*model.SERVICE_ENVELOPE.fields, T.StructField("file_name", T.StringType())])

    def read():
        files = spark.read.schema(model.SERVICE_ENVELOPE).option("multiLine", True).option("pathGlobFilter", "*.json")
        return files.json(path).withColumn("file_name", F.col("_metadata.file_name"))

    return _empty_if_missing(spark, read, schema)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """All entries of the service files with their file and position; a missing folder is empty."""
    envelopes = read_envelopes(spark, path)
    return envelopes.select("file_name", F.posexplode("misconfigurations").alias("pos", "entry")).select(
        "file_name", "pos", "entry.*")


def read_any_shape(spark: SparkSession, path: str) -> DataFrame:
    """Entries of files that hold an envelope, a bare list, or a single entry."""
    schema = T.StructType([*model.RECOMMENDATION.fields, *model.SERVICE_ENVELOPE.fields])
    rows = spark.read.schema(schema).option("multiLine", True).json(path).withColumn("file_name", F.col("_metadata.file_name"))
    names = model.RECOMMENDATION.fieldNames()
    wrapped = rows.filter(F.col("misconfigurations").isNotNull())
    wrapped = wrapped.select("file_name", F.explode("misconfigurations").alias("e")).select("file_name", "e.*")
    plain = rows.filter(F.col("misconfigurations").isNull()).select("file_name", *names)
    return wrapped.unionByName(plain)


def read_service(spark: SparkSession, path: str, service: str) -> DataFrame:
    """One service of a table from ``writers.write_by_service``; only its folder is read."""
    return spark.read.parquet(path).filter(F.col("service_key") == text.storage_key(F.lit(service)))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV rows with a header, as text; empty rows and rows without service and scenario drop out."""
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"', ignoreLeadingWhiteSpace=False)
    rows = rows.filter(F.coalesce(*[F.nullif(F.col(f"`{c}`"), F.lit("")) for c in rows.columns]).isNotNull())
    return rows.filter(F.coalesce(text.clean_text("service_name"), text.clean_text("scenario")).isNotNull())


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """Source configuration, one row per source (check it with ``quality.source_errors``)."""
    config = spark.read.schema(model.SOURCE_CONFIG).option("multiLine", True).json(path)
    return config.select(F.inline("sources"))


def read_feeds(spark: SparkSession, path: str, max_items: int = 50) -> DataFrame:
    """Entries of landed RSS and Atom files, the first ``max_items`` of each feed."""
    def rows(tag, schema):
        reader = spark.read.format("xml").option("rowTag", tag).option("ignoreNamespace", True).schema(schema)
        return reader.load(path).withColumns({"feed": F.col("_metadata.file_path"), "ord": F.monotonically_increasing_id()})

    rss = rows("item", model.RSS_ITEM).select(
        "feed", "ord", "title", "link", "description", F.col("encoded").alias("content"), "pubDate",
        F.coalesce("author", "creator").alias("author"), "category")
    links = F.filter("link", lambda link: F.coalesce(link["_rel"], F.lit("alternate")) == "alternate")
    atom = rows("entry", model.ATOM_ENTRY).select(
        "feed", "ord", F.col("title._VALUE").alias("title"), F.try_element_at(links, F.lit(1))["_href"].alias("link"),
        F.col("summary._VALUE").alias("description"), F.col("content._VALUE").alias("content"),
        F.coalesce("published", "updated").alias("pubDate"), F.col("author.name").alias("author"),
        F.col("category._term").alias("category"))
    return first_n_per_group(rss.unionByName(atom), ["feed"], ["ord"], max_items, ["ord"])


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("page_id", "url", "html")


def read_rule_files(spark: SparkSession, root: str, pattern: str = "*", rules_path: str = "", max_files: int = 50) -> DataFrame:
    """Rule files under a landed repository: path inside it, content and URL, the first files only.

    ``pattern`` applies to the file name. Files are listed by path.
    """
    files = (spark.read.option("wholetext", True).option("recursiveFileLookup", True)
             .option("pathGlobFilter", pattern).text(root))
    base = root.rstrip("/") + "/"
    full = F.col("_metadata.file_path")
    placed = files.select(F.substring_index(full, base, -1).alias("path"), F.col("value").alias("content"), full.alias("url"))
    placed = placed.filter(F.col("path").startswith(rules_path)).withColumn("root", F.lit(root))
    return first_n_per_group(placed, ["root"], ["path"], max_files, ["path"]).drop("root")


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    """Staged records as JSON files; unreadable ones are skipped, a missing id is the file name."""
    schema = T.StructType([*model.STAGED.fields, T.StructField("_corrupt", T.StringType())])

    def read():
        reader = spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt")
        rows = reader.json(path).withColumn("file_name", F.col("_metadata.file_name"))
        return rows.filter(F.col("_corrupt").isNull()).drop("_corrupt")

    rows = _empty_if_missing(spark, read, T.StructType([*model.STAGED.fields, T.StructField("file_name", T.StringType())]))
    stem = F.regexp_replace("file_name", "\\.json$", "")
    return rows.select(
        F.coalesce("recommendation.id", stem).alias("id"), "file_name", "staged_at", "source_id",
        *[F.col(f"recommendation.{c}").alias(c) for c in ("service_name", "scenario", "risk_detail")],
        "dedup_score", "closest_existing", "recommendation")
