"""Validation of entries against the declared field rules.

Every check adds to one array of errors per row, so a table is validated in a single pass
without a shuffle. The array becomes rows only on demand.
"""

from pyspark.sql import Column, DataFrame, functions as F

from advisorium import model


def _error(field: str, rule: str, message) -> Column:
    message = F.lit(message) if isinstance(message, str) else message
    return F.struct(F.lit(field).alias("field"), F.lit(rule).alias("rule"), message.alias("message"))


def _shown(c) -> Column:
    return F.col(c).cast("string")


def required_errors(fields=model.REQUIRED):
    """Missing, null and empty required fields."""
    for field in fields:
        missing = F.coalesce(F.col(field).cast("string"), F.lit("")) == ""
        yield F.when(missing, _error(field, "required", f"Missing required field: {field}"))


def range_errors(ranges=None):
    for field, (low, high) in (ranges or model.RANGES).items():
        value = F.concat(F.lit(f"Field '{field}' value "), _shown(field))
        if low is not None:
            yield F.when(F.col(field) < low, _error(field, "minimum", F.concat(value, F.lit(f" is below minimum {low}"))))
        if high is not None:
            yield F.when(F.col(field) > high, _error(field, "maximum", F.concat(value, F.lit(f" exceeds maximum {high}"))))


def uuid_errors(field="id"):
    """An identifier that is given but not a lower-case UUID."""
    message = F.concat(F.lit(f"Field '{field}' does not match UUID format: "), _shown(field))
    yield F.when(~F.col(field).rlike(model.UUID_PATTERN), _error(field, "uuid", message))


def enum_errors(allowed: dict):
    for field, values in allowed.items():
        message = F.concat(F.lit(f"Field '{field}' has invalid value '"), _shown(field),
                           F.lit(f"'. Allowed values: {list(values)}"))
        yield F.when(~F.col(field).isin(*values), _error(field, "enum", message))


def strict_errors(columns):
    """Rules the schema declares beyond the basic checks, for the columns that are present."""
    def pattern(field, regex):
        message = F.concat(F.lit(f"Field '{field}' does not match pattern: "), _shown(field))
        return F.when(~F.col(field).rlike(regex), _error(field, "pattern", message))

    def every(field, holds, rule):
        return F.when(~F.forall(field, holds), _error(field, rule, f"Field '{field}' has invalid items"))

    if "service_name" in columns:
        yield pattern("service_name", model.SERVICE_PATTERN)
    if "risk_detail" in columns:
        yield pattern("risk_detail", model.RISK_PATTERN)
    if "references" in columns:
        yield F.when(F.size("references") > 10, _error("references", "maxItems", "Field 'references' has more than 10 items"))
        yield every("references", lambda r: r.rlike(model.URI_PATTERN), "uri")
    for field in ("tags", "compliance_frameworks"):
        if field in columns:
            repeated = F.size(F.array_distinct(field)) < F.size(field)
            yield F.when(repeated, _error(field, "uniqueItems", f"Field '{field}' has repeated items"))
    if "cve_references" in columns:
        yield every("cve_references", lambda c: c.rlike(model.CVE_PATTERN), "pattern")
    if "architectural_patterns" in columns:
        yield every("architectural_patterns", lambda p: F.coalesce(p["pattern_name"], F.lit("")) != "", "required")
        yield every("architectural_patterns", lambda p: F.coalesce(p["relationship"].isin(*model.RELATIONSHIPS), F.lit(False)), "enum")
    if "aws_doc_url" in columns:
        yield pattern("aws_doc_url", model.URI_PATTERN)


def with_errors(df: DataFrame, strict: bool = False, enums=None) -> DataFrame:
    """Add ``errors``, an array of (field, rule, message), empty for a valid entry."""
    checks = [*required_errors()]
    checks += range_errors({f: r for f, r in model.RANGES.items() if f in df.columns})
    checks += uuid_errors()
    checks += enum_errors(enums or {})
    if strict:
        checks += strict_errors(df.columns)
    return df.withColumn("errors", F.array_compact(F.array(*checks)))


def validity(df: DataFrame, **options) -> DataFrame:
    """The entries with ``is_valid`` and their messages."""
    checked = with_errors(df, **options)
    messages = F.transform("errors", lambda e: e["message"])
    return checked.withColumn("messages", messages).withColumn("is_valid", F.size("errors") == 0).drop("errors")


def violations(df: DataFrame, **options) -> DataFrame:
    """One row per broken rule."""
    return with_errors(df, **options).select("id", F.inline("errors"))


def rule_violations(df: DataFrame, checks) -> DataFrame:
    """One row per broken rule of some checks only, such as ``range_errors()``."""
    return df.select("id", F.inline(F.array_compact(F.array(*checks))))


def file_totals(df: DataFrame, file_col: str, **options) -> DataFrame:
    """Valid and total entries per file, and whether the whole file is valid."""
    checked = with_errors(df, **options)
    counted = checked.groupBy(F.col(file_col).alias("file")).agg(
        F.count(F.lit(1)).alias("entries"),
        F.sum(F.when(F.size("errors") == 0, 1).otherwise(0)).alias("valid_entries"),
    )
    return counted.withColumn("is_valid", F.col("entries") == F.col("valid_entries"))


def validation_totals(df: DataFrame, file_col: str, **options) -> DataFrame:
    """Files valid / total and entries valid / total."""
    return file_totals(df, file_col, **options).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum(F.col("is_valid").cast("int")).alias("valid_files"),
        F.sum("entries").alias("entries"),
        F.sum("valid_entries").alias("valid_entries"),
    )


def repeated_ids(df: DataFrame, key="id") -> DataFrame:
    """Ids that occur more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def type_errors(df: DataFrame, json_col: str, declared=None) -> DataFrame:
    """Entries given as JSON text whose values have a type other than the declared one.

    A boolean passes as an integer and null always passes. ``df`` needs an ``id`` column.
    """
    # What a declared type looks like in the type name of a JSON value.
    accepted = {
        "string": "^STRING$", "integer": "^(BIGINT|BOOLEAN|DECIMAL\\(\\d+,0\\))$",
        "number": "^(BIGINT|BOOLEAN|DECIMAL.*|DOUBLE|FLOAT)$", "boolean": "^BOOLEAN$",
        "array": "^ARRAY", "object": "^OBJECT", "null": "^VOID$",
    }
    value = F.try_parse_json(json_col)
    checks = []
    for field, types in (declared or model.DECLARED_TYPES).items():
        kind = F.schema_of_variant(F.try_variant_get(F.col("__entry"), f"$.{field}", "variant"))
        right = kind.rlike("|".join(accepted[t] for t in types)) | (kind == "VOID")
        message = F.concat(F.lit(f"Field '{field}' has invalid type. Expected {' or '.join(types)}, got "), kind)
        checks.append(F.when(~right, _error(field, "type", message)))
    parsed = df.select("id", value.alias("__entry"))
    return parsed.select("id", F.inline(F.array_compact(F.array(*checks))))


def source_errors(sources: DataFrame) -> DataFrame:
    """Problems of a source configuration: missing fields, type, categories, repeated ids."""
    given = lambda c: F.when(F.col(c).isNotNull(), F.lit(c))
    # Fields a source must have.
    needed = ("id", "name", "type", "url", "categories", "enabled")
    missing = F.array_except(F.array(*[F.lit(c) for c in needed]), F.array_compact(F.array(*[given(c) for c in needed])))
    complete = F.size(missing) == 0
    checks = F.array_compact(F.array(
        F.when(~complete, _error("source", "fields", F.concat(F.lit("missing fields: "), F.array_join(missing, ", ")))),
        F.when(complete & ~F.col("type").isin(*model.SOURCE_TYPES),
               _error("type", "type", F.concat(F.lit("invalid type: "), F.col("type")))),
        F.when(complete & (F.size("categories") == 0),
               _error("categories", "empty", "'categories' must be a non-empty list")),
    ))
    single = sources.select("id", F.inline(checks))
    # Only a complete source takes part in the search for repeated ids.
    again = repeated_ids(sources.filter(complete)).select(
        "id", F.inline(F.array(_error("id", "duplicate", F.concat(F.lit("duplicate id: "), F.col("id"))))))
    return single.unionByName(again)


def count_mismatches(envelopes: DataFrame) -> DataFrame:
    """Service envelopes whose count differs from the number of entries they hold."""
    held = F.coalesce(F.size("misconfigurations"), F.lit(0))
    return envelopes.select("service", "count", held.alias("held")).filter(~F.col("count").eqNullSafe(F.col("held")))


