"""Declared schemas, enumerations and field rules of the catalogue.

Every reader uses these explicit schemas: optional arrays and structs are absent from most
files, so an inferred schema would silently lose columns and widen integers.
"""

from pyspark.sql import types as T

_S, _I = T.StringType(), T.IntegerType()
_STRINGS = T.ArrayType(_S)


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


METADATA = _struct(
    ("created_at", _S), ("updated_at", _S), ("contributors", _STRINGS), ("source", _S),
)
DETECTION_METHOD = _struct(("method", _S), ("details", _S))
REMEDIATION_EXAMPLE = _struct(("language", _S), ("code", _S), ("description", _S))
ARCHITECTURAL_PATTERN = _struct(("pattern_name", _S), ("relationship", _S), ("description", _S))

RECOMMENDATION = _struct(
    ("id", _S),
    ("status", _S),
    ("service_name", _S),
    ("scenario", _S),
    ("alert_criteria", _S),
    ("recommendation_action", _S),
    ("risk_detail", _S),
    ("build_priority", _I),
    ("action_value", _I),
    ("effort_level", _I),
    ("risk_value", _I),
    ("recommendation_description_detailed", _S),
    ("category", _S),
    ("output_notes", _S),
    ("notes", _S),
    ("references", _STRINGS),
    ("metadata", METADATA),
    ("tags", _STRINGS),
    ("cve_references", _STRINGS),
    ("compliance_mappings", _STRINGS),
    ("detection_methods", T.ArrayType(DETECTION_METHOD)),
    ("remediation_examples", T.ArrayType(REMEDIATION_EXAMPLE)),
    ("architectural_patterns", T.ArrayType(ARCHITECTURAL_PATTERN)),
    ("pattern_implementation_guidance", _S),
    ("estimated_cost_impact", _S),
    ("compliance_frameworks", _STRINGS),
    ("aws_doc_url", _S),
)

SERVICE_ENVELOPE = _struct(
    ("service", _S), ("count", _I), ("misconfigurations", T.ArrayType(RECOMMENDATION)),
)

FETCH_CONFIG = _struct(
    ("max_items", _I), ("branch", _S), ("rules_path", _S), ("file_pattern", _S),
    ("max_files", _I), ("follow_links", T.BooleanType()), ("link_pattern", _S), ("max_pages", _I),
)
PARSE_CONFIG = _struct(("item_selector", _S), ("title_selector", _S), ("body_selector", _S))
SOURCE = _struct(
    ("id", _S), ("name", _S), ("type", _S), ("url", _S), ("categories", _STRINGS),
    ("enabled", T.BooleanType()), ("fetch_config", FETCH_CONFIG), ("parse_config", PARSE_CONFIG),
)
SOURCE_CONFIG = _struct(("version", _S), ("sources", T.ArrayType(SOURCE)))

RAW_ITEM = _struct(
    ("source_id", _S), ("source_name", _S), ("title", _S), ("body", _S), ("url", _S),
    ("published_at", _S), ("content_hash", _S), ("categories", _STRINGS),
    ("raw_metadata", T.MapType(_S, _S)),
)

STAGED = _struct(
    ("staged_at", _S), ("staged_by", _S), ("source_id", _S), ("source_url", _S),
    ("dedup_score", T.DoubleType()), ("closest_existing", _S), ("recommendation", RECOMMENDATION),
)

FEED_ITEM = _struct(
    ("title", _S), ("link", _S), ("description", _S), ("content", _S), ("pubDate", _S),
    ("author", _S), ("category", _STRINGS),
)
# The same item as the two kinds of feed spell it.
RSS_ITEM = _struct(
    ("title", _S), ("link", _S), ("description", _S), ("encoded", _S), ("pubDate", _S),
    ("author", _S), ("creator", _S), ("category", _STRINGS),
)
ATOM_ENTRY = _struct(
    ("title", _struct(("_VALUE", _S), ("_type", _S))),
    ("link", T.ArrayType(_struct(("_href", _S), ("_rel", _S)))),
    ("summary", _struct(("_VALUE", _S), ("_type", _S))), ("content", _struct(("_VALUE", _S), ("_type", _S))),
    ("published", _S), ("updated", _S), ("author", _struct(("name", _S))),
    ("category", T.ArrayType(_struct(("_term", _S)))),
)

FINDING = _struct(
    ("rule_id", _S), ("service", _S), ("resource_type", _S), ("resource_id", _S),
    ("risk_type", _S), ("severity", _I), ("scenario", _S), ("recommendation", _S),
    ("details", T.MapType(_S, _S)),
)

# Enumerations of the declared schema.
RISKS = ("cost", "security", "operations", "performance", "reliability")
RELATIONSHIPS = ("missing_implementation", "incorrect_implementation", "anti_pattern", "related_to")
SOURCE_TYPES = ("rss", "html", "github")
SEVERITIES = ("OK", "WARNING", "ERROR", "CRITICAL")

# Order in which a row falls into one single risk bucket.
RISK_BUCKET_ORDER = ("cost", "security", "performance", "reliability", "operations")

# Field rules of the declared schema.
REQUIRED = ("id", "service_name", "scenario", "risk_detail")
UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
SERVICE_PATTERN = "^[a-z][a-z0-9-]*$"
RISK_PATTERN = (
    "^(cost|security|operations|performance|reliability)"
    "(,\\s*(cost|security|operations|performance|reliability))*$"
)
CVE_PATTERN = "^CVE-[0-9]{4}-[0-9]+$"
URI_PATTERN = "^[A-Za-z][A-Za-z0-9+.-]*:\\S+$"
RANGES = {
    "build_priority": (0, 3),
    "action_value": (0, None),
    "effort_level": (0, 3),
    "risk_value": (0, 3),
}
DECLARED_TYPES = {
    "id": ("string",),
    "service_name": ("string",),
    "scenario": ("string",),
    "alert_criteria": ("string",),
    "recommendation_action": ("string",),
    "risk_detail": ("string",),
    "build_priority": ("integer",),
    "action_value": ("integer", "null"),
    "effort_level": ("integer", "null"),
    "risk_value": ("integer", "null"),
    "recommendation_description_detailed": ("string",),
    "category": ("string",),
    "output_notes": ("string",),
    "notes": ("string",),
    "references": ("array",),
    "metadata": ("object",),
    "tags": ("array",),
    "cve_references": ("array",),
    "compliance_mappings": ("array",),
    "detection_methods": ("array",),
    "remediation_examples": ("array",),
    "architectural_patterns": ("array",),
    "pattern_implementation_guidance": ("string",),
    "estimated_cost_impact": ("string",),
    "compliance_frameworks": ("array",),
    "aws_doc_url": ("string",),
}

FLAT_TEXT = (
    "id", "service_name", "scenario", "alert_criteria", "recommendation_action", "risk_detail",
    "recommendation_description_detailed", "category", "output_notes", "notes",
    "pattern_implementation_guidance",
)
FLAT_INTEGERS = ("build_priority", "action_value", "effort_level", "risk_value")
FLAT_METADATA = ("created_at", "updated_at", "source")
FLAT_ARRAYS = (
    "references", "tags", "architectural_patterns", "detection_methods",
    "remediation_examples", "compliance_mappings",
)
# Declared in the schema but not part of the 25-column table; kept when asked for.
FLAT_EXTRA = ("cve_references", "estimated_cost_impact", "compliance_frameworks", "aws_doc_url")
