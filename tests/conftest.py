import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
               .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints"))).getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows given as dicts to a DataFrame of a declared schema; missing fields are null."""

    def make(rows, schema):
        from pyspark.sql import types as T

        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        return spark.createDataFrame([tuple(row.get(f.name) for f in schema.fields) for row in rows], schema)

    return make


def recommendation(**changes):
    """A valid entry as a dict."""
    entry = {
        "id": "11111111-2222-3333-4444-555555555555", "service_name": "s3",
        "scenario": "Bucket versioning is not enabled", "alert_criteria": "Versioning is off",
        "recommendation_action": "Enable versioning", "risk_detail": "security", "build_priority": 1,
        "action_value": 2, "effort_level": 1, "risk_value": 2,
        "recommendation_description_detailed": "Versioning protects against deletion.", "category": "storage",
        "references": ["https://example.org/versioning"], "tags": ["versioning", "s3"],
        "metadata": {"created_at": "2026-01-01T00:00:00Z", "updated_at": "2026-01-02T00:00:00Z",
                     "contributors": ["someone"], "source": "Test"},
    }
    entry.update(changes)
    return entry
