"""Publications are seen whole or not at all."""

import pytest
from pyspark.sql import functions as F

from advisorium.sources import snapshots


def ids(spark, root, table):
    return sorted(r.id for r in snapshots.read(spark, root, table).collect())


@pytest.fixture
def root(spark, tmp_path):
    root = str(tmp_path / "published")
    schema = "id string, service_name string"
    snapshots.publish(spark, root, {
        "catalog": spark.createDataFrame([("a", "s3")], schema),
        "staging": spark.createDataFrame([("b", "s3"), ("c", "iam"), ("a", "s3")], schema)})
    return root


def decisions(spark):
    return spark.createDataFrame([("b", "promote", ""), ("c", "reject", "no"), ("a", "promote", "")], "id string, action string, reason string")


def test_promotion_changes_both_tables_together(spark, root):
    results = snapshots.promote(spark, root, decisions(spark))
    assert {r.id: r.result for r in results.collect()} == {"b": "promoted", "c": "rejected", "a": "duplicate id"}
    assert ids(spark, root, "catalog") == ["a", "b"] and ids(spark, root, "staging") == ["a"]
    assert snapshots.current(spark, root)[0] == 1


def test_a_write_that_dies_leaves_everything_as_it_was(spark, root, monkeypatch):
    """The second of two tables fails; then the manifest does."""
    bad = spark.range(3).select(F.raise_error(F.lit("lost")).cast("string").alias("id"), F.lit("x").alias("service_name"))
    with pytest.raises(Exception, match="lost"):
        snapshots.publish(spark, root, {"catalog": spark.range(1).select(F.col("id").cast("string")), "staging": bad})
    assert ids(spark, root, "catalog") == ["a"] and ids(spark, root, "staging") == ["a", "b", "c"]

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(snapshots, "_commit", killed)
    with pytest.raises(KeyboardInterrupt):
        snapshots.promote(spark, root, decisions(spark))
    monkeypatch.undo()
    assert ids(spark, root, "catalog") == ["a"] and ids(spark, root, "staging") == ["a", "b", "c"]
    snapshots.promote(spark, root, decisions(spark))  # and it can be done again
    assert ids(spark, root, "catalog") == ["a", "b"]


def test_the_second_of_two_publications_fails(spark, root, monkeypatch):
    before = snapshots.current(spark, root)
    snapshots.publish(spark, root, {"catalog": spark.createDataFrame([("z",)], "id string")})
    monkeypatch.setattr(snapshots, "current", lambda *_: (before[0], dict(before[1])))
    with pytest.raises(snapshots.Conflict):
        snapshots.publish(spark, root, {"catalog": spark.createDataFrame([("y",)], "id string")})
    monkeypatch.undo()
    assert ids(spark, root, "catalog") == ["z"] and ids(spark, root, "staging") == ["a", "b", "c"]


def test_old_publications_expire(spark, root):
    for n in range(3):
        snapshots.publish(spark, root, {"catalog": spark.createDataFrame([(str(n),)], "id string")})
    assert len(snapshots.expire(spark, root, keep=2)) == 2
    assert ids(spark, root, "catalog") == ["2"] and ids(spark, root, "staging") == ["a", "b", "c"]
    assert snapshots.expire(spark, root, keep=2) == []
