"""History in buckets: right rows, and no exchange on its side of the plan."""

from advisorium.operators import joins
from advisorium.plans import ingest
from advisorium.sources import buckets

KEYS = ["source_id", "content_hash"]
SCHEMA = "source_id string, content_hash string"


def sides(df):
    """The lines of the plan below which the bucketed table is scanned."""
    return df._jdf.queryExecution().executedPlan().toString().split("\n")


def exchanges_above_scan(df, name):
    """Exchanges between the scan of a table and the first join above it."""
    lines = sides(df)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    found = []
    for at, line in enumerate(lines):
        if name in line and "FileScan" in line:
            level = depth(line)
            for above in reversed(lines[:at]):
                if depth(above) < level:
                    level = depth(above)
                    if "Join" in above:
                        break
                    if "Exchange" in above:
                        found.append(above)
    return found


def test_history_stays_where_it_is(spark, tmp_path):
    path = str(tmp_path / "seen")
    old = spark.createDataFrame([(f"s{n % 3}", f"h{n}") for n in range(200)], SCHEMA)
    buckets.append(old, path, KEYS, 8)
    buckets.append(spark.createDataFrame([("s0", "later")], SCHEMA), path, KEYS, 8)
    items = spark.createDataFrame([("s0", "h0", 1), ("s0", "new", 2), ("s0", "new", 3), ("s1", "later", 4), ("s0", "later", 5)], f"{SCHEMA}, ord long")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        seen = buckets.opened(spark, path, old.schema, KEYS, 8)
        unseen, fresh = joins.unseen(items, seen), ingest.fresh_items(items, seen)
        assert sorted(r.ord for r in unseen.collect()) == [2, 3, 4]
        assert sorted(r.ord for r in fresh.collect()) == [2, 4]
        for df in (unseen, fresh):
            assert "Bucketed: true" in "\n".join(sides(df)) and not exchanges_above_scan(df, "bucketed_")
        catalog = str(tmp_path / "catalog")
        buckets.append(spark.createDataFrame([("a", "old")], "id string, v string"), catalog, ["id"], 4)
        known = buckets.opened(spark, catalog, None, ["id"], 4)
        new = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "id string, v string, ord int")
        both = joins.insert_if_absent(known, new)
        assert sorted(map(tuple, both.collect())) == [("a", "old"), ("b", "y")]
        assert not [e for e in exchanges_above_scan(both, "bucketed_") if "Union" not in e]
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_a_session_that_has_not_seen_the_table(spark, tmp_path):
    path = str(tmp_path / "seen")
    rows = spark.createDataFrame([("s", "h")], SCHEMA)
    buckets.append(rows, path, KEYS, 4)
    spark.sql(f"DROP TABLE {buckets._name(path)}")  # the files stay
    assert buckets.opened(spark, path, rows.schema, KEYS, 4).count() == 1
    buckets.append(spark.createDataFrame([("s", "g")], SCHEMA), path, KEYS, 4)
    assert buckets.opened(spark, path, rows.schema, KEYS, 4).count() == 2
