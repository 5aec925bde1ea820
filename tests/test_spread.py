"""Hot keys: right results and plans without one huge task."""

from pyspark.sql import functions as F

from advisorium.operators import joins, ranking
from advisorium.operators.spread import first_n_per_group, keep_first, placed, spread_lookup


def hot_rows(spark, n=3000):
    """A third of the rows on one key, the rest over many."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("source_id"),
        F.col("id").alias("ord"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_n_is_exact_for_every_size(spark):
    rows = hot_rows(spark)
    order = {}
    for r in rows.collect():
        order.setdefault(r.source_id, []).append(r.ord)
    for n in (1, 7, 40, 1500):
        found = first_n_per_group(rows, ["source_id"], [F.desc("ord")], n, ["ord"]).collect()
        got = {}
        for r in found:
            got.setdefault(r.source_id, set()).add(r.ord)
        assert got == {k: set(sorted(v)[-n:]) for k, v in order.items()}
    assert first_n_per_group(rows, ["source_id"], ["ord"], 0, ["ord"]).count() == 3000
    assert first_n_per_group(rows, ["source_id"], ["ord"], None, ["ord"]).count() == 3000


def test_groups_are_cut_before_they_meet(spark):
    small = plan(ranking.first_items(hot_rows(spark), 50))
    assert small.count("WindowGroupLimit") == 4 and "__section" in small
    large = plan(first_n_per_group(hot_rows(spark), ["source_id"], ["ord"], 10_000, ["ord"]))
    assert large.count("Window [") == 3


def test_a_hot_key_gets_tasks_by_its_share(spark):
    """A key with nine rows in ten is dealt over as many sections as its count asks for; other keys are not copied."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 10 != 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("source_id"),
        F.col("id").alias("ord"))
    lookup = rows.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = spread_lookup(rows, lookup, ["source_id"], ["ord"], rows_per_copy=100)
        assert joined.count() == 3000 and joined.filter("source_id = 'hot' AND n = 2700").count() == 2700
        located = joined.withColumn("task", F.spark_partition_id())
        tasks = located.groupBy("source_id").agg(F.countDistinct("task").alias("n"))
        assert all((r.n > 15) if r.source_id == "hot" else r.n == 1 for r in tasks.collect())
        largest = located.groupBy("task").count().agg(F.max("count")).first()[0]
        assert largest < 700
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_lookup_keeps_rows_without_a_partner(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, id int")
    lookup = spark.createDataFrame([("a", 10)], "k string, v int")
    assert sorted((r.id, r.v) for r in spread_lookup(rows, lookup, ["k"], ["id"]).collect()) == [(1, 10), (2, None), (3, None)]
    assert spread_lookup(rows, lookup, ["k"], ["id"], how="inner").count() == 1


def test_places_and_offsets(spark):
    rows = hot_rows(spark).withColumn("source_id", F.when(F.col("ord") % 7 != 0, F.col("source_id"))).withColumn("bytes", F.col("ord") % 13)
    want = {}
    for r in rows.orderBy("ord").collect():
        position, offset = want.setdefault(r.source_id, [0, 0])
        want[r.source_id, r.ord] = position, offset
        want[r.source_id] = [position + 1, offset + r.bytes]
    for n in ("4", "23"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found = placed(rows, "source_id", ["ord"], F.col("bytes")).collect()
        assert len(found) == 3000 and all((r.position, r.offset) == want[r.source_id, r.ord] for r in found)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert placed(rows.limit(0), "source_id", ["ord"]).count() == 0


def test_unseen_checks_each_pair_once(spark):
    items = spark.createDataFrame([("s", "h1", 1), ("s", "h1", 2), ("s", "h2", 3), ("t", "h1", 4)], "source_id string, content_hash string, ord long")
    seen = spark.createDataFrame([("s", "h1"), ("s", "h1")], "source_id string, content_hash string")
    assert sorted(r.ord for r in joins.unseen(items, seen).collect()) == [3, 4]


def test_insert_if_absent(spark):
    old = spark.createDataFrame([("a", "old")], "id string, v string")
    new = spark.createDataFrame([("a", "new", 1), ("b", "later", 3), ("b", "first", 2)], "id string, v string, ord int")
    assert sorted(map(tuple, joins.insert_if_absent(old, new).collect())) == [("a", "old"), ("b", "first")]
    assert keep_first(new, ["id"], ["ord"]).count() == 2


def test_rules_and_resources_of_one_service_are_dealt_by_their_pairs(spark):
    """Few rows on either side make many pairs; no task holds a large share of them."""
    rules = spark.range(300).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") < 290, "hot").when(F.col("id") < 298, "cold").alias("service_name"),
                                    F.concat(F.lit("do it "), "id").alias("scenario"), F.lit("act").alias("recommendation_action"))
    resources = spark.range(400).select(F.col("id").alias("resource_id"), F.when(F.col("id") < 390, "hot").when(F.col("id") < 395, "cold").alias("service"),
                                        (F.col("id") % 2).cast("double").alias("usage"))
    resources = resources.unionAll(resources.where("resource_id = 0"))
    for limit in (100, 4000):
        found = joins.match_rules(resources, rules, "it", "usage", 1.0, pairs_per_task=limit)
        rows = found.select("*", F.spark_partition_id().alias("task")).collect()
        want = sorted([(r, str(i)) for r in [0, *range(0, 390, 2)] for i in range(290)] + [(r, str(i)) for r in (390, 392, 394) for i in range(290, 298)])
        assert sorted((r.resource_id, r.rule_id) for r in rows) == want
        tasks = [r.task for r in rows]
        assert max(map(tasks.count, set(tasks))) < max(10 * limit, len(want) / 3)
    assert joins.match_rules(resources, rules, "nowhere", "usage", 1.0).count() == 0
