"""Streams give what the batch jobs give."""

import random
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from advisorium.operators import ranking
from advisorium.plans import ingest
from advisorium.streaming import ingest as streaming
from tests.conftest import SMALL

START = datetime(2024, 1, 1)


def write_parts(df, path, order, parts):
    """Rows as ``parts`` files in order, each one a micro-batch."""
    rows = df.orderBy(order).collect()
    size = -(-len(rows) // parts)
    for n in range(parts):
        df.sparkSession.createDataFrame(rows[n * size:(n + 1) * size], df.schema).coalesce(1).write.mode("append").parquet(f"{path}/part={n}")


def stream(spark, schema, path):
    # Files are taken by modification time, one per micro-batch.
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def test_ingest_stream_equals_batch(spark, tmp_path):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = ingest.raw_items(documents, "lang", "doc_id", "text")
    items = items.unionByName(items.limit(30).withColumn("ord", F.col("ord") + 100_000))
    landing, root = str(tmp_path / "landing"), str(tmp_path / "state")
    write_parts(items, landing, "ord", 3)
    for _ in range(2):  # starting again takes nothing twice
        streaming.start_ingest(stream(spark, items.schema, landing), root, str(tmp_path / "check")).awaitTermination()
    taken = spark.read.parquet(f"{root}/items")
    nothing = items.limit(0).select("source_id", "content_hash")
    expected = ingest.fresh_items(items.select("source_id", "content_hash", "ord"), nothing)
    assert sorted(r.ord for r in taken.collect()) == sorted(r.ord for r in expected.collect())
    assert streaming.remembered(spark, str(tmp_path / "check")).count() == taken.count()


def test_newest_hashes_of_a_source_are_kept(spark, tmp_path):
    """History grows tenfold in batches, with a restart between: what a batch reads of it stays bounded."""
    rng = random.Random(3)
    keep, parts = 20, 4
    rows = [(f"s{rng.randrange(2)}", f"h{rng.randrange(60)}", n, f"body {n}") for n in range(240)]
    schema = "source_id string, content_hash string, ord long, body string"
    size = -(-len(rows) // parts)
    expected, hashes = [], {}
    for low in range(0, len(rows), size):
        for source in ("s0", "s1"):
            kept, batch = hashes.setdefault(source, []), {}
            for _, found, order, _ in (r for r in rows[low:low + size] if r[0] == source):
                if found not in kept:
                    batch.setdefault(found, order)
            expected += batch.values()
            hashes[source] = (kept + sorted(batch, key=batch.get))[-keep:]
    check = str(tmp_path / "check")
    for some in (2, 4):  # the second start goes on where the first one ended
        for n in range(some - 2, some):
            spark.createDataFrame(rows[n * size:(n + 1) * size], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/part={n}")
        streaming.start_ingest(stream(spark, schema, f"{tmp_path}/in"), str(tmp_path), check, keep).awaitTermination()
    assert sorted(r.ord for r in spark.read.parquet(f"{tmp_path}/items").collect()) == sorted(expected)
    held = streaming.remembered(spark, check).collect()
    assert {s: [r.content_hash for r in sorted(held, key=lambda r: -r.age) if r.source_id == s] for s in hashes} == hashes


def fetch_rows(rng, n):
    rows = [(f"s{rng.randrange(6)}", START + timedelta(hours=h), rng.random() < 0.6, rng.randrange(2), rng.random() < 0.2) for h in range(n)]
    return rows + [("s9", START, True, 0, False), ("s9", None, True, 0, False), ("s8", START, False, 3, False), ("s7", START, False, 0, True)]


LOG = "source_id string, ts timestamp, error boolean, items long, not_modified boolean"


def test_counters_of_shuffled_batches(spark, tmp_path):
    """Batches in any order of time, with a restart between, end in the counters of the whole log."""
    rng = random.Random(5)
    rows = fetch_rows(rng, 120)
    rng.shuffle(rows)
    check = str(tmp_path / "check")
    for n in range(3):
        spark.createDataFrame(rows[n * 42:(n + 1) * 42], LOG).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/part={n}")
        if n != 1:  # two batches in the second run
            streaming.start_counters(stream(spark, LOG, f"{tmp_path}/in"), check).awaitTermination()
    whole = spark.createDataFrame(rows, LOG)
    for flag in (False, True):
        expected = ranking.trailing_counters(whole, flag)
        found = streaming.read_counters(spark, check, flag).select(*expected.columns)
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert any(r.consecutive_errors > 1 for r in expected.collect())


def test_summaries_merge_in_any_order():
    rng = random.Random(6)
    rows = [(rng.choice([None, *range(30)]), rng.choice([True, True, False, None]), rng.choice([0, 0, 2, None]), rng.choice([True, False, None]))
            for _ in range(60)]
    whole = streaming.summarised(None, rows)
    for _ in range(50):
        rng.shuffle(rows)
        summary = None
        for low in range(0, len(rows), 7):
            summary = streaming.summarised(summary, rows[low:low + 7])
        assert summary == whole


def test_idle_sources_are_told(spark, tmp_path):
    spark.createDataFrame(fetch_rows(random.Random(7), 10), LOG).coalesce(1).write.parquet(f"{tmp_path}/in/part=0")
    log = stream(spark, LOG, f"{tmp_path}/in")
    collected = []

    def take(batch, n):
        collected.extend(batch.collect())

    query = streaming.source_activity(log, idle_ms=0).writeStream.outputMode("update").foreachBatch(take).option(
        "checkpointLocation", str(tmp_path / "check")).trigger(processingTime="1 second").start()
    deadline = time.time() + 90
    while time.time() < deadline and not any(r.idle for r in collected):
        time.sleep(0.5)
    query.stop()
    assert {r.source_id for r in collected if r.idle} <= {r.source_id for r in collected if not r.idle}
    assert any(r.idle for r in collected)


def test_unique_within_a_delay(spark, tmp_path):
    schema = "source_id string, content_hash string, ts timestamp"
    rows = [("s", "h", START), ("s", "h", START + timedelta(minutes=5)), ("s", "g", START), ("t", "h", START)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    query = streaming.unique_within(source, "ts", "1 hour").writeStream.format("memory").queryName("unique_items").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("unique_items").count() == 3


def test_daily_extremes_of_a_stream(spark, tmp_path):
    schema = "resource_id string, ts timestamp, value double"
    rows = [("r", START + timedelta(hours=h), float(h)) for h in range(0, 120, 6)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    query = streaming.daily_extremes(source).writeStream.format("memory").queryName("extremes").trigger(availableNow=True).start()
    query.awaitTermination()
    found = {r.window.start: (r.low, r.high, r.readings) for r in spark.table("extremes").collect()}
    assert found[START] == (0.0, 18.0, 4) and found[START + timedelta(days=1)] == (24.0, 42.0, 4)


def test_new_items_of_a_source_are_given_on_in_bounded_frames():
    """The items of a large batch are held as columns, not as a frame each, and passed on in parts."""
    import pandas as pd

    class Value:
        kept = (["h7", "h8"],)
        get = lambda self: self.kept

        def update(self, value):
            self.kept = value

    rng, n = random.Random(5), 3 * streaming.ROWS_AT_ONCE
    rows = [("s", f"h{rng.randrange(2 * n)}", rng.randrange(n)) for _ in range(2 * n)] + [("s", None, 4), ("s", None, 3)]
    frames = [pd.DataFrame(rows[at:at + 7_000], columns=["source_id", "content_hash", "ord"]) for at in range(0, len(rows), 7_000)]
    seen = streaming.Seen(["ord", "source_id", "content_hash"], keep=10_000)
    seen.seen = Value()
    given = list(seen.handleInputRows(("s",), iter(frames), None))
    assert len(given) > 2 and max(map(len, given)) <= streaming.ROWS_AT_ONCE and list(given[0].columns) == seen.columns
    least = {}
    for _, found, order in rows:
        if found not in ("h7", "h8"):
            least[found] = min(order, least.get(found, order))
    want = sorted((order, found or "", found) for found, order in least.items())
    got = [(r.ord, None if pd.isna(r.content_hash) else r.content_hash) for frame in given for r in frame.itertuples()]
    assert sorted(got, key=str) == sorted([(order, found) for order, _, found in want], key=str)
    assert [order for order, _ in got] == [order for order, _, _ in want]
    assert len(seen.seen.kept[0]) == 10_000
    assert list(seen.handleInputRows(("s",), iter([frames[0].iloc[:0]]), None)) == []


def test_counters_take_plain_rows():
    """A key costs no frame: rows come and go as they are, with nulls and repeated times."""
    from pyspark.sql import Row

    class Value:
        kept = None
        get = lambda self: self.kept

        def update(self, value):
            self.kept = value

    counters, fields = streaming.Counters(None), ("time", "error", "items", "not_modified")
    counters.summary = Value()
    rows = [(5, True, 0, False), (1, False, 2, False), (5, True, None, False), (None, None, None, None), (7, False, 0, True)]
    for part in (rows[:2], rows[2:]):
        given = list(counters.handleInputRows(("a", 3), iter([Row(**dict(zip(fields, r))) for r in part]), None))
    assert given == [Row(source_id="a", last=7, idle=False)]
    assert counters.summary.kept == (7, 5, 7, [7], [0], [0], [1])
