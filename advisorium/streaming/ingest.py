"""Streaming ingest and source counters on keyed state (RocksDB).

The state of a key is read and written only by batches that hold rows of it, so a micro-batch costs what it
brings, however long the history is. Start a session with ``with_state`` settings, or set them yourself.
"""

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from advisorium.operators.ranking import MAX_HASHES_PER_SOURCE

# The workers need these helpers but may not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROWS_AT_ONCE = 10_000  # items that are given on, or reduced to their first copies, together
SHARES = 8  # keys that the rows of a source are dealt over


def with_state(spark):
    """Keyed state of any size needs the RocksDB store; running streams keep theirs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return spark


def unique_within(items: DataFrame, ts: str, delay: str) -> DataFrame:
    """First item of every (source, hash) within a delay; state is bounded by the watermark."""
    return items.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["source_id", "content_hash"])


def _firsts(frames):
    """The first item of every hash, in the order of the items."""
    import pandas as pd

    return pd.concat(frames, ignore_index=True).sort_values(["ord", "content_hash"], kind="stable").drop_duplicates("content_hash")


class Seen(StatefulProcessor):
    """Lets the first item of every hash of a source pass, and remembers the newest ``keep`` hashes of the source."""

    def __init__(self, columns, keep):
        self.columns, self.keep = columns, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "hashes array<string>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        kept = self.seen.get()
        hashes = list(kept[0]) if kept is not None else []
        known, waiting, size, least = set(hashes), [], 0, ROWS_AT_ONCE
        for frame in rows:
            frame = frame[[found not in known for found in frame["content_hash"]]]
            if len(frame):
                waiting.append(frame)
                size += len(frame)
            if size >= least:  # copies go before there are many
                waiting = [_firsts(waiting)]
                size = len(waiting[0])
                least = 2 * size + ROWS_AT_ONCE
        if waiting:
            # in the order of the items, as one run after the other would mark them
            passed = _firsts(waiting)
            del known, waiting
            self.seen.update(((hashes + passed["content_hash"].tolist())[-self.keep:],))
            for at in range(0, len(passed), ROWS_AT_ONCE):
                yield passed.iloc[at:at + ROWS_AT_ONCE][self.columns]

    def close(self) -> None:
        pass


def new_items(items: DataFrame, keep: int = MAX_HASHES_PER_SOURCE) -> DataFrame:
    """The items of a stream whose hash is not among the newest ``keep`` of their source; of copies in a batch the first.

    ``items`` has source_id, content_hash, ord and what else is to be kept. A hash that was pushed out by newer ones is new
    again. The hashes of a source are one value of bounded size.
    """
    with_state(items.sparkSession)
    return items.groupBy("source_id").transformWithStateInPandas(
        statefulProcessor=Seen(items.columns, keep), outputStructType=items.schema, outputMode="Append", timeMode="None")


def start_ingest(items: DataFrame, root: str, checkpoint: str, keep: int = MAX_HASHES_PER_SOURCE, **trigger):
    """Stream items (source_id, content_hash, ord, ...) into ``root``/items without repeats; each batch is written once."""
    writer = new_items(items, keep).writeStream.format("parquet").option("path", f"{root}/items")
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def remembered(spark, checkpoint: str) -> DataFrame:
    """source_id, content_hash, age: the hashes that an ingest stream holds; the newest has age 0."""
    state = spark.read.format("statestore").option("stateVarName", "seen").load(checkpoint)
    each = state.select(F.col("key.source_id").alias("source_id"), F.posexplode(F.reverse("value.hashes")).alias("age", "content_hash"))
    return each.select("source_id", "content_hash", "age")


# Counters --------------------------------------------------------------------------------------

# A summary of fetches: when the last success, the last non-empty fetch and the last fetch were, and how many errors, empty and
# unchanged fetches there were at each time that may still count. A time without a value is the lowest.
SUMMARY = ("success long, non_empty long, last long, times array<long>, errors array<long>, empty array<long>, unchanged array<long>")
NO_TIME = -(1 << 63)


def summarised(summary, rows):
    """The summary of a set of fetches and further rows (time, error, items, not_modified), older or newer."""
    success, non_empty, last, runs = summary or (None, None, None, {})
    runs = dict(runs)
    later = lambda a, b: b if a is None else a if b is None else max(a, b)
    for time, error, items, not_modified in rows:
        some = items is not None and items > 0
        if error is False:
            success = later(success, time)
        if error or some:
            non_empty = later(non_empty, time)
        last = later(last, time)
        at = NO_TIME if time is None else time
        nothing = error is False and items == 0
        counts = [bool(error), nothing and not not_modified, nothing and bool(not_modified)]
        if any(counts):
            runs[at] = [a + b for a, b in zip(runs.get(at, (0, 0, 0)), counts)]
    # what lies behind both ends never counts again, whatever comes later
    if success is not None and non_empty is not None:
        runs = {t: c for t, c in runs.items() if t > min(success, non_empty)}
    return success, non_empty, last, runs


class Counters(StatefulProcessor):
    """Keeps the summary of the fetches of a share of a source; tells when no fetch came for ``idle_ms``."""

    def __init__(self, idle_ms):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.summary = handle.getValueState("summary", SUMMARY)
        if self.idle_ms is not None:
            self.due = handle.getValueState("due", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        kept, summary = self.summary.get(), None
        if kept is not None:
            success, non_empty, last, times, *counts = kept
            summary = success, non_empty, last, {t: list(c) for t, c in zip(times, zip(*counts))}
        summary = summarised(summary, ((r.time, r.error, r["items"], r.not_modified) for r in rows))
        success, non_empty, last, runs = summary
        times = sorted(runs)
        self.summary.update((success, non_empty, last, times, *[[runs[t][i] for t in times] for i in range(3)]))
        if self.idle_ms is not None:
            if self.due.exists():
                self.handle.deleteTimer(self.due.get()[0])
            at = timerValues.getCurrentProcessingTimeInMs() + self.idle_ms
            self.handle.registerTimer(at)
            self.due.update((at,))
        yield self._row(key, last, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        self.due.clear()
        yield self._row(key, self.summary.get()[2], True)

    def _row(self, key, last, idle):
        return Row(source_id=key[0], last=last, idle=idle)

    def close(self) -> None:
        pass


def source_activity(log: DataFrame, idle_ms: int | None = None) -> DataFrame:
    """source_id, last (microseconds), idle: a row for each share of a source that has fetches in a batch, or has had none for ``idle_ms``.

    ``log`` has source_id, ts, error, items and optionally not_modified, in any order of time. The rows of a source are dealt
    over SHARES keys by their time; the summaries of the shares are put together when they are read.
    """
    with_state(log.sparkSession)
    if "not_modified" not in log.columns:
        log = log.withColumn("not_modified", F.lit(False))
    time = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = log.select("source_id", time.alias("time"), F.col("error").cast("boolean"), F.col("items").cast("long"),
                      F.col("not_modified").cast("boolean"), F.pmod(F.xxhash64("ts"), F.lit(SHARES)).cast("int").alias("share"))
    # Plain rows: most keys have few of them in a batch, and a frame for each key costs more than they do.
    return rows.groupBy("source_id", "share").transformWithState(
        statefulProcessor=Counters(idle_ms), outputStructType="source_id string, last long, idle boolean", outputMode="Update",
        timeMode="None" if idle_ms is None else "ProcessingTime")


def start_counters(log: DataFrame, checkpoint: str, **trigger):
    """Keep what the trailing counters of every source need as state; ``read_counters`` reads it."""
    writer = source_activity(log).writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_counters(spark, checkpoint: str, not_modified_is_empty: bool = False) -> DataFrame:
    """The trailing counters after the newest finished batch, as ``ranking.trailing_counters`` has them for the whole log."""
    state = spark.read.format("statestore").option("stateVarName", "summary").load(checkpoint)
    shares = state.select(F.col("key.source_id").alias("source_id"), "value.*")
    ends = shares.groupBy("source_id").agg(*[F.max(c).alias(f"{c}_end") for c in ("success", "non_empty", "last")])
    each = shares.select("source_id", F.inline(F.arrays_zip("times", "errors", "empty", "unchanged")))
    open_runs = each.join(ends, "source_id")
    after = lambda end: F.col(end).isNull() | (F.col("times") > F.col(end))
    total = lambda counts, end: F.coalesce(F.sum(F.when(after(end), counts)), F.lit(0))
    nothing = F.col("empty") + F.col("unchanged") if not_modified_is_empty else F.col("empty")
    counted = open_runs.groupBy("source_id").agg(
        total(F.col("errors"), "success_end").alias("consecutive_errors"), total(nothing, "non_empty_end").alias("consecutive_empty"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return ends.join(counted, "source_id", "left").select(
        "source_id", zero("consecutive_errors"), zero("consecutive_empty"), F.timestamp_micros("success_end").alias("last_success"),
        F.timestamp_micros("non_empty_end").alias("last_non_empty"), F.timestamp_micros("last_end").alias("last_ts"))


def daily_extremes(metrics: DataFrame, delay: str = "1 day") -> DataFrame:
    """Lowest and highest reading per resource and day of a stream, once the day is complete."""
    watched = metrics.withWatermark("ts", delay)
    return watched.groupBy("resource_id", F.window("ts", "1 day")).agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.count(F.lit(1)).alias("readings"))
