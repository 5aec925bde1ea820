"""Global shuffle of records into shards, in two passes and with built-in functions only.

Pass one scatters the records over memory-sized buckets: a shard is chosen by rendezvous hashing of the id
alone, and a bucket within it by a seeded hash that also differs between rows of the same id. Pass two
permutes each bucket in memory (``shuffle`` is a seeded Fisher-Yates permutation) and writes it. The slots of
a shard count through its buckets.

The law is ``key``: id and shard count decide the shard, and one more shard takes rows only into itself.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from advisorium.llm.shared import packed, unpacked, written

RESULTS = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def best_shard(key, shards):
    """The shard of the highest hash of (id, shard), with that hash."""
    weights = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                          lambda k: F.struct(F.xxhash64(key, k).alias("weight"), k.alias("shard")))
    return F.array_max(weights)


def scattered(df: DataFrame, shards=40, id_col="doc_id", text_col="text", seed=7, bucket_bytes=8 << 20) -> DataFrame:
    """Pass one and two: the written buckets, with ``row``, shard, grown_shard, bucket and position in the bucket."""
    key, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    sized = df.select(packed(df), key.alias("key"), (F.octet_length(text) + 16).cast("long").alias("size"),
                      F.crc32(text.cast("binary")).alias("text_crc32"))
    total = df.agg(F.sum((F.octet_length(text) + 16).cast("long")).alias("n")).first()["n"] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    best, extra = F.col("best"), F.xxhash64(F.col("key"), F.lit(shards))
    dealt = (sized.withColumn("best", best_shard(F.col("key"), shards))
             .withColumn("shard", best["shard"])
             .withColumn("grown_shard", F.when(extra > best["weight"], F.lit(shards)).otherwise(best["shard"]))
             .withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), F.col("key"), F.monotonically_increasing_id()), F.lit(buckets)))
             .drop("best"))
    record = F.struct("row", "size", "text_crc32", "grown_shard")
    filled = (dealt.repartition("shard", "bucket").groupBy("shard", "bucket").agg(F.collect_list(record).alias("records")))
    placed = filled.select("shard", "bucket", F.posexplode(F.shuffle("records", seed)).alias("place", "record"))
    return written(placed.select("shard", "bucket", "place", "record.*"), "buckets")


def shuffled(df: DataFrame, shards=40, id_col="doc_id", text_col="text", seed=7, bucket_bytes=8 << 20) -> DataFrame:
    """The rows of ``df`` with size, text_crc32, law, shard, slot and grown_shard.

    A null text has 16 bytes and the checksum of no bytes. All rows of one id (null is an id too) share a
    shard, but not a bucket. Repeated rows each take a slot of their own. An empty table gives no rows; columns
    named like a result are replaced by it.
    """
    table = scattered(df, shards, id_col, text_col, seed, bucket_bytes)
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = table.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rows = table.join(starts, ["shard", "bucket"])
    return unpacked(rows, df.columns, {
        "size": F.col("size"), "text_crc32": F.col("text_crc32"), "law": F.lit("key"), "shard": F.col("shard"),
        "slot": (F.col("start") + F.col("place")).cast("long"), "grown_shard": F.col("grown_shard")})


def write_shards(df: DataFrame, path, **options):
    """One folder per shard; a reader that sorts by slot gets the permutation."""
    rows = shuffled(df, **options)
    rows.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard").parquet(path)
