"""Helpers that keep one hot key from landing in one task.

A single source, service or group of copies may hold a large share of all rows. These helpers
cut such a group into sections by a deterministic hash (so a recomputed task yields the same
rows after an executor is lost) and put the sections together again once they are small.
"""

from pyspark.sql import DataFrame, Window, functions as F

from advisorium.sources.scratch import written

_SECTION, _RANK, _COPIES, _PART, _SIZE = "__section", "__rank", "__copies", "__part", "__size"


def first_n_per_group(df: DataFrame, keys, order, n, spread_by) -> DataFrame:
    """The first ``n`` rows of every group in ``order``; 0 or None keeps all rows.

    ``order`` must be a total order within a group and ``spread_by`` columns that vary inside
    one. Each section is cut to its own first ``n`` rows before the group meets in one task, so
    that task never sees more than sections x n rows. Up to 1,000 rows per group Spark also
    limits the groups before the first shuffle.
    """
    if not n:
        return df
    levels = () if n == 1 else (64,) if n <= 1000 else (4096, 64)
    for sections in levels:
        section = F.pmod(F.xxhash64(*spread_by), F.lit(sections))
        df = _cut(df.withColumn(_SECTION, section), [*keys, _SECTION], order, n).drop(_SECTION)
    return _cut(df, keys, order, n)


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """One row per key: the first in ``order``."""
    return _cut(df, keys, order, 1)


def _cut(df, keys, order, n):
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, rank).filter(F.col(_RANK) <= n).drop(_RANK)


def key_counts(rows: DataFrame, keys) -> DataFrame:
    """Rows of every key: the keys and ``n``."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def spread_lookup(rows: DataFrame, lookup: DataFrame, keys, spread_by, how="left", rows_per_copy=1_000_000, counts=None) -> DataFrame:
    """Join many rows to a table with few rows per key, usually one.

    The rows of each key are counted first (``counts``: ``key_counts`` where the caller has them; else ``rows`` is read once
    more for its keys). The lookup rows of a key are copied once for every ``rows_per_copy`` of its rows, and those are dealt
    over the copies: a key with a large share of the rows gets as many tasks as that takes, and the lookup rows of other
    keys stay as they are. Rows with a null key find nothing and are dealt by ``spread_by`` alone. Neither side is assumed to
    fit in memory.
    """
    counts = key_counts(rows, keys) if counts is None else counts
    copies = F.ceil(F.col("n") / F.lit(rows_per_copy)).cast("int").alias(_COPIES)
    hot = counts.select(*keys, copies).filter(F.col(_COPIES) > 1)  # a key needs over rows_per_copy rows to be here
    none = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    parts = F.when(none, 64).otherwise(F.coalesce(F.col(_COPIES), F.lit(1)))
    dealt = rows.join(hot, list(keys), "left").withColumn(_SECTION, F.pmod(F.xxhash64(*spread_by), parts).cast("int")).drop(_COPIES)
    every = F.sequence(F.lit(0), F.coalesce(F.col(_COPIES), F.lit(1)) - 1)
    repeated = lookup.join(hot, list(keys), "left").withColumn(_SECTION, F.explode(every)).drop(_COPIES)
    return dealt.join(repeated, [*keys, _SECTION], how).drop(_SECTION)


def spread_product(wide: DataFrame, narrow: DataFrame, key: str, wide_by, narrow_by, pairs_per_task=1_000_000) -> DataFrame:
    """Join on a key that has many rows on both sides: every row of ``wide`` with every row of ``narrow`` of its key.

    The rows of each key are counted on both sides, so both are read twice. The narrow rows of a key are cut into sections of
    at most about ``pairs_per_task`` rows, its wide rows into as many as leave about ``pairs_per_task`` pairs to a pair of
    sections, by hashes of ``narrow_by`` and ``wide_by``; each pair of sections meets on its own. Keys with fewer pairs stay whole. A wide row
    meets its narrow rows one after the other, so its values repeat in neighbouring rows of the result.
    """
    spark, limit = wide.sparkSession, F.lit(pairs_per_task)
    counts = written(key_counts(wide, [key]).join(key_counts(narrow, [key]).withColumnRenamed("n", "m"), key), "pairs")
    columns = F.ceil(F.col("m") / limit)
    rows = F.least(F.col("n"), F.ceil(F.col("n") * F.ceil(F.col("m") / columns) / limit))
    cut = counts.select(key, rows.cast("int").alias("__rows"), columns.cast("int").alias("__columns"))
    cells = cut.agg(F.sum(F.col("__rows").cast("long") * F.col("__columns"))).first()[0] or 0
    parts = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), cells), 20_000)
    meet = [key, "__row", "__column"]
    section = lambda by, n: F.pmod(F.xxhash64(*by), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = wide.join(cut, key).withColumn("__row", section(wide_by, "__rows")).withColumn("__column", every("__columns"))
    right = narrow.join(cut, key).withColumn("__column", section(narrow_by, "__columns")).withColumn("__row", every("__rows"))
    left, right = (side.drop("__rows", "__columns").repartition(parts, *meet) for side in (left, right))
    # Few rows make many pairs, so the sizes of the sides say nothing about the number of tasks: it is given, and the sides merge.
    return left.hint("merge").join(right, meet).drop("__row", "__column")


def placed(df: DataFrame, key: str, order, size=None) -> DataFrame:
    """Add ``position``: the place of a row among those of its key in ``order``, from 0; with ``size`` (a column) also ``offset``:
    the sum of the sizes before it.

    ``order`` must be a total order. The rows are cut into ranges of (key, order), so a key of any size is spread over
    tasks; counts and sums inside each range are put together by a prefix sum over the ranges of a key.
    """
    ranged = df.repartitionByRange(key, *order).withColumn(_PART, F.spark_partition_id())
    ranged = written(ranged if size is None else ranged.withColumn(_SIZE, size.cast("long")), "ranges")
    inside = Window.partitionBy(_PART, key).orderBy(*order)  # a part of a key: as large as a range at most
    sums = ranged.groupBy(_PART, key).agg(F.count(F.lit(1)).alias("__n"), *([] if size is None else [F.sum(_SIZE).alias("__sum")]))
    earlier = Window.partitionBy(key).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    starts = sums.select(F.col(_PART), F.col(key).alias("__key"), before("__n").alias("__rows"),
                         *([] if size is None else [before("__sum").alias("__offset")]))
    numbered = ranged.withColumn("position", F.row_number().over(inside) - 1)
    if size is not None:
        numbered = numbered.withColumn("offset", F.sum(_SIZE).over(inside) - F.col(_SIZE))
    same = (numbered[_PART] == starts[_PART]) & numbered[key].eqNullSafe(starts["__key"])
    joined = numbered.join(starts, same).drop(starts[_PART]).withColumn("position", F.col("position") + F.col("__rows"))
    if size is not None:
        joined = joined.withColumn("offset", F.col("offset") + F.col("__offset"))
    return joined.drop(_PART, _SIZE, "__key", "__rows", "__offset")
