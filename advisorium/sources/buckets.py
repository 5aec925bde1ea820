"""Tables in hash buckets, for histories that new rows are joined to again and again.

A bucketed table lies in files by the hash of its key. A join on that key moves the new side to the buckets and leaves the
history where it is: no exchange on its side of the plan. New rows are appended as further files of the same buckets.
"""

import hashlib

from pyspark.sql import DataFrame

BUCKETS = 64


def _name(path):
    return f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"


def append(df: DataFrame, path: str, keys, buckets: int = BUCKETS) -> None:
    """Add rows to the bucketed table at ``path``, which the first call makes. ``keys`` and ``buckets`` stay the same for good."""
    opened(df.sparkSession, path, df.schema, keys, buckets)
    dealt = df.repartition(buckets, *keys)  # one file for each bucket
    dealt.write.mode("append").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(_name(path))


def opened(spark, path: str, schema, keys, buckets: int = BUCKETS) -> DataFrame:
    """The table at ``path``; a session that has not seen it learns its buckets from ``keys`` and ``buckets``."""
    name = _name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)
