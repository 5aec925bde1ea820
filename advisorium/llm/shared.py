"""Small helpers of the corpus operators."""

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from advisorium.sources.scratch import scratch_root

FOLDER = ContextVar("folder", default=None)  # where the tables of a run go, when their caller has named a folder
FILE_ROWS = 4000  # of the input of an operator, to a file of its tables


def few_parts(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in no more partitions than an input of so many ``rows`` asks for; all tasks of the session keep work.

    Every file costs its writer time, and on a local file system processes that set its mode.
    """
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` as a table in the checkpoint folder, so that later uses do not compute it again.

    ``rows``, where given, is the size of the operator's input and bounds the number of files.
    """
    df = df if rows is None else few_parts(df, rows)
    path = f"{FOLDER.get() or scratch_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def folder(spark):
    """Gives the path of a new folder, which takes the tables written inside the block. Its caller deletes it."""
    path = f"{scratch_root(spark)}/run-{uuid.uuid4().hex}"
    token = FOLDER.set(path)
    try:
        yield path
    finally:
        FOLDER.reset(token)


def delete(spark, path):
    """Delete a folder of tables, once all that was made from them is written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(table: DataFrame):
    """Delete a table that ``written`` has made, once all that was made from it is written."""
    for path in {f.rpartition("/")[0] for f in table.inputFiles()}:
        delete(table.sparkSession, path)


def packed(df: DataFrame, names=None, alias="row"):
    """The columns ``names`` (default: all) as one struct, so that their names meet no column of an operator."""
    names = df.columns if names is None else list(names)
    if not names:
        return F.struct(F.lit(None).cast("boolean").alias("none")).alias(alias)
    return F.struct(*[F.col(f"`{n}`") for n in names]).alias(alias)


def unpacked(df: DataFrame, names, results):
    """Columns of the struct ``row`` beside ``results`` ({name: column}); a result replaces a column of its name."""
    kept = [F.col(f"row.`{n}`").alias(n) for n in names if n not in results]
    return df.select(*kept, *[c.alias(n) for n, c in results.items()])


def row_type(df: DataFrame, names):
    """Type of the struct that ``packed`` makes."""
    fields = [T.StructField(n, df.schema[n].dataType) for n in names]
    return T.StructType(fields or [T.StructField("none", T.BooleanType())])


def in_arrow(df: DataFrame, run, fields, *options) -> DataFrame:
    """``run(batches, schema, *options)`` over the Arrow batches of each partition; ``fields`` is [(name, type)]."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([T.StructField(name, T._parse_datatype_string(kind) if isinstance(kind, str) else kind)
                           for name, kind in fields])
    def task(batches):
        try:
            yield from run(batches, to_arrow_schema(schema), *options)
        finally:
            give_back()

    return df.mapInArrow(task, schema)


def give_back():
    """Free memory of this worker goes back to the system: workers outlive their tasks, and an executor has several."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library than glibc


def batch_of(schema, columns, n):
    """A record batch of ``schema``; columns that are not given are null."""
    import pyarrow as pa

    def column(field):
        values = columns.get(field.name)
        if values is None:
            return pa.nulls(n, field.type)
        return values.cast(field.type) if isinstance(values, pa.Array) else pa.array(values, field.type)

    return pa.RecordBatch.from_arrays([column(f) for f in schema], schema=schema)
