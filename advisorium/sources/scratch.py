"""Intermediate tables: computed once, written to shared storage, safe from lost executors."""

import uuid

from pyspark.sql import DataFrame


def scratch_root(spark) -> str:
    """The checkpoint folder of the session; where it names none, a folder in its warehouse, which is shared too."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the checkpoint folder, so that later uses do not compute it again."""
    path = f"{scratch_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
