"""Published tables as versioned snapshots.

A publication writes its tables to new folders and then one small manifest that names the folder of every table. The
manifest is the only thing that changes what readers see: a write that fails before it leaves the tables as they were, and
tables that belong together, such as the catalogue and the staging area, change in one step. Manifests are numbered; of
two publications from the same number one fails, and nothing of it is seen.
"""

import json
import uuid

from pyspark.sql import DataFrame, functions as F


class Conflict(RuntimeError):
    """Another publication came first."""


def _files(spark, path):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _numbers(spark, root):
    files, path = _files(spark, f"{root}/manifests")
    if not files.exists(path):
        return []
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def current(spark, root: str):
    """(number, {table: folder}) of the newest publication; (-1, {}) before the first."""
    numbers = _numbers(spark, root)
    if not numbers:
        return -1, {}
    return numbers[-1], json.loads(spark.read.text(f"{root}/manifests/{numbers[-1]:012}.json", wholetext=True).first().value)


def read(spark, root: str, table: str) -> DataFrame:
    """A table of the newest publication."""
    return spark.read.parquet(f"{root}/{current(spark, root)[1][table]}")


def publish(spark, root: str, tables: dict) -> int:
    """Write ``tables`` ({name: DataFrame}) and make them current together; other tables stay as they are.

    Returns the number of the publication. Raises ``Conflict``, and changes nothing, when another one was faster.
    """
    number, folders = current(spark, root)
    version = uuid.uuid4().hex
    for name, df in tables.items():
        folders[name] = f"tables/{name}/{version}"
        df.write.parquet(f"{root}/{folders[name]}")
    _commit(spark, root, number + 1, folders)
    return number + 1


def _commit(spark, root, number, folders):
    """The manifest appears whole, or not at all: it is written aside and renamed to a name that must be free."""
    files, target = _files(spark, f"{root}/manifests/{number:012}.json")
    _, aside = _files(spark, f"{root}/manifests/.{uuid.uuid4().hex}")
    out = files.create(aside, False)
    try:
        out.write(bytearray(json.dumps(folders).encode()))
    finally:
        out.close()
    if files.exists(target) or not files.rename(aside, target):
        files.delete(aside, False)
        raise Conflict(f"publication {number} of {root} exists already")


def expire(spark, root: str, keep: int = 2) -> list:
    """Delete publications older than the newest ``keep``, and the folders that only they name. Returns the deleted folders."""
    numbers = _numbers(spark, root)
    named = lambda ns: {f for n in ns for f in json.loads(
        spark.read.text(f"{root}/manifests/{n:012}.json", wholetext=True).first().value).values()}
    old = numbers[:-keep]
    gone = sorted(named(old) - named(numbers[-keep:]))
    for n in old:  # first what names the folders
        files, path = _files(spark, f"{root}/manifests/{n:012}.json")
        files.delete(path, False)
    for folder in gone:
        files, path = _files(spark, f"{root}/{folder}")
        files.delete(path, True)
    return gone


def promote(spark, root: str, decisions: DataFrame, catalog: str = "catalog", staging: str = "staging") -> DataFrame:
    """Carry out decisions (id, action, reason): promoted records enter the catalogue and leave the staging area with the
    rejected ones, in one publication. Returns the results of the decisions."""
    from advisorium.operators import review
    from advisorium.sources.scratch import written

    known, staged = read(spark, root, catalog), read(spark, root, staging)
    results = written(review.decide(staged, decisions, known), "decided")
    promoted = results.filter(F.col("result") == "promoted").select("id")
    added = staged.join(promoted, "id", "left_semi").select(*known.columns)
    publish(spark, root, {catalog: known.unionByName(added), staging: review.after_promotion(staged, results)})
    return results
