"""Nearest existing vector of every new vector, exact, by pivots and the triangle inequality.

Vectors are scaled to unit length, where the distance of two vectors follows from their cosine. A few existing vectors, far
from each other, are pivots, chosen from a bounded sample. Every existing vector belongs to its closest pivot and lies in a
ring: a block of limited size of vectors with nearly equal distances from that pivot. A vector at distance d from the pivot is
no closer to a ring from ``low`` to ``high`` than low - d or d - high.

Each new vector first meets the ring it is closest to by that bound, which gives it a best score; then only those rings that
could hold an equal or better one. Rings are cut from ranges of (pivot, distance), so many equal vectors are spread over tasks,
and a ring that many vectors visit is copied by the count of its visits.
"""

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from advisorium.sources.scratch import written

# The workers need these helpers but may not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIVOTS, SAMPLE = 64, 1024  # the pivots, and the existing vectors they are chosen from, at most
RING_ROWS, SLICE_ROWS = 2048, 20_000  # vectors of a ring, and visits of one task
TIE_DECIMALS = 9
MARGIN = 1e-6  # for rounding: bounds are lowered by so much


def nearest_vectors(new: DataFrame, existing: DataFrame, key: str, vector: str, position: str, pivots: int = PIVOTS,
                    ring_rows: int = RING_ROWS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Best cosine similarity of embeddings per new row: (key, score, position of the closest).

    The width is that of most existing vectors, of the larger one in a tie. Rows of another width, or with
    missing components, count as rows without a vector; new ones are not returned. A vector of length 0 has the
    score 0 with all. Scores are compared at nine decimals; equal ones go to the smaller position.
    """
    whole = (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    left = new.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v")).filter(whole)
    right = existing.select(F.col(position).cast("long").alias("position"), F.col(vector).cast("array<double>").alias("v"))
    right = right.filter(whole)
    widths = right.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    _, width = widths.agg(F.max(F.struct("n", "width")).alias("top")).select("top.n", "top.width").first()
    key_type = new.schema[key].dataType
    if width is None:
        return left.select(F.col("key").alias(key), F.lit(None).cast("double").alias("score"), F.lit(None).cast("long").alias("position"))
    left, right = left.filter(F.size("v") == width), right.filter(F.size("v") == width)

    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    zeros = right.filter(length == 0).agg(F.min("position").alias("zero"))
    right = right.filter(length > 0)
    sample = right.withColumn("order", F.xxhash64("position")).orderBy("order", "position").limit(SAMPLE).drop("order")
    chosen = _in_arrow(sample.coalesce(1), _far_apart, "pivots binary", pivots).first()
    if chosen is None:  # all existing vectors have length 0
        return left.join(F.broadcast(zeros)).select(F.col("key").alias(key), F.lit(0.0).alias("score"), F.col("zero").alias("position"))
    shared = new.sparkSession.sparkContext.broadcast(bytes(chosen["pivots"]))  # PIVOTS rows at most

    placed = _in_arrow(right, _placed, "position long, v binary, pivot int, distance double", shared, width)
    dealt = placed.repartitionByRange("pivot", "distance", "position").sortWithinPartitions("pivot", "distance", "position")
    rings = written(_in_arrow(dealt, _rings, "ring long, pivot int, low double, high double, positions array<long>, vectors binary",
                              ring_rows), "rings")
    bounds = rings.select("ring", "pivot", "low", "high")
    numbered = _in_arrow(left, _asked, T.StructType([
        T.StructField("row", T.LongType()), T.StructField("key", key_type), T.StructField("v", T.BinaryType()),
        T.StructField("distances", T.ArrayType(T.DoubleType())), T.StructField("near", T.IntegerType())]), shared, width)
    asked = written(numbered, "vectors")

    some = asked.filter("distances IS NOT NULL")  # those of length above 0
    each = some.select("row", F.posexplode("distances").alias("pivot", "d"))
    apart = F.greatest(F.col("low") - F.col("d"), F.col("d") - F.col("high"), F.lit(0.0))
    # cosine of two unit vectors at this distance
    reach = F.when(apart > 0, 1 - apart * apart / 2).otherwise(F.lit(1.0)) + MARGIN
    ranges = bounds.groupBy("pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"))  # a row per pivot
    # every pivot is an existing vector, so it has a ring
    closest = some.select("row", F.col("near").alias("pivot"), F.get("distances", F.col("near")).alias("d")).join(bounds, "pivot")
    closest = closest.groupBy("row").agg(F.max_by("ring", F.struct(reach, -F.col("ring"))).alias("ring"))
    first = written(_visited(closest, asked, rings, slice_rows), "first")

    wanted = each.join(first.select("row", F.col("score").alias("least"), F.col("ring").alias("seen")), "row")
    wanted = wanted.join(ranges, "pivot").filter(reach >= F.col("least")).drop("low", "high")
    others = wanted.join(bounds, "pivot").filter((reach >= F.col("least")) & (F.col("ring") != F.col("seen"))).select("row", "ring")
    found = first.drop("ring").unionByName(_visited(others, asked, rings, slice_rows).drop("ring"))
    best = found.groupBy("row").agg(F.max(F.struct("score", (-F.col("position")).alias("before"))).alias("top"))
    # a vector of length 0 on either side scores 0
    low = right.agg(F.min("position").alias("low"))
    joined = asked.select("row", "key", F.col("distances").isNull().alias("none")).join(best, "row", "left")
    joined = joined.join(F.broadcast(zeros.join(low)))  # one row
    nothing = F.col("none")
    by_zero = F.col("zero").isNotNull() & ((F.col("top.score") < 0) | ((F.col("top.score") == 0) & (F.col("zero") < -F.col("top.before"))))
    return joined.select(
        F.col("key").alias(key),
        F.when(nothing | by_zero, F.lit(0.0)).otherwise(F.col("top.score")).alias("score"),
        F.when(nothing, F.least("zero", "low")).when(by_zero, F.col("zero")).otherwise(-F.col("top.before")).alias("position"))


def _visited(pairs, asked, rings, slice_rows):
    """(row, ring, score, position): the best of each ring for the rows that visit it."""
    visits = pairs.groupBy("ring").agg(F.ceil(F.count(F.lit(1)) / F.lit(slice_rows)).cast("int").alias("slices"))
    copies = rings.join(visits, "ring").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).select(
        "ring", "slice", "positions", "vectors")
    rows = pairs.join(visits, "ring").withColumn("slice", F.pmod(F.xxhash64("row"), F.col("slices")).cast("int"))
    rows = rows.join(asked.select("row", "v"), "row").select("ring", "slice", "row", "v")
    met = rows.groupBy("ring", "slice").cogroup(copies.groupBy("ring", "slice"))
    return met.applyInArrow(_best_of_ring, "row long, ring long, score double, position long")


def _in_arrow(df, run, fields, *options):
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T._parse_datatype_string(fields) if isinstance(fields, str) else fields
    return df.mapInArrow(lambda batches: run(batches, to_arrow_schema(schema), *options), schema)


def _batch(schema, columns):
    import pyarrow as pa

    def column(field, values):
        return values.cast(field.type) if isinstance(values, pa.Array) else pa.array(values, field.type)

    return pa.RecordBatch.from_arrays([column(f, c) for f, c in zip(schema, columns)], schema=schema)


def _units(column, width):
    """Rows of unit length; those of length 0 stay as they are."""
    import numpy as np

    matrix = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    scale = np.abs(matrix).max(axis=1, keepdims=True)  # squares of extreme numbers stay in range
    matrix = np.divide(matrix, scale, out=np.zeros_like(matrix), where=scale > 0)
    length = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


def _distances(matrix, pivots):
    import numpy as np

    return np.sqrt(np.maximum(2 - 2 * (matrix @ pivots.T), 0))


def _far_apart(batches, schema, n):
    """Pivots: the first row, then always the one farthest from those chosen."""
    import numpy as np

    parts = [_units(b.column("v"), len(b.column("v")[0])) for b in batches if b.num_rows]
    if parts:
        matrix = np.concatenate(parts)
        chosen, nearest = [0], _distances(matrix, matrix[:1])[:, 0]
        while len(chosen) < n and nearest.max() > 1e-6:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, _distances(matrix, matrix[chosen[-1:]])[:, 0])
        yield _batch(schema, [[matrix[chosen].tobytes()]])


def _pivots(shared, width):
    import numpy as np

    return np.frombuffer(shared.value, np.float64).reshape(-1, width)


def _placed(batches, schema, shared, width):
    import numpy as np

    for batch in batches:
        if batch.num_rows:
            matrix = _units(batch.column("v"), width)
            apart = _distances(matrix, _pivots(shared, width))
            at = apart.argmin(axis=1)
            yield _batch(schema, [batch.column("position"), [row.tobytes() for row in matrix], at.astype(np.int32),
                                  apart[np.arange(len(at)), at]])


def _rings(batches, schema, ring_rows):
    from pyspark import TaskContext

    ring, pivot, rows = TaskContext.get().partitionId() << 33, None, []

    def made():
        by_position = sorted(rows)
        apart = [r[2] for r in rows]
        return _batch(schema, [[ring], [pivot], [min(apart)], [max(apart)], [[r[0] for r in by_position]], [b"".join(r[1] for r in by_position)]])

    for batch in batches:
        for at, *row in zip(*[batch.column(n).to_pylist() for n in ("pivot", "position", "v", "distance")]):
            if rows and (at != pivot or len(rows) >= ring_rows):
                yield made()
                ring, rows = ring + 1, []
            pivot = at
            rows.append(row)
    if rows:
        yield made()


def _asked(batches, schema, shared, width):
    import numpy as np
    from pyspark import TaskContext

    row = TaskContext.get().partitionId() << 33
    for batch in batches:
        if batch.num_rows:
            matrix = _units(batch.column("v"), width)
            apart = _distances(matrix, _pivots(shared, width))
            lists = [d if any_ else None for d, any_ in zip(apart.tolist(), matrix.any(axis=1))]
            n = batch.num_rows
            yield _batch(schema, [list(range(row, row + n)), batch.column("key"), [r.tobytes() for r in matrix], lists,
                                  apart.argmin(axis=1).astype(np.int32)])
            row += n


def _best_of_ring(rows, ring):
    import numpy as np
    import pyarrow as pa

    n, best, at = rows.num_rows, [], []
    if n and ring.num_rows:
        positions = np.array(ring.column("positions")[0].as_py(), np.int64)
        others = np.frombuffer(ring.column("vectors")[0].as_py(), np.float64).reshape(len(positions), -1)
        vectors = rows.column("v").to_pylist()
        for low in range(0, n, 1000):
            matrix = np.frombuffer(b"".join(vectors[low:low + 1000]), np.float64).reshape(-1, others.shape[1])
            scores = np.round(matrix @ others.T, TIE_DECIMALS)
            first = scores.argmax(axis=1)  # positions ascend, so the first is the smallest
            best += scores[np.arange(len(first)), first].tolist()
            at += positions[first].tolist()
    kept = rows.slice(0, len(best))
    return pa.table({"row": kept.column("row"), "ring": kept.column("ring"), "score": pa.array(best, pa.float64()),
                     "position": pa.array(at, pa.int64())})
