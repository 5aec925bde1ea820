"""Exact top-k by inner product over integer vectors: MaxScore in shards, then a merge.

A term is a dimension with a sign. The posting list of (d, +) has the vectors with a positive component d, that
of (d, -) those with a negative one, each with its largest weight in the shard. A query meets, of each
dimension, the list of its own sign; the other sign can only lower a score, so the sum over the met lists
bounds the score from above. Lists whose bounds together stay below the k-th best score so far are not
essential: no vector found in them alone can enter the result. The essential lists are traversed, the others
are probed for vectors that may still compete, and the exact score is computed for those that are left.

Vectors are dealt to shards and queries to blocks, both of limited size; a task takes one (block, shard) pair.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from advisorium.llm.shared import batch_of, in_arrow

CELLS = 1 << 18  # (query, vector) cells that are bounded at once: 2 MB
FIRST = 12  # lists of a query that give its first known vectors
MANY = 16  # above one rival in so many cells, all cells are scored by one product


def searched(ids, vectors, query_ids, queries, k):
    """(query ids, vector ids, scores): the k best of one shard for each query, ties to the smaller id."""
    import numpy as np

    most = [max(int(x.max(initial=0)), -int(x.min(initial=0))) for x in (vectors, queries)]
    # sums of products below 2^53 are exact in doubles, whatever their order
    kind = np.float64 if most[0] * most[1] * vectors.shape[1] < 1 << 53 else np.int64
    vectors, queries, lowest = vectors.astype(kind), queries.astype(kind), -np.inf if kind is np.float64 else np.iinfo(kind).min
    # about half of the vectors are in each list, so a list is held as a row of weights, 0 for those that are not
    lists = np.concatenate([np.maximum(vectors.T, 0), np.maximum(-vectors.T, 0)])
    largest, out = lists.max(axis=1, initial=0), []
    at_once = max(1, CELLS // max(1, len(ids)))
    for low in range(0, len(queries), at_once):
        asked, numbers = queries[low:low + at_once], query_ids[low:low + at_once]
        own = numbers[:, None] == ids  # a query is no candidate of its own
        enough = len(ids) - own.sum(axis=1) >= k
        met = np.concatenate([np.maximum(asked, 0), np.maximum(-asked, 0)], axis=1)
        order = np.argsort(-met * largest, axis=1, kind="stable")
        place = np.argsort(order, axis=1)  # of each list in the order of what it adds at most
        sums = np.cumsum(np.take_along_axis(met * largest, order, 1)[:, ::-1], axis=1)[:, ::-1]
        rest = np.concatenate([sums, np.zeros((len(asked), 1), kind)], axis=1)  # bound of the lists from i on
        least = np.full(len(asked), lowest, kind)  # score of the k-th best known vector
        for first in (FIRST, None):
            # lists that together stay below the k-th best score are not essential
            essential = np.where(least > 0, (rest >= least[:, None]).sum(axis=1), met.shape[1]) if first is None else np.full(len(asked), first)
            bound = np.where(place < essential[:, None], met, 0) @ lists
            bound[own] = -1
            if enough.any():
                seeds = np.argpartition(bound, -k, axis=1)[:, -k:]
                known = np.einsum("qsd,qd->qs", vectors[seeds], asked).min(axis=1)
                least = np.where(enough, np.maximum(least, known), least)
        left = rest[np.arange(len(asked)), np.minimum(essential, met.shape[1])]
        rivals = ((bound + left[:, None] >= least[:, None]) | (least <= 0)[:, None]) & ~own
        if np.count_nonzero(rivals) * MANY > rivals.size:
            scores = asked @ vectors.T
            of, at = np.nonzero(rivals & (scores >= least[:, None]))
            scores = scores[of, at]
        else:
            of, at = np.nonzero(rivals)
            scores = np.einsum("rd,rd->r", asked[of], vectors[at])
            good = scores >= least[of]
            of, at, scores = of[good], at[good], scores[good]
        best = np.lexsort((ids[at], -scores, of))
        of, at, scores = of[best], at[best], scores[best]
        top = np.arange(len(of)) - np.searchsorted(of, of) < k
        out.append((numbers[of[top]], ids[at[top]], scores[top].astype(np.int64)))
    return [np.concatenate(column) for column in zip(*out)] if out else [np.zeros(0, np.int64)] * 3


def matrix(rows, width):
    """Vectors, an Arrow list of lists, as the rows of a matrix; a shorter one is filled up with zeros."""
    import numpy as np

    ends = rows.offsets.to_numpy()
    full = np.zeros((len(rows), width), np.int64)
    full[np.arange(width) < np.diff(ends)[:, None]] = rows.values.to_numpy()[ends[0]:ends[-1]]
    return full


def pairs_searched(batches, schema, k):
    import numpy as np

    for batch in batches:
        for n in range(batch.num_rows):
            ids, vectors, query_ids, queries = (batch.column(name)[n].values for name in ("ids", "vectors", "query_ids", "queries"))
            width = max(int(np.diff(rows.offsets.to_numpy()).max()) for rows in (vectors, queries))
            found = searched(ids.to_numpy(), matrix(vectors, width), query_ids.to_numpy(), matrix(queries, width), k)
            if len(found[0]):
                yield batch_of(schema, dict(zip(schema.names, found)), len(found[0]))


def blocked(df, name, parts, alias):
    """One row per block: the ids and the vectors of about as many rows in each."""
    row = F.struct("id", "vector")
    block = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(parts)).cast("int")
    gathered = df.groupBy(block.alias(name)).agg(F.collect_list(row).alias("rows"))
    return gathered.select(name, F.col("rows.id").alias(alias[0]), F.col("rows.vector").alias(alias[1]))


def top_k(vectors: DataFrame, queries: DataFrame, k=20, id_col="vec_id", vector_col="embedding", scale=64,
          shard_rows=4096, block_rows=2048) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` the k best rows of ``vectors`` but the one of its id.

    Components become floor(scale * x); the score is the inner product, ties go to the smaller id. Vectors that are
    null, empty of an id, or hold null or non-finite components take no part; a shorter vector counts as filled up
    with zeros. Of repeated ids each row is a candidate; a query whose id repeats is asked once, with its smallest vector
    (component by component).
    Empty tables give no rows. No pair is left out: every block of queries meets every shard, one pair to a task row.
    """
    def clean(df):
        x = F.col(f"`{vector_col}`")
        whole = F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double")).cast("long"))
        good = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        return df.where(F.col(f"`{id_col}`").isNotNull() & F.coalesce(good, F.lit(False))).select(
            F.col(f"`{id_col}`").cast("long").alias("id"), whole.alias("vector"))

    candidates, asked = clean(vectors), clean(queries).groupBy("id").agg(F.min("vector").alias("vector"))
    sizes = candidates.agg(F.count(F.lit(1)).alias("n")).first()["n"], asked.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    shards, blocks = (max(1, -(-n // rows)) for n, rows in zip(sizes, (shard_rows, block_rows)))
    left = blocked(candidates, "shard", shards, ("ids", "vectors")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = blocked(asked, "block", blocks, ("query_ids", "queries")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    fields = [("query_id", "bigint"), ("vec_id", "bigint"), ("score", "bigint")]
    parts = max(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), shards * blocks // 4)  # a task holds few pairs
    pairs = left.repartition(parts, "shard", "block").join(right.repartition(parts, "shard", "block"), ["shard", "block"])
    found = in_arrow(pairs, pairs_searched, fields, k)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
