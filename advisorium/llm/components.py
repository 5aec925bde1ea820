"""Connected components of a graph given by its edges, by large-star and small-star rounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisorium.llm.shared import batch_of, few_parts, in_arrow, written

EDGE = [("u", "bigint"), ("v", "bigint")]


def forest(batches, schema):
    """The edges of a partition as stars of its own components: as many edges as it has nodes, at most."""
    parent = {}

    def root(node):
        top = node
        while (above := parent.setdefault(top, top)) != top:
            top = above
        while node != top:
            parent[node], node = top, parent[node]
        return top

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    rows = [(node, root(node)) for node in list(parent)]
    rows = [r for r in rows if r[0] != r[1]]
    for at in range(0, len(rows), 50_000):
        part = rows[at:at + 50_000]
        yield batch_of(schema, dict(zip(("u", "v"), zip(*part))), len(part))


def large_star(edges):
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges):
    """A node and its smaller neighbours are linked to the smallest of them; edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v")))


def state(edges):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()


def components(edges: DataFrame, u="u", v="v", few=500_000, rows=None) -> DataFrame:
    """(node, root) of every node that has an edge to another; root is the smallest node of its component.

    The stars of all partitions are counted: up to ``few`` of them (some 10 MB) one task joins them, with the same
    result as the rounds. Each round writes its edges to the checkpoint folder; the rounds end when the edges stay
    the same. Self links, repeated edges and null ends do no harm; no edges give no rows. ``rows``, where given, is
    the size of the input that the edges come from: it bounds the number of files of a round.
    """
    given = edges.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v")).where("u <> v")
    given = given if rows is None else few_parts(given, rows)
    now = written(in_arrow(given, forest, EDGE), "edges")
    before, after = None, state(now)
    if after[0] <= few:
        now, before = written(in_arrow(now.coalesce(1), forest, EDGE), "edges"), after
    while before != after and after[0]:
        now = written(small_star(large_star(now)).distinct(), "edges", rows)
        before, after = after, state(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
