"""Ranked lexical search over a length-stratified index.

Documents whose length gives the same normaliser m are a stratum. A stratum is held in blocks of bounded size; a
block has, for each of its terms, the places of its documents ordered by how often the term occurs in them (tf). Within a
stratum the impact of a term depends on tf alone, so it is computed once for each tf and added to all documents of its run.

The sum over a query's terms of the impact at the block's largest tf bounds what any document of the block can score.
Blocks are visited in the order of these bounds: first, for each query, the best ones that hold k documents together.
The k-th score found there is the query's threshold, and of the other blocks only those whose bound reaches it are
visited. The result is exact; no block is left out that could hold a better or equal document.

The index is built by ranges of (m, document), so equally long documents, however many, are spread over tasks, and
postings meet queries by a join on the term.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from advisorium.llm.shared import batch_of, discard, in_arrow, written

#: Letters and digits of ASCII and everything beyond it make terms; A-Z become a-z.
SEPARATED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
BLOCK_DOCS, BLOCK_POSTINGS = 8192, 1_000_000  # documents and postings of a block at most (one document more of postings)
QUERIES = 256  # queries that are scored together


class Index(NamedTuple):
    """blocks: block, m, ids; postings: block, m, term, tfs, counts, places; the two sums; what the ids are."""

    blocks: DataFrame
    postings: DataFrame
    documents: int
    terms: int
    id_type: T.DataType


def terms_of(content):
    """The terms of a text in UTF-8, in order."""
    return content.translate(SEPARATED).split()


def counted(batches, schema):
    """n, terms and tfs of each text."""
    from collections import Counter

    import numpy as np
    import pyarrow as pa

    for batch in batches:
        column, at = batch.column("content"), 0
        while at < batch.num_rows:
            sizes, terms, tfs, lengths, size = [], [], [], [], 0
            while at + len(sizes) < batch.num_rows and size < 4 << 20:
                content = column[at + len(sizes)].as_py()
                found = Counter(terms_of(content))
                sizes.append(found.total())
                terms += found.keys()
                tfs += found.values()
                lengths.append(len(found))
                size += len(content)
            ends = pa.array(np.cumsum([0, *lengths]).astype(np.int32))
            lists = {"terms": pa.ListArray.from_arrays(ends, pa.array(terms, pa.binary()).cast(pa.string())),
                     "tfs": pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32()))}
            kept = {n: batch.column(n).slice(at, len(sizes)) for n in schema.names if n not in ("n", "terms", "tfs")}
            yield batch_of(schema, kept | lists | {"n": sizes}, len(sizes))
            at += len(sizes)


def inverted(batches, schema, block_docs):
    """Blocks of the strata of a partition, which is sorted by m: a row of ids, then a row for each term."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    block, stratum, parts, docs, size = TaskContext.get().partitionId() << 36, None, [], 0, 0

    def rows():
        ids = pa.chunked_array([p.column("id") for p in parts]).combine_chunks()
        yield batch_of(schema, {"block": [block], "m": [stratum], "ids": pa.ListArray.from_arrays(pa.array([0, docs], pa.int32()), ids)}, 1)
        terms = pa.chunked_array([p.column("terms").flatten() for p in parts]).combine_chunks().dictionary_encode()
        tf = np.concatenate([p.column("tfs").flatten().to_numpy() for p in parts])
        held = np.concatenate([p.column("terms").value_lengths().to_numpy() for p in parts])
        place, code = np.repeat(np.arange(docs, dtype=np.int32), held), terms.indices.to_numpy()
        order = np.lexsort((place, tf, code))
        code, tf, place = code[order], tf[order], place[order]
        new_term = np.r_[True, code[1:] != code[:-1]]
        runs = np.flatnonzero(new_term | np.r_[True, tf[1:] != tf[:-1]])  # where a tf begins
        heads = np.flatnonzero(new_term)  # where a term begins
        counts, first_runs = np.diff(np.r_[runs, len(code)]), np.searchsorted(runs, heads)
        names = terms.dictionary.take(pa.array(code[heads]))
        run_ends, place_ends = np.r_[first_runs, len(runs)].astype(np.int32), np.r_[heads, len(code)].astype(np.int32)
        for a in range(0, len(heads), 50_000):
            b = min(a + 50_000, len(heads))
            cut = lambda ends, values, kind: pa.ListArray.from_arrays(
                pa.array(ends[a:b + 1] - ends[a]), pa.array(values[ends[a]:ends[b]], kind))
            yield batch_of(schema, {
                "block": pa.array(np.full(b - a, block)), "m": pa.array(np.full(b - a, stratum)), "term": names[a:b],
                "tfs": cut(run_ends, tf[runs], pa.int32()), "counts": cut(run_ends, counts, pa.int32()),
                "places": cut(place_ends, place, pa.int32())}, b - a)

    for batch in batches:
        ms, at = batch.column("m").to_numpy(), 0
        lengths = np.cumsum(batch.column("terms").value_lengths().to_numpy())
        while at < batch.num_rows:
            if parts and (ms[at] != stratum or docs >= block_docs or size >= BLOCK_POSTINGS):
                yield from rows()
                block, parts, docs, size = block + 1, [], 0, 0
            stratum, start = int(ms[at]), int(lengths[at - 1]) if at else 0
            to = min(int(np.searchsorted(ms, stratum, "right")), at + block_docs - docs)
            to = max(at + 1, min(to, int(np.searchsorted(lengths, start + BLOCK_POSTINGS - size)) + 1))
            parts.append(batch.slice(at, to - at))
            docs, size, at = docs + to - at, size + int(lengths[to - 1]) - start, to
    if parts:
        yield from rows()


def build(df: DataFrame, id_col="doc_id", text_col="text", block_docs=BLOCK_DOCS) -> Index:
    """The index of all rows of ``df``; a null text has no terms, repeated rows are documents of their own, ids may be null."""
    id_type = df.schema[id_col].dataType
    source = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("content"))
    fields = [("id", id_type), ("n", "bigint"), ("terms", "array<string>"), ("tfs", "array<int>")]
    texts = written(in_arrow(source, counted, fields), "counted")
    sums = texts.where("n > 0").agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    m = F.expr(f"100 - 50 + ((50 * n * {sums.documents}L) div {max(sums.terms, 1)}L)")
    keyed = texts.where("n > 0").select("id", m.alias("m"), "terms", "tfs", F.monotonically_increasing_id().alias("row"))
    dealt = keyed.repartitionByRange("m", "row").sortWithinPartitions("m", "row").drop("row")
    fields = [("block", "bigint"), ("m", "bigint"), ("term", "string"), ("tfs", "array<int>"), ("counts", "array<int>"),
              ("places", "array<int>"), ("ids", T.ArrayType(id_type))]
    table = written(in_arrow(dealt, inverted, fields, block_docs), "index")
    discard(texts)  # all that is left of it is in the index
    blocks = table.where("term IS NULL").select("block", "m", "ids")
    return Index(blocks, table.where("term IS NOT NULL").drop("ids"), sums.documents, sums.terms, id_type)


def scored(head, rows, schema, k):
    """The documents of a block that may be among the best k of a set of queries.

    ``head`` has one row: the ids, the queries that are asked and their thresholds; ``rows`` are the postings.
    """
    import numpy as np
    import pyarrow as pa

    out = []
    if head.num_rows:
        ids, m, first = head.column("ids")[0].as_py(), head.column("m")[0].as_py(), head.column("set")[0].as_py() * QUERIES
        wanted, least = head.column("asked")[0].as_py(), head.column("least")[0].as_py()
        asked = np.zeros(QUERIES, bool)
        asked[wanted] = True
        sums = np.zeros((QUERIES, len(ids)), np.int64)
        for batch in rows.to_batches():
            lists = {n: (batch.column(n).offsets.to_numpy(), batch.column(n).values.to_numpy()) for n in ("tfs", "counts", "places", "asked")}
            cut = lambda n, i: lists[n][1][lists[n][0][i]:lists[n][0][i + 1]]  # noqa: E731, B023
            for i, w in enumerate(batch.column("w").to_pylist()):
                queries, tf = cut("asked", i), cut("tfs", i).astype(np.int64)
                queries = queries[asked[queries]]
                if len(queries):
                    impacts = w * (1_000_000_000 * tf // (1000 * tf + 20 * m))  # once for each tf
                    sums[queries[:, None], cut("places", i)[None, :]] += np.repeat(impacts, cut("counts", i))
        for query, low in zip(wanted, least):
            scores = sums[query]
            good = np.flatnonzero(scores >= max(1, low))
            if len(good) > k:
                good = good[scores[good] >= np.partition(scores[good], -k)[-k]]
            top = sorted((-s, ids[i] is None, 0 if ids[i] is None else ids[i]) for i, s in zip(good.tolist(), scores[good].tolist()))
            out += [(first + query, None if none else i, -s) for s, none, i in top[:k]]
    columns = dict(zip(schema.names, zip(*out))) if out else {}
    return pa.Table.from_batches([batch_of(schema, columns, len(out))])


def search(index: Index, queries: DataFrame, k=50, query_col="item_id", text_col="text", id_name="doc_id") -> DataFrame:
    """item_id, rank, doc_id, score: of each row of ``queries`` the k documents with the highest scores above 0.

    Equal scores go by ascending id, null last. A null text asks for nothing and has no rows, like a text of unknown
    terms; repeated rows of ``queries`` are asked each on its own. Other columns of the tables are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    key_type = queries.schema[query_col].dataType
    asked = queries.select(F.col(f"`{query_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("content"))
    # numbers have no gaps inside a partition, so sets of them are full
    numbered = asked.withColumn("query", F.monotonically_increasing_id())
    fields = [("id", key_type), ("query", "bigint"), ("n", "bigint"), ("terms", "array<string>"), ("tfs", "array<int>")]
    items = written(in_arrow(numbered, counted, fields), "queries")
    wanted = items.select("query", F.explode("terms").alias("term"))
    result = [F.col(n) for n in (query_col, "rank", id_name, "score")]
    if not index.documents:
        return items.limit(0).select(F.col("id").alias(query_col), F.lit(0).alias("rank"), F.lit(None).cast(index.id_type).alias(id_name),
                                     F.lit(0).cast("bigint").alias("score")).select(*result)

    hits = written(index.postings.join(wanted.select("term").distinct(), "term", "left_semi"), "hits")
    df = hits.groupBy("term").agg(F.sum(F.size("places")).alias("df"))
    w = F.floor(1000 * F.log(F.lit(float(2 * index.documents + 2)) / (2 * F.col("df") + 1))).cast("bigint").alias("w")
    weighted = written(wanted.join(df, "term").select("query", "term", w), "weights").where("w > 0")
    # one row per term and set of queries
    local, group = F.pmod("query", F.lit(QUERIES)).cast("int"), F.floor(F.col("query") / QUERIES)
    terms = weighted.groupBy("term", group.alias("set")).agg(F.first("w").alias("w"), F.collect_list(local).alias("asked"))

    most = F.array_max("tfs")
    impact = F.expr("(1000000000L * most) div (1000 * most + 20 * m)")
    tops = hits.select("block", "m", "term", most.alias("most")).select("block", "term", impact.alias("impact"))
    bounds = tops.join(weighted, "term").groupBy("query", "block").agg(F.sum(F.col("w") * F.col("impact")).alias("bound"))
    sizes = index.blocks.select("block", F.size("ids").alias("docs"))
    visits = Window.partitionBy("query").orderBy(F.desc("bound"), "block")
    before = F.coalesce(F.sum("docs").over(visits.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = written(bounds.join(sizes, "block").select("query", "block", "bound", (before < k).alias("first")), "bounds")

    def visited(pairs):
        """Scores of the given (query, block, least) pairs."""
        heads = pairs.groupBy("block", group.alias("set")).agg(F.collect_list(F.struct(local.alias("q"), "least")).alias("a")).join(
            index.blocks, "block").select("block", "set", "m", "ids", F.col("a.q").alias("asked"), F.col("a.least").alias("least"))
        meant = pairs.select("block", group.alias("set")).distinct()
        rows = hits.drop("m").join(terms, "term").join(meant, ["block", "set"], "left_semi").drop("term")
        kind = T.StructType([T.StructField("query", T.LongType()), T.StructField("id", index.id_type), T.StructField("score", T.LongType())])
        schema, key = to_arrow_schema(kind), ["block", "set"]
        met = heads.groupBy(*key).cogroup(rows.groupBy(*key))  # a block's postings for a set of queries: bounded by the block
        return met.applyInArrow(lambda head, rows: scored(head, rows, schema, k), kind)

    def best(rows):
        place = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        return rows.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)

    first = written(best(visited(ranked.where("first").withColumn("least", F.lit(1).cast("bigint")))), "first")
    least = first.where(F.col("rank") == k).select("query", F.col("score").alias("least"))
    others = ranked.where("NOT first").join(least, "query", "left").withColumn("least", F.coalesce("least", F.lit(1).cast("bigint")))
    found = first.drop("rank").unionByName(visited(others.where("bound >= least").select("query", "block", "least")))
    rows = best(found).join(items.select("query", F.col("id").alias(query_col)), "query")
    return rows.withColumnRenamed("id", id_name).select(*result)
