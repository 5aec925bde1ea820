"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked at two differing bits or fewer.

Candidates come from Golay fuzzy hashing. A fingerprint has three segments of 22, 21 and 21 bits. Where two
fingerprints differ in at most two bits, one segment is free of errors (pigeonhole) and the next one has at
most two, so the pair shares that segment and one of its Golay keys. Fingerprints that share such a key are
compared. A key held by more than ``dense`` different fingerprints takes another exact way: each of them is
written once for every pair of bit positions outside the shared segment with these two bits cleared; equal
results differ in these bits only and so are links, and no group has more than four members.
"""

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisorium.llm import golay
from advisorium.llm.components import components
from advisorium.llm.exact_dedup import LOWER
from advisorium.llm.shared import batch_of, in_arrow, packed, row_type, unpacked, written

BITS, WORDS, SEED = 64, 3, 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (lowest bit, width)
RESULTS = ("fingerprint", "component_id")


def fingerprint(content):
    """The fingerprint of a text in UTF-8: a bit is 1 if set in over half the hashes of its 3-word shingles."""
    from itertools import accumulate

    import numpy as np
    from xxhash import xxh64_intdigest as xxh

    words = content.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < WORDS:
        return xxh(joined, SEED)
    ends = list(accumulate(map(len, words), lambda end, n: end + 1 + n))
    starts = [0, *(end + 1 for end in ends)]
    n, counts = len(words) - WORDS + 1, np.zeros(BITS, np.int64)
    hashes = np.fromiter((xxh(joined[a:b], SEED) for a, b in zip(starts, ends[WORDS - 1:])), "<u8", n)
    for at in range(0, n, 255 * 64):
        bits = np.unpackbits(hashes[at:at + 255 * 64].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        counts += np.add.reduce(bits[:whole].reshape(-1, 255, BITS), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[whole:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(batches, schema):
    import numpy as np
    from pyspark import TaskContext

    row = TaskContext.get().partitionId() << 36
    for batch in batches:
        n = batch.num_rows
        found = np.array([fingerprint(c.as_py()) for c in batch.column("content")], np.uint64).view(np.int64)
        yield batch_of(schema, {"row": batch.column("row"), "id": batch.column("id"), "fp": found.tolist(),
                                "row_id": range(row, row + n)}, n)
        row += n


def golay_keys(batches, schema):
    """(key, fp): segment number, its bits, and a Golay key of the next segment."""
    import numpy as np

    made = golay.tables()
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
        parts = [(fps >> low) & ((1 << width) - 1) for low, width in SEGMENTS]
        for i in range(3):
            at, index = golay.keys(parts[(i + 1) % 3], made)
            yield batch_of(schema, {"key": (i << 40 | parts[i][at] << 12 | index).tolist(), "fp": fps[at].tolist()}, len(at))


def links(fps: DataFrame, dense=256, rows=None) -> DataFrame:
    """All links (u, v) that connect the different fingerprints ``fp``, through candidates and a check of each.

    Of a dense key only the links to the smallest of each group are given; the components are the same.
    ``rows``, where given, bounds the number of files.
    """
    keys = written(in_arrow(fps, golay_keys, [("key", "bigint"), ("fp", "bigint")]), "keys", rows)
    crowded = written(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > dense).select("key"), "crowded", rows)
    sparse = keys.join(crowded, "key", "left_anti")
    a, b = sparse.select("key", F.col("fp").alias("u")), sparse.select("key", F.col("fp").alias("v"))
    near = a.join(b, "key").where((F.col("u") > F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= 2)).select("u", "v")
    pairs = []
    for low, width in SEGMENTS:
        free = [bit for bit in range(BITS) if not low <= bit < low + width]
        masks = [1 << x | 1 << y for x, y in combinations(free, 2)]
        pairs.append(F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in masks]))
    members = keys.join(crowded, "key", "left_semi").select("fp", F.shiftright("key", 40).alias("segment")).distinct()
    cleared = (members.withColumn("mask", F.explode(F.when(F.col("segment") == 0, pairs[0]).when(F.col("segment") == 1, pairs[1])
                                                    .otherwise(pairs[2])))
               .select("segment", "mask", F.col("fp").bitwiseAND(F.bitwise_not("mask")).alias("rest"), "fp"))
    stars = cleared.groupBy("segment", "mask", "rest").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    dense_links = stars.select(F.array_min("fps").alias("v"), F.explode("fps").alias("u")).where("u <> v").select("u", "v")
    return near.unionAll(dense_links)


def linked(df: DataFrame, id_col="doc_id", text_col="text", carry=None, dense=256) -> DataFrame:
    """Rows of ``df`` (columns ``carry``) as the struct ``row``, with row_id, fp, component_id and keep_row."""
    carry = list(df.columns if carry is None else carry)
    kind = df.schema[id_col].dataType
    source = df.select(packed(df, carry), F.col(f"`{id_col}`").alias("id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("content"))
    fields = [("row", row_type(df, carry)), ("id", kind), ("row_id", "bigint"), ("fp", "bigint")]
    rows = written(in_arrow(source, fingerprints, fields), "fingerprints")
    first = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row_id"))
    fps = written(rows.groupBy("fp").agg(F.min(first).alias("first")), "distinct")
    roots = components(links(fps.select("fp"), dense))
    rooted = fps.join(roots, fps.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    tops = rooted.groupBy("root").agg(F.min("first").alias("top"))
    found = rooted.join(tops, "root").select("fp", F.col("top.id").alias("component_id"), F.col("top.row_id").alias("keep_row"))
    return rows.join(found, "fp").select("row", "row_id", "fp", "component_id", "keep_row")


def near_duplicates(df: DataFrame, id_col="doc_id", text_col="text", carry=None, dense=256) -> DataFrame:
    """The rows of ``df`` with fingerprint (16 hex digits) and component_id, the smallest id reachable by links.

    A null text is an empty one; texts without words have fingerprint zero and are linked like any other. A
    null id is larger than any other, so component_id is null only where no row of the component has an id.
    Repeated rows share a component. An empty table gives no rows; columns named like a result are replaced.
    """
    carry = [c for c in (df.columns if carry is None else carry) if c not in RESULTS]
    rows = linked(df, id_col, text_col, carry, dense)
    return unpacked(rows, carry, {"fingerprint": F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id": F.col("component_id")})


def kept(df: DataFrame, id_col="doc_id", text_col="text", dense=256) -> DataFrame:
    """One row of each component stays: that of the smallest id (of repeated ones, the first)."""
    rows = linked(df, id_col, text_col, None, dense).where(F.col("row_id") == F.col("keep_row"))
    return unpacked(rows, df.columns, {})
