"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates come from two sides. By SimHash, texts whose fingerprints Golay keys link at two differing bits or fewer, as
``simhash`` finds them, are candidates of each other. Most pairs of the similarity asked for are further apart (3 to 11
bits), so MinHash adds those it finds: 192 hashes of the shingle set in 32 bands of six. Texts that share a band are a
bucket; a pair of similarity s shares one with probability 1 - (1 - s^6)^32, which is 0.99994 at 0.8 and rises
with s. The texts of a component of fingerprints are a bucket as well. Every candidate is verified on exact shingle sets, in two rounds, for only links that connect matter.
First, texts that buckets connect are a group, and each text of a group meets its first one: a shingle set is sent
once, and large groups are dealt over tasks with a copy of the first set each. Then the buckets that still hold texts
not connected so far are compared pair by pair, without the first texts, whose pairs are done: a bucket is cut into
sections of bounded size, and each pair of sections meets in one task.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisorium.llm.components import components
from advisorium.llm.exact_dedup import LOWER
from advisorium.llm.shared import batch_of, few_parts, in_arrow, packed, row_type, unpacked, written
from advisorium.llm.simhash import fingerprint
from advisorium.llm.simhash import links as fingerprint_links

WORDS, SIMILARITY, SEED = 5, 0.8, 42
BANDS, ROWS = 32, 6
SECTION, SECTION_SHINGLES = 512, 2_000_000  # texts and shingles of a section, about
COLUMNS = 4096  # shingles that are multiplied at once
FEW = 2_000_000  # row numbers (16 MB) that go to every task at most; more are joined by a shuffle


def shingles(content, words=WORDS):
    """Sorted different hashes of the shingles of a text in UTF-8; fewer words than that are one shingle."""
    from itertools import accumulate

    import numpy as np
    from xxhash import xxh64_intdigest as xxh

    found = content.translate(LOWER).split()
    if not found:
        return np.zeros(0, np.uint64)
    joined, width = b" ".join(found), min(words, len(found))
    ends = list(accumulate(map(len, found), lambda end, n: end + 1 + n))
    starts = [0, *(end + 1 for end in ends)]
    hashes = (xxh(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1:]))
    return np.unique(np.fromiter(hashes, np.uint64, len(found) - width + 1))


def multipliers():
    import numpy as np

    return np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(hashes, factors):
    """One key for each band; the texts without words share a key of their own."""
    import numpy as np

    if not len(hashes):
        return [0]
    least = np.full(len(factors), (1 << 64) - 1, np.uint64)
    for at in range(0, len(hashes), 512):
        part = hashes[at:at + 512]
        for low in range(0, len(factors), 64):
            np.minimum(least[low:low + 64], (factors[low:low + 64, None] * part).min(axis=1), out=least[low:low + 64])
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    return key.view(np.int64).tolist()


def signatures(batches, schema, words):
    import numpy as np
    from pyspark import TaskContext

    row, factors = TaskContext.get().partitionId() << 36, multipliers()
    for batch in batches:
        n, sets = batch.num_rows, (shingles(c.as_py(), words) for c in batch.column("content"))
        found = [(len(s), band_keys(s, factors)) for s in sets]
        fps = np.array([fingerprint(c.as_py()) for c in batch.column("content")], np.uint64).view(np.int64)
        yield batch_of(schema, {"row": batch.column("row"), "id": batch.column("id"), "row_id": range(row, row + n), "fp": fps.tolist(),
                                "size": [f[0] for f in found], "bands": [f[1] for f in found]}, n)
        row += n


def shingle_sets(batches, schema, words):
    for batch in batches:
        sets = [shingles(c.as_py(), words).tobytes() for c in batch.column("content")]
        yield batch_of(schema, {"row_id": batch.column("row_id"), "shingles": sets}, len(sets))


def near(sets, similarity):
    """Which of the shingle sets are similar: a square matrix of booleans."""
    import numpy as np

    sizes = np.array([len(s) for s in sets], np.int64)
    _, number, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner, shared = np.repeat(np.arange(len(sets)), sizes), times[number] > 1
    owner, number = owner[shared], (np.cumsum(times > 1) - 1)[number[shared]]
    both = np.zeros((len(sets), len(sets)))
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        a, b = np.searchsorted(number, [low, low + COLUMNS])
        part = np.zeros((len(sets), int(number[b - 1]) - low + 1), np.float32)
        part[owner[a:b], number[a:b] - low] = 1
        both += part @ part.T
    return both >= similarity * (sizes[:, None] + sizes[None, :] - both) - 1e-9


def block_links(rows, similarity):
    """(u, v) of a block of (row_id, section, shingles): each text with the least one of its component here.

    A block of two sections compares those of the one with those of the other; pairs inside a section have a
    block of their own.
    """
    import numpy as np

    ids = np.array([r[0] for r in rows], np.int64)
    order = np.argsort(ids)
    ids, part = ids[order], np.array([r[1] for r in rows], np.int64)[order]
    linked = near([np.frombuffer(rows[i][2], np.uint64) for i in order], similarity)
    if part.min() != part.max():
        linked &= part[:, None] != part[None, :]
    np.fill_diagonal(linked, True)
    own = np.arange(len(ids))
    while True:
        least = np.where(linked, own[None, :], len(ids)).min(axis=1)
        least = least[least]
        if (least == own).all():
            break
        own = least
    return [(u, v) for u, v in zip(ids.tolist(), ids[own].tolist()) if u != v]


def verified(batches, schema, similarity):
    """Links of the blocks of a partition, which is sorted by block."""
    block, rows = None, []

    def links():
        found = block_links(rows, similarity) if len(rows) > 1 else []
        if found:
            yield batch_of(schema, dict(zip(("u", "v"), zip(*found))), len(found))

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("key", "low", "high", "row_id", "section", "shingles")]
        for key, low, high, *row in zip(*columns):
            if (key, low, high) != block:
                yield from links()
                block, rows = (key, low, high), []
            rows.append(row)
    yield from links()


def starred(batches, schema, similarity):
    """Which texts are similar to the first one of their group; a partition is sorted by group, the first one ahead."""
    import numpy as np

    head = group = None
    for batch in batches:
        found = []
        columns = [batch.column(n).to_pylist() for n in ("root", "section", "row_id", "shingles")]
        for root, section, row_id, shingles_ in zip(*columns):
            own = np.frombuffer(shingles_, np.uint64)
            if (root, section) != group:
                group, head = (root, section), own
            elif len(own) and len(head):
                both = int((head[np.minimum(np.searchsorted(head, own), len(head) - 1)] == own).sum())
                if both >= similarity * (len(own) + len(head) - both) - 1e-9:
                    found.append((row_id, root))
            elif len(own) == len(head):  # texts without words
                found.append((row_id, root))
        if found:
            yield batch_of(schema, dict(zip(("u", "v"), zip(*found))), len(found))


def among(rows, ids, n, limit=FEW):
    """The rows whose row_id is in ``ids``: a broadcast where they are few by count, else a shuffle; ``n`` bounds the files."""
    ids = written(ids.distinct(), "ids", n)
    return rows.join(F.broadcast(ids) if ids.count() <= limit else ids, "row_id", "left_semi")


def links(signed: DataFrame, text, words, similarity, section=SECTION) -> DataFrame:
    """Links (u, v) between row_ids that connect all verified pairs; ``text`` is the column with the content."""
    edge, n = [("u", "bigint"), ("v", "bigint")], signed.count()
    bands = signed.select("row_id", F.explode("bands").alias("key"))
    fps = written(signed.select("fp").distinct(), "fps", n)
    close = written(components(fingerprint_links(fps, rows=n), rows=n), "close", n)
    own = signed.select("row_id", "fp").join(close, F.col("fp") == F.col("node"), "left")
    keys = bands.unionAll(own.select("row_id", F.xxhash64(F.lit("fingerprint"), F.coalesce("root", "fp")).alias("key")))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first")).where("n > 1").drop("n")
    members = written(keys.join(shared, "key"), "members", n)
    groups = written(components(members.select(F.col("row_id").alias("u"), F.col("first").alias("v")), rows=n), "groups", n)
    candidates = groups.select(F.col("node").alias("row_id")).unionAll(groups.select("root").distinct())
    chosen = among(signed, candidates, n).select("row_id", F.coalesce(text, F.lit("")).cast("binary").alias("content"))
    sets = written(in_arrow(chosen, shingle_sets, [("row_id", "bigint"), ("shingles", "binary")], words), "sets")

    sizes = groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / section).cast("int").alias("sections"))
    texts = groups.join(sizes, "root").select(
        "root", F.pmod(F.xxhash64("node"), F.col("sections")).cast("int").alias("section"), F.col("node").alias("row_id"))
    firsts = sizes.select("root", F.explode(F.sequence(F.lit(0), F.col("sections") - 1)).alias("section"), F.col("root").alias("row_id"))
    met = written(texts.unionByName(firsts), "met", n).join(sets, "row_id")
    met = met.repartition("root", "section").sortWithinPartitions("root", "section", "row_id")  # the first has the smallest row_id
    stars = written(in_arrow(met, starred, edge, similarity), "stars", n)

    # the rest: buckets with texts of several stars; pairs with the first text of a group are done
    others = members.join(groups.select(F.col("node").alias("row_id")), "row_id", "left_semi").select("key", "row_id")
    others = others.join(stars.select(F.col("u").alias("row_id"), "v"), "row_id", "left").withColumn("star", F.coalesce("v", "row_id"))
    others = written(others.join(signed.select("row_id", "size"), "row_id").select("key", "row_id", "star", "size"), "others", n)
    sections = F.ceil(F.greatest(F.col("n") / section, F.col("size") / SECTION_SHINGLES, F.lit(1)))
    buckets = others.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"), F.min("star").alias("low"), F.max("star").alias("high"),
        *[F.bit_xor(F.xxhash64("row_id", F.lit(i))).alias(f"mark{i}") for i in (0, 1)]).where("low < high")
    # buckets with the same members count once
    buckets = buckets.groupBy("n", "mark0", "mark1").agg(F.min("key").alias("key"), F.max("size").alias("size")).select(
        "key", sections.cast("int").alias("sections"))
    own = F.pmod(F.xxhash64("row_id"), F.col("sections")).cast("int")
    dealt = (others.join(buckets, "key").withColumn("section", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sections") - 1)))
             .select("key", "row_id", "section", F.least("section", "other").alias("low"), F.greatest("section", "other").alias("high")))
    blocks = dealt.join(sets, "row_id").repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return stars.unionByName(in_arrow(blocks, verified, edge, similarity))


def kept(df: DataFrame, id_col="doc_id", text_col="text", words=WORDS, similarity=SIMILARITY, section=SECTION) -> DataFrame:
    """One row of each group connected by near copies stays: that of the smallest id (of repeated ones, the first).

    A null text is an empty one, and texts without words are copies of each other; a null id is larger than any
    other. An empty table gives no rows.
    """
    source = df.select(packed(df), F.col(f"`{id_col}`").alias("id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("content"))
    fields = [("row", row_type(df, df.columns)), ("id", df.schema[id_col].dataType), ("row_id", "bigint"), ("fp", "bigint"), ("size", "int"),
              ("bands", "array<bigint>")]
    signed = written(in_arrow(source, signatures, fields, words), "signatures")
    n = signed.count()
    roots = written(components(links(signed, F.col(f"row.`{text_col}`"), words, similarity, section), rows=n), "roots", n)
    grouped = roots.select(F.col("node").alias("row_id"), "root").unionAll(roots.select("root", "root").distinct())
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row_id"))
    grouped = signed.select("row_id", "id").join(grouped, "row_id")
    tops = grouped.groupBy("root").agg(F.min(order).alias("top"))
    gone = grouped.join(tops, "root").where("row_id <> top.row_id").select("row_id")
    return few_parts(unpacked(signed.join(gone, "row_id", "left_anti"), df.columns, {}), n)
