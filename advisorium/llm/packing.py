"""Packing of token sequences: first-fit decreasing in randomised groups, over a tournament tree of free room.

A text is cut into pieces of at most ``capacity`` tokens; only its last piece is shorter. The pieces of all
texts are dealt to groups of bounded size by a seeded hash, each group is packed on its own: longest piece
first, each into the first bin with room for it. The tree holds in every node the largest room below it, so
that bin is found, and its room updated, in as many steps as the tree is high.
"""

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisorium.llm import bpe
from advisorium.llm.shared import batch_of, in_arrow, row_type, unpacked, written

END = 1
RESULTS = ("start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset")
PIECE = "array<struct<start:bigint,length:bigint,ids_crc32:bigint,ids:binary>>"


class Tournament:
    """Rooms of a row of bins; the winner of a match is the larger room."""

    def __init__(self, bins, capacity):
        self.leaves = 1
        while self.leaves < bins:
            self.leaves *= 2
        self.room = [capacity] * (2 * self.leaves)

    def place(self, length):
        """(first bin with room for ``length``, what was in it); its room is taken."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < length:
                node += 1
        at, left = node - self.leaves, room[node]
        room[node] = left - length
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
        return at, left


def first_fit_decreasing(lengths, capacity):
    """[(bin, offset)] for each length, none above ``capacity``; equal lengths go in the order given."""
    placed = [None] * len(lengths)
    tree = Tournament(len(lengths), capacity)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at, left = tree.place(lengths[i])
        placed[i] = at, capacity - left
    return placed


def pieces_of(ids, capacity, with_ids):
    """The pieces of one text's ids (little-endian 32 bits), which end with END."""
    ids += END.to_bytes(4, "little")
    cuts = [(at, ids[4 * at:4 * (at + capacity)]) for at in range(0, len(ids) // 4, capacity)]
    return [{"start": at, "length": len(part) // 4, "ids_crc32": zlib.crc32(part), "ids": part if with_ids else None}
            for at, part in cuts]


def packed_groups(batches, schema, capacity):
    for group, rows in bpe.in_groups(batches, "group"):
        rows = list(rows)
        for row, (at, offset) in zip(rows, first_fit_decreasing([r["length"] for r in rows], capacity)):
            row["sequence_id"], row["offset"] = group << 32 | at, offset
        for at in range(0, len(rows), 10_000):
            part = rows[at:at + 10_000]
            yield batch_of(schema, {n: [r[n] for r in part] for n in schema.names}, len(part))


def pack(df: DataFrame, path, text_col="text", carry=None, capacity=2048, group_pieces=1 << 15, seed=11, with_ids=True,
         **options) -> DataFrame:
    """One row per piece: the columns ``carry`` of ``df`` (default: all but the text) with start, length, ids_crc32, doc_tokens, ids, sequence_id, offset.

    The ids of a text are followed by id 1, so a null or empty text is one piece of one token. Repeated rows are
    packed each on its own; an empty table gives no rows; columns of ``df`` named like a result are replaced.
    ``with_ids=False`` leaves the ids of the pieces null. A group has about ``group_pieces`` pieces.
    """
    carry = [c for c in ([c for c in df.columns if c != text_col] if carry is None else carry) if c not in RESULTS]

    def finish(own):
        cut = [pieces_of(ids, capacity, with_ids) for ids in own]
        return {"doc_tokens": [len(ids) // 4 + 1 for ids in own], "pieces": cut}

    texts = bpe.encode(df, path, finish, [("doc_tokens", "bigint"), ("pieces", PIECE)], text_col, carry, **options)
    pieces = written(texts.select("row", "doc_tokens", F.explode("pieces").alias("piece")).select("row", "doc_tokens", "piece.*"), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64(F.lit(seed), "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))
    fields = [("row", row_type(df, carry)), *[(n, "binary" if n == "ids" else "bigint") for n in RESULTS]]
    together = dealt.repartition("group").sortWithinPartitions("group", F.desc("length"), "ids_crc32", "start")
    return unpacked(in_arrow(together, packed_groups, fields, capacity), carry, {n: F.col(n) for n in RESULTS})
