"""Exact deduplication by Grace hashing.

Two texts are equal when identical after lower-casing A-Z only; null counts as empty. Each scan task first
joins the equal texts it sees under a leader (a table of bounded size that is emptied when full), so a group
of copies reaches the shuffle as one record per task. The leaders are scattered by a hash of the content;
each partition keeps an open-addressing table that compares whole contents, and what doesn't fit its budget
goes to spill files by further hash bits, which are treated the same way, level by level.
"""

import hashlib
import os
import pickle
import tempfile
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisorium.llm.shared import batch_of, in_arrow, packed, row_type, unpacked, written

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
RESULTS = ("keep_id", "group_size", "kept", "text_sha256")


class ContentTable:
    """Open addressing with linear probing over whole contents."""

    def __init__(self):
        self.cells, self.mask = [-1] * 1024, 1023
        self.hashes, self.contents, self.values, self.size = [], [], [], 0

    def find(self, key, content):
        """(cell, entry); entry is -1 where the content is not in the table."""
        at = key & self.mask
        while (entry := self.cells[at]) >= 0:
            if self.hashes[entry] == key and self.contents[entry] == content:
                break
            at = (at + 1) & self.mask
        return at, entry

    def add(self, at, key, content, value):
        self.cells[at] = len(self.hashes)
        self.hashes.append(key)
        self.contents.append(content)
        self.values.append(value)
        self.size += len(content) + 200
        if 2 * len(self.hashes) > self.mask:
            self.mask = 4 * self.mask + 3
            self.cells = [-1] * (self.mask + 1)
            for entry, key in enumerate(self.hashes):
                at = key & self.mask
                while self.cells[at] >= 0:
                    at = (at + 1) & self.mask
                self.cells[at] = entry


def rank(number, row):
    """Order of the rows of a group: the largest id first; no id is the least, equal ids go to the first row."""
    return (number is not None, number if number is not None else 0, -row)


def leaders(batches, schema, budget):
    """Each row with its leader, and each leader with its content, best row and count."""
    import xxhash
    from pyspark import TaskContext

    first_row = TaskContext.get().partitionId() << 36
    table, seen = ContentTable(), 0

    def flush():
        values = table.values
        return batch_of(schema, {
            "leader": [v[0] for v in values], "content": table.contents, "copies": [v[2] for v in values],
            "top_id": [v[1][1] if v[1][0] else None for v in values], "top_row": [-v[1][2] for v in values]}, len(values))

    for batch in batches:
        numbers, own, rows = batch.column("id").to_pylist(), [], []
        for number, content in zip(numbers, batch.column("content")):
            content = content.as_py().translate(LOWER)
            row, key = first_row + seen, xxhash.xxh64_intdigest(content)
            seen += 1
            at, entry = table.find(key, content)
            if entry < 0:
                table.add(at, key, content, [row, rank(number, row), 0])
            value = table.values[entry]
            value[1], value[2] = max(value[1], rank(number, row)), value[2] + 1
            own.append(value[0])
            rows.append(row)
        yield batch_of(schema, {"row": batch.column("row"), "row_id": rows, "leader": own}, len(rows))
        if table.size > budget:
            yield flush()
            table = ContentTable()
    yield flush()


def records_of(batches):
    import xxhash

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("leader", "top_id", "top_row", "copies")]
        for leader, top_id, top_row, copies, content in zip(*columns, batch.column("content")):
            content = content.as_py()
            yield xxhash.xxh64_intdigest(content), leader, rank(top_id, top_row), copies, content


def spilled(path):
    with open(path, "rb") as file:
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return


def grace(records, budget, fan_out, folder, level=0):
    """(content, best rank, best member, count, all members) of each content, its records together.

    A record is (hash of the content, member, rank, copies, content).
    """
    table, files = ContentTable(), {}
    for record in records:
        key, member, best, copies, content = record
        at, entry = table.find(key, content)
        if entry < 0 and table.hashes and table.size + len(content) > budget:
            part = (key >> (64 - 4 * (level + 1))) % fan_out
            if part not in files:
                files[part] = open(f"{folder}/{level}-{part}", "wb")
            pickle.dump(record, files[part], pickle.HIGHEST_PROTOCOL)
            continue
        if entry < 0:
            table.add(at, key, content, [best, member, 0, []])
        value = table.values[entry]
        if best > value[0]:
            value[:2] = best, member
        value[2] += copies
        if isinstance(member, int):
            value[3].append(member)
    for content, value in zip(table.contents, table.values):
        yield (content, *value)
    del table
    for file in files.values():
        file.close()
    for part, file in files.items():
        deeper = f"{folder}/{level}-{part}.d"
        os.mkdir(deeper)
        yield from grace(spilled(file.name), budget, fan_out, deeper, (level + 1) % 15)
        os.remove(file.name)


def members_of(groups):
    """(leader, keep id, keep row, count, digest) of every leader."""
    for content, best, _, copies, members in groups:
        digest = hashlib.sha256(content).hexdigest()
        for leader in members:
            yield leader, best[1] if best[0] else None, -best[2], copies, digest


def groups_of(batches, schema, budget, fan_out):
    with tempfile.TemporaryDirectory() as folder:
        rows = members_of(grace(records_of(batches), budget, fan_out, folder))
        while part := list(islice(rows, 10_000)):
            yield batch_of(schema, dict(zip(schema.names, zip(*part))), len(part))


def assign(df: DataFrame, id_col="doc_id", text_col="text", carry=None, budget=64 << 20, fan_out=16) -> DataFrame:
    """The rows of ``df`` with keep_id, group_size, kept and text_sha256.

    Of equal texts the row with the largest id is kept; a null id is less than any other, and of repeated rows
    (same text, same id) exactly one is kept. A null text is an empty one. ``carry`` names the columns to return
    (default: all); a column named like a result is replaced by it. An empty table gives no rows. ``budget`` is
    the bytes of contents a task holds, ``fan_out`` the number of spill files a level.
    """
    carry = [c for c in (df.columns if carry is None else carry) if c not in RESULTS]
    kind = df.schema[id_col].dataType
    source = df.select(packed(df, carry), F.col(f"`{id_col}`").alias("id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("content"))
    fields = [("row", row_type(df, carry)), ("row_id", "bigint"), ("leader", "bigint"), ("content", "binary"),
              ("top_id", kind), ("top_row", "bigint"), ("copies", "bigint")]
    table = written(in_arrow(source, leaders, fields, budget), "leaders")
    groups = [("leader", "bigint"), ("keep_id", kind), ("keep_row", "bigint"), ("group_size", "bigint"),
              ("text_sha256", "string")]
    scattered = (table.where(F.col("content").isNotNull()).select("leader", "top_id", "top_row", "copies", "content")
                 .repartition(F.xxhash64("content")))
    found = in_arrow(scattered, groups_of, groups, budget, fan_out)
    rows = table.where(F.col("row_id").isNotNull()).select("row", "row_id", "leader").join(found, "leader")
    return unpacked(rows, carry, {"keep_id": F.col("keep_id"), "group_size": F.col("group_size"),
                                  "kept": F.col("row_id") == F.col("keep_row"), "text_sha256": F.col("text_sha256")})


def best_rows(batches, schema, budget):
    """Of the equal texts that a scan task sees the best row, as bytes, with the hash of its content."""
    import xxhash
    from pyspark import TaskContext

    first_row = TaskContext.get().partitionId() << 36
    table, seen = ContentTable(), 0

    def flush():
        values = table.values
        return batch_of(schema, {
            "key": [h - (1 << 64) if h >> 63 else h for h in table.hashes], "top_row": [-v[0][2] for v in values],
            "top_id": [v[0][1] if v[0][0] else None for v in values],
            "row": [pickle.dumps(v[1][v[2]].as_py(), pickle.HIGHEST_PROTOCOL) for v in values]}, len(values))

    for batch in batches:
        rows = batch.column("row")
        for i, (number, content) in enumerate(zip(batch.column("id").to_pylist(), batch.column("content"))):
            content = content.as_py().translate(LOWER)
            key, best = xxhash.xxh64_intdigest(content), rank(number, first_row + seen)
            seen += 1
            at, entry = table.find(key, content)
            if entry < 0:
                table.add(at, key, content, [best, rows, i])
            elif best > table.values[entry][0]:
                table.values[entry][:] = best, rows, i
        if table.size > budget:
            yield flush()
            table = ContentTable()
    yield flush()


def winners(batches, schema, budget, fan_out, text_name):
    """The best row of each content; contents are made again from the rows."""
    def records():
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("key", "top_id", "top_row", "row")]
            for key, number, row, payload in zip(*columns):
                text = pickle.loads(payload)[text_name] or ""
                yield key & (1 << 64) - 1, payload, rank(number, row), 1, text.encode().translate(LOWER)

    with tempfile.TemporaryDirectory() as folder:
        groups = grace(records(), budget, fan_out, folder)
        while part := list(islice(groups, 500)):
            yield batch_of(schema, {"row": [pickle.loads(g[2]) for g in part]}, len(part))


def kept(df: DataFrame, id_col="doc_id", text_col="text", budget=64 << 20, fan_out=16) -> DataFrame:
    """The rows of ``df`` that stay, with its columns: what ``assign`` marks as kept, without its table of members."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    plain = df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    source = plain.select(packed(plain), F.col(names[id_col]).alias("id"),
                          F.coalesce(F.col(names[text_col]), F.lit("")).cast("binary").alias("content"))
    fields = [("key", "bigint"), ("top_id", df.schema[id_col].dataType), ("top_row", "bigint"), ("row", "binary")]
    local = in_arrow(source, best_rows, fields, budget).repartition("key")
    rows = in_arrow(local, winners, [("row", row_type(plain, plain.columns))], budget, fan_out, names[text_col])
    return rows.select(*[F.col(f"row.{n}").alias(c) for c, n in names.items()])
