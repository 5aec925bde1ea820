import zlib
from collections import defaultdict

import xxhash

from advisorium.llm import shards


def best(number, count):
    def weight(k):
        seed = 42
        if number is not None:
            seed = xxhash.xxh64_intdigest(number.to_bytes(8, "little", signed=True), seed)
        value = xxhash.xxh64_intdigest(k.to_bytes(4, "little"), seed)
        return value - (1 << 64) if value >> 63 else value

    return max((weight(k), k) for k in range(count))[1]


def test_law_slots_and_digests(docs, awkward):
    rows = awkward + [(100 + i, f"text {i}") for i in range(500)] + [(9, "copy")] * 50
    found = shards.shuffled(docs(rows), shards=7, bucket_bytes=2000)
    assert found.columns.count("size") == 1 and "row" in found.columns
    got = found.collect()
    assert sorted((repr(r.doc_id), r.text or "") for r in got) == sorted((repr(n), t or "") for n, t in rows)
    slots = defaultdict(list)
    for r in got:
        data = (r.text or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 16, zlib.crc32(data), "key")
        assert r.shard == best(r.doc_id, 7) and r.grown_shard == best(r.doc_id, 8) and r.grown_shard in (r.shard, 7)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_order_is_shuffled_and_empty_table(docs):
    rows = [(i, f"t{i}") for i in range(400)]
    one = [r.doc_id for r in shards.shuffled(docs(rows), shards=1).orderBy("slot").collect()]
    assert one != sorted(one) and sorted(one) == list(range(400))
    neighbours = sum(abs(a - b) == 1 for a, b in zip(one, one[1:]))
    assert neighbours < 20
    assert shards.shuffled(docs(rows).limit(0)).collect() == []


def test_written_shards(spark, docs, tmp_path):
    shards.write_shards(docs([(i, "x") for i in range(100)]), str(tmp_path / "out"), shards=4)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100
