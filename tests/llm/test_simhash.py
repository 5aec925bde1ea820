import random

import numpy as np
import pytest
import xxhash

from advisorium.llm import golay, simhash
from advisorium.llm.components import components


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(links, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_golay_keys_meet():
    made, generator = golay.tables(), random.Random(1)
    for _ in range(500):
        u = generator.getrandbits(23)
        v = u
        for bit in generator.sample(range(23), generator.randint(0, 2)):
            v ^= 1 << bit
        keys = [set(golay.keys(np.array([x]), made)[1].tolist()) for x in (u, v)]
        assert keys[0] & keys[1] and len(keys[0]) in (1, 6)


def test_fingerprint():
    generator = random.Random(4)
    words = ["Ab", "ä", "x,", "é b", "The", "the", "#"]
    for n in [*range(8), 400, 300 * 64]:
        text = "".join(generator.choice(words) + generator.choice([" ", "\n", "\t ", "  "]) for _ in range(n))
        assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


@pytest.mark.parametrize("dense", [256, 2])
def test_links_give_the_components_of_all_pairs(spark, dense):
    """With the exact way for dense keys as well as without."""
    generator = random.Random(7)
    fps = {0, (1 << 64) - 1}
    for _ in range(40):
        fp = generator.getrandbits(64)
        fps.add(fp)
        for _ in range(generator.randint(0, 12)):
            for bit in generator.sample(range(64), generator.randint(1, 3)):
                fp ^= 1 << bit
            fps.add(fp)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = roots([(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2], signed)
    frame = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    links = simhash.links(frame, dense)
    assert all(((r.u ^ r.v) & (1 << 64) - 1).bit_count() <= 2 for r in links.collect())
    got = {r.node: r.root for r in components(links).collect()}
    assert {n: got.get(n, n) for n in signed} == want


@pytest.mark.parametrize("few", [500_000, 0])
def test_components(spark, few):
    """In one task and by rounds."""
    edges = [(1, 2), (2, 3), (9, 8), (7, 7), (None, 1), (3, 2), *[(20 + i, 21 + i) for i in range(40)], (100, 60)]
    frame = spark.createDataFrame(edges, "u bigint, v bigint").repartition(5)
    assert {r.node: r.root for r in components(frame, few=few).collect()} == {2: 1, 3: 1, 9: 8, 100: 20, **{i: 20 for i in range(21, 61)}}
    assert components(frame.limit(0)).collect() == []


def test_documents(docs, awkward):
    base = [f"w{i}" for i in range(400)]
    near = base.copy()
    near[7] = "changed"
    rows = awkward + [(50, " ".join(base)), (51, " ".join(near)), (52, " ".join(reversed(base)))]
    frame = docs(rows)
    got = simhash.near_duplicates(frame).collect()
    want = {i: brute_fingerprint(t) for i, (_, t) in enumerate(rows)}
    assert sorted(r.fingerprint for r in got) == sorted(f"{f:016x}" for f in want.values())
    unique = set(want.values())
    root = roots([(a, b) for a in unique for b in unique if a < b and (a ^ b).bit_count() <= 2], unique)
    best = {}
    for i, (number, _) in enumerate(rows):
        if number is not None:
            best[root[want[i]]] = min(best.get(root[want[i]], number), number)
    assert {(r.fingerprint, r.component_id) for r in got} == {(f"{f:016x}", best.get(root[f])) for f in unique}
    kept = simhash.kept(frame)
    assert kept.columns == frame.columns and kept.count() == len(set(root.values()))
    assert simhash.near_duplicates(frame.limit(0)).collect() == []
