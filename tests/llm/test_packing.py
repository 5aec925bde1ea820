import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from advisorium.llm import bpe, packing


def first_fit(lengths, capacity):
    rooms, placed = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = next((k for k, room in enumerate(rooms) if room >= lengths[i]), len(rooms))
        if at == len(rooms):
            rooms.append(capacity)
        placed[i] = at, capacity - rooms[at]
        rooms[at] -= lengths[i]
    return [placed[i] for i in range(len(lengths))]


@pytest.mark.parametrize("seed", range(6))
def test_first_fit_decreasing(seed):
    generator = random.Random(seed)
    lengths = [generator.randint(1, 100) for _ in range(generator.randint(1, 300))]
    assert packing.first_fit_decreasing(lengths, 100) == first_fit(lengths, 100)


@pytest.mark.parametrize("group_pieces", [1 << 15, 7])
def test_pieces(docs, awkward, path, group_pieces):
    rows = awkward + [(70 + i, "some words of a text " * i) for i in range(40)]
    got = packing.pack(docs(rows), path, capacity=64, group_pieces=group_pieces).collect()
    texts, sequences, wanted = defaultdict(list), defaultdict(list), defaultdict(list)
    for number, text in rows:
        ids = bpe.tokenizer(path).encode(text or "", add_special_tokens=False).ids + [1]
        wanted[number, len(ids)].append(ids)
    for r in got:
        assert r.ids_crc32 == zlib.crc32(r.ids) and r.length == len(r.ids) // 4 <= 64
        texts[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(texts) == set(wanted)
    for key, pieces in texts.items():
        assert sum(p.length for p in pieces) == sum(map(len, wanted[key]))
        cuts = sorted((p.start, np.frombuffer(p.ids, "<u4").tolist()) for p in pieces)
        assert cuts == sorted((at, ids[at:at + 64]) for ids in wanted[key] for at in range(0, len(ids), 64))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    tokens = sum(r.length for r in got)
    if group_pieces > 1000:
        assert len(sequences) * 64 <= 1.02 * tokens + 64
    assert packing.pack(docs(rows).limit(0), path).collect() == []
