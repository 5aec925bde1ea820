import hashlib
from collections import defaultdict

import pytest

from advisorium.llm import exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for i, (number, text) in enumerate(rows):
        groups[exact_dedup.LOWER and (text or "").encode().translate(exact_dedup.LOWER)].append(number)
    out = []
    for content, numbers in groups.items():
        known = [n for n in numbers if n is not None]
        best = max(known, default=None)
        out += [(n, best, len(numbers), hashlib.sha256(content).hexdigest()) for n in numbers]
    return sorted(out, key=repr)


@pytest.mark.parametrize("budget", [1 << 26, 1, 500])
def test_against_plain_python(docs, awkward, budget):
    """Also with tables that hold one text, so that everything else is spilled, level by level."""
    rows = awkward + [(100 + i, f"Text {i % 37}") for i in range(300)]
    found = exact_dedup.assign(docs(rows), budget=budget, fan_out=3)
    assert "kept" in found.columns and found.columns.count("kept") == 1 and "row" in found.columns
    got = found.collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == expected(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) and all(r.doc_id == r.keep_id for r in kept)


def test_grace_splits_what_does_not_fit(tmp_path):
    records = [(hash((i % 50,)) & (1 << 64) - 1, i, exact_dedup.rank(i, i), 1, f"text {i % 50}".encode()) for i in range(500)]
    groups = list(exact_dedup.grace(records, 1000, 4, str(tmp_path)))
    rows = list(exact_dedup.members_of(groups))
    assert len(groups) == 50 and sorted(r[0] for r in rows) == list(range(500))
    assert all(copies == 10 and best == 450 + leader % 50 for leader, best, _, copies, _ in rows)


def test_kept_rows_and_empty_table(docs, awkward):
    rows = docs(awkward)
    kept = exact_dedup.kept(rows, budget=300, fan_out=2)
    assert kept.columns == rows.columns and kept.schema == rows.schema
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [2, 4, 5, 6, 7]
    assert exact_dedup.assign(rows.limit(0)).collect() == []
