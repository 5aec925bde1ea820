import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from advisorium.llm import repair
from advisorium.llm.queries import QUERIES
from tests.conftest import SMALL

sys.setrecursionlimit(20_000)  # the brute force goes row by row
RIGHT = re.compile(r"(s?(ua)+)?")
FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def brute(symbols):
    """Cheapest edits by exhaustive recursion over the roles written so far; at most two inserts in a row help."""
    step = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, before, inserts):
        found = []
        if i == len(symbols) and before in ("", "a"):
            found.append((0, "", ""))
        if inserts < 2:
            for role in step[before]:
                if role != "s":
                    cost, audit, roles = best(i, role, inserts + 1)
                    found.append((cost + 5, "I" + audit, role + roles))
        if i < len(symbols):
            symbol = symbols[i]
            cost, audit, roles = best(i + 1, before, 0)
            found.append((cost + 2, "D" + audit, roles))
            more = 5 if symbol in "SUA_" else 0
            if symbol != "x":
                for role in step[before]:
                    cost, audit, roles = best(i + 1, role, 0)
                    if symbol.lower() == role:
                        found.append((cost + more, "K" + audit, role + roles))
                    if role != "s":
                        found.append((cost + more + 1, "R" + audit, role + roles))
        return min(found, default=(10**9, "", ""))

    cost, audit, roles = best(0, "", 0)
    assert RIGHT.fullmatch(roles)
    return cost, audit


@settings(max_examples=500, deadline=None)
@given(st.text("suaSUAx-_", max_size=12))
def test_search_is_cheapest_and_least(symbols):
    assert repair.audit_of(symbols) == brute(symbols)


def test_pieces_change_nothing(monkeypatch):
    generator = random.Random(2)
    texts = ["".join(generator.choice("ssuuuaaaUAx-_") for _ in range(generator.randint(3, 40))) for _ in range(300)]
    whole = [repair.audit_of(t) for t in texts]
    monkeypatch.setattr(repair, "PIECE", 3)
    assert [repair.audit_of(t) for t in texts] == whole
    assert whole == [brute(t) for t in texts]


def rows_after(rows):
    """Rows (conv, turn, role, text) damaged, by conversation."""
    out = {}
    for conv, turn, role, text in rows:
        name = lambda v: " " if v is None else str(v)
        kept = out.setdefault(conv, [])
        fate = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        kept += [(turn, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, faults, symbols = set(), [], ""
    for _, role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "b" if not shown else "d" if (role, text) in seen else "." if shown[-1] in ".!?" else "t"
        seen.add((role, text))
        faults.append(fault)
        initial = role[:1] if role[:1] in tuple("sua") else "-"
        symbols += "x" if fault in "bd" else initial if fault == "." else "_" if initial == "-" else initial.upper()
    cost, audit = brute(symbols)
    turns, left, state = [], iter(rows), ""
    for edit in audit:
        row = next(left) if edit != "I" else None
        if edit == "D":
            continue
        role = row[1] if edit == "K" else "assistant" if state == "u" else "user"
        turns.append(f"{role}:{'' if edit == 'I' else row[2]}")
        state = role[0]
    known = [r[0] for r in rows if r[0] is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(turns).encode()).hexdigest())


def compare(got, rows):
    want = {conv: expected(kept) for conv, kept in rows_after(rows).items()}
    assert len(got) == len(want)
    for r in got:
        assert tuple(r[n] for n in FIELDS) == want[r.conv_id], r


def test_query_against_plain_python(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    compare(QUERIES["op12_repair"](spark, SMALL).collect(), rows)


@pytest.mark.parametrize("partitions", [1, 7])
def test_long_and_awkward_conversations(spark, partitions):
    generator = random.Random(4)
    texts = ["One.", "Two", "", " \t", "Three!", "Four?", "fünf …", "Six. \n", "x" * 30_000 + "."]
    rows = [(1, n, generator.choice(["system", "user", "assistant", "user", "assistant"]), f"{generator.choice(texts)}{n // 3}.") for n in range(400)]
    rows += [(2, n, generator.choice(["user", "assistant"]), generator.choice(texts)) for n in range(300)]
    rows += [(c, n, generator.choice(["system", "user", "assistant", "tool", "", None]), generator.choice([*texts, None]))
             for c in range(10, 60) for n in range(generator.randint(1, 9))]
    rows += [(3, 5, "user", "Same.")] * 150  # equal rows of one turn
    rows += [(None, n, "user", "No name.") for n in (None, 1, 2)] + [(4, None, "user", None), (5, 1 << 62, "user", "a."), (5, 1, "a", "b.")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, kind string, seq int")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        compare(repair.repair(repair.damaged(frame), copies="copies").collect(), rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_spread_over_partitions(spark):
    """One conversation has nearly all rows; adaptive execution is kept from joining its partitions again."""
    generator = random.Random(6)
    rows = [(1, n, generator.choice(["system", "user", "assistant", "user", "assistant"]), f"{generator.choice(['a.', 'b', '', 'c?'])}{n % 90}.")
            for n in range(600)] + [(2, 1, "user", "x."), (0, 1, "user", "x.")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        compare(repair.repair(repair.damaged(frame), copies="copies").collect(), rows)
        turns = repair.repaired_turns(repair.damaged(frame), copies="copies").orderBy("conv_id", "position").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert "".join(t.role[0] for t in turns if t.conv_id == 1 and t.position < 10_000).count("uu") == 0
    assert [t.position for t in turns if t.conv_id == 1] == list(range(sum(t.conv_id == 1 for t in turns)))


def test_all_dropped_and_empty(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    frame = spark.createDataFrame([(conv, 1, "user", "Hi.")], "conv_id bigint, turn bigint, role string, text string")
    row = repair.repair(repair.damaged(frame), copies="copies").first()
    assert tuple(row[n] for n in FIELDS) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.repair(frame.limit(0)).collect() == [] and repair.repaired_turns(frame.limit(0)).collect() == []
