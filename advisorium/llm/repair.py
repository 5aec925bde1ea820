"""Repair of the order of roles in conversations by iterative-deepening A*.

A conversation is right when its role initials are ``(s?(ua)+)?``: perhaps a system turn, then pairs of user and
assistant. Edits make it so: Delete a row (2; a must for blank and repeated rows), Insert an empty user or assistant
turn (5), Keep (0), Rerole to user or assistant (1); a truncated row that is not deleted adds 5. The audit of a
conversation is the row of initials of its cheapest edits, of equally cheap ones the least in ASCII order.

The search is depth first in ASCII order (D, I, K, R) under a bound on the cost, which starts at a lower bound (every
faulty row costs 2 at least) and rises to the least cost that went beyond it. A table holds for each state that failed
the lower bound of what it still costs, and states that cannot meet the bound are not entered again. So the first path that
is accepted is the answer.

Rows are dealt by ranges of (conversation, turn), so a conversation of any length is spread over as many tasks as its
share of the rows asks for. A conversation that lies inside a partition is repaired there. The first and the last one of a
partition may go on in others: their rows are cut in pieces of PIECE rows. The cheapest cost of each piece from each state
to each other is a small matrix; the matrices give, from the last piece to the first, what each state costs from there on,
and with that the same search finds the edits of every piece on its own. Long conversations inside a partition are cut the
same way. Only the hash over the whole repaired text of a conversation reads its rows one after the other, by definition.
"""

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisorium.llm.shared import batch_of, in_arrow, written

PIECE = 64
INF = 1 << 40
SPACE = " \t\n\x0b\x0c\r"
#: States: nothing yet, after system, after user, after assistant; the last and the first are complete.
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
COMPLETE = (0, INF, INF, 0)
TO_COMPLETE = (0, 10, 5, 0)
LEGAL = {"su", "ua", "au"}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def options(symbol, state):
    """(edit, cost, next state) of a row in ASCII order; a symbol is x (must go) or a role initial, a capital if truncated."""
    yield "D", 2, state
    yield "I", 5, NEXT[state]
    if symbol != "x":
        more, initial = (5, symbol.lower()) if symbol.isupper() or symbol == "_" else (0, symbol)
        if (state, initial) in KEEP:
            yield "K", more, KEEP[state, initial]
        yield "R", 1 + more, NEXT[state]


@lru_cache(maxsize=200_000)
def search(symbols, entry, ends, last):
    """(cost, edits, state at the end) of the cheapest edits of a row of symbols, of those the least in ASCII order.

    ``ends`` is what each state costs after the last row; only after the last piece of a conversation may turns be
    inserted behind its last row. The cost is INF where no edits lead to an end.
    """
    n, least = len(symbols), [min(ends), min(ends[SYSTEM:]), min(ends[USER:]), min(ends[USER:])]  # a state leads to these only
    hopeful = [0] * (n + 1)  # a faulty row costs 2 at least, deleted
    for i in range(n - 1, -1, -1):
        hopeful[i] = hopeful[i + 1] + (2 if symbols[i] in "xSUA_" else 0)
    lower, edits = {}, []

    def floor(i, state):
        return lower.get((i, state), hopeful[i] + least[state])

    def found(i, state, budget):
        """The state at the end, or None; then the table has a bound above the budget."""
        beyond = INF
        if i == n:
            if ends[state] <= budget:
                return state
            if not last:
                lower[i, state] = ends[state]
                return None
            steps = [("I", 5, NEXT[state])]
        else:
            steps = options(symbols[i], state)
        for edit, cost, after in steps:
            to = i if edit == "I" else i + 1
            if floor(to, after) <= budget - cost:
                edits.append(edit)
                end = found(to, after, budget - cost)
                if end is not None:
                    return end
                edits.pop()
            beyond = min(beyond, cost + floor(to, after))
        lower[i, state] = beyond
        return None

    bound = floor(0, entry)
    while bound < INF:
        end = found(0, entry, bound)
        if end is not None:
            return bound, "".join(edits), end
        bound = lower[0, entry]
    return INF, "", entry


@lru_cache(maxsize=50_000)
def matrix(symbols):
    """Cheapest cost of a piece from each state to each, row after row."""
    return tuple(search(symbols, a, tuple(0 if b == c else INF for c in range(4)), False)[0] for a in range(4) for b in range(4))


def before(costs, ends):
    """What each state costs ahead of a piece with this matrix, when ``ends`` is what they cost behind it."""
    return tuple(min(INF, *(costs[4 * a + b] + ends[b] for b in range(4))) for a in range(4))


def audit_of(symbols):
    """(cost, edits) of a whole conversation."""
    if len(symbols) <= PIECE:
        return search(symbols, START, COMPLETE, True)[:2]
    pieces, ends = [symbols[at:at + PIECE] for at in range(0, len(symbols), PIECE)], [TO_COMPLETE]
    for piece in reversed(pieces):
        ends.append(before(matrix(piece), ends[-1]))
    state, edits = START, []
    for piece, after in zip(pieces, reversed(ends[:-1])):
        last = len(edits) == len(pieces) - 1
        _, own, state = search(piece, state, COMPLETE if last else after, last)
        edits.append(own)
    return ends[-1][START], "".join(edits)


class Repair:
    """Applies edits to rows one by one; hands the repaired turns to ``emit(edit, role, text)``."""

    def __init__(self, emit):
        self.state, self.edits, self.at, self.emit = START, "", 0, emit

    def begin(self, edits):
        self.edits, self.at = edits, 0

    def inserts(self):
        while self.edits[self.at:self.at + 1] == "I":
            self.state = NEXT[self.state]
            self.emit("I", NAMES[self.state], "")
            self.at += 1

    def row(self, role, text):
        self.inserts()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEEP[self.state, role[:1]]
            self.emit("K", role, text)
        elif edit == "R":
            self.state = NEXT[self.state]
            self.emit("R", NAMES[self.state], text)


def initial_of(role):
    return role[:1] if role[:1] in ("s", "u", "a") else "-"


def fault_of(text):
    """b (blank), t (truncated) or a point."""
    shown = text.rstrip(SPACE)
    if not shown:
        return "b"
    return "." if shown[-1] in ".!?" else "t"


def symbol_of(initial, fault):
    if fault in "bd":
        return "x"
    return initial if fault == "." else "_" if initial == "-" else initial.upper()


def facts(turns, initials, faults):
    """What a run of rows tells about its conversation; runs are put together by ``joined``."""
    known = [t for t in turns if t is not None]
    return {"blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])), "first": initials[:1], "last": initials[-1:],
            "low": min(known, default=None), "high": max(known, default=None), "turns": len(set(known))}


def joined(a, b):
    """Facts of two runs, the one after the other; ``a`` may be None."""
    if a is None or not b["first"]:
        return a or b
    if not a["first"]:
        return b
    out = {n: a[n] + b[n] for n in ("blank", "duplicate", "truncated", "illegal", "turns")}
    out["illegal"] += a["last"] + b["first"] not in LEGAL
    out["turns"] -= a["high"] is not None and a["high"] == b["low"]
    both = lambda pick, n: pick((x[n] for x in (a, b) if x[n] is not None), default=None)
    return out | {"first": a["first"], "last": b["last"], "low": both(min, "low"), "high": both(max, "high")}


def gaps_of(found):
    """Missing turns between the first and the last, as a 64-bit number."""
    if found is None or found["low"] is None:
        return 0
    return (found["high"] - found["low"] + 1 - found["turns"] + (1 << 63)) % (1 << 64) - (1 << 63)


class Writer:
    """Rows of an output schema, as batches."""

    def __init__(self, schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, **row):
        self.rows.append(row)
        self.size += len(row.get("text") or "") + len(row.get("audit") or "") + 50

    def batches(self, least=4 << 20):
        if self.rows and self.size >= least:
            rows, self.rows, self.size = self.rows, [], 0
            yield batch_of(self.schema, {n: [r.get(n) for r in rows] for n in self.schema.names}, len(rows))


class Digest:
    """Takes repaired turns: their hash, and the turns themselves where they are asked for."""

    def __init__(self, writer, conv, with_turns):
        import hashlib

        self.hash, self.n, self.writer, self.conv, self.with_turns = hashlib.sha256(), 0, writer, conv, with_turns

    def __call__(self, edit, role, text):
        self.hash.update(f"{chr(10) if self.n else ''}{role}:{text}".encode())
        if self.with_turns:
            self.writer.add(conv=self.conv, kind="turn", seq=self.n, edit=edit, role=role, text=text)
        self.n += 1

    def report(self, found, cost, audit):
        counts = {n: (found or {}).get(n, 0) for n in COUNTS} | {"gaps": gaps_of(found), "cost": cost}
        self.writer.add(conv=self.conv, kind="report", audit=audit, repaired_sha256=self.hash.hexdigest(), **counts)


def rows_of(batches, names):
    for batch in batches:
        yield from zip(*[batch.column(n).to_pylist() for n in names])


def first_pass(batches, schema, with_turns):
    """Repairs the conversations inside a partition; hands on the rows of its first and its last one."""
    from pyspark import TaskContext

    part, out = TaskContext.get().partitionId(), Writer(schema)

    def edge(run, conv, rows, start):
        if not start:
            out.add(conv=conv, kind="head", part=part, run=run, seq=-1)
        for n, (turn, role, text) in enumerate(rows, start):
            out.add(conv=conv, kind="row", part=part, run=run, seq=n, turn=turn, role=role, text=text,
                    initial=initial_of(role), fault=fault_of(text))

    def whole(conv, rows):
        seen, faults = set(), []
        for _, role, text in rows:
            fault = fault_of(text)
            if fault != "b" and (role, text) in seen:
                fault = "d"
            seen.add((role, text))
            faults.append(fault)
        initials = [initial_of(r[1]) for r in rows]
        cost, audit = audit_of("".join(map(symbol_of, initials, faults)))
        digest = Digest(out, conv, with_turns)
        repair = Repair(digest)
        repair.begin(audit)
        for _, role, text in rows:
            repair.row(role, text)
        repair.inserts()
        found = facts([r[0] for r in rows], "".join(initials), "".join(faults)) if rows else None
        digest.report(found, cost, audit)

    run, now, rows, sent = -1, None, [], 0
    for conv, turn, role, text, copies in rows_of(batches, ("conv", "turn", "role", "text", "copies")):
        if run < 0 or conv != now:
            if run == 0:
                edge(0, now, rows, sent)
            elif run > 0:
                whole(now, rows)
            run, now, rows, sent = run + 1, conv, [], 0
        rows += [(turn, role, text)] * copies
        if run == 0 and len(rows) >= 5000:  # the first one is handed on as it comes
            edge(0, now, rows, sent)
            sent, rows = sent + len(rows), []
        yield from out.batches()
    if run >= 0:
        edge(min(run, 1), now, rows, sent)
    yield from out.batches(0)


def measured(batches, schema):
    """Symbols, facts and matrix of each piece."""
    for batch in batches:
        columns = {n: batch.column(n) for n in ("conv", "part", "run", "piece")}
        rows = [sorted(r, key=lambda x: x["seq"]) for r in batch.column("rows").to_pylist()]
        initials, faults = ["".join(x["initial"] for x in r) for r in rows], ["".join(x["fault"] for x in r) for r in rows]
        symbols = ["".join(map(symbol_of, i, f)) for i, f in zip(initials, faults)]
        found = [facts([x["turn"] for x in r], i, f) for r, i, f in zip(rows, initials, faults)]
        yield batch_of(schema, columns | {"symbols": symbols, "facts": found, "costs": [matrix(s) for s in symbols]}, len(rows))


def with_ends(batches, schema):
    """What each state costs behind each piece; the pieces of a conversation come from the last to the first."""
    now, ends, fresh = None, TO_COMPLETE, True
    for batch in batches:
        out = []
        for conv, costs in zip(batch.column("conv").to_pylist(), batch.column("costs").to_pylist()):
            last = fresh or conv != now
            now, fresh, ends = conv, False, TO_COMPLETE if last else ends
            out.append((last, COMPLETE if last else ends))
            ends = before(costs, ends)
        kept = {n: batch.column(n) for n in ("conv", "part", "run", "piece", "symbols", "facts")}
        yield batch_of(schema, kept | {"final": [o[0] for o in out], "ends": [list(o[1]) for o in out]}, len(out))


def searched(batches, schema):
    """The cheapest edits of each piece from each state."""
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("symbols", "ends", "final")]
        paths = [[search(s, state, tuple(e), final) for state in range(4)] for s, e, final in zip(*columns)]
        kept = {n: batch.column(n) for n in ("conv", "part", "run", "piece", "facts")}
        kept |= {"audits": [[p[1] for p in x] for x in paths], "costs": [[p[0] for p in x] for x in paths]}
        yield batch_of(schema, kept, len(paths))


def last_pass(batches, schema, with_turns):
    """Puts the pieces of each conversation together: a piece with its edits, then its rows."""
    out, now, begun = Writer(schema), None, False
    digest = repair = found = cost = None
    audits = []
    for conv, piece_audits, costs, fact, role, text in rows_of(batches, ("conv", "audits", "costs", "facts", "role", "text")):
        if not begun or conv != now:
            if begun:
                repair.inserts()
                digest.report(found, cost, "".join(audits))
            now, begun, found, cost, audits = conv, True, None, None, []
            digest = Digest(out, conv, with_turns)
            repair = Repair(digest)
        if piece_audits is not None:
            repair.inserts()
            cost = costs[START] if cost is None else cost
            repair.begin(piece_audits[repair.state])
            audits.append(piece_audits[repair.state])
            found = joined(found, fact)
        else:
            repair.row(role, text)
        yield from out.batches()
    if begun:
        repair.inserts()
        digest.report(found, cost, "".join(audits))
    yield from out.batches(0)


def _repaired(df, conv_col, turn_col, role_col, text_col, copies, with_turns):
    conv_type = df.schema[conv_col].dataType
    value = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    rows = df.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"), value(role_col).alias("role"),
                     value(text_col).alias("text"), (F.lit(1) if copies is None else F.coalesce(F.col(f"`{copies}`"), F.lit(1))).cast("int").alias("copies"))
    # the order of rows of one turn is that of their hash; equal rows lie side by side, in whatever partition
    keyed = rows.withColumn("hash", F.xxhash64("role", "text")).withColumn("row", F.monotonically_increasing_id())
    order = ["conv", "turn", "hash", "role", "text"]
    dealt = keyed.repartitionByRange("conv", "turn", "hash", "row").sortWithinPartitions(*order)
    result = [("conv", conv_type), ("kind", "string"), ("seq", "bigint"), *[(n, "bigint") for n in COUNTS], ("audit", "string"),
              ("repaired_sha256", "string"), ("edit", "string"), ("role", "string"), ("text", "string")]
    edge = [("part", "int"), ("run", "int"), ("turn", "bigint"), ("initial", "string"), ("fault", "string")]
    first = written(in_arrow(dealt, first_pass, result + edge, with_turns), "turns")
    inside = first.where("kind IN ('report', 'turn')").select(*[n for n, _ in result])
    edges = first.where("kind IN ('head', 'row')").withColumn("piece", F.floor(F.col("seq") / PIECE))

    place = F.struct("part", "run", "seq")
    firsts = edges.where("kind = 'row'").groupBy("conv", "role", "text").agg(F.min(place).alias("p")).select(
        "p.*", F.lit(True).alias("new"))
    fault = F.when((F.col("fault") != "b") & F.col("new").isNull(), "d").otherwise(F.col("fault"))
    marked = edges.drop("text", "role").join(firsts, ["part", "run", "seq"], "left")
    row = F.struct("seq", "turn", "initial", fault.alias("fault"))
    pieces = marked.groupBy("part", "run", "piece").agg(  # PIECE rows at most; the head of a run is a piece without rows
        F.first("conv").alias("conv"), F.collect_list(F.when(F.col("kind") == "row", row)).alias("rows"))
    at = [("conv", conv_type), ("part", "int"), ("run", "int"), ("piece", "bigint")]
    told = ("struct<blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,first:string,last:string,low:bigint,high:bigint,"
            "turns:bigint>")
    sized = in_arrow(pieces, measured, [*at, ("symbols", "string"), ("facts", told), ("costs", "array<bigint>")])
    back = sized.repartition("conv").sortWithinPartitions("conv", F.desc("part"), F.desc("run"), F.desc("piece"))
    ended = in_arrow(back, with_ends, [*at, ("symbols", "string"), ("facts", told), ("final", "boolean"), ("ends", "array<bigint>")])
    solved = in_arrow(ended.repartition("part", "run", "piece"), searched,
                      [*at, ("facts", told), ("audits", "array<string>"), ("costs", "array<bigint>")])
    lines = solved.withColumns({"seq": F.lit(-2).cast("bigint"), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string")})
    texts = edges.where("kind = 'row'").select(*[n for n, _ in at], "seq", "role", "text")
    together = lines.unionByName(texts, allowMissingColumns=True).repartition("conv").sortWithinPartitions(
        "conv", "part", "run", "piece", "seq")
    return inside.unionByName(in_arrow(together, last_pass, result, with_turns))


def repair(df: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text", copies=None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: one row per conversation.

    Rows go by turn, nulls first; those of one turn in the fixed order of a hash of role and text, so equal rows side by
    side. A null role or text is one space; turns are whole numbers. A null conv_id is a conversation of its own. ``copies``
    names a column that says how often a row counts; a conversation with no row left has zeros, an empty audit and the hash
    of an empty text. Repeated rows are duplicates. Roles that begin with none of s, u, a fit nowhere and must be changed or go.
    Other columns of ``df`` are not read. An empty table gives no rows.
    """
    rows = _repaired(df, conv_col, turn_col, role_col, text_col, copies, False).where("kind = 'report'")
    return rows.select(F.col("conv").alias("conv_id"), *COUNTS, "audit", "repaired_sha256")


def repaired_turns(df: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text", copies=None) -> DataFrame:
    """conv_id, position, edit (I, K or R), role, text: the turns of the repaired conversations. As ``repair`` otherwise."""
    rows = _repaired(df, conv_col, turn_col, role_col, text_col, copies, True).where("kind = 'turn'")
    return rows.select(F.col("conv").alias("conv_id"), F.col("seq").alias("position"), "edit", "role", "text")


def damaged(df: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """conv_id, turn, role, text, copies: rows with the faults that crc32(``conv_id:turn``) % 20 asks for.

    0 drops a row (copies 0), 1 empties its text, 2 removes ``.!?`` from it, 3 repeats it (copies 2), 4 makes it a user's.
    Nulls are one space, in the checksum as well; conv_id and turn stay null.
    """
    value = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(value(conv_col), F.lit(":"), value(turn_col)).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(value(text_col), "[.!?]", "")).otherwise(value(text_col))
    return df.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                     F.when(fate == 4, "user").otherwise(value(role_col)).alias("role"), text.alias("text"),
                     F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"))
