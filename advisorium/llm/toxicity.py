"""Toxicity of texts: a lexicon in a trie, met by Levenshtein automata, with context windows around each hit.

The lexicon is mined from a bounded sample of labelled rows: whole words, and stems (``term*``, the beginning
of longer words), each with its log odds between toxic and clean tokens. A word hits a term when it equals it,
begins with it (stems), or when its Levenshtein automaton accepts it: the automaton of the word is run down the
trie, so only terms within the allowed distance are reached. Misspellings that are common in clean rows are
left out. Each hit is weighed by its surroundings: inside quotation marks it counts as quoted, and other hits
and second-person words near it make it direct abuse. A logistic regression over these sums gives the score.
"""

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisorium.llm.shared import batch_of, in_arrow, packed, row_type, unpacked, written

TOKEN = re.compile(r"[^\W_]+")
MARK = re.compile("[\"“”«»„]")
CLOSING = {"\"": "\"", "“": "”", "«": "»", "„": "“”"}
#: Forms of address in the languages of the corpus.
SECOND_PERSON = frozenset("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch "
                          "usted ustedes tus vosotros".split())
WINDOW = 12
SHORTEST_STEM, LONGEST_STEM = 4, 8
SHORTEST_FUZZY, STRONG = 5, 3.0  # misspellings are looked for of words this long whose log odds are this high
KNOWN = 400_000
RESULTS = ("held_out", "score", "predicted")


class Lexicon:
    """Terms in a trie; ``terms`` maps a term (a stem ends in *) to its weight."""

    def __init__(self, terms, exceptions=()):
        self.terms, self.exceptions = dict(terms), frozenset(exceptions)
        self.stems = {t[:-1] for t in terms if t.endswith("*")}
        self.lengths = sorted({len(s) for s in self.stems}, reverse=True)
        self.trie, self.heads, self.tails = {}, {}, {}
        for term in (t for t, weight in self.terms.items() if not t.endswith("*") and len(t) >= SHORTEST_FUZZY and weight >= STRONG):
            node = self.trie
            for letter in term:
                node = node.setdefault(letter, {})
            node[""] = term
            # one edit leaves one half as it is, at its end of the word, and changes the length by one at most
            near = {len(term) - 1, len(term), len(term) + 1}
            self.heads.setdefault(term[:len(term) // 2], set()).update(near)
            self.tails.setdefault(term[len(term) // 2:], set()).update(near)
        self.head_lengths, self.tail_lengths = ({len(x) for x in xs} for xs in (self.heads, self.tails))

    def near(self, word, edits=1):
        """(edits, term) of the terms that the Levenshtein automaton of ``word`` accepts on its way down the trie.

        State e of the automaton is a bit mask: bit i is set where i letters of the word are read with e edits.
        """
        masks, final = {}, 1 << len(word)
        for i, letter in enumerate(word):
            masks[letter] = masks.get(letter, 0) | 1 << i
        start = [1]
        for _ in range(edits):
            start.append(start[-1] | start[-1] << 1)
        found, todo = [], [(self.trie, start)]
        while todo:
            node, states = todo.pop()
            for letter, child in node.items():
                if letter == "":
                    found += [(e, child) for e, s in enumerate(states) if s & final][:1]
                    continue
                mask, after, lower, lower_after = masks.get(letter, 0), [], 0, 0
                for s in states:
                    # read the letter; or insert, substitute it, or skip a letter of the word, one edit more
                    s_after = (s & mask) << 1 | lower | lower << 1 | lower_after << 1
                    after.append(s_after & (2 * final - 1))
                    lower, lower_after = s, s_after
                if any(after):
                    todo.append((child, after))
        return found

    def match(self, word):
        """(term, edits) of a word in lower case, or None."""
        if word in self.terms:
            return word, 0
        for n in self.lengths:
            if word[:n] in self.stems:
                return f"{word[:n]}*", 0
        if len(word) < SHORTEST_FUZZY - 1 or word in self.exceptions:
            return None
        size = len(word)
        if not (any(size in self.heads.get(word[:n], ()) for n in self.head_lengths)
                or any(size in self.tails.get(word[-n:], ()) for n in self.tail_lengths)):
            return None
        found = self.near(word)
        return min(((term, e) for e, term in found), key=lambda x: (x[1], -self.terms[x[0]], x[0]), default=None)


class Reader:
    """Hits of texts, with what is known of words remembered up to a bound."""

    def __init__(self, lexicon):
        self.lexicon, self.known, self.hot = lexicon, set(), {}

    def hits(self, text):
        """(tokens, [(place, term, edits)])"""
        tokens = TOKEN.findall(text.lower())
        new = set(tokens) - self.known
        if new:
            if len(self.known) > KNOWN:
                self.known, self.hot = set(), {}
                new = set(tokens)
            self.known |= new
            for word in new:
                if found := self.lexicon.match(word):
                    self.hot[word] = found
        hot = self.hot
        return tokens, [(i, *hot[t]) for i, t in enumerate(tokens) if t in hot]


def quotations(text):
    """(start, end) of the quotations of a text, of whatever length; a mark that is never closed quotes nothing."""
    marks, spans, never, i = [(m.start(), m[0]) for m in MARK.finditer(text)], [], set(), 0
    while i < len(marks):
        start, mark = marks[i]
        if mark in CLOSING and mark not in never:
            end = next((j for j in range(i + 1, len(marks)) if marks[j][1] in CLOSING[mark]), None)
            if end is not None:
                spans.append((start, marks[end][0] + 1))
                i = end
            else:
                never.add(mark)
        i += 1
    return spans


def quoted_places(text):
    """Numbers of the tokens inside quotation marks."""
    lower, inside = text.lower(), set()
    spans = quotations(lower)
    at = 0
    for i, token in enumerate(TOKEN.finditer(lower)):
        while at < len(spans) and spans[at][1] <= token.start():
            at += 1
        if at == len(spans):
            break
        if token.start() >= spans[at][0]:
            inside.add(i)
    return inside


def described(text, reader):
    """The features of a text: what its hits add up to, directly and quoted, and in its worst window."""
    tokens, hits = reader.hits(text)
    if not hits:
        return [0.0] * 9  # one score for all texts without a hit, of whatever length
    quoted, terms = quoted_places(text), reader.lexicon.terms
    direct = cited = fuzzy = worst = addressed = 0.0
    window, total = [], 0.0
    for place, term, edits in hits:
        weight = terms[term] * (0.6 if edits else 1.0)
        if place in quoted:
            cited += weight
            continue
        if edits:
            fuzzy += weight
        direct += weight
        near = tokens[max(0, place - WINDOW):place + WINDOW + 1]
        addressed += weight * any(t in SECOND_PERSON for t in near)
        window.append((place, weight))
        total += weight
        while window[0][0] < place - 2 * WINDOW:
            total -= window.pop(0)[1]
        worst = max(worst, total)
    n = max(len(tokens), 1)
    direct_hits = sum(p not in quoted for p, _, _ in hits)
    return [math.log1p(direct), math.log1p(cited), math.log1p(worst), 10 * min(1.0, direct / n), math.log1p(direct_hits),
            math.log1p(len({t for _, t, _ in hits})), math.log1p(addressed), math.log1p(fuzzy), math.log1p(len(tokens)) / 5]


def terms_of(text):
    """Every whole word and stem of a text, each as often as it stands there."""
    for token in TOKEN.findall(text.lower()):
        if len(token) >= 3:
            yield token
        for n in range(SHORTEST_STEM, min(LONGEST_STEM, len(token) - 1) + 1):
            yield f"{token[:n]}*"


def counted(batches, schema):
    """(term, tokens in toxic and clean rows, toxic and clean rows with it) of a partition of the sample."""
    counts, rows = {}, [0, 0]
    for batch in batches:
        for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text")):
            own = {}
            for term in terms_of(text.as_py()):
                own[term] = own.get(term, 0) + 1
            rows[toxic] += 1
            for term, n in own.items():
                value = counts.setdefault(term, [0, 0, 0, 0])
                value[1 - toxic] += n
                value[3 - toxic] += 1
    items = [*counts.items(), ("", [0, 0, *rows[::-1]])]  # the empty term has the number of rows
    for at in range(0, len(items), 20_000):
        part = items[at:at + 20_000]
        columns = [[t for t, _ in part], *zip(*[v for _, v in part])]
        yield batch_of(schema, dict(zip(schema.names, columns)), len(part))


def training_rows(docs, labels, id_col, text_col, sample):
    """(toxic, text) of at most ``sample`` labelled rows outside the held-out quarter, chosen by a hash of the id."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("key")).agg(
        F.max("toxic").cast("int").alias("toxic"))
    chosen = known.where(~held_out(F.col("key"))).orderBy(F.xxhash64("key"), "key").limit(sample)
    # at most ``sample`` rows of two numbers: small enough to broadcast
    return docs.select(F.col(f"`{id_col}`").alias("key"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).join(
        F.broadcast(chosen), "key").select("toxic", "text")


def held_out(key):
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def mined(rows, size, support):
    """The lexicon {term: log odds} of the training rows: the ``size`` most telling terms, none the stem of another.

    A word is taken before a stem that tells about as much: only words have near misspellings.
    """
    fields = [("term", "string"), ("toxic_tokens", "bigint"), ("clean_tokens", "bigint"), ("toxic_rows", "bigint"), ("clean_rows", "bigint")]
    sums = in_arrow(rows, counted, fields).groupBy("term").agg(*[F.sum(n).alias(n) for n, _ in fields[1:]])
    sums = sums.where((F.col("toxic_rows") >= support) | (F.col("term") == ""))
    totals = sums.where("term = ''").first()
    if totals is None or not totals["toxic_rows"] or not totals["clean_rows"]:
        return {}
    toxic, clean = totals["toxic_rows"], totals["clean_rows"]
    share = (F.col("toxic_rows") + 0.5) / (toxic + 1), (F.col("clean_rows") + 0.5) / (clean + 1)
    rate = (F.col("toxic_tokens") + 0.5) / toxic, (F.col("clean_tokens") + 0.5) / clean
    weight = F.log(rate[0] / rate[1])
    gain = (share[0] - share[1]) / F.sqrt(share[0] * (1 - share[0]) / toxic + share[1] * (1 - share[1]) / clean)
    best = (sums.where("term <> ''").withColumns({"weight": weight, "gain": gain * F.when(F.col("term").endswith("*"), 1.0).otherwise(1.1)}).where("weight > 1.8 AND gain > 4")
            .orderBy(F.desc("gain"), F.length("term").desc(), "term").limit(20 * size).collect())
    terms = {}
    for row in best:
        word = row["term"].rstrip("*")
        if len(terms) == size:
            break
        if any(word.startswith(t.rstrip("*")) or t.startswith(word) for t in terms):
            continue
        terms[row["term"]] = round(row["weight"], 6)
    return terms


def misleading(batches, schema, terms):
    """Words of clean rows that are near a term without being one."""
    lexicon = Lexicon(terms)
    for batch in batches:
        seen = {}
        for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text")):
            if not toxic:
                for word in set(TOKEN.findall(text.as_py().lower())):
                    seen[word] = seen.get(word, 0) + 1
        rows = [(w, n) for w, n in seen.items() if (found := lexicon.match(w)) and found[1]]
        if rows:
            yield batch_of(schema, dict(zip(("word", "n"), zip(*rows))), len(rows))


def described_rows(batches, schema, lexicon):
    reader = Reader(lexicon)
    for batch in batches:
        rows = [described(t.as_py(), reader) for t in batch.column("text")]
        yield batch_of(schema, {"toxic": batch.column("toxic"), "features": rows}, len(rows))


def fitted(features, labels, penalty=1.0, rounds=30):
    """Logistic regression by Newton steps: (means, scales, weights, intercept last)."""
    import numpy as np

    x, y = np.array(features, float), np.array(labels, float)
    means, scales = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    x = np.hstack([(x - means) / scales, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.diag([penalty] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if abs(step).max() < 1e-8:
            break
    return means.tolist(), scales.tolist(), w.tolist()


def train(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", sample=8_000, size=400, support=8):
    """A model (lexicon, regression) from at most ``sample`` labelled rows; None where one of the labels has no rows.

    The driver holds at most ``20 * size`` candidate terms and nine numbers per sampled row.
    """
    rows = written(training_rows(docs, labels, id_col, text_col, sample), "sample")
    terms = mined(rows, size, support)
    if not terms:
        return None
    near = in_arrow(rows, misleading, [("word", "string"), ("n", "bigint")], terms).groupBy("word").agg(F.sum("n").alias("n"))
    exceptions = [r["word"] for r in near.where("n >= 2").orderBy(F.desc("n"), "word").limit(20 * size).collect()]
    lexicon = Lexicon(terms, exceptions)
    found = in_arrow(rows, described_rows, [("toxic", "int"), ("features", "array<double>")], lexicon).collect()
    if len({r["toxic"] for r in found}) < 2:
        return None
    ordered = sorted((r["features"], r["toxic"]) for r in found)
    return lexicon, fitted(*zip(*ordered))


def scored(batches, schema, model):
    lexicon, (means, scales, weights) = model
    reader = Reader(lexicon)
    for batch in batches:
        scores = []
        for text in batch.column("text"):
            z = weights[-1]
            for value, mean, scale, weight in zip(described(text.as_py(), reader), means, scales, weights):
                z += weight * (value - mean) / scale
            scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        yield batch_of(schema, {"row": batch.column("row"), "key": batch.column("key"), "score": scores}, len(scores))


def score(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", carry=None, threshold=0.3, model=None,
          **options) -> DataFrame:
    """The rows of ``docs`` with held_out, score and predicted.

    A null text is an empty one; texts without a hit get the score of such texts. Without rows of both labels
    every score is 0. Repeated rows are scored each on its own; an empty table gives no rows; columns named like
    a result are replaced. ``options`` go to ``train``.
    """
    carry = [c for c in (docs.columns if carry is None else carry) if c not in RESULTS]
    model = model or train(docs, labels, id_col, text_col, **options)
    source = docs.select(packed(docs, carry), F.col(f"`{id_col}`").alias("key"),
                         F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    if model is None:
        found = source.select("row", "key", F.lit(0.0).alias("score"))
    else:
        fields = [("row", row_type(docs, carry)), ("key", docs.schema[id_col].dataType), ("score", "double")]
        found = in_arrow(source, scored, fields, model)
    return unpacked(found, carry, {"held_out": held_out(F.col("key")), "score": F.col("score"),
                                   "predicted": (F.col("score") >= threshold).cast("int")})


def clean(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their columns."""
    carried = docs.select(*[F.col(f"`{c}`").alias(f"in_{c}") for c in docs.columns])
    rows = score(carried, labels, id_col="in_doc_id", text_col="in_text", **options).where("predicted = 0")
    return rows.select(*[F.col(f"`in_{c}`").alias(c) for c in docs.columns])
