"""Compiles ordered rule tables into single-pass column expressions.

A rule table is plain data. Keyword tables become one CASE expression inside code generation. For tables of
patterns an automaton first passes once over each text, in Arrow batches, and finds the literals that the patterns
imply; a regular expression then runs only on the rows that hold its literal. No join, no shuffle.
"""

import re
import sys
from typing import NamedTuple

from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

# The workers need these helpers but may not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class PatternRule(NamedTuple):
    """Assigns ``target`` when any of the regular expressions is found."""

    target: str
    patterns: tuple


class Outcome(NamedTuple):
    """Yields ``text`` in a scope when any keyword occurs (no keywords: always)."""

    scope: str
    keywords: tuple
    text: str


def needed_text(pattern: str):
    """A text every match of the pattern contains, or None when that is not obvious."""
    plain = re.sub(r"\(\?!.*?\)", "", pattern)
    if re.search(r"[|()]", plain):
        return None
    plain = re.sub(r"\[[^\]]*\]|\\.", "\n", plain)
    plain = re.sub(r".[?*{][^}\n]*}?" if "{" in plain else r".[?*]", "\n", plain)
    runs = re.findall(r"[a-z0-9 -]+", re.sub(r"[.+^$]", "\n", plain))
    return max(runs, key=len, default=None)


class Literal(NamedTuple):
    """A text that a pattern implies, and whether a word must begin or end where it does."""

    text: str
    begins: bool
    ends: bool


def literal_of(pattern: str):
    """The literal of a pattern, or None when that is not obvious."""
    needed = needed_text(pattern)
    if needed is None:
        return None
    return Literal(needed, pattern.startswith(r"\b" + needed), pattern.endswith(needed + r"\b"))


def occurring(text: Column, literals) -> Column:
    """The numbers of the literals that occur in a text, by one pass of an automaton.

    Where a word must begin or end, an occurrence next to a letter a-z, a digit or ``_`` does not count; whether other
    neighbours are part of a word is left to the pattern.
    """
    literals, made = list(literals), []

    def find(texts):
        import ahocorasick
        import pyarrow as pa

        if not made:
            automaton, by_text = ahocorasick.Automaton(), {}
            for n, literal in enumerate(literals):
                by_text.setdefault(literal.text, []).append((n, literal.begins, literal.ends))
            for word, which in by_text.items():
                automaton.add_word(word, (len(word), which))
            automaton.make_automaton()
            made.append((automaton, frozenset("abcdefghijklmnopqrstuvwxyz0123456789_")))
        automaton, inside = made[0]
        out = []
        for value in texts.to_pylist():
            found = set()
            for end, (size, which) in automaton.iter(value) if value else ():
                start = end - size
                for n, begins, ends in which:
                    if n not in found and not (begins and start >= 0 and value[start] in inside) and not (
                            ends and end + 1 < len(value) and value[end + 1] in inside):
                        found.add(n)
            out.append(sorted(found))
        return pa.array(out, pa.list_(pa.int32()))

    return F.arrow_udf(find, "array<int>")(text)


def found_any(text: Column, patterns, held: Column, numbers) -> Column:
    """True when any pattern is found in a lower-case text, with Unicode word boundaries.

    ``held`` has the numbers of the literals that occur in the text, ``numbers`` the number of each literal; patterns
    without a literal always run.
    """
    found = None
    for pattern in patterns:
        hit, literal = text.rlike("(?iUd)" + pattern), literal_of(pattern)
        if literal:
            hit = F.array_contains(held, numbers[literal]) & hit
        found = hit if found is None else found | hit
    return found


def contains_any(text: Column, words) -> Column:
    """True when any word occurs as a plain substring."""
    hit = text.contains(words[0])
    for word in words[1:]:
        hit = hit | text.contains(word)
    return hit


def literals_of(rules, keep=()):
    """The different literals of rules and ``keep`` patterns, numbered from 0."""
    patterns = [p for r in rules for p in r.patterns] + list(keep)
    return {literal: n for n, literal in enumerate(dict.fromkeys(filter(None, map(literal_of, patterns))))}


def first_matching(text: Column, held: Column, rules, keep=()) -> Column:
    """Target of the first rule that matches; null when none does or a ``keep`` pattern is found.

    ``held`` is ``occurring(text, literals_of(rules, keep))``.
    """
    numbers = literals_of(rules, keep)
    chosen = F.coalesce(*[F.when(found_any(text, r.patterns, held, numbers), F.lit(r.target)) for r in rules])
    if not keep:
        return chosen
    return F.when(~found_any(text, keep, held, numbers), chosen)


def first_outcome(outcomes, text: Column, scopes: dict, default: Column) -> Column:
    """Text of the first outcome whose scope holds and whose keywords occur, else ``default``."""
    decision = None
    for outcome in outcomes:
        applies = scopes[outcome.scope]
        if outcome.keywords:
            applies = applies & contains_any(text, outcome.keywords)
        if decision is None:
            decision = F.when(applies, F.lit(outcome.text))
        else:
            decision = decision.when(applies, F.lit(outcome.text))
    return decision.otherwise(default)
