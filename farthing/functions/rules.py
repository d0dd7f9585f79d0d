"""Rule tables turned into Catalyst expressions.

A rule table is a plain ordered Python list, so it is compiled once on the
driver into one expression that runs inside whole-stage code generation; no
row ever reaches Python.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce
from itertools import accumulate, groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Spec = tuple[str, str]  # ("sub" | "re", pattern)


def required_literal(pattern: str) -> str:
    """Longest literal every match of the regex must contain, or ''.

    Groups, classes, escapes and optional characters are taken out; what is
    left between them is literal. A top-level alternative has none.
    """
    bare = re.sub(r"\\[.]", "\0", pattern)  # an escaped dot, kept apart
    bare = re.sub(r"\\.(?:[*+?]|\{[^}]*\})?", "\n", bare)
    bare = re.sub(r"\[[^\]]*\](?:[*+?]|\{[^}]*\})?", "\n", bare)
    while "(" in bare:
        shrunk = re.sub(r"\([^()]*\)(?:[*+?]|\{[^}]*\})?", "\n", bare)
        if shrunk == bare:
            return ""
        bare = shrunk
    if "|" in bare:
        return ""
    bare = re.sub(r".(?:[*?]|\{[^}]*\})", "\n", bare)
    runs = re.split(r"[\n+.^$]", bare)
    return max((r.replace("\0", ".") for r in runs), key=len)


def _steps(pattern: str) -> list[tuple[str, int]]:
    """Escapes, classes and single characters of a regex, each with the open groups after it."""
    steps = re.findall(r"\\.|\[\^?\]?(?:\\.|[^\]\\])*\]|.", pattern, re.S)
    return list(zip(steps, accumulate((s == "(") - (s == ")") for s in steps), strict=True))


def required_literals(pattern: str) -> list[str]:
    """Literals one of which every match of the regex must contain, or [].

    An alternative counts with the literals of all its branches, a lookahead at
    the start with those of what it looks for.
    """
    literal = required_literal(pattern)
    if literal:
        return [literal]
    steps = _steps(pattern)
    parts = ["".join(s for s, _ in run) for bar, run in groupby(steps, key=lambda s: s == ("|", 0)) if not bar]
    if ("|", 0) in steps:
        each = [required_literals(p) for p in parts]
        return list(dict.fromkeys(sum(each, []))) if len(parts) == steps.count(("|", 0)) + 1 and all(each) else []
    if pattern.startswith(("(?=", "(?:")) and (")", 0) in steps:
        end = steps.index((")", 0))
        rest = [s for s, _ in steps[end + 1 :]]
        if not rest or (pattern[2] == "=" and rest[0] not in "*?{"):
            return required_literals("".join(s for s, _ in steps[3:end]))
    return []


#: What ``letters`` tells of a text, a bit each: letters that many texts lack.
LETTERS = "bcdfghjkmpquvwxyz&"


def letters(text: Column) -> Column:
    """Which of ``LETTERS`` a text has, as one number for a column of its own.

    A cascade tests that number before it looks for a word in the text.
    """
    raw = text.cast("binary")
    bits = [F.when(F.contains(raw, F.lit(bytearray(c, "ascii"))), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, c in enumerate(LETTERS)]
    return F.when(text.isNotNull(), reduce(Column.bitwiseOR, bits))


def shows(text: Column, word: str, has: Column | None = None) -> Column:
    """Substring test; of the two that Spark has, the one over bytes takes half the time. ``has`` is ``letters`` of the text."""
    test = F.contains(text.cast("binary"), F.lit(bytearray(word, "utf-8")))
    needs = sum(1 << LETTERS.index(c) for c in set(word) if c in LETTERS)
    if has is None or not needs:
        return test
    return (has.bitwiseAND(F.lit(needs)) == F.lit(needs)) & test


def _any(tests: Sequence[Column]) -> Column:
    hit = tests[0]
    for test in tests[1:]:
        hit = hit | test
    return hit


def regex_hit(text: Column, pattern: str, has: Column | None = None) -> Column:
    """Regex test behind a substring test for the literals it needs.

    The substring test is many times cheaper, so a long cascade runs few
    regexes per row.
    """
    test = text.rlike("(?U)" + pattern)
    literals = required_literals(pattern)
    return _any([shows(text, w, has) for w in literals]) & test if literals else test


def spec_hit(text: Column, specs: Sequence[Spec], has: Column | None = None) -> Column:
    """True when any spec of the set occurs in ``text``.

    A substring that contains another of the set adds nothing, nor does a regex whose literal contains one. What is left
    stands behind one test for the shortest literal that several specs share. ``has`` is ``letters`` of the text, if at hand.
    """
    words = list(dict.fromkeys(p for kind, p in specs if kind == "sub"))
    words = [w for w in words if not any(v in w for v in words if v != w)]
    wanted: dict[str, list[Column]] = {w: [] for w in words}
    tests = []
    for pattern in dict.fromkeys(p for kind, p in specs if kind == "re"):
        literals = required_literals(pattern)
        if literals and all(any(w in literal for w in words) for literal in literals):
            continue
        if len(literals) == 1:
            wanted.setdefault(literals[0], []).append(text.rlike("(?U)" + pattern))
        else:
            tests.append(regex_hit(text, pattern, has))
    shared: dict[str, list[Column]] = {}
    for literal, regexes in wanted.items():
        guard = min((w for w in wanted if w in literal), key=len)
        own = shared.setdefault(guard, [])
        if literal == guard:
            own += regexes
        else:
            own.append(shows(text, literal, has) & _any(regexes) if regexes else shows(text, literal, has))
    found = [shows(text, w, has) if w in words else shows(text, w, has) & _any(own) for w, own in shared.items()]
    return _any(found + tests)


def settle(df: DataFrame, columns: dict[str, Column], apart: bool = False) -> DataFrame:
    """Add expensive columns that are computed exactly once per row.

    A later filter on a plain projected column is pushed below it by copying
    its expression; for a cascade of a hundred tests that multiplies both
    planning and run time. A one-row generator is not copied.

    ``apart`` is for long cascades: they become a projection of their own, which a
    higher-order function keeps out of whole-stage code. That code puts a
    projection into one method, and the JVM never compiles a method of over 8000 bytes; outside it Spark
    cuts long expressions into methods that are compiled.
    """
    rest = [c for c in df.columns if c not in columns]
    if apart:
        made = {name: f"_settled_{i}" for i, name in enumerate(columns)}
        mark = F.exists(F.array(F.col(f"`{df.columns[0]}`").isNull()), lambda missing: missing)
        values = [value.alias(made[name]) for name, value in columns.items()]
        df = df.select(*[F.col(f"`{c}`") for c in rest], *values, mark.alias("_apart"))
        one = F.array(F.struct(*[F.col(at).alias(name) for name, at in made.items()], "_apart"))
        return df.select(*[F.col(f"`{c}`") for c in rest], F.inline(one)).drop("_apart")
    one = F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))
    return df.select(*[F.col(f"`{c}`") for c in rest], F.inline(one))


def cascade(text: Column, rules: Iterable[tuple[str, Sequence[Spec]]], has: Column | None = None) -> Column:
    """Value of the first rule with a hit, NULL when none hits.

    ``rules`` is ordered (value, specs). Neighbours with one value are merged:
    the first hit among them yields that value either way.
    """
    chain = None
    for value, run in groupby(rules, key=lambda rule: rule[0]):
        specs = [spec for _, group in run for spec in group]
        test = spec_hit(text, specs, has)
        chain = F.when(test, F.lit(value)) if chain is None else chain.when(test, F.lit(value))
    return chain if chain is not None else F.lit(None).cast("string")


def ordered_regex(text: Column, rules: Iterable[tuple[str, str]], has: Column | None = None) -> Column:
    """Cascade over (regex, value) pairs."""
    return cascade(text, [(value, [("re", pattern)]) for pattern, value in rules], has)


def ordered_words(text: Column, rules: Iterable[tuple[str, str]], has: Column | None = None) -> Column:
    """Cascade over (substring, value) pairs."""
    return cascade(text, [(value, [("sub", word)]) for word, value in rules], has)


def longest_first(aliases: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """Longest needle first; equal lengths keep table order (stable sort)."""
    return sorted(aliases, key=lambda pair: -len(pair[0]))


def any_word(text: Column, words: Sequence[str], has: Column | None = None) -> Column:
    return spec_hit(text, [("sub", w) for w in words], has)


def lookup(key: Column, table: dict) -> Column:
    """Exact-key lookup in a small literal map, NULL when absent."""
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), key)
