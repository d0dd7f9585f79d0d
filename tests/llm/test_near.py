"""Near-duplicates, components and passages against plain versions."""

from collections import defaultdict

import numpy as np
import pytest

from farthing.llm.components import components
from farthing.llm.minhash import Banding, near_duplicates, signatures
from farthing.llm.passages import repeated_passages


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain_components(links, nodes=()):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in [*up, *nodes]}


def plain_near(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    links = [
        (i, j) for k, (i, s) in enumerate(sets) for j, o in sets[:k]
        if s and o and i != j and 100 * len(s & o) >= 85 * len(s | o)
    ]
    return plain_components(links, [i for i, _ in sets])


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (170, 2))] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, k) for k in range(5001, 5100)]
    got = {r.node: r.component for r in components(spark.createDataFrame([*links, (7, 7), (None, 3)], "x bigint, y bigint")).collect()}
    want = {k: v for k, v in plain_components(links).items()}
    assert got == {k: v for k, v in want.items() if k in got} and all(v == k for k, v in want.items() if k not in got)
    assert components(spark.createDataFrame([], "x bigint, y bigint")).count() == 0


def test_circular_shift():
    """Coordinate k + 1 of a set is coordinate k of the set moved by one place."""
    codes = np.array([5, 9, 77], np.uint64)
    assert signatures(codes, np.array([0, 3]), 64).shape == (1, 64)
    same = signatures(np.concatenate([codes, codes]), np.array([0, 3, 3, 6]), 32)
    assert (same[0] == same[2]).all() and (same[1] == 0xFFFFFFFF).all()


def edited(rng, words, n):
    out = list(words)
    for k in rng.choice(len(out), n, replace=False):
        out[k] = f"new{rng.integers(10**6)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def families(spark):
    """Groups around the threshold: a base with light and heavy edits, chains, exact copies."""
    rng = np.random.default_rng(11)
    rows, n = [], 0
    for family in range(4):
        base = [f"w{rng.integers(10**5)}" for _ in range(120)]
        for k in range(60):
            rows.append((n, edited(rng, base, int(rng.integers(0, 6)))))
            n += 1
        step = list(base)
        for k in range(20):  # each is near the one before, the ends are far apart
            step = edited(rng, step, 1).split()
            rows.append((n, " ".join(step)))
            n += 1
        rows += [(n + k, " ".join(base).upper()) for k in range(5)]
        n += 5
    return rows


def test_families(spark, families):
    got = near_duplicates(spark.createDataFrame(families, "doc_id bigint, text string"))
    want = plain_near(families)
    assert {r.doc_id: r.component_id for r in got.collect()} == want


def test_groups_below_the_threshold_stay_apart(spark):
    """A large group that collides in bands without being alike takes the block path."""
    rng = np.random.default_rng(5)
    base = [f"v{k}" for k in range(400)]
    rows = [(k, edited(rng, base, 9)) for k in range(150)]
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == plain_near(rows)


def test_special_cases(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = near_duplicates(odd_docs).collect()
    assert len(got) == len(rows)
    want = plain_near(rows)
    for r in got:
        assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(shingles(t)) for i, t in rows}
    assert near_duplicates(no_docs).count() == 0
    lost = near_duplicates(spark.createDataFrame([(None, "a b c"), (None, "a b c"), (1, "a b c")], "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or -1, r.kept) for r in lost) == [(-1, True), (-1, True), (1, True)]


def test_recall_of_the_bands():
    b = Banding()
    assert (1 - 0.85**b.rows) ** b.bands < 1e-7


def shared_runs(rows, size):
    held = defaultdict(set)
    for i, t in rows:
        w = (t or "").encode().lower().split()
        for k in range(len(w) - size + 1):
            held[tuple(w[k : k + size])].add(i)
    return {i for ids in held.values() if len(ids) > 1 for i in ids}


def test_passages(spark, docs, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    passage = "Alpha beta gamma delta one two. " * 3 + "Some other words stand here, and then a few more come. Yes. " * 4
    extra = [(10**6, f"Before it goes this sentence. {passage}After it comes another."), (10**6 + 1, f"Line.\n{passage}\nLast line."), (10**6 + 2, "Quite short.")]
    found = repeated_passages(spark.createDataFrame([*rows, *extra], "doc_id bigint, text string")).collect()
    ids = {r.doc_id for r in found}
    assert {10**6, 10**6 + 1} <= ids and 10**6 + 2 not in ids
    assert shared_runs(rows, 75) <= ids
    assert all(r.removed == (r.first_doc < r.doc_id) for r in found)
    assert ids - {10**6, 10**6 + 1} <= shared_runs(rows, 12)
    assert repeated_passages(no_docs).count() == 0
    assert repeated_passages(odd_docs).count() == 0


def ranges_of(found):
    held = defaultdict(list)
    for r in found:
        held[r.doc_id].append((r.start, r.stop, r.first_doc, r.removed))
    return {i: sorted(v) for i, v in held.items()}


def test_touching_passages_keep_their_own_first_document(spark):
    """Document 5 has P of document 2, then Q, which document 9 has too: Q stays in 5."""
    p, q = (" ".join(f"{x}{k}" for k in range(60)) + "." for x in "pq")
    rows = [(2, p), (5, f"{p}\n{q}"), (9, q)]
    found = ranges_of(repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert found == {2: [(0, 60, 2, False)], 5: [(0, 60, 2, True), (60, 120, 5, False)], 9: [(0, 60, 5, True)]}
    words = {i: t.split() for i, t in rows}
    for i, ranges in found.items():
        for a, b, first, removed in ranges:
            kept = [words[first][x:y] for x, y, _, gone in found[first] if not gone]
            assert not removed or any(words[i][a:b] == k[j : j + b - a] for k in kept for j in range(len(k)))


def test_passages_cut_at_any_word(spark):
    """Exact runs in the middle of foreign sentences, of any length from 50 words, wrapped anyhow: found whole."""
    rng = np.random.default_rng(23)
    rows, want = [], {}
    for n in (50, 51, 57, 60, 75, 120):
        passage = [f"p{n}x{k}" for k in range(n)]
        for copy in range(2):
            before, after = ([f"h{rng.integers(10**9)}" for _ in range(rng.integers(20, 90))] for _ in range(2))
            words = before + passage + after
            gaps = [" " if copy else rng.choice([" ", "\n"]) for _ in words]
            rows.append((len(rows), "".join(w + g for w, g in zip(words, gaps))))
            want[rows[-1][0]] = [(len(before), len(before) + n, rows[-1][0] - copy, bool(copy))]
    short = [f"s{k}" for k in range(49)]
    rows += [(100 + k, " ".join([*(f"one{k}x{i}" for i in range(40)), *short, *(f"two{k}x{i}" for i in range(40))])) for k in range(2)]
    assert ranges_of(repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()) == want


def test_wrapped_paragraphs(spark):
    """A paragraph of short lines is near one that is a single line; a blank line parts paragraphs."""
    rng = np.random.default_rng(29)
    base = [f"w{k}" for k in range(100)]
    near = edited(rng, base, 2).split()
    wrapped = "\n".join(" ".join(near[k : k + 9]) for k in range(0, 100, 9))
    rows = [(1, " ".join(base)), (2, f"Some words ahead.\n\n{wrapped}\n \nSome words behind.")]
    found = ranges_of(repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert found == {1: [(0, 100, 1, False)], 2: [(3, 103, 1, True)]}
