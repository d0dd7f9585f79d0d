"""Runs of words against trying every period at every place."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from farthing.llm import periods
from farthing.llm.queries import op13_periodic_runs
from farthing.llm.words import mixed

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e, q) for (s, e), q in found.items())


def found_runs(texts):
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    codes = mixed(np.array([w for t in texts for w in t], np.uint64) + np.uint64(9))
    text, low, high, q = periods.periodic_runs(codes, first)
    return [(int(t), int(a - first[t]), int(b - first[t]), int(p)) for t, a, b, p in zip(text, low, high, q)]


block = st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(1, 9), st.integers(0, 3))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(block, max_size=6), max_size=5))
def test_all_runs(blocks):
    texts = [[w for unit, times, more in text for w in unit * times + unit[:more]] for text in blocks]
    assert found_runs(texts) == [(i, *r) for i, t in enumerate(texts) for r in plain_runs(t)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), max_size=90), max_size=3))
def test_two_letters(texts):
    assert found_runs(texts) == [(i, *r) for i, t in enumerate(texts) for r in plain_runs(t)]


def test_long_repeats_stay_linear():
    """Texts on which comparing all pairs of places would not end."""
    assert found_runs([[1] * 300_000]) == [(0, 0, 300_000, 1)]
    unit = list(range(50_000))
    assert found_runs([unit * 4 + unit[:7], unit * 3]) == [(0, 0, 200_007, 50_000)]
    assert found_runs([unit * 3 + unit[:-1]]) == []
    inner = ([5] * 6 + [7]) * 20_000
    assert found_runs([inner])[:2] == [(0, 0, 6, 1), (0, 0, 140_000, 7)] and len(found_runs([inner])) == 20_001


def test_grammar_derives_the_text():
    """Every nonterminal's places repeat its first place, and boundaries are covered once a place."""
    ids = np.array([1, 2, 3, 1, 2, 3, 1, 2, 4, 4, 4, 4, 4, 9, 1, 2, 3, 1, 2, 3])
    g = periods.grammar(ids, np.arange(20), np.array([0] * 13 + [1] * 7))
    middles = sorted((g.place + (g.middle - g.start)[g.rule]).tolist())
    assert middles == [*range(1, 13), *range(14, 20)]
    for rule, place in zip(g.rule, g.place):
        size = g.stop[rule] - g.start[rule]
        assert np.array_equal(ids[place : place + size], ids[g.start[rule] : g.stop[rule]])


def test_a_wrong_hash_is_mended(monkeypatch):
    monkeypatch.setattr(periods._Hashes, "same", lambda self, a, b, length: np.ones(len(np.atleast_1d(length)), bool))
    text = [8, 9] + [1, 2] * 5 + [7, 6] + [3, 3, 3, 3, 3, 3]
    assert set(found_runs([text])) <= {(0, *r) for r in plain_runs(text)}


def collapsed(words):
    gone = {i for s, e, q in plain_runs(words) for i in range(s + q, e)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_texts(spark, odd_docs, no_docs):
    more = spark.createDataFrame([(20, "ab " * 9 + "end\x00 end\x01 end\x00 end\x01 end\x00 end\x01", "a", "n", 1, 2), (21, "x y " * 7, "a", "n", 1, 2), (None, "é " * 6, None, "n", 1, 2)], odd_docs.schema)
    rows = odd_docs.unionByName(more).withColumnsRenamed({"size": "runs", "key": "collapsed"}).collect()
    got = periods.repetitions(spark.createDataFrame(rows, "doc_id bigint, text string, source string, runs string, collapsed int, id int")).collect()
    key = lambda x: (x[0] is None, x)
    have = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=key)
    want = []
    for r in rows:
        words = WORD.findall(r.text or "")
        want.append((r.doc_id, [(s, e - s, q) for s, e, q in plain_runs(words[:200])] if len(words) < 200 else None, collapsed(words) if len(words) < 200 else None))
    for (i, runs, text), (j, told, kept) in zip(have, sorted(want, key=lambda x: (x[0] is None, x[0] or 0, str(x[1])))):
        assert i == j and (told is None or (runs, text) == (told, kept))
    assert periods.repetitions(no_docs).count() == 0


def test_query(spark, folder, docs):
    got = {r.doc_id: r for r in op13_periodic_runs(spark, folder).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        h = zlib.crc32(str(r.doc_id).encode())
        words = WORD.findall(r.text or "")
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if h % 10 and n > 1500:
            continue  # the plain way is slow
        runs = plain_runs(words)
        best = min(runs, key=lambda x: (x[0] - x[1], x[0], x[2]), default=None)
        own = got[r.doc_id]
        assert own.n_runs == len(runs)
        told = (own.start, own.length, own.period, own.exponent_milli)
        assert told == ((best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4)
        assert own.runs_sha256 == hashlib.sha256("".join(f"{s},{e - s},{q}\n" for s, e, q in runs).encode()).hexdigest()
        assert own.collapsed_sha256 == hashlib.sha256(collapsed(words).encode()).hexdigest()


def test_joined_words_of_sliced_columns():
    column = pa.array([b"zz", b"  a b ", None, b"", b"c"], pa.binary())[1:]
    assert periods._judged(column)[1].to_pylist() == ["a b", "", "", "c"]
