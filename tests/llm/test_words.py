"""Word codes against plain splitting."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from farthing.llm.words import ALNUM, SPACED, SPACED_CASED, runs, shingle_sets, words_of

RULES = {"spaced": (SPACED, r"[^\x20\x09-\x0D]+", True), "cased": (SPACED_CASED, r"[^\x20\x09-\x0D]+", False),
         "alnum": (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True)}
ALPHABET = st.characters(exclude_categories=["Cs"]) | st.sampled_from(" \n\tAaé.0")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def column(texts):
    return pa.array([None if t is None else t.encode() for t in texts], pa.binary())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | st.text(ALPHABET, max_size=60), max_size=6))
def test_same_words_same_codes(texts):
    for table, pattern, fold in RULES.values():
        w = words_of(column(texts), table)
        want = [re.findall(pattern, (lower(t) if fold else t) if t else "") for t in texts]
        assert list(np.diff(w.first)) == [len(x) for x in want]
        flat = [x.replace("\x00", "\x01") if table is not ALNUM else x for words in want for x in words]
        by_code = dict(zip(w.codes.tolist(), flat))
        assert [by_code[c] for c in w.codes.tolist()] == flat and len(by_code) == len(set(flat))


def test_long_words_with_shifted_letters_differ():
    a, b = "a" * 64 + "b" * 64, "b" * 64 + "a" * 64
    w = words_of(column([a, b, a]), SPACED)
    assert w.codes[0] != w.codes[1] and w.codes[0] == w.codes[2]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | st.text(st.sampled_from("ab \n"), max_size=40), max_size=5))
def test_shingle_sets(texts):
    codes, bounds = shingle_sets(words_of(column(texts), SPACED), 5)
    for i, t in enumerate(texts):
        w = re.findall(r"\S+", t or "")
        want = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        assert bounds[i + 1] - bounds[i] == len(want)
    w = words_of(column(texts), SPACED)
    assert len(runs(w.codes, w.first, 5)[0]) == sum(max(0, n - 4) for n in np.diff(w.first))
