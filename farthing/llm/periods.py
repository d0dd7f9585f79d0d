"""Periodic runs of words, found in a Re-Pair grammar of the word ids.

A run is a stretch of words with smallest period q, at least ``max(6, 4 * q)`` long, that no
neighbouring word extends with that period. Three steps, for all texts of an Arrow batch at once:

* *Grammar.* Pairs of neighbouring ids that occur again in their text become nonterminals, the more frequent
  pair first where two overlap, until no pair repeats; what is left of a stretch is paired up as a
  balanced tree, so that every boundary between two words belongs to one nonterminal.
* *Boundary runs.* Each nonterminal is looked at once, however often it occurs: a run across the boundary of its
  two halves has 2q words or more on one side, so q is the distance from the boundary to another
  place of the same two words; prefix hashes extend the match both ways inside the nonterminal.
* *Translation.* The runs found are copied to all places that derive from the nonterminal. A run lies whole in the
  lowest nonterminal around it and in pieces further down, so an interval inside
  another one of its text and period goes, and the rest are the maximal ones.

Two words inside a run occur three times or more in their text, so stretches without such pairs are left out
of the grammar; ordinary prose leaves almost nothing. The candidates of a nonterminal are at most as many as its words, and
one text repeated n times has some log n nonterminals: nothing grows with the square of a text.

Defined results: a null or empty text has no words and no runs and collapses to an empty string; repeated rows
are judged each; other columns are ignored, whatever their names; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farthing.llm.common import in_batches, pieces, utf8
from farthing.llm.words import SPACED_CASED, Words, mixed, text_bytes, words_of

LEAST_WORDS = 6
LEAST_COPIES = 4
#: Candidates that are looked at together.
STEP = 1 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_WIDE = np.int64(1) << 31

#: As ``SPACED_CASED``, but U+0000 is told from U+0001: 0xFF is no byte of UTF-8.
EXACT = SPACED_CASED.copy()
EXACT[0] = 0xFF

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _ids(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A dense id of every value, and how often the value occurs."""
    _, place, count = np.unique(values, return_inverse=True, return_counts=True)
    return place.astype(np.int64), count[place]


# -- the grammar -----------------------------------------------------------------


@dataclass
class Grammar:
    """Nonterminals by one place each (``start``, ``middle``, ``stop`` in words), and all places that derive from them."""

    start: np.ndarray
    middle: np.ndarray
    stop: np.ndarray
    rule: np.ndarray
    place: np.ndarray


def _chosen(pair: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Boundaries to replace: those that rank above both neighbours, every second one of a like row.

    ``rank`` is 0 at a boundary that takes no part.
    """
    n = len(pair)
    at = np.arange(n)
    like = np.zeros(n, bool)
    like[1:] = (pair[1:] == pair[:-1]) & (rank[1:] > 0) & (rank[:-1] > 0)
    above_left, above_right = np.ones(n, bool), np.ones(n, bool)
    above_left[1:] = rank[1:] > rank[:-1]
    above_right[:-1] = (rank[:-1] > rank[1:]) | like[1:]
    head = np.maximum.accumulate(np.where(like, 0, at))
    even = (at - head + ~above_left[head]) % 2 == 0
    return (rank > 0) & (above_left | like) & above_right & even


def grammar(ids: np.ndarray, place: np.ndarray, stretch: np.ndarray) -> Grammar:
    """Re-Pair of the words ``ids`` at ``place``; no nonterminal reaches over the end of a ``stretch``."""
    sym, start, stop = ids.copy(), place.copy(), place + 1
    glued = stretch[1:] == stretch[:-1]  # what may be one nonterminal in the end
    open_ = glued.copy()  # what may still be a pair that repeats
    free = int(sym.max(initial=-1)) + 1
    rules: list[tuple[np.ndarray, ...]] = []
    known = 0
    while True:
        at = np.flatnonzero(open_)
        pair = np.full(len(open_), -1, np.int64)
        pair[at] = sym[at] * _WIDE + sym[at + 1]
        kinds, kind, count = np.unique(pair[at], return_inverse=True, return_counts=True)
        often = count[kind] > 1
        open_[at[~often]] = False
        if not often.any():
            break
        weight = (np.log2(count).astype(np.uint64) << np.uint64(58)) | (mixed(kinds.view(np.uint64)) >> np.uint64(6)) | np.uint64(1)
        rank = np.zeros(len(open_), np.uint64)
        rank[at[often]] = weight[kind[often]]
        take = np.flatnonzero(_chosen(pair, rank))
        if not len(take):  # two kinds of one rank side by side
            take = at[often][:1]
        _, first, own = np.unique(pair[take], return_index=True, return_inverse=True)
        s, m, e = start[take], start[take + 1], stop[take + 1]
        rules.append((s[first], m[first], e[first], known + own, s))
        known += len(first)
        sym[take], stop[take] = free + own, e
        free += len(first)
        stays = np.ones(len(sym), bool)
        stays[take + 1] = False
        sym, start, stop = sym[stays], start[stays], stop[stays]
        bound = np.ones(len(open_), bool)
        bound[take] = False
        glued, open_ = glued[bound], open_[bound]
    while glued.any():  # the rest as balanced trees, one nonterminal a place
        head = np.concatenate([[True], ~glued])
        at = np.arange(len(head))
        take = np.flatnonzero(glued & ((at - np.maximum.accumulate(np.where(head, at, 0)))[:-1] % 2 == 0))
        s, m, e = start[take], start[take + 1], stop[take + 1]
        rules.append((s, m, e, known + np.arange(len(take)), s))
        known += len(take)
        stop[take] = e
        stays = np.ones(len(start), bool)
        stays[take + 1] = False
        start, stop = start[stays], stop[stays]
        bound = np.ones(len(glued), bool)
        bound[take] = False
        glued = glued[bound]
    if not rules:
        return Grammar(*(np.zeros(0, np.int64) for _ in range(5)))
    return Grammar(*(np.concatenate(x) for x in zip(*rules)))


# -- runs across boundaries --------------------------------------------------------


class _Hashes:
    """Hashes of any stretch of words, and how far two stretches agree."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        self.power = np.ones(n + 1, np.uint64)
        np.multiply.accumulate(np.full(n, _FACTOR), out=self.power[1:])
        # The sum of code * factor^-place, times factor^place: one pass of plain sums.
        inverse = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
        back = np.ones(n + 1, np.uint64)
        np.multiply.accumulate(np.full(n, inverse), out=back[1:])
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * back[:n], out=self.sums[1:])

    def same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether ``length`` words from ``a`` and from ``b`` (further on) are equal."""
        here, there = self.sums[a + length] - self.sums[a], self.sums[b + length] - self.sums[b]
        return here == there * self.power[b - a]

    def forward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from ``a`` on equal those from ``b`` on, ``most`` at the utmost."""
        return self._reach(most, lambda n, at: self.same(a[at], b[at], n))

    def backward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words before ``a`` equal those before ``b``."""
        return self._reach(most, lambda n, at: self.same(a[at] - n, b[at] - n, n))

    @staticmethod
    def _reach(most: np.ndarray, fits) -> np.ndarray:
        low, high = np.zeros(len(most), np.int64), most.copy()
        while (at := np.flatnonzero(low < high)).size:
            middle = (low[at] + high[at] + 1) // 2
            good = fits(middle, at)
            low[at] = np.where(good, middle, low[at])
            high[at] = np.where(good, high[at], middle - 1)
        return low


def _spread(low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, number) for all numbers from ``low`` up to ``high`` of each row, about ``STEP`` at a time."""
    count = np.maximum(high - low, 0)
    ends = np.cumsum(count)
    a = 0
    while a < len(count):
        before = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + STEP, side="right")))
        row = np.repeat(np.arange(a, b), count[a:b])
        yield row, low[row] + np.arange(len(row)) - (ends[row] - count[row] - before)
        a = b


def _extended(codes: np.ndarray, start: int, middle: int, stop: int, period: int) -> tuple[int, int]:
    """The stretch of this period around ``middle`` inside (start, stop), word by word."""
    same = codes[start : stop - period] == codes[start + period : stop]
    anchor = middle - start if middle + period <= stop and middle - start < len(same) and same[middle - start] else middle - start - period
    wrong = np.flatnonzero(~same)
    k = int(np.searchsorted(wrong, anchor))
    low = int(wrong[k - 1]) + 1 if k else 0
    high = int(wrong[k]) if k < len(wrong) else len(same)
    return start + low, start + high + period


def boundary_runs(codes: np.ndarray, g: Grammar, place: np.ndarray, stretch: np.ndarray) -> tuple[np.ndarray, ...]:
    """(nonterminal, start, stop, period) of all runs across the boundary of a nonterminal, at its first place."""
    nothing = tuple(np.zeros(0, np.int64) for _ in range(4))
    node = np.flatnonzero(g.stop - g.start >= LEAST_WORDS)
    if not len(node):
        return nothing
    s, m, e = g.start[node], g.middle[node], g.stop[node]
    n = np.int64(len(codes) + 1)
    inner = np.flatnonzero((stretch[1:] == stretch[:-1]) & (place[1:] == place[:-1] + 1))
    at = place[inner]
    gram = np.full(len(codes), -1, np.int64)
    gram[at] = _ids(mixed(codes[at] * _FACTOR + codes[at + 1]))[0]
    listed = np.sort(gram[at] * n + at)
    hashes = _Hashes(codes)
    found: list[tuple[np.ndarray, ...]] = []

    def keep(row: np.ndarray, low: np.ndarray, high: np.ndarray, q: np.ndarray) -> None:
        good = (low < m[row]) & (high > m[row]) & (high - low >= np.maximum(LEAST_WORDS, LEAST_COPIES * q))
        found.append((node[row[good]], low[good], high[good], q[good]))

    right = np.flatnonzero(e - m >= 3)
    own = gram[m[right]] * n + m[right]
    for row, i in _spread(np.searchsorted(listed, own, side="right"), np.searchsorted(listed, own + (e - m)[right] // 2, side="right")):
        row = right[row]
        q = listed[i] % n - m[row]
        good = hashes.same(m[row], m[row] + q, q)
        row, q = row[good], q[good]
        low = m[row] - hashes.backward(m[row], m[row] + q, m[row] - s[row])
        keep(row, low, m[row] + q + hashes.forward(m[row], m[row] + q, e[row] - m[row] - q), q)
    left = np.flatnonzero(m - s >= 3)
    own = gram[m[left] - 2] * n + m[left] - 2
    for row, i in _spread(np.searchsorted(listed, own - (m - s)[left] // 2), np.searchsorted(listed, own)):
        row = left[row]
        q = m[row] - 2 - listed[i] % n
        good = hashes.same(m[row] - 2 * q, m[row] - q, q)
        row, q = row[good], q[good]
        low = m[row] - q - hashes.backward(m[row] - q, m[row], m[row] - q - s[row])
        keep(row, low, m[row] + hashes.forward(m[row] - q, m[row], e[row] - m[row]), q)
    rule, low, high, q = (np.concatenate(x) for x in zip(*found)) if found else nothing
    order = np.lexsort((q, high, low, rule))  # multiples of a period give the same stretch again
    least = np.ones(len(order), bool)
    for x in (rule, low, high):
        x[:] = x[order]
    least[1:] = (rule[1:] != rule[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    rule, low, high, q = rule[least], low[least], high[least], q[order][least]
    for k in range(len(rule)):  # the hashes are not proof
        if not np.array_equal(codes[low[k] : high[k] - q[k]], codes[low[k] + q[k] : high[k]]):
            low[k], high[k] = _extended(codes, g.start[rule[k]], g.middle[rule[k]], g.stop[rule[k]], q[k])
    good = high - low >= np.maximum(LEAST_WORDS, LEAST_COPIES * q)
    return rule[good], low[good], high[good], q[good]


# -- whole texts --------------------------------------------------------------------


def _translated(g: Grammar, rule: np.ndarray, low: np.ndarray, high: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, ...]:
    """The runs at all places that derive from their nonterminal."""
    order = np.argsort(g.rule, kind="stable")
    places = g.place[order]
    bounds = np.searchsorted(g.rule[order], np.arange(len(g.start) + 1))
    parts = []
    for k, i in _spread(bounds[rule], bounds[rule + 1]):
        moved = places[i] - g.start[rule[k]]
        parts.append((low[k] + moved, high[k] + moved, q[k]))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _maximal(text: np.ndarray, low: np.ndarray, high: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Which intervals lie in no other one of their text and period, one of equal ones; then only the smallest period of each."""
    order = np.lexsort((-high, low, q, text))
    t, a, b, p = text[order], low[order], high[order], q[order]
    group = np.cumsum(np.concatenate([[False], (t[1:] != t[:-1]) | (p[1:] != p[:-1])]))
    far = np.maximum.accumulate(group * _WIDE + b)
    keep = np.ones(len(order), bool)
    keep[1:] = group[1:] * _WIDE + b[1:] > far[:-1]
    order = order[keep]
    order = order[np.lexsort((q[order], high[order], low[order]))]
    least = np.ones(len(order), bool)
    least[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
    order = order[least]
    return order[np.lexsort((q[order], low[order]))]


def periodic_runs(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, stop, period) of all runs, by text, start and period; places count through all texts.

    Text ``i`` has the words ``codes[first[i]:first[i + 1]]``.
    """
    nothing = tuple(np.zeros(0, np.int64) for _ in range(4))
    if len(codes) < LEAST_WORDS:
        return nothing
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    own = mixed(codes + mixed(text.astype(np.uint64) + np.uint64(1)))
    inside = text[1:] == text[:-1]
    again = inside & (_ids(own[:-1] * _FACTOR + own[1:])[1] >= LEAST_COPIES - 1)
    edge = np.diff(np.concatenate([[False], again, [False]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    wide = end - begin + 1 >= LEAST_WORDS
    begin, size = begin[wide], (end - begin + 1)[wide]
    if not len(begin):
        return nothing
    stretch = np.repeat(np.arange(len(begin)), size)
    place = begin[stretch] + np.arange(len(stretch)) - (np.cumsum(size) - size)[stretch]
    g = grammar(_ids(own[place])[0], place, stretch)
    rule, low, high, q = boundary_runs(own, g, place, stretch)
    if not len(rule):
        return nothing
    low, high, q = _translated(g, rule, low, high, q)
    keep = _maximal(text[low], low, high, q)
    return text[low[keep]], low[keep], high[keep], q[keep]


def _joined(raw: np.ndarray, w: Words, keep: np.ndarray) -> pa.Array:
    """Each text's kept words with one space between."""
    n = len(w.first) - 1
    at = np.flatnonzero(keep)
    size = w.ends[at] - w.starts[at] + 1
    stop = np.cumsum(size)
    text = np.searchsorted(w.first, at, side="right") - 1
    source = np.repeat(w.starts[at] - (stop - size), size) + np.arange(int(size.sum()))
    out = raw[np.minimum(source, max(len(raw) - 1, 0))] if len(at) else np.zeros(0, np.uint8)
    out[stop - 1] = 32
    last = np.flatnonzero(np.concatenate([text[1:] != text[:-1], [True]])) if len(at) else at
    out = np.delete(out, stop[last] - 1)
    sizes = np.bincount(text, weights=size, minlength=n).astype(np.int64)
    sizes -= sizes > 0
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


def _judged(column: pa.Array) -> list[pa.Array]:
    w = words_of(column, EXACT)
    text, low, high, q = periodic_runs(w.codes, w.first)
    mark = np.zeros(len(w.codes) + 1, np.int64)
    np.add.at(mark, low + q, 1)
    np.add.at(mark, high, -1)
    base = w.first[text]
    runs = pa.StructArray.from_arrays([pa.array(low - base), pa.array(high - low), pa.array(q)], ["start", "length", "period"])
    bounds = pa.array(np.searchsorted(text, np.arange(len(w.first))).astype(np.int32))
    return [pa.ListArray.from_arrays(bounds, runs), _joined(text_bytes(column)[0], w, np.cumsum(mark)[:-1] == 0)]


def repetitions(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, collapsed) of every text: its runs by start and period, and the text without their repeats.

    A run's ``start`` and ``length`` count words. ``collapsed`` has the words, one space apart, but for those that
    any run holds after its first period.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch, "text"):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *_judged(part.column("text"))], ["doc_id", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_batches(docs.select("doc_id", utf8()), work, f"doc_id {kind}, runs {RUNS}, collapsed string")


def longest(runs: Column) -> Column:
    """The run of greatest length, of equal ones the first, then the one of least period; null without runs."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less"))))
    return F.when(best.isNotNull(), F.struct((-best["back"]).alias("start"), best["length"].alias("length"), (-best["less"]).alias("period")))
