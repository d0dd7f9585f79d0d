"""Benchmark decontamination with training suffix arrays.

Training documents form shards of about ``SHARD_WORDS`` words inside their tasks. Each
shard gets the suffix array of its words, sorted as deep as the longest test item
needs, and every suffix of a test item of ``WINDOW`` words or more (or a whole shorter item) is
binary-searched in it: the range of its first ``WINDOW`` words gives all occurrences, and these, compared
word by word, the longest verbatim match. A shorter match is not reported. No row is shuffled.

Test items are written once to the shared folder in files of bounded size; a task
holds one file at a time, whatever the size of the benchmark.

Defined results: a null text has no words, is never hit, and an item without words has
no window; an item of fewer than ``WINDOW`` words is one window; matches never cross
documents; repeated items are listed each, rows of one document are judged each; an empty benchmark hits
nothing; null item_ids are not listed; other columns are ignored or, in ``without_contaminated``, passed on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farthing.llm.common import in_batches, new_folder, pieces, utf8
from farthing.llm.words import ALNUM, words_of

WINDOW = 13
#: Words of a shard: about a hundred bytes each while it is sorted, in every worker of an executor.
SHARD_WORDS = 1 << 18
#: Bytes of test items in one file, which a task holds at once.
BLOCK_BYTES = 4 << 20
#: Occurrences that one step expands.
STEP = 1 << 20
_FIELDS = (
    "n_words bigint, n_hit bigint, item_ids array<bigint>, contaminated boolean, "
    "matches array<struct<item_id:bigint,item_start:int,start:int,length:int>>"
)


@dataclass
class Tests:
    """Words of the test items of one file, laid end to end."""

    codes: np.ndarray
    first: np.ndarray
    ids: np.ndarray

    @property
    def longest(self) -> int:
        return int(np.diff(self.first).max(initial=0))


def write_tests(benchmark: DataFrame) -> str:
    """The items in files of about ``BLOCK_BYTES`` in the shared folder; its path."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), utf8())
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    path = new_folder(spark, "tests")
    rows.repartition(max(1, -(-int(total) // BLOCK_BYTES))).write.parquet(path)
    return path


def _blocks(path: str) -> Iterator[Tests]:
    fs, root = pafs.FileSystem.from_uri(path)
    for info in sorted(fs.get_file_info(pafs.FileSelector(root)), key=lambda i: i.path):
        if info.path.endswith(".parquet"):
            rows = pq.read_table(info.path, filesystem=fs).combine_chunks()
            if rows.num_rows:
                w = words_of(rows["text"].combine_chunks(), ALNUM)
                ids = rows["item_id"].combine_chunks()
                yield Tests(w.codes, w.first, np.array(ids.to_pylist(), dtype=object))


def suffix_array(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes, in order of their first ``depth`` tokens at least.

    Prefix doubling: ranks by 1, 2, 4, ... tokens; only suffixes whose rank is still
    shared are sorted again.
    """
    n = len(tokens)
    order = np.argsort(tokens, kind="stable").astype(np.int64)
    rank = np.zeros(n + depth + 1, np.int64)  # beyond the end: 0, before all others
    ordered = tokens[order]
    heads = np.ones(n, bool)
    heads[1:] = ordered[1:] != ordered[:-1]
    group = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    rank[order] = group + 1
    known = 1
    open_ = np.flatnonzero(~heads | ~np.append(heads[1:], True))
    while known < depth and len(open_):
        who = order[open_]
        base, ahead = rank[who], rank[np.minimum(who + known, n)]
        by = np.argsort(base * (n + 2) + ahead, kind="stable")
        who, base, ahead = who[by], base[by], ahead[by]
        order[open_] = who
        fresh = np.ones(len(who), bool)
        fresh[1:] = (base[1:] != base[:-1]) | (ahead[1:] != ahead[:-1])
        group = np.maximum.accumulate(np.where(fresh, open_, 0))
        rank[who] = group + 1
        left = ~fresh | ~np.append(fresh[1:], True)
        open_ = open_[left]
        known *= 2
    return order


def _bound(tokens: np.ndarray, array: np.ndarray, query: np.ndarray, at: np.ndarray, size: np.ndarray, after: bool) -> np.ndarray:
    """First place in ``array`` whose suffix is not below (``after``: is above) each query prefix."""
    low, high = np.zeros(len(at), np.int64), np.full(len(at), len(array), np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_]) >> 1
        sign = _compare(tokens, array[mid], query, at[open_], size[open_])
        up = sign < 0 if not after else sign <= 0
        low[open_[up]] = mid[up] + 1
        high[open_[~up]] = mid[~up]


def _compare(tokens, place, query, at, size) -> np.ndarray:
    """-1, 0, 1: the suffix at ``place`` against the first ``size`` words of the query."""
    sign = np.zeros(len(place), np.int8)
    open_, k = np.arange(len(place)), 0
    while len(open_):
        open_ = open_[size[open_] > k]
        there = place[open_] + k
        inside = there < len(tokens)
        mine = np.where(inside, tokens[np.minimum(there, len(tokens) - 1)], -1)
        theirs = query[at[open_] + k]
        differ = mine != theirs
        sign[open_[differ]] = np.where(mine[differ] < theirs[differ], -1, 1)
        open_, k = open_[~differ], k + 1
    return sign


def _shared(tokens, place, query, at, size) -> np.ndarray:
    """Words that the suffix at ``place`` and the query have in common."""
    out = np.zeros(len(place), np.int64)
    open_, k = np.arange(len(place)), 0
    while len(open_):
        open_ = open_[(size[open_] > k) & (place[open_] + k < len(tokens))]
        open_ = open_[tokens[place[open_] + k] == query[at[open_] + k]]
        k += 1
        out[open_] = k
    return out


class Shard:
    """Documents of one shard: words, suffix array, hits."""

    def __init__(self, codes: list[np.ndarray], depth: int):
        sizes = np.array([len(c) for c in codes], np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes + 1)])  # one separator after each
        flat = np.zeros(int(self.first[-1]), np.uint64)
        sep = self.first[1:] - 1
        word = np.ones(len(flat), bool)
        word[sep] = False
        flat[word] = np.concatenate(codes) if codes else flat[:0]
        self.known, inverse = np.unique(flat[word], return_inverse=True)
        self.tokens = np.zeros(len(flat), np.int64)
        self.tokens[word] = 2 * inverse + 2  # a separator is 0; odd numbers are words not seen here
        self.sizes, self.word = sizes, word
        self.array = suffix_array(self.tokens, depth)
        self.hit = np.zeros(len(flat) + 1, np.int32)
        self.items: list[set] = [set() for _ in sizes]
        self.best: list[dict] = [{} for _ in sizes]

    def _known(self, codes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.known, codes)
        same = at < len(self.known)
        same[same] = self.known[at[same]] == codes[same]
        return np.where(same, 2 * at + 2, 2 * at + 1)

    def search(self, tests: Tests) -> None:
        query = self._known(tests.codes)
        item = np.repeat(np.arange(len(tests.first) - 1), np.diff(tests.first))
        at = np.arange(len(query))
        left = tests.first[item + 1] - at
        total = np.diff(tests.first)[item]
        # Windows: 13 words, or a shorter item as a whole.
        opens = np.flatnonzero((left >= WINDOW) | ((total < WINDOW) & (left == total)))
        at, left, item = at[opens], left[opens], item[opens]
        size = np.minimum(left, WINDOW)
        low = _bound(self.tokens, self.array, query, at, size, after=False)
        high = _bound(self.tokens, self.array, query, at, size, after=True)
        found = np.flatnonzero(high > low)
        counts = (high - low)[found]
        ends = np.cumsum(counts)
        a = 0
        while a < len(found):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + STEP, side="right")))
            self._mark(tests, query, found[a:b], counts[a:b], low, at, size, left, item)
            a = b

    def _mark(self, tests, query, found, counts, low, at, size, left, item) -> None:
        which = np.repeat(found, counts)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        place = self.array[low[which] + offset]
        self.hit += np.bincount(place, minlength=len(self.hit)).astype(np.int32)
        self.hit -= np.bincount(place + size[which], minlength=len(self.hit)).astype(np.int32)
        length = _shared(self.tokens, place, query, at[which], left[which])
        doc = np.searchsorted(self.first, place, side="right") - 1
        own = item[which]
        order = np.lexsort((place, at[which], -length, own, doc))
        doc, own, length, place, which = doc[order], own[order], length[order], place[order], which[order]
        head = np.ones(len(doc), bool)
        head[1:] = (doc[1:] != doc[:-1]) | (own[1:] != own[:-1])
        for i in np.flatnonzero(head):
            d, test = int(doc[i]), tests.ids[own[i]]
            if test is None:
                continue
            self.items[d].add(int(test))
            start = int(at[which[i]] - tests.first[own[i]])
            new = (-int(length[i]), start, int(place[i] - self.first[d]))
            old = self.best[d].get(int(test))
            if old is None or new < old:
                self.best[d][int(test)] = new

    def rows(self) -> list[pa.Array]:
        covered = (np.cumsum(self.hit[:-1]) > 0) & self.word
        n_hit = np.diff(np.concatenate([[0], np.cumsum(covered)])[self.first])
        matches = [
            [{"item_id": i, "item_start": s, "start": p, "length": -n} for i, (n, s, p) in sorted(b.items())] for b in self.best
        ]
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("item_start", pa.int32()), ("start", pa.int32()), ("length", pa.int32())]))
        return [
            pa.array(self.sizes), pa.array(n_hit), pa.array([sorted(s) for s in self.items], pa.list_(pa.int64())),
            pa.array((n_hit > 0) & (20 * n_hit >= self.sizes)), pa.array(matches, kind),
        ]


def _shards(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[list[pa.RecordBatch], Shard]]:
    """Batches until a shard is full, and the shard searched for all test files."""
    depth = max([1, *(t.longest for t in _blocks(path))])

    def done(held, codes):
        shard = Shard(codes, depth)
        if len(shard.known):
            for tests in _blocks(path):
                shard.search(tests)
        return held, shard

    held: list[pa.RecordBatch] = []
    codes: list[np.ndarray] = []
    count = 0
    for batch in batches:
        for a, b in pieces(batch, "text"):
            part = batch.slice(a, b - a)
            w = words_of(part.column("text").cast(pa.binary()), ALNUM)
            codes += [w.codes[w.first[i] : w.first[i + 1]] for i in range(b - a)]
            held.append(part)
            count += len(w.codes)
            if count >= SHARD_WORDS:
                yield done(held, codes)
                held, codes, count = [], [], 0
    if held:
        yield done(held, codes)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: words, hit words, items, verdict and the longest match of each item.

    ``contaminated``: a twentieth of the words or more are hit. ``matches`` locates the
    longest verbatim match of each item of ``item_ids``: its first word in item and document, its length in words.
    Matches of fewer than ``WINDOW`` words, but for whole shorter items, are not reported.
    """
    path = write_tests(benchmark)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, shard in _shards(batches, path):
            ids = pa.concat_arrays([h.column("doc_id") for h in held])
            yield pa.RecordBatch.from_arrays([ids, *shard.rows()], ["doc_id", *_names()])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_batches(docs.select("doc_id", utf8()), work, f"doc_id {kind}, {_FIELDS}")


def _names() -> list[str]:
    return ["n_words", "n_hit", "item_ids", "contaminated", "matches"]


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that are not contaminated, with all their columns, in the same pass."""
    path = write_tests(benchmark)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, shard in _shards(batches, path):
            clean = np.logical_not(np.asarray(shard.rows()[3]))
            a = 0
            for part in held:
                yield part.filter(pa.array(clean[a : a + part.num_rows]))
                a += part.num_rows

    return in_batches(docs, work, docs.schema)
