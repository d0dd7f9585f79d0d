"""Substring dedup: repeated passages by MinHash over paragraphs.

Paragraphs are lines of at least ``least`` words, and neighbouring shorter lines together, up to a
blank line, since texts are wrapped differently. Bands of a few coordinates are
tuned for recall (20 of 4 rows miss a pair at 0.8 with probability 3e-5), colliding
paragraphs are verified by exact Jaccard of their five-word shingles, and connected
components give the clusters: all but the occurrences in the smallest document go.

A passage may also stand anywhere inside a longer line, or run over several. So every run of ``least``
words that two documents share is a second kind, equal word for word wherever sentences and
lines end. Each run has an anchor that only its words define (the smallest code of the shorter runs
inside), so runs are compared only where two documents share an anchor; the runs of a longer
passage overlap and give it whole. Both kinds give spans of words, each with the smallest
document of its copies. Where spans of a document overlap, a word belongs to the smallest of
these; the result are the ranges of words with one such document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farthing.llm.common import in_batches, pieces, stored, utf8
from farthing.llm.components import components
from farthing.llm.minhash import Banding, prints_of, set_codes, similar
from farthing.llm.sieve import Sieve, sieve_of
from farthing.llm.words import SPACED, Words, mixed, text_bytes, words_of

LEAST = 50
BANDING = Banding(above=80, bands=20, rows=4)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


def _lines(column: pa.Array, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Text, first word and end word of every paragraph of enough words, and the paragraph.

    Neighbouring lines of fewer words are one paragraph, up to a blank line: they may be one, wrapped.
    """
    raw, _ = text_bytes(column)
    w = words_of(column, SPACED)
    n = len(w.codes)
    gaps = np.zeros(n, np.int64)
    if n:
        newlines = np.concatenate([[0], np.cumsum(raw == 10)])
        gaps[1:] = newlines[w.starts[1:]] - newlines[w.ends[:-1]]
        gaps[w.first[:-1][np.diff(w.first) > 0]] = 2  # a text ends a paragraph as a blank line does
    starts = np.flatnonzero(gaps)
    short = np.diff(np.append(starts, n)) < least
    wrapped = (gaps[starts] == 1) & short
    wrapped[1:] &= short[:-1]
    starts = starts[~wrapped]
    ends = np.append(starts[1:], n)
    kept = np.flatnonzero(ends - starts >= least)
    starts, ends = starts[kept], ends[kept]
    text = np.searchsorted(w.first, starts, side="right") - 1
    first = w.first[text]
    lines = [raw[w.starts[i] : w.ends[j - 1]].tobytes() for i, j in zip(starts, ends)]
    return text, starts - first, ends - first, lines


def paragraphs(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, start, stop, line): the lines of at least ``least`` words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch, "text"):
                part = batch.slice(a, b - a)
                text, start, stop, lines = _lines(part.column("text"), least)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(text)), pa.array(start), pa.array(stop), pa.array(lines, pa.binary())],
                    ["doc_id", "start", "stop", "line"],
                )

    return in_batches(docs.select(F.col("doc_id").cast("bigint"), utf8()), work, "doc_id bigint, start bigint, stop bigint, line binary")


def _prints(docs: DataFrame, least: int, banding: Banding) -> DataFrame:
    """(doc_id, start, stop, n, f1, keys) of each paragraph, without its text."""
    held = paragraphs(docs, least).withColumnRenamed("line", "text")
    return prints_of(held, banding, ("doc_id", "start", "stop"))


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, ... base^n modulo 2^64."""
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _lines_of(docs: DataFrame, ids: DataFrame, least: int, banding: Banding) -> DataFrame:
    """(id, text) of the paragraphs with these codes, and a few others; the texts stay in the scan."""
    shared = docs.sparkSession.sparkContext.broadcast(sieve_of(ids))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch, "text"):
                lines = pa.array(_lines(batch.column("text").slice(a, b - a), least)[3], pa.binary())
                codes = set_codes(lines, banding)
                kept = pa.array(shared.value.might_hold(codes))
                yield pa.RecordBatch.from_arrays([pa.array(codes).filter(kept), lines.filter(kept)], ["id", "text"])

    return in_batches(docs.select(utf8()), work, "id bigint, text binary")


def _sums(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of the words' codes by place, and the factors that take a place out again."""
    n = len(w.codes)
    with np.errstate(over="ignore"):
        power, back = _powers(_STEP, n), _powers(_BACK, n)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(w.codes * power[:n], dtype=np.uint64)]), back


def _run_codes(sums: np.ndarray, back: np.ndarray, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """The code of the ``size`` words from each word of ``at`` on."""
    with np.errstate(over="ignore"):
        return mixed((sums[at + size] - sums[at]) * back[at] + np.asarray(size).astype(np.uint64))


@dataclass
class Stretches:
    """Neighbouring runs of ``least`` words with one anchor: ``n[i]`` runs from word ``start[i]`` of all on."""

    words: Words
    sums: np.ndarray
    back: np.ndarray
    text: np.ndarray
    start: np.ndarray
    n: np.ndarray
    anchor: np.ndarray


def _anchored(column: pa.Array, least: int) -> Stretches:
    """All runs of ``least`` words of the texts, as stretches with one anchor, of ``least`` runs at most.

    The anchor is the smallest code of the runs of ``(least + 1) // 2`` words inside; equal runs have equal ones.
    """
    w = words_of(column, SPACED)
    sums, back = _sums(w)
    if len(w.codes) < least:
        return Stretches(w, sums, back, *(np.zeros(0, np.int64),) * 3, np.zeros(0, np.uint64))
    inner = (least + 1) // 2
    low, width, wanted = _run_codes(sums, back, np.arange(len(w.codes) - inner + 1), inner), 1, least - inner + 1
    while width < wanted:  # the smallest of ``width`` neighbours
        step = min(width, wanted - width)
        low, width = np.minimum(low[:-step], low[step:]), width + step
    text = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    at = np.flatnonzero(text[: len(low)] == text[least - 1 :])
    anchor = low[at]
    opens = np.ones(len(at), bool)
    opens[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)  # between two texts some words start no run
    since = np.arange(len(at)) - np.maximum.accumulate(np.where(opens, np.arange(len(at)), 0))
    first = np.flatnonzero(since % least == 0)
    return Stretches(w, sums, back, text[at[first]], at[first], np.diff(np.append(first, len(at))), anchor[first])


def _anchors(docs: DataFrame, least: int) -> DataFrame:
    """(code, doc_id): the anchors of each document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch, "text"):
                part = batch.slice(a, b - a)
                found = _anchored(part.column("text"), least)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.anchor.view(np.int64)), part.column("doc_id").take(pa.array(found.text))], ["code", "doc_id"]
                )

    return in_batches(docs.select(F.col("doc_id").cast("bigint"), utf8()), work, "code bigint, doc_id bigint")


def _stretches(docs: DataFrame, least: int, anchors: Sieve) -> DataFrame:
    """(code, doc_id, start, runs): the stretches whose anchor the sieve lets pass.

    ``code`` is that of all words they cover, ``runs`` has the codes of their runs of ``least`` words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(anchors)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        for batch in batches:
            for a, b in pieces(batch, "text"):
                part = batch.slice(a, b - a)
                found = _anchored(part.column("text"), least)
                met = np.flatnonzero(anchors.might_hold(found.anchor))
                text, start, n = found.text[met], found.start[met], found.n[met]
                code = _run_codes(found.sums, found.back, start, n + (least - 1))
                ends = np.concatenate([[0], np.cumsum(n)])
                at = np.arange(ends[-1]) + np.repeat(start - ends[:-1], n)
                runs = _run_codes(found.sums, found.back, at, least)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(code.view(np.int64)), part.column("doc_id").take(pa.array(text)), pa.array(start - found.words.first[text]),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(runs.view(np.int64))),
                    ],
                    ["code", "doc_id", "start", "runs"],
                )

    schema = "code bigint, doc_id bigint, start bigint, runs array<bigint>"
    return in_batches(docs.select(F.col("doc_id").cast("bigint"), utf8()), work, schema)


def _shared_runs(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, start, stop, first): ranges of words whose runs of ``least`` words another document has too.

    Equal stretches meet first, by the code of all their words; only one of each kind is cut into
    its runs, and what these find goes back to all.
    """
    anchors = sieve_of(_repeated(_anchors(docs, least), "code").select("code"))
    rows = stored(_stretches(docs, least, anchors), "stretches")
    kinds = rows.groupBy("code").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.first("runs").alias("runs"))
    cut = stored(kinds, "kinds").select("code", "first", "last", F.posexplode("runs").alias("place", "run"))
    met = cut.groupBy("run").agg(F.min("first").alias("least"), F.max("last").alias("most")).where("least < most")
    places = cut.select("code", "place", "run").join(stored(met.select("run", "least"), "repeated"), "run")
    # Neighbouring runs with one first document are one range; a kind has ``least`` runs at most.
    island = F.col("place") - F.row_number().over(Window.partitionBy("code", "least").orderBy("place"))
    ranges = places.withColumn("island", island).groupBy("code", "least", "island").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    found = rows.select("code", "doc_id", "start").join(stored(ranges.select("code", "least", "low", "high"), "ranges"), "code")
    return found.select(
        "doc_id", (F.col("start") + F.col("low")).alias("start"), (F.col("start") + F.col("high") + least).alias("stop"), F.col("least").alias("first")
    )


def _repeated(rows: DataFrame, key: str) -> DataFrame:
    """(key, first): what occurs in two documents or more, with the smallest one."""
    ends = rows.groupBy(key).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    return stored(ends.where("first < last").select(key, "first"), "repeated")


def _labelled(start: np.ndarray, stop: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of words of one document, cut where the smallest first document of their spans changes."""
    order = np.lexsort((start, -first))
    start, stop, first = start[order], stop[order], first[order]
    opens = np.ones(len(start), bool)
    opens[1:] = (first[1:] != first[:-1]) | (start[1:] > np.maximum.accumulate(stop)[:-1])
    at = np.flatnonzero(opens)
    label = np.zeros(stop.max() + 1, np.int64)
    covered = np.zeros(len(label), bool)
    for a, b, f in zip(start[at], np.maximum.reduceat(stop, at), first[at]):  # the smallest first comes last
        label[a:b] = f
        covered[a:b] = True
    edges = np.ones(len(label), bool)
    edges[1:] = (covered[1:] != covered[:-1]) | (label[1:] != label[:-1])
    cut = np.flatnonzero(edges)
    ends = np.append(cut[1:], len(label))
    kept = covered[cut]
    return cut[kept], ends[kept], label[cut[kept]]


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column("spans")
        bounds = np.asarray(spans.offsets)
        flat = [np.asarray(c) for c in spans.values.flatten()]
        for i, doc in enumerate(batch.column("doc_id").to_pylist()):
            a, b, first = _labelled(*(c[bounds[i] : bounds[i + 1]] for c in flat))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(a), doc)), pa.array(a), pa.array(b), pa.array(first)], ["doc_id", "start", "stop", "first_doc"]
            )


def repeated_passages(docs: DataFrame, least: int = LEAST, banding: Banding = BANDING) -> DataFrame:
    """(doc_id, start, stop, first_doc, removed): ranges of words that other documents share.

    One row per range of words with one ``first_doc``; ``removed`` is true unless that is the
    document itself. Where passages overlap in part, ``first_doc`` may have left some
    of the words to a still smaller document; some document keeps each word. Defined results: null and empty texts, and texts without doc_id, have no rows;
    rows of one doc_id are one document, so a passage that only they share is not a
    repeat; no rows give no rows; other columns are ignored.
    """
    docs = docs.where("doc_id is not null")
    lines = stored(_prints(docs, least, banding), "prints")
    classes = lines.groupBy("f1").agg(F.first("n").alias("n"), F.first("keys").alias("keys"))

    def texts(ids: DataFrame) -> DataFrame:
        return _lines_of(docs, ids, least, banding).join(ids, "id", "left_semi")

    links = similar(stored(classes.select(F.col("f1").alias("id"), "n", "keys"), "classes"), texts, banding)
    joined = stored(components(links), "components")
    member = lines.select("doc_id", "start", "stop", F.col("f1").alias("node")).join(joined, "node", "left")
    member = stored(member.select("doc_id", "start", "stop", F.coalesce("component", "node").alias("component")), "paragraphs")
    near = member.join(_repeated(member, "component"), "component")
    spans = near.select("doc_id", "start", "stop", "first").unionByName(_shared_runs(docs, least))
    own = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop", "first")).alias("spans"))
    found = in_batches(own, _ranges, "doc_id bigint, start bigint, stop bigint, first_doc bigint")
    return found.withColumn("removed", F.col("first_doc") < F.col("doc_id"))
