"""Toxicity by class-conditional Kneser-Ney models over folded letters.

Two models of order five, one of toxic and one of ordinary texts, give every symbol
of a text a likelihood. Both back off to one shared model of order five whose counts come
from the two classes together, so a rare expression is judged by what both know of it.
Besides the discounts, ``trust`` shared counts are added to each context: how many is
chosen by the fit.
The alphabet has 32 symbols (letters without accents, a digit, a mark, a gap, three
for other scripts), which bounds each model by 32^5 cells whatever the corpus is, of which languages use
a hundredth; the counts themselves come from every labelled text.

A document is compared by length-normalised log-likelihoods: of the whole text per
symbol, and of its three most toxic words, since a few words vanish in the mean of a
long text. A logistic curve over these and the logarithm of the length, fitted on texts that the
models scoring them have not seen, makes the score.

Defined results: a null or empty text has zero evidence and gets the score of that;
without labels of both classes every score is 0.0; several labels of one document
count as toxic if any is; a null label or doc_id labels nothing; repeated rows are scored each;
other columns of the input are ignored or, in ``without_toxic``, passed on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farthing.llm.common import gathered, in_batches, pieces, utf8
from farthing.llm.words import text_bytes

ORDER, BITS = 5, 5
SYMBOLS = 1 << BITS
CONTEXTS = SYMBOLS ** (ORDER - 1)
DISCOUNT = 0.75
#: Labelled rows, about, that the logistic curve over five numbers is fitted on.
FIT_ROWS = 20_000
#: Shared counts per context to choose from.
TRUSTS = (0.0, 20.0, 60.0)
#: Labels are broadcast up to so many rows, joined by a shuffle beyond.
BROADCAST_LABELS = 2_000_000
GAP, DIGIT, MARK, OTHER = 0, 27, 28, 29


def _symbols() -> np.ndarray:
    """Symbol of each byte; second bytes of Latin letters get the bare letter."""
    out = np.full(256, MARK, np.uint8)
    out[[32, 9, 10, 11, 12, 13]] = GAP
    out[48:58] = DIGIT
    for i in range(26):
        out[65 + i] = out[97 + i] = i + 1
    out[128:] = OTHER + np.arange(128) % 3
    bare = "aaaaaaaceeeeiiii" + "dnooooo" + "\0" + "ouuuuy"
    for i, letter in enumerate(bare):
        if letter != "\0":
            for second in (0x80 + i, 0xA0 + i):  # large and small
                out[second] = ord(letter) - 96
    out[0x9F] = 19
    return out


_SYMBOL = _symbols()
_LEAD = np.arange(256) >= 0xC0


def cells_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cell (last five symbols) of every symbol, and the texts' bounds; then where a gap stands.

    Before the first symbol of a text and after its last stand gaps.
    """
    raw, bounds = text_bytes(column)
    kept = ~_LEAD[raw]
    ahead = np.concatenate([[0], np.cumsum(kept)])[bounds]
    n = len(bounds) - 1
    pad = ORDER  # four gaps before a text, one after
    line = np.zeros(ahead[-1] + pad * n, np.int32)
    place = np.arange(ahead[-1]) + np.repeat(np.arange(n) * pad + ORDER - 1, np.diff(ahead))
    line[place] = _SYMBOL[raw[kept]]
    cell = np.zeros(len(line), np.int32)
    for back in range(ORDER):
        cell[back:] |= line[: len(line) - back] << (BITS * back)
    starts = ahead[:-1] + np.arange(n) * pad
    inner = np.ones(len(line), bool)
    for k in range(ORDER - 1):
        inner[starts + k] = False
    sizes = np.diff(ahead) + 1
    return cell[inner], np.concatenate([[0], np.cumsum(sizes)]), line[inner] == GAP


@dataclass
class Ratios:
    """Log-likelihood differences: of the cells seen, and of each context's other cells.

    An unseen cell gets its share of the shared model from both classes alike, so what
    differs is the mass that each context gives away.
    """

    cells: np.ndarray
    values: np.ndarray
    others: np.ndarray

    def dense(self) -> np.ndarray:
        out = np.repeat(self.others.astype(np.float16), SYMBOLS)
        out[self.cells] = self.values
        return out


@dataclass
class Model:
    """The ratios, and the curve: how evidence becomes a score."""

    ratios: Ratios
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    known: bool = True

    def score(self, evidence: np.ndarray) -> np.ndarray:
        if not self.known:
            return np.zeros(len(evidence))
        z = ((evidence - self.centre) / self.scale) @ self.weights[1:] + self.weights[0]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def ratios(cells: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray, trust: float) -> Ratios:
    """log p(symbol | four before it) of the toxic model minus that of the ordinary one.

    ``cells``: the sorted cells that some labelled text has, with their counts per class.
    """
    seen, types = cells[(toxic + ordinary) > 0], {}
    for order in range(ORDER - 1, 0, -1):  # distinct symbols before each shorter run
        types[order] = np.bincount(seen % SYMBOLS**order, minlength=SYMBOLS**order).astype(np.float64)
        seen = np.flatnonzero(types[order])
    shared = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for order in range(1, ORDER):
        shared = _backed_off(types[order], shared)
    context, low = cells // SYMBOLS, shared[cells % CONTEXTS]

    def above(counts: np.ndarray, low: np.ndarray, trust: float) -> tuple[np.ndarray, np.ndarray]:
        """Likelihood of each cell, and the mass that its context gives to the model below."""
        total = np.bincount(context, counts, CONTEXTS) + trust
        kinds = np.bincount(context, counts > 0, CONTEXTS)
        away = np.where(total > 0, (DISCOUNT * kinds + trust) / np.maximum(total, 1e-9), 1.0)
        return np.maximum(counts - DISCOUNT, 0) / np.maximum(total, 1e-9)[context] + away[context] * low, away

    both, _ = above(toxic + ordinary, low, 0.0)
    (p, gives), (q, leaves) = (above(c, both, trust) for c in (toxic, ordinary))
    return Ratios(cells, (np.log(p) - np.log(q)).astype(np.float32), (np.log(gives) - np.log(leaves)).astype(np.float32))


def _backed_off(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Discounted counts per context; the mass taken off goes to the lower order."""
    rows = counts.reshape(-1, SYMBOLS)
    below = np.tile(lower.reshape(-1, SYMBOLS), (len(rows) * SYMBOLS // lower.size, 1))
    total, kinds = rows.sum(1, keepdims=True), (rows > 0).sum(1, keepdims=True)
    held = np.maximum(rows - DISCOUNT, 0) + DISCOUNT * kinds * below
    return np.where(total > 0, held / np.maximum(total, 1), below).ravel()


def evidence_of(column: pa.Array, ratio: np.ndarray) -> np.ndarray:
    """Per text: mean difference of a symbol, the three most toxic words, log of the length."""
    cell, bounds, gap = cells_of(column)
    n = len(bounds) - 1
    out = np.zeros((n, 5))
    if not n:
        return out
    value = ratio[cell].astype(np.float64)
    out[:, 0] = np.add.reduceat(value, bounds[:-1]) / np.diff(bounds)
    out[:, 4] = np.log(np.diff(bounds))
    opens = gap.copy()
    opens[bounds[:-1]] = True
    at = np.flatnonzero(opens)
    words = np.add.reduceat(value, at)
    text = np.searchsorted(bounds, at, side="right") - 1
    order = np.lexsort((-words, text))
    rank = np.arange(len(at)) - np.searchsorted(text, text)[order]
    for k in range(3):
        best = order[rank == k]
        out[text[best], 1 + k] = words[best]
    return out


def _labelled(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg((F.max("toxic") > 0).alias("is_toxic"))
    )
    if known.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    fold = (F.xxhash64(F.lit("fold"), "doc_id") % 2 != 0).alias("odd")
    chance = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 30)).alias("chance")
    return docs.where(learn).select("doc_id", utf8()).join(known, "doc_id").select("text", "is_toxic", fold, chance)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n): cell and kind of text (class, half) in one number, and its count; at -1 the texts."""
    keys, counts, texts = [], [], 0

    def merged() -> None:
        key, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, np.concatenate(counts)).astype(np.int64)
        keys[:], counts[:] = [key], [total]

    for batch in batches:
        for a, b in pieces(batch, "text"):
            part = batch.slice(a, b - a)
            texts += part.num_rows
            cell, bounds, _ = cells_of(part.column("text"))
            kind = np.asarray(part.column("is_toxic")).astype(np.int32) * 2 + np.asarray(part.column("odd")).astype(np.int32)
            key, n = np.unique(cell * 4 + np.repeat(kind, np.diff(bounds)), return_counts=True)
            keys.append(key)
            counts.append(n)
            if sum(map(len, keys)) > 1 << 22:
                merged()
    if keys:
        keys.append(np.array([-1], np.int32))
        counts.append(np.array([texts]))
        merged()
        for a in range(0, len(keys[0]), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(keys[0][a : a + (1 << 16)]), pa.array(counts[0][a : a + (1 << 16)])], ["key", "n"])


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> Model:
    """Both models and the curve, from the labelled texts that ``learn`` allows."""
    spark = docs.sparkSession
    rows = _labelled(docs, labels, F.lit(True) if learn is None else learn)
    key, n = gathered(in_batches(rows, _count, "key int, n bigint").groupBy("key").agg(F.sum("n").alias("n")))
    texts = int(n[key < 0].sum())
    key, n = key[key >= 0].astype(np.int64), n[key >= 0]
    cells = np.unique(key // 4)
    counts = np.zeros((4, len(cells)))  # ordinary and toxic texts, each in two halves
    counts[key % 4, np.searchsorted(cells, key // 4)] = n

    def whole(trust: float) -> Ratios:
        return ratios(cells, counts[2] + counts[3], counts[0] + counts[1], trust)

    unknown = Model(whole(0.0), np.zeros(6), np.zeros(5), np.ones(5), known=False)
    if not counts[:2].any() or not counts[2:].any():
        return unknown
    sample = rows.where(F.col("chance") < min(1 << 30, FIT_ROWS * (1 << 30) // max(1, texts)))
    curves = []
    for trust in TRUSTS:
        # Each half of the labelled texts is judged by models of the other half.
        halves = [ratios(cells, counts[3], counts[1], trust), ratios(cells, counts[2], counts[0], trust)]
        x, y = _judged(sample, halves)
        if len(y) and y.min() < y.max():
            centre, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
            model = Model(whole(trust), _logistic((x - centre) / scale, y), centre, scale)
            p = np.clip(model.score(x), 1e-9, 1 - 1e-9)
            curves.append((-float(np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))), trust, model))
    return min(curves, key=lambda c: c[:2])[2] if curves else unknown


def _judged(sample: DataFrame, halves: list[Ratios]) -> tuple[np.ndarray, np.ndarray]:
    """Evidence and class of the sampled texts."""
    shared = sample.sparkSession.sparkContext.broadcast(halves)
    names = ["whole", "first", "second", "third", "length"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = [r.dense() for r in shared.value]
        for batch in batches:
            for a, b in pieces(batch, "text"):
                part = batch.slice(a, b - a)
                odd = np.asarray(part.column("odd")).astype(int)
                both = [evidence_of(part.column("text"), r) for r in dense]
                own = np.where(odd[:, None] == 0, both[0], both[1])
                yield pa.RecordBatch.from_arrays([*map(pa.array, own.T), part.column("is_toxic")], [*names, "is_toxic"])

    schema = ", ".join(f"{n} double" for n in names) + ", is_toxic boolean"
    found = in_batches(sample.select("text", "odd", "is_toxic"), work, schema).toPandas().sort_values([*names, "is_toxic"])
    return found[names].to_numpy(float), found["is_toxic"].to_numpy(float)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Newton steps with a ridge on the slopes, which keeps separable data finite."""
    x = np.column_stack([np.ones(len(x)), x])
    w, keep = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + keep, x.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row, over whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = shared.value.ratios.dense()
        for batch in batches:
            for a, b in pieces(batch, "text"):
                part = batch.slice(a, b - a)
                got = shared.value.score(evidence_of(part.column("text"), dense))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(got)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_batches(docs.select("doc_id", utf8()), judged, f"doc_id {kind}, score double")


def without_toxic(docs: DataFrame, model: Model, limit: float = 0.3) -> DataFrame:
    """The rows scored below ``limit``, with all their columns, in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = shared.value.ratios.dense()
        for batch in batches:
            for a, b in pieces(batch, "text"):
                part = batch.slice(a, b - a)
                got = shared.value.score(evidence_of(part.column("text").cast(pa.binary()), dense))
                yield part.filter(pa.array(got < limit))

    return in_batches(docs, below, docs.schema)
