"""Quality rules: zstandard compression bands over whole texts and fixed chunks.

A text that compresses far better than prose of its length repeats itself; one that
hardly compresses is noise. ``BANDS`` gives the allowed ratio of raw to compressed
bytes by length; a whole text must lie in the band of its length, and at least half
of its chunks (by bytes) in the band of theirs.

Defined results: a null or empty text has no words, fails the base rules and has no
ratio; repeated rows are judged each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from farthing.llm.common import in_batches, pieces, utf8
from farthing.llm.words import SPACED_CASED, mixed, runs, text_bytes, words_of

#: (least bytes, lowest ratio, highest ratio); the last whose least length fits holds.
BANDS = ((0, 0.5, 4.0), (256, 1.05, 5.0), (1024, 1.2, 6.5), (4096, 1.4, 8.0), (16384, 1.5, 10.0), (65536, 1.5, 12.0))
CHUNK_BYTES = 4096
LEVEL = 3
MIN_WORDS = 50
REPEAT_SHARE = 50
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_FIELDS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, ratio double, chunk_share double, kept boolean"


def band(size: int) -> tuple[float, float]:
    return next((low, high) for least, low, high in reversed(BANDS) if size >= least)


def _ratio(press: zstandard.ZstdCompressor, raw: bytes) -> float:
    return len(raw) / len(press.compress(raw))


def _bands(press: zstandard.ZstdCompressor, raw: bytes) -> tuple[float, float, bool]:
    """Ratio of the whole, share of bytes in chunks within their band, verdict."""
    whole = _ratio(press, raw)
    low, high = band(len(raw))
    fit = 0
    for a in range(0, len(raw), CHUNK_BYTES):
        chunk = raw[a : a + CHUNK_BYTES]
        least, most = band(len(chunk))
        fit += len(chunk) * (least <= _ratio(press, chunk) <= most)
    share = fit / len(raw)
    return whole, share, low <= whole <= high and share >= 0.5


def _repeated_lines(raw: bytes) -> int:
    seen: set[bytes] = set()
    again = 0
    for line in raw.split(b"\n"):
        if line.split():
            again += line in seen
            seen.add(line)
    return again


def _repeat_words(codes: np.ndarray, first: np.ndarray, size: int = 3) -> np.ndarray:
    """Per text: words inside ``size``-word windows that the text has twice or more."""
    n = len(first) - 1
    window, at = runs(codes, first, size)
    if not len(at):
        return np.zeros(n, np.int64)
    text = np.searchsorted(first, at, side="right") - 1
    own = mixed(window + mixed(text.astype(np.uint64) + np.uint64(1)))
    _, place, count = np.unique(own, return_inverse=True, return_counts=True)
    hit = np.zeros(len(codes), bool)
    twice = at[count[place] > 1]
    for k in range(size):
        hit[twice + k] = True
    return np.diff(np.concatenate([[0], np.cumsum(hit)])[first])


def judge(column: pa.Array, press: zstandard.ZstdCompressor) -> list[pa.Array]:
    raw, bounds = text_bytes(column)
    w = words_of(column, SPACED_CASED)
    n = len(bounds) - 1

    def total(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[bounds])

    n_words = np.diff(w.first)
    chars = total((SPACED_CASED[raw] != 0) & ((raw & 0xC0) != 0x80))
    symbols = total(_SYMBOLS[raw])
    repeats = _repeat_words(w.codes, w.first)
    texts = [raw[bounds[i] : bounds[i + 1]].tobytes() for i in range(n)]
    lines = np.array([_repeated_lines(t) for t in texts], np.int64)
    failed = (n_words < MIN_WORDS) | (100 * repeats > REPEAT_SHARE * n_words)
    found = [_bands(press, t) if t else (None, None, False) for t in texts]
    return [
        *(pa.array(x.astype(np.int64)) for x in (n_words, chars, symbols, lines, repeats)),
        pa.array(failed),
        pa.array([f[0] for f in found], pa.float64()),
        pa.array([f[1] for f in found], pa.float64()),
        pa.array([bool(f[2] and not bad) for f, bad in zip(found, failed)], pa.bool_()),
    ]


def compression_bands(docs: DataFrame) -> DataFrame:
    """One row per document: its counts, base rules, ratios and verdict."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
        for batch in batches:
            for a, b in pieces(batch, "text"):
                part = batch.slice(a, b - a)
                names = ["doc_id", *(f.split()[0] for f in _FIELDS.split(", "))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *judge(part.column("text"), press)], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_batches(docs.select("doc_id", utf8()), work, f"doc_id {kind}, {_FIELDS}")
