"""Words of many texts at once, as 64-bit codes.

A text is cut on its UTF-8 bytes with a table that says which bytes separate
words; a word's code is the sum of one random number per (place, byte), so equal
words have equal codes in every task and different ones differ but for a chance of
about 2^-64 per pair.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

_PLACES = 64
_RANDOM = np.random.Generator(np.random.PCG64(20240611)).integers(1, 2**63, (_PLACES, 256), dtype=np.uint64).ravel()
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _byte_table(separators, fold: bool) -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    if fold:
        out[65:91] += 32
    out[list(separators)] = 0
    return out


_SPACE = (0x20, *range(0x09, 0x0E))
#: Words are runs of anything but space and U+0009 to U+000D; A-Z lower-cased or not.
SPACED = _byte_table(_SPACE, fold=True)
SPACED_CASED = _byte_table(_SPACE, fold=False)
#: Words are runs of 0-9, a-z (A-Z lower-cased) and all beyond U+007F.
ALNUM = _byte_table([b for b in range(128) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123)], fold=True)
# U+0000 is an ordinary word character between spaces; 1 stands for it, and for U+0001.
SPACED[0] = SPACED_CASED[0] = 1


@dataclass
class Words:
    """``codes`` of all words; text ``i`` has ``codes[first[i]:first[i + 1]]``."""

    codes: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column and the row bounds in them; nulls are empty."""
    column = column.cast(pa.large_binary())
    n = len(column)
    bounds = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if column.null_count:
        lengths = np.where(np.asarray(column.is_valid()), np.diff(bounds), 0)
        if (np.diff(bounds) != lengths).any():
            return text_bytes(column.fill_null(b""))
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def words_of(column: pa.Array, kind: np.ndarray) -> Words:
    """All words of a binary column; ``kind`` is one of the byte tables above."""
    raw, bounds = text_bytes(column)
    seen = kind[raw]
    inside = seen != 0
    fresh, last = inside.copy(), inside.copy()
    fresh[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    inner = bounds[(bounds > 0) & (bounds < len(raw))]
    fresh[inner] |= inside[inner]
    last[inner - 1] |= inside[inner - 1]
    starts, ends = np.flatnonzero(fresh), np.flatnonzero(last) + 1
    first = np.searchsorted(starts, bounds)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), first, starts, ends)
    lengths = ends - starts
    total = int(lengths.sum())
    offsets = np.zeros(len(starts), np.int64)
    np.cumsum(lengths[:-1], out=offsets[1:])
    place = np.arange(total, dtype=np.int64) - np.repeat(offsets, lengths)
    letters = seen[inside].astype(np.int64)
    codes = np.add.reduceat(_RANDOM[((place & (_PLACES - 1)) << 8) | letters], offsets)
    for i in np.flatnonzero(lengths > _PLACES):  # the places come round again: another code
        codes[i] = xxhash.xxh64_intdigest(seen[starts[i] : ends[i]].tobytes())
    return Words(mixed(codes), first, starts, ends)


def runs(codes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all ``size``-word runs inside texts, and the place where each starts."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * _STEP + codes[k : k + n]
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(text[:n] == text[size - 1 :])
    return mixed(out[at]), at


def whole(codes: np.ndarray) -> np.uint64:
    """The code of a sequence of words shorter than a run; its length counts."""
    out = np.uint64(len(codes))
    with np.errstate(over="ignore"):
        for c in codes:
            out = out * _STEP + c
    return mixed(np.array([out ^ np.uint64(0xA5A5A5A55A5A5A5A)], np.uint64))[0]


def shingle_sets(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``size``-word shingles of every text, sorted, and their bounds.

    A text with fewer words, but some, has one shingle: its whole sequence.
    """
    codes, at = runs(w.codes, w.first, size)
    n = len(w.first) - 1
    text = np.searchsorted(w.first, at, side="right") - 1
    counts = np.diff(w.first)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        codes = np.concatenate([codes, np.array([whole(w.codes[w.first[i] : w.first[i + 1]]) for i in short], np.uint64)])
        text = np.concatenate([text, short])
    order = np.lexsort((codes, text))
    codes, text = codes[order], text[order]
    if len(codes):
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != codes[:-1]) | (text[1:] != text[:-1])
        codes, text = codes[keep], text[keep]
    return codes, np.searchsorted(text, np.arange(n + 1))
