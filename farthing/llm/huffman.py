"""Length-limited canonical Huffman codes for token ids, coded and decoded in numpy.

``lengths`` are optimal under a limit (package-merge); codes are canonical, so the lengths alone
restore them. A stream is cut into blocks of ``BLOCK`` ids; each has a checkpoint,
the bit where it starts, and is decoded without the others by one table of 2^limit entries.
"""

from __future__ import annotations

import numpy as np

LIMIT = 20
BLOCK = 1024


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Length of each symbol's code (0: does not occur), of least total under ``limit``.

    Package-merge over sorted weights: in each of ``limit`` rounds the packages, pairs of the
    last round's items, join the symbols; a symbol's length is how often it is chosen.
    """
    symbols = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(symbols)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need codes of more than {limit} bits")
    if n <= 1:
        out[symbols] = 1
        return out
    order = symbols[np.argsort(counts[symbols], kind="stable")]
    weight = counts[order].astype(np.int64)
    # Each round's list, as weights and whether an item is a symbol; a prefix of it holds
    # the lightest symbols and packages, so a prefix length says all about a choice.
    is_symbol, held = [], weight
    is_symbol.append(np.ones(n, bool))
    for _ in range(limit - 1):
        pairs = held[: len(held) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weight, pairs])
        place = np.argsort(both, kind="stable")
        held = both[place]
        is_symbol.append(place < n)
    lengths = np.zeros(n, np.int64)
    take = 2 * n - 2
    for kinds in reversed(is_symbol):
        chosen = int(kinds[:take].sum())
        lengths[:chosen] += 1
        take = 2 * (take - chosen)
    out[order] = lengths
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then symbol."""
    codes = np.zeros(len(lengths), np.uint32)
    code = at = 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    for size in range(1, int(lengths.max(initial=0)) + 1):
        code <<= 1
        own = order[at : at + int((lengths == size).sum())]
        codes[own] = code + np.arange(len(own))
        code += len(own)
        at += len(own)
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Bits of the table, and symbol and length for each value of the next bits."""
    bits = max(1, int(lengths.max(initial=0)))
    codes = canonical(lengths)
    known = np.flatnonzero(lengths)
    order = known[np.lexsort((known, lengths[known]))]
    spans = 1 << (bits - lengths[order].astype(np.int64))
    symbol, size = np.zeros(1 << bits, np.uint32), np.zeros(1 << bits, np.uint8)
    if len(order):
        assert (codes[order].astype(np.int64) << (bits - lengths[order].astype(np.int64)) == np.cumsum(spans) - spans).all()
        filled = int(spans.sum())
        symbol[:filled], size[:filled] = np.repeat(order, spans), np.repeat(lengths[order], spans)
    return bits, symbol, size


def encode(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit stream, and the bit where each block of ``BLOCK`` ids starts (and the end)."""
    if not len(ids):
        return b"", np.zeros(1, np.int64)
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    word, shift = starts >> 5, (starts & 31)
    # A code lies in one 64-bit window that starts at a 32-bit word.
    value = codes[ids].astype(np.uint64) << (64 - shift - size).astype(np.uint64)
    heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    window = np.bitwise_or.reduceat(value, heads)
    out = np.zeros(int(ends[-1] >> 5) + 2, np.uint32)
    at = word[heads]
    out[at] |= (window >> np.uint64(32)).astype(np.uint32)
    out[at + 1] |= (window & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    marks = np.append(starts[::BLOCK], ends[-1])
    return out.astype(">u4").tobytes()[: (int(ends[-1]) + 7) // 8], marks


def decode(stream: bytes, marks: np.ndarray, n: int, table: tuple[int, np.ndarray, np.ndarray]) -> np.ndarray:
    """All ids; every block starts at its checkpoint, and all advance side by side."""
    bits, symbol, size = table
    raw = np.frombuffer(stream + bytes(8), np.uint8).astype(np.uint32)
    window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    blocks = len(marks) - 1
    out = np.zeros((blocks, BLOCK), np.uint32)
    at = marks[:-1].astype(np.int64).copy()
    last = n - (blocks - 1) * BLOCK
    shift = np.uint32(32 - bits)
    for k in range(min(BLOCK, n)):
        if k == last:  # the last block may be shorter
            at = at[:-1]
        own = (window[at >> 3] << (at & 7).astype(np.uint32)) >> shift
        out[: len(at), k] = symbol[own]
        at += size[own]
    return out.ravel()[:n]
