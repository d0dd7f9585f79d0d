"""A Bloom filter of fixed size: drops, before a shuffle, rows that a join would drop after it.

It holds 2^26 bits whatever the data, so it may be broadcast. It lets every wanted code
pass; others pass the more often the fuller it is, and the join that follows drops them. With
far more codes than bits it saves nothing and costs no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farthing.llm.common import gathered, in_batches
from farthing.llm.words import mixed

WORDS = 1 << 20
_SALTS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)


def _places(codes: np.ndarray) -> Iterator[np.ndarray]:
    for salt in _SALTS:
        yield (mixed(codes ^ np.uint64(salt)) >> np.uint64(38)).astype(np.int64)


@dataclass
class Sieve:
    bits: np.ndarray

    def might_hold(self, codes: np.ndarray) -> np.ndarray:
        codes = codes.view(np.uint64)
        out = np.ones(len(codes), bool)
        for at in _places(codes):
            out &= (self.bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0
        return out


def sieve_of(codes: DataFrame) -> Sieve:
    """From the one bigint column; 2^20 words at most are gathered."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(WORDS, np.uint64)
        for batch in batches:
            for at in _places(batch.column(0).drop_null().to_numpy().view(np.uint64)):
                np.bitwise_or.at(bits, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        word = np.flatnonzero(bits)
        for a in range(0, len(word), 1 << 16):
            own = word[a : a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(bits[own].view(np.int64))], ["word", "bits"])

    word, held = gathered(in_batches(codes, work, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")))
    bits = np.zeros(WORDS, np.uint64)
    bits[word] = held.view(np.uint64)
    return Sieve(bits)
