"""Exact cuts of weighted rows in a random order, without sorting a group.

Rows have a group, an order key of ``KEY_BITS`` bits and a weight. A cut is the key
below which a group's rows weigh as close to a wanted sum as whole rows allow. Each round counts
the weight of 256 equal ranges of keys and goes on in the one that holds the cut, until it
has few rows; those are read. Nothing but counts of ranges and those few rows
reaches the driver, 256 numbers per cut and round.

Rows with one key stay on one side: they repeat each other.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_BITS = 40
RANGES = 256
FEW_ROWS = 500


def order_key(*columns: str | Column, seed: int) -> Column:
    """A random, repeatable order of rows."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 64 - KEY_BITS)


def cuts(rows: DataFrame, wanted: Sequence[tuple[int, int]], extras: int = 0) -> list[tuple[int, list[int]]]:
    """For each (group, sum): the cut, and up to ``extras`` keys beyond it that fill what is left.

    ``rows``: (grp int, key bigint, weight bigint), a written table. The wanted sums of
    one group may be any number; each is found on its own.
    """
    spark = rows.sparkSession
    state = {i: (g, 0, 1 << KEY_BITS, 0, want) for i, (g, want) in enumerate(wanted)}
    found: dict[int, tuple[int, list[int]]] = {i: (0, []) for i, (_, _, _, _, want) in state.items() if want <= 0}
    open_ = {i: s for i, s in state.items() if i not in found}
    while open_:
        ranges = spark.createDataFrame(
            [(i, g, low, high) for i, (g, low, high, _, _) in open_.items()], "cut int, grp int, low bigint, high bigint"
        )
        inside = rows.join(F.broadcast(ranges), "grp").where("key >= low and key < high")
        step = F.greatest(F.lit(1), F.ceil((F.col("high") - F.col("low")) / RANGES)).cast("bigint")
        cell = ((F.col("key") - F.col("low")) / step).cast("bigint")
        counted = defaultdict(dict)
        for r in inside.groupBy("cut", cell.alias("cell")).agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n")).collect():
            counted[r.cut][r.cell] = (r.w, r.n)
        small, after = [], {}
        for i, (g, low, high, before, want) in open_.items():
            width = max(1, -(-(high - low) // RANGES))
            for c in sorted(counted[i]):
                w, n = counted[i][c]
                if before + w > want:
                    here = (g, low + c * width, min(high, low + (c + 1) * width), before, want)
                    if n <= FEW_ROWS or width == 1:
                        small.append((i, here))
                    else:
                        after[i] = here
                    break
                before += w
            else:
                found[i] = (high, [])
        found.update(_read(rows, small, extras))
        open_ = after
    return [found[i] for i in range(len(wanted))]


def _read(rows: DataFrame, small: list, extras: int) -> dict[int, tuple[int, list[int]]]:
    """The cuts inside ranges of few rows (or of one key, whose rows are one)."""
    if not small:
        return {}
    ranges = rows.sparkSession.createDataFrame([(i, s[0], s[1], s[2]) for i, s in small], "cut int, grp int, low bigint, high bigint")
    inside = rows.join(F.broadcast(ranges), "grp").where("key >= low and key < high")
    held = defaultdict(list)
    for r in inside.groupBy("cut", "key").agg(F.sum("weight").alias("w")).collect():
        held[r.cut].append((r.key, r.w))
    out = {}
    for i, (_, low, high, before, want) in small:
        cut, left, rest = high, want - before, []
        for n, (key, w) in enumerate(sorted(held[i])):
            if w > left:
                cut, rest = key, sorted(held[i])[n:]
                break
            left -= w
        more = []
        for _ in range(extras):  # the row that comes closest to what is left
            best = min((x for x in rest if x[0] not in more), key=lambda x: (abs(left - x[1]), x[0]), default=None)
            if best is None or abs(left - best[1]) >= abs(left):
                break
            more.append(best[0])
            left -= best[1]
        out[i] = (cut, more)
    return out
