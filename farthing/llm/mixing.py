"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Sources share the budget by weight, none above ``most`` times its size; the excess of a full
source goes to the others by weight. A source is taken whole as often as fits its target,
and once more in part: the first rows of a random order, cut where the target is met.

The draws of a source lie in blocks, ranges of the random order that hold drawn rows. The exact
block quotas of all sources are split among output shards by a tree: each node draws, by a
multivariate hypergeometric law, which blocks go to its left half. A shard then takes
its quota from each source's permuted blocks, disjoint from all others, and orders its draws at random.
``takes`` counts the rows so drawn, and says at which places of which shards they lie.

Gathered are one row per source, and counts of slices of thousands of blocks or draws; quotas
are sources x shards numbers.

Defined results: a null text has size 0; null is a source of its own, last; sources without words have target 0
and are not drawn; rows repeating doc_id and text are taken alike; no rows give no
rows; the columns of the input pass through ``mixed`` unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farthing.llm.common import stored, utf8
from farthing.llm.cuts import KEY_BITS, cuts, order_key

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 17
SHARDS = 16
BLOCK_DOCS = 256
#: Blocks, and draws of a shard, that are numbered in one slice, about.
SLICE_BLOCKS, SLICE_DRAWS = 4096, 8192
LEAST_SLICES = 64


@dataclass(frozen=True)
class Share:
    """What the mix takes of one source."""

    source: str | None
    size: int
    rows: int
    target: float
    copies: int
    cut: int
    extras: tuple[int, ...]


def targets(sizes: Sequence[int], weights: Sequence[int], most: int = MOST) -> list[Fraction]:
    """The budget (all sizes) by weight, capped; exact."""
    out = [Fraction(0)] * len(sizes)
    left, open_ = Fraction(sum(sizes)), list(range(len(sizes)))
    while open_ and left > 0:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = Fraction(most * sizes[i])
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in full]
    return out


def _word_counts(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: 0 if t is None else len(t.split())).astype("int64")


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    """Size and order key of each row, as further columns of private names."""
    count = F.pandas_udf(_word_counts, "bigint")
    return docs.select("*", count(utf8("text")).alias("_size"), order_key("doc_id", "text", seed=seed).alias("_key"))


def shares(sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> list[Share]:
    """Targets and cuts per source; ``sized``: a written table of (source, _size, _key)."""
    spark = sized.sparkSession
    found = sized.groupBy("source").agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    found = sorted(found, key=lambda r: (r.source is None, (r.source or "").encode()))
    aims = targets([r["size"] for r in found], [weights[i % len(weights)] for i in range(len(found))], most)
    copies = [int(a // r["size"]) if r["size"] else 0 for a, r in zip(aims, found)]
    if not found:
        return []
    names = spark.createDataFrame([(i, r.source) for i, r in enumerate(found)], f"grp int, name {sized.schema['source'].dataType.simpleString()}")
    keyed = sized.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("name"))).select("grp", F.col("_key").alias("key"), F.col("_size").alias("weight"))
    keyed = stored(keyed, "keys")
    wanted = [(i, round(a - c * r["size"])) for i, (a, c, r) in enumerate(zip(aims, copies, found))]
    got = cuts(keyed, wanted, extras=3)
    return [
        Share(r.source, r["size"], r["n"], float(a), c, cut, tuple(more))
        for r, a, c, (cut, more) in zip(found, aims, copies, got)
    ]


def _by_source(docs: DataFrame, plan: Sequence[Share]) -> DataFrame:
    """The share of each row's source; one row per source is broadcast."""
    spark = docs.sparkSession
    kind = docs.schema["source"].dataType.simpleString()
    known = spark.createDataFrame(
        [(i, s.source, s.size, s.target, s.copies, s.cut, list(s.extras)) for i, s in enumerate(plan)],
        f"_grp int, _source {kind}, _source_size bigint, _target double, _copies int, _cut bigint, _extras array<bigint>",
    )
    return docs.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def _times() -> Column:
    partly = (F.col("_key") < F.col("_cut")) | F.array_contains("_extras", F.col("_key"))
    return F.when(F.col("_source_size") == 0, F.lit(0)).otherwise(F.col("_copies") + partly.cast("int"))


def quotas(blocks: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """(shards, sources) block quotas from the splitting tree; columns add up to ``blocks``."""
    total = int(blocks.sum())
    room = np.full(shards, total // shards, np.int64)
    room[: total % shards] += 1
    out = np.zeros((shards, len(blocks)), np.int64)

    def split(low: int, high: int, held: np.ndarray) -> None:
        if high - low == 1:
            out[low] = held
            return
        mid = (low + high) // 2
        draw = np.random.default_rng([seed, low, high])
        left = draw.multivariate_hypergeometric(held, int(room[low:mid].sum()), method="marginals")
        split(low, mid, left)
        split(mid, high, held - left)

    split(0, shards, np.asarray(blocks, np.int64))
    return out


def _numbered(rows: DataFrame, group: str, *order: str) -> tuple[DataFrame, dict[int, int]]:
    """``rows``, a written table, with ``_number`` from 0 in each group, and the groups' counts.

    ``_slice`` must not fall along the order. Rows are ranked inside slices; the slices' counts are gathered.
    """
    found = sorted((r[group], r["_slice"], r["count"]) for r in rows.groupBy(group, "_slice").count().collect())
    counts: dict[int, int] = {}
    before = []
    for g, part, n in found:
        before.append((g, part, counts.get(g, 0)))
        counts[g] = counts.get(g, 0) + n
    ahead = rows.sparkSession.createDataFrame(before, f"{group} int, _slice bigint, _ahead bigint")
    rank = F.row_number().over(Window.partitionBy(group, "_slice").orderBy(*order)) - 1
    ranked = rows.withColumn("_rank", rank).join(F.broadcast(ahead), [group, "_slice"])
    return ranked.withColumn("_number", F.col("_ahead") + F.col("_rank")).drop("_slice", "_ahead", "_rank"), counts


def _block_shards(drawn: DataFrame, sources: int, shards: int, seed: int) -> DataFrame:
    """(_grp, _copy, _cell, _shard): each source's permuted blocks, dealt by quota."""
    # The slices are in the order of copies, then cells: a cell is below 2^40.
    part = F.col("_copy").cast("bigint") * (1 << KEY_BITS) + (F.col("_cell") / SLICE_BLOCKS).cast("bigint")
    blocks = stored(drawn.select("_grp", "_copy", "_cell").distinct().withColumn("_slice", part), "blocks")
    numbered, held = _numbered(blocks, "_grp", "_cell")
    counts = [held.get(i, 0) for i in range(sources)]
    split = quotas(np.array(counts, np.int64), shards, seed)
    rows = []
    for i, n in enumerate(counts):
        if n:
            stride = next(a for a in range(1 + (seed * 7919 + i * 104729) % n, 2 * n + 2) if math.gcd(a, n) == 1)
            rows += [(i, n, stride, int(lo), int(hi), j) for j, (lo, hi) in enumerate(zip(split[:, i].cumsum() - split[:, i], split[:, i].cumsum())) if hi > lo]
    dealt = drawn.sparkSession.createDataFrame(rows, "_grp int, _n bigint, _stride bigint, _lo bigint, _hi bigint, _shard int")
    places = dealt.select("*", F.explode(F.sequence("_lo", F.col("_hi") - 1)).alias("_place"))
    owned = places.select("_grp", ((F.col("_place") * F.col("_stride")) % F.col("_n")).alias("_number"), "_shard")
    return stored(numbered.join(owned, ["_grp", "_number"]).select("_grp", "_copy", "_cell", "_shard"), "owned")


def _draws(sized: DataFrame, plan: Sequence[Share]) -> DataFrame:
    """Each row as often as it is drawn, with ``_copy`` and the ``_cell`` of its block."""
    per = [(i, max(1, -(-s.rows // BLOCK_DOCS))) for i, s in enumerate(plan)]
    width = sized.sparkSession.createDataFrame(per, "_grp int, _per int")
    cell = (F.col("_key") * F.col("_per") / F.lit(1 << KEY_BITS)).cast("bigint")
    return (
        _by_source(sized, plan).join(F.broadcast(width), "_grp").withColumn("_times", _times()).where("_times > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_times") - 1))).withColumn("_cell", cell)
    )


def _dealt(rows: DataFrame, sized: DataFrame, plan: Sequence[Share], shards: int, seed: int) -> DataFrame:
    """The draws of ``rows`` with ``_shard``, ``_order`` in it and ``_slice`` of the order.

    ``sized``: the written (source, _size, _key) of the same rows.
    """
    owned = _block_shards(_draws(sized, plan), len(plan), shards, seed)
    placed = _draws(rows, plan).join(owned, ["_grp", "_copy", "_cell"])
    order = F.xxhash64(F.lit(seed + 1), "_key", "_copy", "_grp")
    slices = max(LEAST_SLICES, sum(s.rows * (s.copies + 1) for s in plan) // (shards * SLICE_DRAWS))
    part = F.shiftright((F.shiftright("_order", 32) + (1 << 31)) * slices, 32)
    return placed.withColumn("_order", order).withColumn("_slice", part.cast("bigint"))


def takes(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: int = SEED, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, source_size, target, taken, shards, places) of every document.

    ``taken`` is the size of all its draws; for each of them, in the order of copies, ``shards`` and ``places`` say where
    ``mixed`` deals it: the shard, and the place in the shard's order from 0. A document not drawn has 0 and empty arrays.
    """
    sized = _sized(docs.select("doc_id", "source", "text"), seed).select("doc_id", "source", "_size", "_key")
    sized = stored(sized.withColumn("_row", F.monotonically_increasing_id()), "sized")
    plan = shares(sized, weights, most)
    every = _by_source(sized, plan).select(
        "_row", "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target")
    )
    spots = docs.sparkSession.createDataFrame([], "_row bigint, _spots array<struct<_copy: int, _shard: int, _number: bigint>>")
    if any(s.target for s in plan):
        dealt = stored(_dealt(sized, sized, plan, shards, seed).select("_row", "_copy", "_shard", "_order", "_slice"), "dealt")
        numbered, _ = _numbered(dealt, "_shard", "_order", "_copy", "_row")
        spot = F.struct("_copy", "_shard", "_number")
        spots = numbered.groupBy("_row").agg(F.sort_array(F.collect_list(spot)).alias("_spots"))
    found = every.join(spots, "_row", "left").withColumn("_spots", F.coalesce("_spots", F.array()))
    return found.select(
        "doc_id", "size", "source_size", "target", (F.size("_spots") * F.col("size")).cast("bigint").alias("taken"),
        F.transform("_spots", lambda s: s["_shard"]).alias("shards"), F.transform("_spots", lambda s: s["_number"]).alias("places"),
    )


def mixed(docs: DataFrame, shards: int = SHARDS, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The drawn rows, each as often as it is taken, with ``mix_shard``, in shuffled order.

    Every partition holds rows of few shards; inside a shard the order is random. The rows' own columns travel
    as one, so any names will do; one named ``mix_shard`` gives way to the new one.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_whole")
    rows = _sized(docs.select("doc_id", "source", "text", whole), seed).drop("doc_id", "text")
    sized = stored(rows.select("source", "_size", "_key"), "sized")
    plan = shares(sized, weights, most)
    kept = [c for c in docs.columns if c != "mix_shard"]
    if not any(s.target for s in plan):
        return docs.limit(0).select(*(F.col(f"`{c}`") for c in kept), F.lit(0).alias("mix_shard"))
    dealt = _dealt(rows, sized, plan, shards, seed)
    return (
        dealt.repartition("_shard", "_slice").sortWithinPartitions("_shard", "_order")
        .select(*(F.col("_whole").getField(c).alias(c) for c in kept), F.col("_shard").alias("mix_shard"))
    )
