"""Resharding by minimum-cost flow.

Old shards with their sizes and new shards with their capacities are the two sides
of a transport problem; a byte that stays costs nothing, a moved one its price. The
flow of least cost says how many bytes go from each old shard to each new one. The
rows of an old shard lie in a random order, and the flow's amounts cut it into blocks, one per
receiver; the first block is what stays. Then the files of all affected shards are rewritten.

The flow runs on the driver over shards, not rows; cuts are found by counts (``cuts``).

Defined results: a null text has size 1 like an empty one; rows repeating doc_id and text move
together; a null source is an own key of the old layout; no rows give no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farthing.llm.common import new_folder, stored
from farthing.llm.cuts import KEY_BITS, cuts, order_key

OLD_SHARDS = 12
NEW_SHARDS = 16
SEED = 23
#: Rows that one numbered range of a shard holds, about.
SLOT_ROWS = 512


def least_cost_flow(supply: Sequence[int], room: Sequence[int], price) -> dict[tuple[int, int], int]:
    """Bytes from each old to each new shard at least cost; all supplies are placed.

    Shortest augmenting paths with node prices (Dijkstra on reduced costs, which
    stay at or above zero). Needs sum(room) >= sum(supply).
    """
    old, new = len(supply), len(room)
    left, free = list(supply), list(room)
    flow: dict[tuple[int, int], int] = {}
    high_old, high_new = [0] * old, [0] * new
    while any(left):
        # Distances from all old shards with bytes left, over forward and used edges.
        dist_old = [0 if left[i] else None for i in range(old)]
        dist_new: list = [None] * new
        came: dict[int, int] = {}
        back: dict[int, int] = {}
        done_old, done_new = set(), set()
        while True:
            at = [(d, 0, i) for i, d in enumerate(dist_old) if d is not None and i not in done_old]
            at += [(d, 1, j) for j, d in enumerate(dist_new) if d is not None and j not in done_new]
            if not at:
                break
            d, side, k = min(at)
            if side == 0:
                done_old.add(k)
                for j in range(new):
                    reach = d + price(k, j) + high_old[k] - high_new[j]
                    if dist_new[j] is None or reach < dist_new[j]:
                        dist_new[j], came[j] = reach, k
            else:
                done_new.add(k)
                for i in range(old):
                    if flow.get((i, k)):
                        reach = d - price(i, k) + high_new[k] - high_old[i]
                        if dist_old[i] is None or reach < dist_old[i]:
                            dist_old[i], back[i] = reach, k
        goals = [(dist_new[j] + high_new[j], j) for j in range(new) if free[j] and dist_new[j] is not None]
        end = min(goals)[1]
        path, j = [], end
        while True:
            i = came[j]
            path.append((i, j, 1))
            if i not in back or (left[i] and dist_old[i] == 0):
                break
            path.append((i, back[i], -1))
            j = back[i]
        start = path[-1][0]
        amount = min([left[start], free[end], *(flow[i, k] for i, k, sign in path if sign < 0)])
        for i, k, sign in path:
            flow[i, k] = flow.get((i, k), 0) + sign * amount
        left[start] -= amount
        free[end] -= amount
        for i in range(old):
            high_old[i] += dist_old[i] or 0
        for k in range(new):
            high_new[k] += dist_new[k] or 0
    return {k: v for k, v in flow.items() if v}


def old_layout(shards: int = OLD_SHARDS) -> Column:
    """The layout before: whole sources, so a large source makes a large shard."""
    return F.pmod(F.crc32(F.coalesce(F.col("source"), F.lit("\0")).cast("binary")), F.lit(shards)).cast("int")


def reshard(docs: DataFrame, old: Column, shards: int = NEW_SHARDS, seed: int = SEED) -> tuple[DataFrame, dict]:
    """Rewritten rows (doc_id, text, shard, old_shard, key) and the plan's figures.

    Shards that nothing enters or leaves keep their files: their rows are read from ``docs``.
    """
    rows = docs.select("doc_id", "text", old.alias("old_shard"), order_key("doc_id", "text", seed=seed).alias("key"))
    weight = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint")
    keys = stored(rows.select(F.col("old_shard").alias("grp"), "key", weight.alias("weight")), "keys")
    held = {r.grp: r.w for r in keys.groupBy("grp").agg(F.sum("weight").alias("w")).collect()}
    names = sorted(held)
    total = sum(held.values())
    room = [total // shards + (k < total % shards) for k in range(shards)]
    flow = least_cost_flow([held[g] for g in names], room, lambda i, j: 0 if names[i] == j else 1)
    wanted, ends = [], []
    for i, g in enumerate(names):
        parts = sorted(((j, n) for (k, j), n in flow.items() if k == i), key=lambda x: (x[0] != g, x[0]))
        done = 0
        for j, n in parts:
            done += n
            wanted.append((g, done))
            ends.append((g, j))
    found = cuts(keys, wanted)
    blocks: dict[int, list] = {}
    for (g, j), (cut, _) in zip(ends, found):
        blocks.setdefault(g, []).append((cut, j))
    for parts in blocks.values():
        parts[-1] = (1 << KEY_BITS, parts[-1][1])
    spark = docs.sparkSession
    table = spark.createDataFrame(
        [(g, [c for c, _ in p], [j for _, j in p]) for g, p in blocks.items()], "old_shard int, ends array<bigint>, receivers array<int>"
    )
    receiver = F.expr("receivers[size(filter(ends, e -> e <= key))]")
    placed = rows.join(F.broadcast(table), "old_shard").select("doc_id", "text", receiver.alias("shard"), "old_shard", "key")
    still = [g for g in names if set(flow.get((names.index(g), j), 0) and j for j in range(shards)) <= {0, g} and all(k == names.index(g) or j != g for k, j in flow)]
    moved = sum(n for (i, j), n in flow.items() if names[i] != j)
    affected = placed.where(~F.col("shard").isin(still)) if still else placed
    path = new_folder(spark, "shards")
    # Ranges of (shard, key): one shard, however large, is written by many tasks.
    affected.repartitionByRange("shard", "key").sortWithinPartitions("shard", "key").write.partitionBy("shard").parquet(path)
    fields = "doc_id {}, text string, old_shard int, key bigint, shard int".format(docs.schema["doc_id"].dataType.simpleString())
    out = spark.read.schema(fields).parquet(path)
    if still:
        out = out.unionByName(placed.where(F.col("shard").isin(still)))
    return out, {"moved_bytes": moved, "total_bytes": total, "flow": {(names[i], j): n for (i, j), n in flow.items()}, "path": path}


def slots(rows: DataFrame) -> DataFrame:
    """``slot``: the gapless number of each row in its shard, by key.

    Shards are numbered in ranges of keys of about ``SLOT_ROWS`` rows each.
    """
    sizes = stored(rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")), "sizes")
    ranges = F.greatest(F.lit(1), F.ceil(F.col("n") / SLOT_ROWS)).cast("bigint")
    cells = rows.join(F.broadcast(sizes), "shard").withColumn("cell", (F.col("key") * ranges / F.lit(1 << KEY_BITS)).cast("bigint")).drop("n")
    cells = stored(cells, "cells")
    counts = cells.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")), "starts")
    inside = Window.partitionBy("shard", "cell").orderBy("key", "doc_id")
    numbered = cells.withColumn("_row", F.row_number().over(inside) - 1)
    return numbered.join(starts, ["shard", "cell"]).withColumn("slot", (F.col("ahead") + F.col("_row")).cast("bigint")).drop("_row", "ahead", "cell")
