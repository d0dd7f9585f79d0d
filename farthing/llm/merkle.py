"""Merkle manifest of a table, built by time-forward processing.

Every row is a leaf. The leaves of a group, in order, are hashed three at a time until one
node is left, the group's subroot; the subroots, in the order of their groups, are hashed
the same way to the root. Nodes carry labels that rise from leaf to root, and each node
sends its digest to its parent's label through a priority queue ordered by label. The queue
is external: messages to labels of the same bundle (``SPAN`` neighbouring nodes and all above them, up
to one top) wait in a heap of bounded size, and those to later labels go to a written table,
which the next round's shuffle hands over sorted by label. A sweep in the reversed order then
sends proof suffixes down: a node takes its own from the queue and sends every child
the siblings of that child with the suffix behind them. One message per bundle crosses tasks, not
one per leaf, and a group with a third of all rows is as many bundles as its size asks for.

A proof is two lists, from the leaf upwards: what stands before the node among the digests
that are hashed together, and what stands after it. ``folded`` computes the root from a leaf and its proof.

Defined results: a null field counts as ``-``; rows with a null group are a group of their own, before
all others; null order values come first; ties of the order follow the leaf's digest, and repeated rows are
a leaf each; an empty table has no rows (and no root); other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from hashlib import sha256
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farthing.llm.common import in_batches, stored

ARITY = 3
#: Levels inside a bundle, and nodes of its lowest level.
HEIGHT = 6
SPAN = ARITY**HEIGHT

_LINKS = [("key", pa.string()), ("place", pa.int64()), ("subroot", pa.string()), ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))]
_NODE = "key string, place bigint, total bigint, digest string"


def digest_of(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def framed(column: str) -> Column:
    """A field as ``bytes:value``, or ``-`` for null: no two different rows read alike."""
    value = F.col(column).cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(fields: Sequence[str], **changed: Column) -> Column:
    """The digest of a row; ``changed`` gives other contents for some fields."""
    parts = [framed(c) for c in fields]
    for name, value in changed.items():
        text = value.cast("string")
        parts[list(fields).index(name)] = F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return digest_of(*parts)


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (a written table with a string column ``key``) with ``place`` in the key's order, and the key's ``total``.

    Range partitions are numbered on their own; what lies before them comes from their counts per
    key, so that no key is ever in one task.
    """
    dealt = rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, key, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for own in batch.column("key").to_pylist():
                key, seen = own, seen + 1 if own == key else 0
                places.append(seen)
            columns = [*batch.columns, pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "part_", "place_"])

    own = stored(in_batches(dealt, work, f"{fields}, part_ int, place_ bigint"), "numbered")
    counts = own.groupBy("key", "part_").agg(F.count(F.lit(1)).alias("rows_"))
    before = Window.partitionBy("key").orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.select(
        "key", "part_", F.coalesce(F.sum("rows_").over(before), F.lit(0)).alias("base_"), F.sum("rows_").over(Window.partitionBy("key")).alias("total")
    )
    return own.join(placed, ["key", "part_"]).select(*rows.columns, (F.col("place_") + F.col("base_")).alias("place"), "total")


# -- one bundle ------------------------------------------------------------------


def _levels(count: int, total: int) -> int:
    """Levels above the lowest of a bundle: all of ``HEIGHT`` if the group goes on above it."""
    if total > SPAN:
        return HEIGHT
    levels = 0
    while count > 1:
        count, levels = -(-count // ARITY), levels + 1
    return levels


def rise(digests: Sequence[str], levels: int) -> list[list[str]]:
    """Digests of all nodes by level, in the order in which the queue hands them over."""
    nodes: list[list[str]] = [list(digests)] + [[] for _ in range(levels)]
    queue = [(1, i // ARITY, i, d) for i, d in enumerate(digests)] if levels else []
    while queue:
        level, place = queue[0][:2]
        children = []
        while queue and queue[0][:2] == (level, place):
            children.append(heapq.heappop(queue)[3])
        own = sha256("".join(children).encode()).hexdigest()
        nodes[level].append(own)
        if level < levels:
            heapq.heappush(queue, (level + 1, place // ARITY, place, own))
    return nodes


def fall(nodes: list[list[str]], suffix: tuple) -> list[tuple]:
    """Proofs of the lowest nodes, as chains (before, after, rest); ``suffix`` is the top's."""
    proofs: list[tuple] = [()] * len(nodes[0])
    queue = [(-(len(nodes) - 1), 0, suffix)]
    while queue:
        level, place, own = heapq.heappop(queue)
        level, place = -level, -place
        if not level:
            proofs[place] = own
            continue
        first = place * ARITY
        run = nodes[level - 1][first : first + ARITY]
        for k in range(len(run)):
            heapq.heappush(queue, (1 - level, -(first + k), ("".join(run[:k]), "".join(run[k + 1 :]), own)))
    return proofs


def _unchained(proof: tuple) -> tuple[list[str], list[str]]:
    before, after = [], []
    while proof:
        before.append(proof[0])
        after.append(proof[1])
        proof = proof[2]
    return before, after


# -- bundles of a task -------------------------------------------------------------


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[dict[str, Any]]]]:
    """The rows of each (key, bundle), which arrive together and in order: at most ``SPAN`` and one message."""
    label, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            own = (row["key"], row["bundle"])
            if own != label and held:
                yield *label, held
                held = []
            label = own
            held.append(row)
    if held:
        yield *label, held


def _in_label_order(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "bundle").sortWithinPartitions("key", "bundle", "place")


def _sent_up(nodes: DataFrame) -> DataFrame:
    """One round upwards: the top of every bundle, as a node of the next level."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        schema = pa.schema([("key", pa.string()), ("place", pa.int64()), ("total", pa.int64()), ("digest", pa.string())])
        for key, bundle, rows in _bundles(batches):
            total = rows[0]["total"]
            top = rise([r["digest"] for r in rows], _levels(len(rows), total))[-1][0]
            out.append({"key": key, "place": bundle, "total": -(-total // SPAN), "digest": top})
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema)

    rows = nodes.select("key", "place", "total", "digest", F.expr(f"place div {SPAN}").alias("bundle"))
    return in_batches(_in_label_order(rows), work, _NODE)


def _sent_down(nodes: DataFrame, messages: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """One round downwards: every node of the level with its proof, from the suffixes of its bundles' tops.

    ``messages``: (key, place of the bundle, subroot, before, after). ``carried`` are string columns of the nodes.
    """
    names = ["total", "digest", *carried]
    proofs = [F.lit(None).cast("string").alias("subroot"), *(F.lit(None).cast("array<string>").alias(c) for c in ("before", "after"))]
    rows = nodes.select("key", F.expr(f"place div {SPAN}").alias("bundle"), "place", *names, *proofs)
    first = messages.select(
        "key", F.col("place").alias("bundle"), F.lit(-1).cast("bigint").alias("place"), F.lit(None).cast("bigint").alias("total"),
        *(F.lit(None).cast("string").alias(c) for c in names[1:]), "subroot", "before", "after",
    )
    schema = pa.schema([*_LINKS, ("digest", pa.string()), *((c, pa.string()) for c in carried)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, bundle, (message, *rows) in _bundles(batches):
            if message["place"] != -1 or not rows:
                raise ValueError(f"bundle {bundle} of {key!r} met no suffix, or a suffix met no bundle")
            suffix: tuple = ()
            for pair in zip(reversed(message["before"]), reversed(message["after"])):
                suffix = (*pair, suffix)
            nodes = rise([r["digest"] for r in rows], _levels(len(rows), rows[0]["total"]))
            out = []
            for row, proof in zip(rows, fall(nodes, suffix)):
                before, after = _unchained(proof)
                out.append({c: row[c] for c in ("key", "place", "digest", *carried)} | {"subroot": message["subroot"], "before": before, "after": after})
            yield pa.RecordBatch.from_pylist(out, schema)

    fields = "key string, place bigint, subroot string, before array<string>, after array<string>, digest string"
    return in_batches(_in_label_order(rows.unionByName(first)), work, ", ".join([fields, *(f"{c} string" for c in carried)]))


class Forest:
    """The trees of all keys: their levels of bundles as written tables, and their tops."""

    def __init__(self, nodes: DataFrame):
        """``nodes``: (key, place, total, digest, ...), the lowest level."""
        most = nodes.agg(F.max("total")).first()[0] or 0
        self.levels, finished = [nodes], []
        while True:
            tops = stored(_sent_up(self.levels[-1]), "tops")
            finished.append(tops.where("total = 1").select("key", "digest", F.lit(len(self.levels) - 1).alias("last")))
            if most <= SPAN:
                break
            self.levels.append(tops.where("total > 1"))
            most = -(-most // SPAN)
        #: (key, digest, last): the top of each key, and the round that made it.
        self.tops = finished[0]
        for more in finished[1:]:
            self.tops = self.tops.unionByName(more)

    def proofs(self, suffixes: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
        """The lowest nodes with their proofs; ``suffixes``: (key, last, subroot, before, after) of each top."""
        links = [c for c, _ in _LINKS]
        messages = None
        for last in range(len(self.levels) - 1, -1, -1):
            own = suffixes.where(F.col("last") == last).withColumn("place", F.lit(0).cast("bigint")).select(*links)
            messages = own if messages is None else own.unionByName(messages)
            if last:
                messages = stored(_sent_down(self.levels[last], messages).select(*links), "suffixes")
        return _sent_down(self.levels[0], messages, carried)


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "source",
    order: str = "doc_id",
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """(order column, leaf, subroot, root, before, after) of every row, and the string columns ``carry``."""
    carry = carry or {}
    kind = docs.schema[order].dataType.simpleString()
    own = F.col(group).cast("string")
    leaves = docs.select(
        F.when(own.isNull(), "n").otherwise(F.concat(F.lit("s"), own)).alias("key"), F.col(order).alias("order_"), leaf_digest(fields).alias("digest"),
        *(c.cast("string").alias(f"c_{n}") for n, c in carry.items()),
    )
    placed = numbered(stored(leaves, "leaves"), ["order_", "digest"]).withColumn("id_", F.col("order_").cast("string"))
    groups = Forest(placed)
    named = stored(groups.tops.select(F.lit("").alias("key"), F.col("key").alias("name"), "digest", F.col("last").cast("string").alias("last_")), "subroots")
    sources = Forest(numbered(named, ["name"]))
    root = sources.tops.select("key", "last", F.col("digest").alias("subroot"), *(F.array().cast("array<string>").alias(c) for c in ("before", "after")))
    above = stored(sources.proofs(root, ["name", "last_"]), "subroot-proofs")
    suffixes = above.select(F.col("name").alias("key"), F.col("last_").cast("int").alias("last"), F.col("digest").alias("subroot"), "before", "after")
    top = root.select("subroot").first()
    found = groups.proofs(suffixes, ["id_", *(f"c_{n}" for n in carry)])
    return found.select(
        F.col("id_").cast(kind).alias(order), F.col("digest").alias("leaf"), "subroot", F.lit(top[0] if top else None).cast("string").alias("root"),
        "before", "after", *(F.col(f"c_{n}").alias(n) for n in carry),
    )


def folded(leaf: Column, before: Column, after: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    levels = F.arrays_zip(before.alias("before"), after.alias("after"))
    return F.aggregate(levels, leaf, lambda own, level: digest_of(level["before"], own, level["after"]))


def proof_digest(before: Column, after: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.zip_with(before, after, lambda b, a: F.concat(b, a)), ""), 256)
