"""Circulant MinHash near-duplicates with exact Jaccard verification.

Two permutations make all coordinates: the first scatters the shingles' 64-bit codes
over a circle of 2^32 places once, the second permutes the circle after a shift by the
coordinate's number, so coordinate k is the smallest ``second(first(x) + k)`` over the set. ``rows`` coordinates form a band; sets that
agree in a band are candidates, and a candidate pair is a link only after its full
64-bit shingle sets are compared. With 40 bands of 6 rows a pair at 0.85 is missed
with probability (1 - 0.85^6)^40, below 1e-8, and one at 0.3 met with 3 %.

Large groups: equal sets are one class from the start. In a band group of more than
``SMALL_GROUP`` classes only a few pivots are compared with all; classes that this
joins need no more comparing. What is left apart is compared block by block: two
blocks of bounded size meet in one task, which counts what each full set of one shares with
all of the other at once, and passes on a spanning forest of the links. No list of pairs is made, and none is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farthing.llm.common import in_batches, pieces, stored, utf8
from farthing.llm.components import components
from farthing.llm.words import SPACED, mixed, shingle_sets, words_of

#: Texts of a table of ids.
Texts = Callable[[DataFrame], DataFrame]

SMALL_GROUP = 24
PIVOTS = 3
#: Members and bytes of full sets in a block, at most but for one longer set.
BLOCK, BLOCK_BYTES = 1024, 4 << 20


@dataclass(frozen=True)
class Banding:
    """Shingle size, threshold as a fraction of whole numbers, bands and rows."""

    words: int = 5
    above: int = 85
    below: int = 100
    bands: int = 40
    rows: int = 6

    @property
    def size(self) -> int:
        return self.bands * self.rows


def _second(x: np.ndarray) -> np.ndarray:
    """The second permutation: a bijection of 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signatures(codes: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """(texts, size) coordinates; a text with an empty set has the largest number everywhere."""
    n = len(bounds) - 1
    out = np.full((n, size), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(bounds))
    if not len(full):
        return out
    first = (mixed(codes) >> np.uint64(32)).astype(np.uint32)  # the first permutation, once
    at = bounds[:-1][full]
    for k in range(size):
        out[full, k] = np.minimum.reduceat(_second(first + np.uint32(k)), at)
    return out


def _set_codes(column: pa.Array, banding: Banding) -> tuple[np.ndarray, np.ndarray]:
    return shingle_sets(words_of(column, SPACED), banding.words)


def _print_of(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A code of each whole set, from two sums over its members."""
    n = len(bounds) - 1
    full = np.flatnonzero(np.diff(bounds))
    out = np.zeros((n, 2), np.uint64)
    if len(full):
        for j, salt in enumerate((0x51ED270B, 0xA24BAED4963EE407)):
            out[full, j] = np.add.reduceat(mixed(codes ^ np.uint64(salt)), bounds[:-1][full])
    return out


def set_codes(column: pa.Array, banding: Banding) -> np.ndarray:
    """The code of each text's set, as ``prints_of`` has it in ``f1``."""
    return _print_of(*_set_codes(column, banding))[:, 0].copy().view(np.int64)


def prints_of(texts: DataFrame, banding: Banding, carried: tuple[str, ...] = ("id",)) -> DataFrame:
    """The ``carried`` columns, and (n, f1, f2, keys): set size, code of the set, one key per band."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch, "text"):
                part = batch.slice(a, b - a)
                codes, bounds = _set_codes(part.column("text"), banding)
                code = _print_of(codes, bounds).view(np.int64)
                rows = signatures(codes, bounds, banding.size).reshape(b - a, banding.bands, banding.rows)
                key = np.zeros((b - a, banding.bands), np.uint64)
                for k in range(banding.rows):
                    key = mixed(key + rows[:, :, k].astype(np.uint64) + np.uint64(1))
                key = mixed(key + np.arange(banding.bands, dtype=np.uint64)).view(np.int64)
                ends = np.arange(b - a + 1, dtype=np.int32) * banding.bands
                keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(key.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in carried), pa.array(np.diff(bounds)), pa.array(code[:, 0]), pa.array(code[:, 1]), keys],
                    [*carried, "n", "f1", "f2", "keys"],
                )

    kinds = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in carried)
    rows = texts.select(*dict.fromkeys((*carried, "text")))
    return in_batches(rows, work, f"{kinds}, n bigint, f1 bigint, f2 bigint, keys array<bigint>")


def _sets(texts: DataFrame, banding: Banding) -> DataFrame:
    """(id, members): the sorted full sets as bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch, "text"):
                part = batch.slice(a, b - a)
                codes, bounds = _set_codes(part.column("text"), banding)
                held = [codes[bounds[i] : bounds[i + 1]].tobytes() for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(held, pa.binary())], ["id", "members"])

    return in_batches(texts, work, "id bigint, members binary")


def _reaches(x: bytes, y: bytes, banding: Banding) -> bool:
    both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return banding.below * common >= banding.above * (len(both) - common)


def _ends(pairs: DataFrame) -> DataFrame:
    """The ids that some pair names."""
    ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    return stored(ends.distinct(), "ends")


def _verified(pairs: DataFrame, texts: Texts, banding: Banding) -> DataFrame:
    """The pairs whose full sets reach the threshold."""

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.loc[[_reaches(x, y, banding) for x, y in zip(f["x"], f["y"])], ["a", "b"]]

    sets = stored(_sets(texts(_ends(pairs)), banding).distinct(), "sets")
    left = sets.select(F.col("id").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("members").alias("y"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return met.mapInPandas(check, "a bigint, b bigint").distinct()


def _sizes_fit(banding: Banding, x: str = "n", y: str = "m"):
    """The smaller set must be the wanted share of the larger one."""
    return F.least(x, y) * banding.below >= F.greatest(x, y) * banding.above


def _members(banded: DataFrame) -> DataFrame:
    """(key, held, id, n): the members of band groups of two or more classes; of groups with the same members one is kept.

    The many keys of one class only are counted and left before anything else of them moves.
    """
    again = stored(banded.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where("held > 1"), "repeated")
    held = stored(banded.join(again, "key").select("key", "held", "id", "n"), "colliding")
    sums = held.groupBy("key", "held").agg(F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("code"), F.min("id").alias("least"))
    one = sums.groupBy("held", "code", "least").agg(F.min("key").alias("key"))
    return stored(held.join(stored(one.select("key"), "groups"), "key", "left_semi"), "members")


def similar(classes: DataFrame, texts: Texts, banding: Banding) -> DataFrame:
    """(a, b): verified links between classes, enough for all components.

    ``classes``: (id, n, keys), one row per distinct set; ``texts`` gives the rows (id,
    text binary) of a table of ids, one or more for each.
    """
    banded = classes.select(F.explode("keys").alias("key"), "id", "n")
    members = _members(banded)
    few, many = members.where(F.col("held") <= SMALL_GROUP), members.where(F.col("held") > SMALL_GROUP)
    small = few.select("key", F.col("id").alias("a"), "n").join(
        few.select("key", F.col("id").alias("b"), F.col("n").alias("m")), "key"
    ).where(F.col("a") < F.col("b"))
    # The pivots of a large group: the first members by a few different orders.
    first = [F.min(F.struct("id", "n")), *(F.min_by(F.struct("id", "n"), F.xxhash64(F.lit(k), "id")) for k in range(1, PIVOTS))]
    pivots = stored(
        many.groupBy("key").agg(F.array_distinct(F.array(*first)).alias("p"))
        .select("key", F.explode("p").alias("p")).select("key", F.col("p.id").alias("a"), F.col("p.n").alias("n")),
        "pivots",
    )
    star = many.select("key", F.col("id").alias("b"), F.col("n").alias("m")).join(pivots, "key").where(F.col("a") != F.col("b"))
    met = [p.where(_sizes_fit(banding)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")) for p in (small, star)]
    pairs = stored(met[0].unionByName(met[1]).distinct(), "pairs")
    links = stored(_verified(pairs, texts, banding), "links")
    if many.isEmpty():
        return links
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = ends.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component"))
    rest = _apart(many, near, texts, banding)
    return links if rest is None else stored(links.unionByName(rest), "links")


def _apart(many: DataFrame, joined: DataFrame, texts: Texts, banding: Banding) -> DataFrame | None:
    """Links inside large groups between classes that no common smallest neighbour has joined.

    In each group the classes outside its largest set of joined ones meet all members, block
    against block; one task holds two blocks. Of the links between two blocks a spanning
    forest is passed on, over what is joined already.
    """
    labelled = stored(
        many.join(joined.select(F.col("node").alias("id"), "component"), "id", "left")
        .select("key", "id", "n", F.coalesce("component", "id").alias("label")),
        "labelled",
    )
    counts = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"))
    main = stored(
        counts.groupBy("key").agg(
            F.max_by(F.struct("label", "w"), F.struct("c", "label")).alias("main"), F.sum("c").alias("held"), F.max("c").alias("most"), F.sum("w").alias("total")
        ).where("held > most").select("key", "held", "most", "total", F.col("main.label").alias("main"), F.col("main.w").alias("kept")),
        "main",
    )
    if main.isEmpty():
        return None
    placed = stored(labelled.join(main, "key"), "placed")

    def blocks(members, sizes):
        return F.greatest(F.ceil(members / BLOCK), F.ceil(8 * sizes / F.lit(BLOCK_BYTES))).cast("int")

    lefts = blocks(F.col("held") - F.col("most"), F.col("total") - F.col("kept"))
    rights = blocks(F.col("held"), F.col("total"))

    def side(rows: DataFrame, own, others, left: bool) -> DataFrame:
        """Each row goes to a block of its side and meets every block of the other."""
        mine = F.pmod(F.xxhash64(F.lit("block"), "id"), own).cast("int")
        return rows.select("key", "id", "n", "label", F.lit(left).alias("left"), mine.alias("mine"), F.explode(F.sequence(F.lit(0), others - 1)).alias("met")).select(
            "key", "id", "n", "label", "left", F.col("mine" if left else "met").alias("i"), F.col("met" if left else "mine").alias("j")
        )

    minor = placed.where(F.col("label") != F.col("main"))
    meets = side(minor, lefts, rights, True).unionByName(side(placed, rights, lefts, False))
    ids = stored(placed.select("id").distinct(), "ends")
    sets = stored(_sets(texts(ids), banding).distinct(), "sets")

    def meet(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["left", "id"])  # the members to meet, then those that meet them
        y, x = f[~f["left"]], f[f["left"]]
        found = []
        if len(x) and len(y):
            ids, sizes = (y[c].to_numpy() for c in ("id", "n"))
            _, group = np.unique(f["label"], return_inverse=True)  # joined so far; a link joins two groups
            flat = np.concatenate([np.frombuffer(m, np.uint64) for m in y["members"]])
            starts = np.cumsum(sizes) - sizes
            for k, (i, n, members) in enumerate(zip(x["id"], x["n"], x["members"]), len(y)):
                near = (group[: len(y)] != group[k]) & (np.minimum(sizes, n) * banding.below >= np.maximum(sizes, n) * banding.above)
                if near.any():
                    own = np.frombuffer(members, np.uint64)
                    at = np.searchsorted(own, flat)
                    common = np.add.reduceat(own[np.minimum(at, n - 1)] == flat, starts, dtype=np.int64)
                    near &= banding.below * common >= banding.above * (sizes + n - common)
                    _, one = np.unique(group[: len(y)][near], return_index=True)
                    for o in np.flatnonzero(near)[one]:
                        found.append((min(i, ids[o]), max(i, ids[o])))
                    group[np.isin(group, group[: len(y)][near])] = group[k]
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return meets.join(sets, "id").groupBy("key", "i", "j").applyInPandas(meet, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    The kept document of a component is its smallest doc_id. Defined results: a text
    without words, or null, has no shingle, no link and is kept; rows of one doc_id
    are one node, whatever their texts; a row without doc_id is kept, unlinked, with a
    null component; no rows give no rows; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), utf8())
    prints = stored(prints_of(texts, banding), "prints")
    linkable = prints.where("id is not null and n > 0")
    classes = stored(
        linkable.groupBy("f1", "f2", "n").agg(F.min("id").alias("rep"), F.min_by("keys", "id").alias("keys")), "classes"
    )
    links = similar(classes.select(F.col("rep").alias("id"), "n", "keys"), lambda ids: texts.join(ids, "id", "left_semi"), banding)
    slim = stored(classes.select("f1", "f2", "n", "rep"), "reps")
    member = stored(prints.join(slim, ["f1", "f2", "n"], "left").select("id", "n", F.when(F.col("id").isNotNull(), F.col("rep")).alias("rep")), "members")
    several = member.where("rep is not null").groupBy("id").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where("x <> y").select("id")
    same_id = member.join(stored(several, "several"), "id").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    joined = stored(components(links.unionByName(same_id)), "components")
    found = member.join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    own = F.coalesce("component", "rep", "id")
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), own.alias("component_id"),
        F.coalesce(F.col("id") == own, F.lit(True)).alias("kept"),
    )
