"""Connected components by alternating star contractions.

Every round rewrites the links so that larger nodes point to smaller neighbours; the
number of links never grows and the rounds are logarithmic in the longest path.
Links and labels stay in written tables: nothing of them reaches the driver but one
bit per round, and the smallest neighbours are a table of their own, so that a
join at a node with very many links can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farthing.llm.common import stored


def _minima(links: DataFrame) -> DataFrame:
    """The smallest of each node ``a`` and its neighbours ``b``, as a written table."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    return stored(least.select("a", F.least("a", "least").alias("least")), "minima")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    met = both.join(_minima(both), "a")
    return met.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _minima(down)
    met = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return met.unionByName(least.select("a", F.col("least").alias("b")))


def _settled(links: DataFrame) -> bool:
    """Whether every node points at one other, and none points on from there."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    sums = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return sums.where("out > 1 or (out = 1 and into = 1)").isEmpty()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest node.

    ``links`` has two columns of one orderable type, in any direction; repeated links,
    links of a node with itself and nulls change nothing. No links: no rows.
    """
    a, b = links.columns[:2]
    now = stored(
        links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    for _ in range(rounds):
        if _settled(now):
            break
        now = stored(_small_star(_large_star(now).where("a <> b")).where("a <> b").distinct(), "links")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
