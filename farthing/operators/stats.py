"""Exact order statistics and cheapest-n means of possibly hot groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farthing.functions import prices
from farthing.operators.spread import attach_facts, cheapest, running_sum

CELLS_PER_DOUBLING = 256
#: Equal parts into which a cell is cut once more.
PARTS = 4096
#: Cells of one sign; doubles span 2^-1074 to 2^1024.
_SPAN = 1100 * CELLS_PER_DOUBLING


def signed_cell(value: Column, per_doubling: int = CELLS_PER_DOUBLING) -> Column:
    """An integer that never falls as the value rises: logarithmic cells on both sides of zero.

    Infinities and NaN (above all, as Spark sorts) have cells of their own. Null stays null.
    """
    real = value.cast("double")
    size = F.abs(real)
    depth = F.floor(F.log2(size) * per_doubling).cast("int") + F.lit(_SPAN)
    top = F.lit(3 * _SPAN)
    away = F.when(size == 0, F.lit(0)).when(size == float("inf"), top).otherwise(depth)
    return F.when(F.isnan(real), top + 1).when(real < 0, -away).otherwise(away)


def _holding(rows: DataFrame, by: Sequence[str], value: str, cell: str, positions: dict[str, Column], size: str) -> DataFrame:
    """The rows of those cells of a group that hold a wanted position.

    ``rows`` come with ``_same``, and ``_before`` where the group is itself a cell. The result has the rows'
    ``by``, cell, value and ``_same``, the count before the cell, the cell's least and greatest value, and the positions.
    """
    inner = "_before" in rows.columns
    known = [size, *positions] if inner else []
    along = Window.partitionBy(*by).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    base = F.max("_before") if inner else F.lit(0)
    counts = rows.groupBy(*by, cell).agg(
        F.sum("_same").alias("_here"), F.min(value).alias("_lo"), F.max(value).alias("_hi"), base.alias("_base"), *[F.max(c).alias(c) for c in known]
    ).withColumn("_before", F.col("_base") + F.coalesce(F.sum("_here").over(along), F.lit(0)))
    if not inner:
        counts = counts.withColumn(size, F.sum("_here").over(Window.partitionBy(*by)))
        for name, position in positions.items():
            counts = counts.withColumn(name, position.cast("bigint"))
    holds = F.lit(False)
    for name in positions:
        holds = holds | ((F.col(name) >= F.col("_before")) & (F.col(name) < F.col("_before") + F.col("_here")))
    facts = ["_before", "_lo", "_hi", size, *positions]
    wanted = counts.where(holds).select(*[F.col(k).alias(f"_w_{k}") for k in [*by, cell]], *facts)
    on = [F.col(f"_w_{k}").eqNullSafe(F.col(k)) for k in [*by, cell]]
    return rows.select(*by, cell, value, "_same").join(wanted, on, "inner").select(*by, cell, value, "_same", *facts)


def order_values(
    df: DataFrame, by: Sequence[str], value: str, positions: dict[str, Column], size: str = "n",
    weight: str | None = None,
) -> DataFrame:
    """Exact values at 0-based positions of the ascending sort, per group.

    ``positions`` maps an output name to an expression over the group's row
    count ``n``. Values are numbers of any sign; rows without one do not
    count. ``weight`` names a multiplicity column when the input is already
    counted by (group, value).

    No group is ever sorted whole. Rows are first counted by (group, value),
    a shuffle that spreads a hot group by its values. Counts per cell, an
    integer that rises with the value, show which cells hold the wanted
    positions; those are cut into ``PARTS`` equal parts between their least
    and greatest value and counted once more, so that values crowded into a
    narrow range spread as well. Only the parts that hold a wanted
    position are scanned in order.
    """
    by = list(by)
    known = df.where(F.col(value).isNotNull())
    if weight is None:
        counted = known.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_same"))
    else:
        counted = known.select(*by, value, F.col(weight).alias("_same"))
    wide = _holding(counted.withColumn("_cell", signed_cell(F.col(value))), by, value, "_cell", positions, size)
    low, high = F.col("_lo").cast("double"), F.col("_hi").cast("double")
    share = F.floor((F.col(value).cast("double") - low) / (high - low) * PARTS)
    part = F.when(high > low, F.least(share, F.lit(PARTS - 1))).otherwise(0).cast("int")
    near = _holding(wide.withColumn("_part", part), [*by, "_cell"], value, "_part", positions, size)
    inner = Window.partitionBy(*by, "_cell", "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    exact = near.withColumn("_start", F.col("_before") + F.coalesce(F.sum("_same").over(inner), F.lit(0)))
    picks = [
        F.max(F.when((F.col(p) >= F.col("_start")) & (F.col(p) < F.col("_start") + F.col("_same")), F.col(value)))
        .alias(p)
        for p in positions
    ]
    return exact.groupBy(*by).agg(F.max(size).alias(size), *picks)


def upper_median(df: DataFrame, by: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """Element floor(n/2) of the ascending sort; the higher of two middles."""
    return order_values(df, by, value, {name: F.floor(F.col("n") / 2)})


def interpolated_median(
    df: DataFrame, by: Sequence[str], value: str, name: str = "median", weight: str | None = None
) -> DataFrame:
    """Mean of the two middle elements (one element when the count is odd)."""
    low, high = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    both = order_values(df, by, value, {"_low": low, "_high": high}, weight=weight)
    middle = F.col("_low") + (F.col("_high") - F.col("_low")) * F.when(F.col("n") % 2 == 0, 0.5).otherwise(0.0)
    return both.select(*by, "n", middle.alias(name))


def ranked_with_count(df: DataFrame, by: Sequence[str], value: str, tie: str) -> DataFrame:
    """Rank by value (ties by ``tie``) and group size, on every row.

    A full ranking cannot be limited before the shuffle, so the rows of a
    group are ranked in slices of the value's cells; nulls come first.
    """
    cell = signed_cell(F.col(value), 4)
    ranked = running_sum(df.withColumn("_cell", cell), by, "_cell", [value, tie], F.lit(1), "rn").drop("_cell")
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return attach_facts(ranked, sizes, by, "n", tie)


def cheapest_n_mean(df: DataFrame, by: Sequence[str], value: str, n: int, name: str = "mean") -> DataFrame:
    """Mean of the n lowest values per group, added in ascending order."""
    kept = cheapest(df.select(*by, value), by, [value], n)
    listed = kept.groupBy(*by).agg(F.array_sort(F.collect_list(value)).alias("_values"))
    return listed.select(*by, prices.ordered_mean(F.col("_values")).alias(name))
