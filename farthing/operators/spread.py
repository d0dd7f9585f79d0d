"""Ways to keep one hot key from landing in one task.

Grouped facts are always built with ``groupBy().agg()``, whose map-side
combine makes a hot key cheap. What needs care is carrying such facts back to
the rows, and ordered scans over a key's rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one task of a join takes without trouble; larger groups are worth salting.
HOT_ROWS = 1_000_000
#: Groups that are salted at most: any other has less than so small a share of the rows.
HOT_GROUPS = 1000
SPREAD = 64
#: Pairs of rows that one task of a join of many with many makes, about.
TASK_PAIRS = 4_000_000


def dealt(df: DataFrame, per_core: int = 4) -> DataFrame:
    """The rows evenly over several tasks a core: a small file may hold very many rows, and long work on
    each of them should not wait for the one task that reads it."""
    return df.repartition(max(1, df.sparkSession.sparkContext.defaultParallelism) * per_core)


def attach_facts(
    rows: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    size: str,
    spread_by: str,
    hot_rows: int = HOT_ROWS,
    spread: int = SPREAD,
) -> DataFrame:
    """Left-join per-group facts to the rows without a hot partition.

    The largest ``HOT_GROUPS`` groups above ``hot_rows`` rows are broadcast: a fixed number,
    whatever the data. Their rows carry a salt and spread over ``spread`` partitions of the
    ordinary join, where they match nothing. Any other group has less than a
    ``HOT_GROUPS``-th of all rows. ``size`` names the fact column with the group's row
    count and ``spread_by`` a row column to hash for the salt.
    """
    values = [c for c in facts.columns if c not in keys]
    largest = facts.where(F.col(size) > hot_rows).orderBy(F.desc(size), *keys).limit(HOT_GROUPS)
    hot = largest.select(*[F.col(k).alias(f"_h_{k}") for k in keys], F.struct(*values).alias("_hot"))
    cold = facts.select(
        *[F.col(k).alias(f"_c_{k}") for k in keys], F.lit(0).alias("_c_salt"), F.struct(*values).alias("_cold")
    )
    on_hot = [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys]
    flagged = rows.join(F.broadcast(hot), on_hot, "left").drop(*[f"_h_{k}" for k in keys])
    salt = F.when(F.col("_hot").isNotNull(), F.pmod(F.hash(spread_by), F.lit(spread)) + 1).otherwise(0)
    flagged = flagged.withColumn("_salt", salt)
    on_cold = [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in keys] + [F.col("_salt") == F.col("_c_salt")]
    joined = flagged.join(cold, on_cold, "left")
    picked = [F.coalesce(F.col(f"_hot.{v}"), F.col(f"_cold.{v}")).alias(v) for v in values]
    return joined.select(*[F.col(c) for c in rows.columns], *picked)


def join_facts(
    rows: DataFrame, facts: DataFrame, key: str, spread_by: str, hot_rows: int = HOT_ROWS, how: str = "inner"
) -> DataFrame:
    """Inner or left join of rows with one fact row per ``key``, safe against hot keys.

    The rows are counted per key first, from the key column alone. After this join an
    aggregate by the key shuffles again, so hot keys stay spread up to their partial sums.
    """
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    sized = facts.join(sizes, key, "left").withColumn("_rows", F.coalesce("_rows", F.lit(0)))
    found = attach_facts(rows, sized.withColumn("_known", F.lit(True)), [key], "_rows", spread_by, hot_rows)
    return (found.where("_known") if how == "inner" else found).drop("_known", "_rows")


def pair_sizes(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key on both sides, of the keys that both have."""
    a = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_left"))
    b = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_right"))
    return a.join(b, list(keys))


def block_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_by: str, right_by: str,
    sizes: DataFrame | None = None, pairs: int = TASK_PAIRS,
) -> DataFrame:
    """Inner join on ``keys`` where both sides may have very many rows of one key.

    A key that makes more than ``pairs`` pairs is cut into blocks of that size: its left rows into bands, its right
    rows into columns, and each row goes to all blocks of its band or column. The number of
    bands follows the ratio of the two sides, so few rows are copied often and many rarely. The
    ``HOT_GROUPS`` keys with the most pairs are cut: a fixed number, whatever the data. They are counted
    first; without any, this is Spark's own join. ``left_by`` and ``right_by``
    are columns to hash for the block; ``sizes`` (keys, _left, _right) saves the count.
    """
    keys = list(keys)
    sizes = pair_sizes(left, right, keys) if sizes is None else sizes
    made = F.col("_left") * F.col("_right")
    found = sizes.where(made > pairs).orderBy(F.desc(made), *keys).limit(HOT_GROUPS).select(*keys, "_left", "_right")
    large = found.collect()  # HOT_GROUPS rows at most
    if not large:
        return left.join(right, keys)
    blocks = F.ceil(made / pairs)
    bands = F.least(blocks, F.greatest(F.lit(1), F.round(F.sqrt(blocks * F.col("_left") / F.col("_right")))))
    hot = (
        left.sparkSession.createDataFrame(large, found.schema)
        .select(*[F.col(k).alias(f"_h_{k}") for k in keys], blocks.alias("_blocks"), bands.cast("bigint").alias("_bands"))
        .withColumn("_columns", F.ceil(F.col("_blocks") / F.col("_bands")).cast("bigint"))
    )

    def dealt(rows: DataFrame, by: str, own: str, other: str, at: str, along: str) -> DataFrame:
        on = [F.col(k) == F.col(f"_h_{k}") for k in keys]
        marked = rows.join(F.broadcast(hot), on, "left")
        place = F.coalesce(F.pmod(F.xxhash64(by), F.col(own)), F.lit(0))
        copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(other) - 1, F.lit(0).cast("bigint"))))
        return marked.select(*[F.col(c) for c in rows.columns], place.alias(at), copies.alias(along))

    a = dealt(left, left_by, "_bands", "_columns", "_band", "_column")
    b = dealt(right, right_by, "_columns", "_bands", "_column", "_band")
    return a.join(b, [*keys, "_band", "_column"]).drop("_band", "_column")


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    slice_col: str,
    order: Sequence[str],
    state: Column,
    name: str,
    inclusive: bool = False,
) -> DataFrame:
    """Last non-null ``state`` before each row (or up to it), per key.

    The rows of a key are cut into ordered slices; each slice is scanned on
    its own, and only one summary row per slice is scanned across slices. A
    key with a third of all rows thus spreads over as many tasks as it has
    slices.
    """
    staged = df.withColumn("_state", state)
    moment = F.struct(*order)
    present = F.col("_state").isNotNull()
    across = Window.partitionBy(*keys).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        staged.groupBy(*keys, slice_col)
        .agg(F.max_by(F.when(present, F.col("_state")), F.when(present, moment)).alias("_tail"))
        .withColumn("_carry", F.last("_tail", ignorenulls=True).over(across))
        .select(*[F.col(k).alias(f"_s_{k}") for k in [*keys, slice_col]], "_carry")
    )
    end = 0 if inclusive else -1
    inside = Window.partitionBy(*keys, slice_col).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    scanned = staged.withColumn("_near", F.last("_state", ignorenulls=True).over(inside))
    on = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in [*keys, slice_col]]
    joined = scanned.join(carried, on, "left")
    return joined.select(*df.columns, F.coalesce("_near", "_carry").alias(name))


def auto_slices(
    df: DataFrame, keys: Sequence[str], order: str, name: str = "_slice", hot_rows: int = HOT_ROWS, slice_rows: int | None = None
) -> DataFrame:
    """``df`` with ordered slices of the rows of large keys, for ``carry_forward`` and ``running_sum``.

    A key above ``hot_rows`` rows is cut at equal steps between the least and the greatest finite value of its first
    order column, a number, date or time, into as many slices as it has ``slice_rows``; nulls, infinities and NaN
    come where Spark sorts them. Counts and bounds are exact, so every evaluation cuts alike. The keys are counted
    first; the ``HOT_GROUPS`` largest are cut, all others are one slice.
    """
    slice_rows = slice_rows or hot_rows
    kind = dict(df.dtypes)[order]
    if kind.startswith("timestamp"):
        at = F.unix_micros(F.col(order).cast("timestamp")).cast("double")
    elif kind == "date":
        at = F.unix_date(order).cast("double")
    elif kind == "string":
        return df.withColumn(name, F.lit(0).cast("bigint"))
    else:
        at = F.col(order).cast("double")
    finite = F.when(~F.isnan(at) & (F.abs(at) != float("inf")), at)
    facts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.min(finite).alias("_least"), F.max(finite).alias("_most"))
    found = facts.where((F.col("_rows") > hot_rows) & (F.col("_most") > F.col("_least"))).orderBy(F.desc("_rows"), *keys).limit(HOT_GROUPS)
    large = found.collect()  # HOT_GROUPS rows at most
    if not large:
        return df.withColumn(name, F.lit(0).cast("bigint"))
    hot = df.sparkSession.createDataFrame(large, found.schema)
    hot = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys], F.ceil(F.col("_rows") / slice_rows).alias("_slices"), "_least", "_most")
    flagged = df.join(F.broadcast(hot), [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys], "left")
    step = F.least(F.floor((at - F.col("_least")) / (F.col("_most") - F.col("_least")) * F.col("_slices")), F.col("_slices") - 1)
    place = (
        F.when(F.col("_slices").isNull(), F.lit(0))
        .when(at.isNull(), F.lit(-2))
        .when(F.isnan(at), F.col("_slices") + 1)
        .when(at == float("inf"), F.col("_slices"))
        .when(at == float("-inf"), F.lit(-1))
        .otherwise(step)
    )
    return flagged.select(*df.columns, place.cast("bigint").alias(name))


def running_sum(
    df: DataFrame, keys: Sequence[str], slice_col: str, order: Sequence[str], amount: Column, name: str
) -> DataFrame:
    """Running total per key, scanned slice by slice (see ``carry_forward``)."""
    staged = df.withColumn("_amount", amount)
    across = Window.partitionBy(*keys).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        staged.groupBy(*keys, slice_col)
        .agg(F.sum("_amount").alias("_sum"))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(across), F.lit(0)))
        .select(*[F.col(k).alias(f"_s_{k}") for k in [*keys, slice_col]], "_before")
    )
    inside = Window.partitionBy(*keys, slice_col).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    scanned = staged.withColumn("_near", F.sum("_amount").over(inside))
    on = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in [*keys, slice_col]]
    joined = scanned.join(before, on, "left")
    return joined.select(*df.columns, (F.col("_near") + F.col("_before")).alias(name))


def cheapest(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], n: int, rank: str = "_rank") -> DataFrame:
    """The first ``n`` rows per group in the given order, with their rank.

    Spark limits each group to ``n`` rows before the shuffle (window group
    limit), so a hot group ships at most ``n`` rows per map task.
    """
    spec = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(spec)).where(F.col(rank) <= n)
