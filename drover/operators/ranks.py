"""Places of rows in a total order, without a window over the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drover.session import materialize


def numbered(df: DataFrame, order: list[Column], within: tuple[str, ...] = (), name: str = "place") -> DataFrame:
    """``df`` with the place of each row, from 1, in the order of ``order``, which must begin with the
    ``within`` columns; the place is counted anew for each of their values, nulls being one.

    The rows are range-partitioned and sorted once. Ids that grow within a partition give the place
    there, and a table with one row per (partition, ``within``) what lies before. Equal
    rows are told apart by a number, so that any number of them is spread over partitions; they
    follow in any order.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    sorted_rows = tied.orderBy(*order, "_tie").drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    placed = materialize(sorted_rows.withColumn("_part", F.shiftright("_at", 33)), "placed")
    group = Window.partitionBy(*[f"_{w}" for w in within])
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(F.col("_part").alias("_in"), *[F.col(w).alias(f"_{w}") for w in within]).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")
    ).withColumnRenamed("_in", "_part")
    starts = starts.select("_first", F.col("_part").alias("_in"), *[f"_{w}" for w in within], F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    # Written, so that the planner knows how small it is.
    starts = materialize(starts, "starts")
    same = reduce(lambda a, w: a & F.col(w).eqNullSafe(F.col(f"_{w}")), within, F.col("_part") == F.col("_in"))
    place = F.col("_at") - F.col("_first") + F.col("_before") + 1
    return placed.join(starts, same).select(*df.columns, place.alias(name))


def in_blocks(df: DataFrame, series: tuple[str, ...], order: list[Column], block: int, halo: int) -> DataFrame:
    """Rows of each series dealt to blocks of ``block`` neighbours, with ``halo`` rows of the blocks on
    either side: columns ``_place``, ``_block`` and ``_own``, which is false for the rows lent from a
    neighbour. A window of up to ``halo`` rows either way over (series, block) sees for the own rows
    what it would see over the whole series."""
    if block < halo:
        raise ValueError("a block must hold the halo of its neighbours")
    at = F.col("_place") - 1
    own = F.floor(at / block)
    inside = at - own * block
    one = lambda number, mine: F.struct(number.alias("_block"), F.lit(mine).alias("_own"))
    copies = F.filter(F.array(
        one(own, True), F.when((inside < halo) & (own > 0), one(own - 1, False)), F.when(inside >= block - halo, one(own + 1, False)),
    ), lambda c: c.isNotNull())
    return numbered(df, order, series, "_place").select("*", F.inline(copies))
