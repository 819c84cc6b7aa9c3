"""Exact percentiles of unbounded groups.

The built-in ``percentile`` keeps every distinct value of a group in one task. Where a
group is bounded (thirteen neighbours, one value per year) that is the right tool.
For groups that grow with the data, :func:`exact_percentile` finds the same number by
counting first and looking at values only near the wanted rank.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drover.session import materialize

RATIO = 1.1  # a bucket spans values within 10 % of each other
SHIFT = 8000  # more than ln(smallest double) / ln(RATIO), so positive values get positive buckets


def magnitude(v: Column) -> Column:
    """Order-preserving bucket number: logarithmic in both directions from zero, so no
    outlier stretches it, and at most some hundred buckets occur in practice."""
    step = lambda x: (F.floor(F.least(F.ln(x), F.lit(710.0)) / math.log(RATIO)) + SHIFT).cast("int")
    return F.when(v > 0, step(v)).when(v < 0, -step(-v)).otherwise(0)


#: Rows of a group that may lie in the range searched last; a range with more is narrowed first.
NEAR = 100_000
PARTS = 64


def exact_percentile(df: DataFrame, keys: tuple[str, ...], value: str, p: float, name: str, near: int = NEAR) -> DataFrame:
    """Percentile ``p`` per group with linear interpolation, as ``keys + (name,)``."""
    return counts_and_percentile(df, keys, value, p, name, near=near)[1]


def counts_and_percentile(
    df: DataFrame,
    keys: tuple[str, ...],
    value: str,
    p: float,
    name: str,
    parts: list[Column] | None = None,
    base: tuple[str, ...] | None = None,
    fan: Callable[[DataFrame], DataFrame] | None = None,
    near: int = NEAR,
) -> tuple[DataFrame, DataFrame]:
    """(counts, percentiles). Counts hold the mergeable aggregates ``parts`` per (base,
    magnitude bucket), so other statistics of the same groups need no scan of their own.

    1. Rows are counted per (base, magnitude bucket), partial counts first, so a group
       that holds a third of all rows costs one row per bucket and task. Running counts
       show which bucket holds each of the two neighbouring ranks.
    2. While a range around a rank holds more than ``near`` rows of different values, the
       rows in it are counted again, in :data:`PARTS` equal parts of the range, and the
       part with the rank becomes the range. Only counts move.
    3. The rows in the last ranges are counted by value, and running counts give the value
       at each rank. A window sees at most ``near`` rows, or one value.

    ``fan`` maps rows keyed by ``base`` to the groups they belong to, when groups overlap.
    In step 1 it multiplies the counts, not the rows. Keys must not be null. The counting
    jobs run when this is called, not when the result is used.
    """
    base = base or keys
    fan = fan or (lambda d: d)
    v = F.col("_v")
    present = F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double"))
    valued = df.withColumn("_v", present)
    counted = valued.groupBy(*base, F.when(v.isNotNull(), magnitude(v)).alias("_b")).agg(
        F.count(v).alias("_c"), F.min(v).alias("_min"), F.max(v).alias("_max"), *(parts or [])
    )
    counted = materialize(counted, f"{name}-counts")
    rows = valued.select(*base, "_v").filter(v.isNotNull())
    by_bucket = fan(counted.filter(F.col("_b").isNotNull())).groupBy(*keys, "_b").agg(
        F.sum("_c").alias("_c"), F.min("_min").alias("_min"), F.max("_max").alias("_max")
    )
    along = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    rank = F.lit(p) * (F.col("_n") - 1)
    first, second = F.floor(rank), F.ceil(rank)
    ranked = by_bucket.withColumns({
        "_upto": F.sum("_c").over(along),
        "_n": F.sum("_c").over(Window.partitionBy(*keys)),
    }).withColumn("_rank", F.explode(F.array_distinct(F.array(first, second))))
    target = ("_n", "_rank")

    def holding(runs: DataFrame) -> DataFrame:
        """The run of rows that holds the rank: its range, and the rows before and in it."""
        holds = (F.col("_upto") - F.col("_c") <= F.col("_rank")) & (F.col("_upto") > F.col("_rank"))
        return runs.filter(holds).select(
            *keys, *target, F.col("_min").alias("_lo"), F.col("_max").alias("_hi"),
            (F.col("_upto") - F.col("_c")).alias("_below"), F.col("_c").alias("_in"),
        )

    def inside(targets: DataFrame) -> DataFrame:
        return fan(rows).join(targets, list(keys)).filter(v.between(F.col("_lo"), F.col("_hi")))

    # Written, so that the planner knows the size of the per-group ranks and broadcasts them only if small.
    targets = materialize(holding(ranked), f"{name}-rank")
    while (targets.filter("_hi > _lo").agg(F.max("_in")).first()[0] or 0) > near:
        span = F.col("_hi") - F.col("_lo")
        part = F.when(span > 0, F.least(F.floor((v - F.col("_lo")) / span * PARTS), F.lit(PARTS - 1))).otherwise(0).cast("int")
        split = inside(targets).groupBy(*keys, *target, "_below", part.alias("_part")).agg(
            F.count(F.lit(1)).alias("_c"), F.min(v).alias("_min"), F.max(v).alias("_max")
        )
        so_far = Window.partitionBy(*keys, "_rank").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
        split = split.withColumn("_upto", F.col("_below") + F.sum("_c").over(so_far))
        targets = materialize(holding(split), f"{name}-rank")

    by_value = inside(targets).groupBy(*keys, *target, "_below", "_v").agg(F.count(F.lit(1)).alias("_c"))
    upward = Window.partitionBy(*keys, "_rank").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    reached = by_value.withColumn("_upto", F.col("_below") + F.sum("_c").over(upward)).filter("_upto > _rank")
    found = reached.groupBy(*keys, "_n").agg(
        F.min(F.when(F.col("_rank") == first, v)).alias("_left"),
        F.min(F.when(F.col("_rank") == second, v)).alias("_right"),
    )
    percentiles = found.select(
        *keys, (F.col("_left") + (F.col("_right") - F.col("_left")) * (rank - first)).alias(name)
    )
    return counted, percentiles
