"""Mixing sources to target weights with DataFrame functions only.

Rows get a hash-random key. Within its source a row's place in key order is found by
distributed prefix sums: the key space of a source is cut into ranges of about
``RANGE_ROWS`` rows, ranges are summed, and a running sum inside a range is added to
the sum of the ranges before it. No task holds a whole source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drover.session import materialize

INTERNAL = ("_key", "_source", "_sid", "_slices", "_range", "_start", "_before")
#: Rows that a range of keys holds on average. It sets the grain of the work, not the result.
RANGE_ROWS = 2048


def random_key(name: str) -> Column:
    """A key that is uniform and the same in every run: the MD5 of the column as text."""
    return F.md5(F.coalesce(F.col(name).cast("string"), F.lit("")))


def source_targets(sources: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Target of each source from (source, source_size), with its rank: weights by code-point order of
    the sources, null last, repeating; together ``share`` times all sizes; none above
    ``most`` times its own size, the excess shared again by weight.

    Each round fixes the sources that a share by weight would overfill; it ends when none
    is left. The driver sees three sums a round. Needs ``share <= most``.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    # One row per source, so one task may rank them.
    ranked = sources.withColumn("_rank", F.row_number().over(order) - 1)
    picked = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.withColumn("weight", picked.cast("long")), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = None
    while True:
        over = F.lit(False) if level is None else F.col("source_size") * most <= F.col("weight") * level
        full, weight, n = ranked.agg(
            F.coalesce(F.sum(F.when(over, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
            F.coalesce(F.sum(over.cast("long")), F.lit(0)),
        ).first()
        if level is not None and n == fixed or not weight:
            break
        fixed, level = n, (share * total - most * full) / weight
    level = float(level or 0.0)
    target = F.least(F.col("source_size") * F.lit(float(most)), F.col("weight") * F.lit(level))
    return ranked.withColumn("target", target)


def mix(df: DataFrame, size: Column, key: Column, source: str = "source", weights: Sequence[int] = (3, 1, 2),
        share: float = 1.5, most: float = 2.0, ties: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``taken``.

    ``key`` is a hexadecimal hash. ``taken`` is what the mix takes of a row, repeats counted: whole epochs of the source,
    then rows by ascending ``key`` until the budget, the target rounded to a whole number,
    is used up; the row on the edge gives the part that is left. Rows with an equal key are
    ordered by ``ties``; rows equal in these too are alike but for their columns. A null
    size is 0, a null source is a source of its own, an empty table gives no rows.
    New columns replace those of the same name; those of :data:`INTERNAL` are not passed on.
    """
    thin = df.drop("source_size", "target", "taken", *INTERNAL).withColumns({"size": F.coalesce(size, F.lit(0)).cast("long"), "_key": key})
    thin = materialize(thin, "mix")
    sums = thin.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size"), F.count("*").alias("_n"))
    targets = source_targets(sums, weights, share, most)
    # Keys are uniform, so equal slices of the key space hold about equally many rows.
    slices = F.ceil(F.col("_n") / F.lit(RANGE_ROWS)).cast("long")
    looked_up = targets.select(F.col("source").alias("_source"), F.col("_rank").alias("_sid"), "source_size", "target", slices.alias("_slices"))
    # From here on a source is its rank, which is never null, so that one shuffle serves the sum and the join.
    placed = thin.join(looked_up, F.col(source).eqNullSafe(F.col("_source")))
    head = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    placed = placed.withColumn("_range", F.floor(head * F.col("_slices") / F.lit(1 << 32)).cast("long"))
    ranges = placed.groupBy("_sid", "_range").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("_sid").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("_sid", "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_sid", "_range").orderBy("_key", *ties, "size").rowsBetween(Window.unboundedPreceding, -1)
    out = placed.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["_sid", "_range"])
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    left = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left - (F.col("_start") + F.col("_before"))))
    return out.withColumn("taken", (epochs * F.col("size") + part).cast("long")).drop(*INTERNAL)
