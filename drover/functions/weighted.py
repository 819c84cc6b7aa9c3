"""The weighted-mean family.

All variants are sums of per-row parts, so they can be computed directly or kept as
parts in a small table and merged later (:func:`parts` and :func:`from_parts`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from drover.functions.columns import col


@dataclass(frozen=True)
class WeightRule:
    """How a missing or non-positive weight counts, and what a zero total gives."""

    missing: float
    nonpositive: float | None  # None keeps the weight as it is
    zero_total_mean: bool  # simple mean when the weights add up to nothing


ONE_HEAD_FLOOR = WeightRule(missing=1.0, nonpositive=1.0, zero_total_mean=False)
ONE_IF_MISSING = WeightRule(missing=1.0, nonpositive=None, zero_total_mean=False)
ZERO_IF_MISSING = WeightRule(missing=0.0, nonpositive=None, zero_total_mean=True)


def effective_weight(weight: Column | str, rule: WeightRule) -> Column:
    w = F.coalesce(col(weight).cast("double"), F.lit(rule.missing))
    if rule.nonpositive is not None:
        w = F.when(w > 0, w).otherwise(F.lit(rule.nonpositive))
    return w


def parts(value: Column | str, weight: Column | str, rule: WeightRule, prefix: str) -> list[Column]:
    """Aggregate columns ``<prefix>_wx, _w, _x, _n``: everything a later merge needs."""
    w = effective_weight(weight, rule)
    v = col(value)
    return [
        F.coalesce(F.sum(v * w), F.lit(0.0)).alias(f"{prefix}_wx"),
        F.sum(w).alias(f"{prefix}_w"),
        F.sum(v).alias(f"{prefix}_x"),
        F.count(v).alias(f"{prefix}_n"),
    ]


def merge_parts(prefix: str) -> list[Column]:
    """Roll parts up to a coarser key, keeping their names."""
    return [F.sum(f"{prefix}_{p}").alias(f"{prefix}_{p}") for p in ("wx", "w", "x", "n")]


def from_parts(prefix: str, rule: WeightRule, scale: Column | None = None) -> Column:
    """The mean, from part columns of the current row."""
    wx, w, x, n = (F.col(f"{prefix}_{p}") for p in ("wx", "w", "x", "n"))
    if rule.zero_total_mean:
        mean = F.when(w > 0, wx / w).otherwise(F.try_divide(x, n))
    else:
        mean = F.try_divide(wx, w)
    return mean if scale is None else mean * scale


def weighted_mean(value: Column | str, weight: Column | str, rule: WeightRule) -> Column:
    """The mean as one aggregate expression."""
    w = effective_weight(weight, rule)
    v = col(value)
    total = F.sum(w)
    if rule.zero_total_mean:
        return F.when(total > 0, F.coalesce(F.sum(v * w), F.lit(0.0)) / total).otherwise(F.avg(v))
    return F.try_divide(F.sum(v * w), total)
