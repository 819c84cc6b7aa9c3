"""Weight and coverage bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from drover.config import COVERAGE_EDGES
from drover.functions.columns import col


def bin_floor(low: Column | str, avg: Column | str, width: int = 100) -> Column:
    """Lower bin edge; the published low edge wins over the average weight."""
    weight = F.coalesce(col(low).cast("double"), col(avg).cast("double"))
    return (F.floor(F.when(~F.isnan(weight), weight) / width) * width).cast("int")


def in_ladder(lo: Column | str, first: int = 300, last: int = 800) -> Column:
    return col(lo).between(first, last)


def ladder_label(lo: Column | str, width: int = 100, first: int = 300, last: int = 800) -> Column:
    """``400-499``; null outside the ladder."""
    lo = col(lo)
    return F.when(in_ladder(lo, first, last), F.concat_ws("-", lo, lo + (width - 1)))


def page_label(lo: Column | str, width: int = 100, first: int = 300, last: int = 800) -> Column:
    """``400–499 lb``; null outside the ladder."""
    lo = col(lo)
    return F.when(
        in_ladder(lo, first, last),
        F.concat(lo.cast("string"), F.lit("–"), (lo + (width - 1)).cast("string"), F.lit(" lb")),
    )


def coverage_bin(level: Column | str, edges: tuple[float, ...] = COVERAGE_EDGES) -> Column:
    """Lower edge of the left-closed bin. Compares with the edge literals themselves:
    flooring would move values that sit on an edge."""
    level = col(level)
    out = F.when(level >= edges[-1], F.lit(edges[-1]))
    for lower in reversed(edges[:-1]):
        out = out.when(level >= lower, F.lit(lower))
    return out


def coverage_label(lower: Column | str, step: float = 0.05) -> Column:
    """``70–75%``; the open last bin reads ``100%``."""
    lower = col(lower)
    pct = lambda c: F.round(c * 100).cast("int").cast("string")
    return F.when(lower >= 1.0, F.lit("100%")).otherwise(
        F.concat(pct(lower), F.lit("–"), pct(lower + step), F.lit("%"))
    )
