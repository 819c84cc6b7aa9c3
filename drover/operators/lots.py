"""Lot filters and the aggregations that shrink lots to weekly or daily cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drover.config import LotScope
from drover.functions.bins import bin_floor, in_ladder, ladder_label
from drover.functions.columns import sum0
from drover.functions.weighted import (
    ONE_HEAD_FLOOR,
    ONE_IF_MISSING,
    ZERO_IF_MISSING,
    effective_weight,
    parts,
    weighted_mean,
)


def core_lots(lots: DataFrame, scope: LotScope = LotScope(), strip: bool = True) -> DataFrame:
    """Keep the analytic core. ``strip`` tolerates padded frame and grade text."""
    trim = F.trim if strip else (lambda c: c)
    keep = (
        F.col("class").isin(*scope.classes)
        & (trim(F.col("frame")) == scope.frame)
        & (trim(F.col("muscle_grade")) == scope.grade)
    )
    if scope.commodity is not None:
        keep = keep & (F.col("commodity") == scope.commodity)
    return lots.filter(keep)


def page_lots(lots: DataFrame, scope: LotScope = LotScope(commodity=None)) -> DataFrame:
    """The population of the price views: core lots whose bin is on the ladder."""
    binned = core_lots(lots, scope, strip=False).withColumn(
        "bin_lo", bin_floor("weight_break_low", "avg_weight")
    )
    return binned.filter(in_ladder("bin_lo"))


def priced(price: Column | str = "price_avg") -> Column:
    """Price is present and positive."""
    return F.col(price) > 0 if isinstance(price, str) else price > 0


def weekly_cells(
    lots: DataFrame,
    scope: LotScope = LotScope(),
    extra_keys: tuple[str, ...] = (),
    source: str = "source",
) -> DataFrame:
    """One head-weighted price per (date, class, weight class).

    Sums are hash-aggregated per source first, partial sums before the shuffle, so a class
    that holds a third of all lots costs one row per map task. The set of sources is
    collected afterwards, over one row per cell and source: collecting it from the lots
    would turn the large aggregation into a sort. ``extra_keys`` (a market, say) extend
    the cell key.
    """
    binned = (
        core_lots(lots, scope)
        .withColumn("weight_class", ladder_label(bin_floor("weight_break_low", "avg_weight")))
        .filter(F.col("weight_class").isNotNull() & priced() & F.col("auction_date").isNotNull())
    )
    keys = (*extra_keys, "auction_date", "sex", "weight_class")
    by_source = binned.withColumnRenamed("class", "sex").groupBy(*keys, source).agg(
        *parts("price_avg", "head_count", ONE_HEAD_FLOOR, "p"), F.count(F.lit(1)).alias("_pens")
    )
    return by_source.groupBy(*keys).agg(
        F.bround(F.sum("p_w")).cast("long").alias("head_count"),
        F.sum("_pens").cast("int").alias("n_pens"),
        F.try_divide(F.sum("p_wx"), F.sum("p_w")).alias("price_nominal"),
        F.array_join(F.sort_array(F.collect_set(source)), ",").alias("source_eras"),
    )


CASH_KEYS = ("auction_date", "class", "frame", "muscle_grade", "weight_break_low", "weight_break_high")


def weekly_cash(lots: DataFrame, first: int = 300, below: int = 1000) -> DataFrame:
    """Cash price per (date, class, frame, grade, bin); keeps every class and grade."""
    lo = bin_floor("weight_break_low", "avg_weight")
    binned = (
        lots.filter(F.col("auction_date").isNotNull() & F.col("price_avg").isNotNull())
        .withColumns({"weight_break_low": lo, "weight_break_high": lo + 100})
        .filter((F.col("weight_break_low") >= first) & (F.col("weight_break_low") < below))
        .dropna(subset=["class", "frame", "muscle_grade"])
    )
    return binned.groupBy(*CASH_KEYS).agg(
        F.sum(effective_weight("head_count", ONE_IF_MISSING)).alias("head_total"),
        F.count("price_avg").alias("n_lots"),
        weighted_mean("price_avg", "head_count", ONE_IF_MISSING).alias("price_avg_cash"),
    )


def daily_cells(lots: DataFrame, keys: tuple[str, ...] = ("auction_date", "class", "bin_lo")) -> DataFrame:
    """Mergeable price statistics per day and bin: the base of every price view.

    All views below are minima, maxima, sums or weighted sums, so each can be
    rolled up from this table. The lots are scanned and shuffled once; what follows
    works on at most (days x classes x bins) rows.
    """
    return page_lots(lots).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_lots"),
        sum0("head_count").alias("head"),
        F.min("price_low").alias("low"),
        F.max("price_high").alias("high"),
        *parts("price_avg", "head_count", ZERO_IF_MISSING, "p"),
    )
