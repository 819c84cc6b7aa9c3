"""Robust spike screening of a weekly real-price series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from drover.config import SpikeRule
from drover.operators.ranks import in_blocks

SERIES = ("sex", "weight_class")


def with_local_median(
    weekly: DataFrame,
    rule: SpikeRule = SpikeRule(),
    series: tuple[str, ...] = SERIES,
    value: str = "price_real",
    day: str = "auction_date",
    block: int | None = None,
) -> DataFrame:
    """Adds ``local_median``: centred median over neighbouring rows of the series, null
    with too few values.

    The input is already one row per date and series, so a series is at most one row
    per calendar day however many lots lie below it. Several markets widen the
    parallelism through ``series``. Where a series is longer than that, ``block`` deals it to
    blocks of so many rows, which overlap by the half window.
    """
    around = lambda over: over.rowsBetween(-rule.half_window, rule.half_window)
    median = lambda w: F.when(F.count(value).over(w) >= rule.min_values, F.percentile(value, F.lit(0.5)).over(w))
    if block is None:
        return weekly.withColumn("local_median", median(around(Window.partitionBy(*series).orderBy(day))))
    dealt = in_blocks(weekly, series, [*map(F.asc, series), F.asc(day)], block, rule.half_window)
    found = dealt.withColumn("local_median", median(around(Window.partitionBy(*series, "_block").orderBy("_place"))))
    return found.filter("_own").select(*weekly.columns, "local_median")


def replace_spikes(
    weekly: DataFrame,
    rule: SpikeRule = SpikeRule(),
    series: tuple[str, ...] = SERIES,
) -> DataFrame:
    """Flags and replaces spikes; keeps the original values for the audit log.

    Medians come from the original values only, so the result does not depend on
    the order in which spikes are found.
    """
    med = F.col("local_median")
    ratio = F.try_divide("price_real", med)
    hit = ((ratio <= rule.ratio_lo) | (ratio >= rule.ratio_hi)) & (
        F.abs(F.col("price_real") - med) > rule.min_abs_dev
    )
    return (
        with_local_median(weekly, rule, series)
        .withColumns({"ratio": ratio, "spike_replaced": F.coalesce(hit, F.lit(False))})
        .withColumns({
            "price_real_orig": F.col("price_real"),
            "price_nominal_orig": F.col("price_nominal"),
            "direction": F.when(~F.col("spike_replaced"), "")
            .when(F.col("ratio") <= rule.ratio_lo, "low")
            .otherwise("high"),
        })
        .withColumns({
            "price_real": F.when(F.col("spike_replaced"), med).otherwise(F.col("price_real")),
            "price_nominal": F.when(
                F.col("spike_replaced"), med * (F.col("cpi_at_obs") / F.col("cpi_base"))
            ).otherwise(F.col("price_nominal")),
        })
    )


CLEANED = (
    "auction_date", "sex", "weight_class", "head_count", "n_pens", "price_nominal",
    "price_real", "cpi_at_obs", "spike_replaced", "direction", "source_eras",
)


def cleaned_rows(screened: DataFrame, markets: tuple[str, ...] = ()) -> DataFrame:
    """The published series."""
    extra = [c for c in ("vintage",) if c in screened.columns]
    return screened.select(*markets, *CLEANED, *extra)


def spike_log(screened: DataFrame, markets: tuple[str, ...] = ()) -> DataFrame:
    """One audit row per replacement, before and after, four decimals."""
    r4 = lambda c: F.round(c, 4)
    return screened.filter("spike_replaced").select(
        *markets, "auction_date", "sex", "weight_class", "direction",
        r4("price_real_orig").alias("price_real_orig"),
        r4("price_real").alias("price_real_replaced"),
        r4("price_nominal_orig").alias("price_nominal_orig"),
        r4("price_nominal").alias("price_nominal_replaced"),
        r4("local_median").alias("local_median_real"),
        r4("ratio").alias("ratio"),
        "cpi_at_obs",
    )
