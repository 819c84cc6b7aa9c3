"""Lots to the cleaned weekly series and to basis."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drover import config as C
from drover.operators import basis as B
from drover.operators import deflate, lots, spikes, vintage, views
from drover.session import materialize


def screened_weekly(
    pens: DataFrame, cpi: DataFrame, base: date = C.BASE_MONTH,
    scope: C.LotScope = C.LotScope(), rule: C.SpikeRule = C.SpikeRule(), source: str = "source",
    markets: tuple[str, ...] = (),
) -> DataFrame:
    """Weekly head-weighted prices in constant money with spikes replaced; the original
    values stay on the row for the audit log. ``markets`` names the columns that tell
    markets apart; each market is a series of its own.

    Plan: one scan of the lots, one hash aggregation (shuffle of partial sums), one
    broadcast of the monthly index, one small shuffle for the per-series windows.
    """
    weekly = lots.weekly_cells(pens, scope, markets, source)
    return spikes.replace_spikes(deflate.deflate_strict(weekly, cpi, base), rule, (*markets, *spikes.SERIES))


def clean_weekly(pens: DataFrame, cpi: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(cleaned series, spike log). The screened table is written once and read twice."""
    screened = materialize(screened_weekly(pens, cpi, **options), "screened")
    markets = options.get("markets", ())
    return spikes.cleaned_rows(screened, markets), spikes.spike_log(screened, markets)


def weekly_basis(
    pens: DataFrame, settles: DataFrame, contracts: tuple[str, ...] = C.CONTRACTS,
    tolerance: int = C.SETTLE_FALLBACK_DAYS,
) -> DataFrame:
    """Lots to basis rows for every class, frame, grade, bin and contract."""
    return B.derive_basis(lots.weekly_cash(pens), settles, contracts, tolerance)


def basis_for_views(
    basis: DataFrame, cpi: DataFrame | None, base: date = C.BASE_MONTH, scope: C.LotScope = C.LotScope()
) -> DataFrame:
    """Basis rows the pages show, with their deflator, written once for several views."""
    shown = B.basis_scope(basis, scope.classes, scope.frame, scope.grade)
    return materialize(deflate.with_deflator(shown, cpi, base), "basis")


def price_cells(pens: DataFrame, cpi: DataFrame | None, base: date = C.BASE_MONTH) -> DataFrame:
    """Daily cells with their deflator, written once for several views. Index factors are
    constant within a month, so they apply to cells as well as to lots."""
    return materialize(deflate.with_deflator(lots.daily_cells(pens), cpi, base), "cells")


def price_views(pens: DataFrame, cpi: DataFrame | None, base: date = C.BASE_MONTH) -> dict[str, DataFrame]:
    """All price pages from one scan of the lots."""
    cells = price_cells(pens, cpi, base)
    return {
        "envelope": views.envelope(cells),
        "seasonality": views.seasonality(cells),
        "trend": views.trend(cells),
        "recent": views.recent_trend(cells),
        "compare": views.compare_now(cells),
    }


def card(pens: DataFrame, weeks: int = 26) -> dict[str, DataFrame]:
    """One-page card: latest date with its head count, prices now, recent trend."""
    cells = price_cells(pens, None)
    now = views.latest_rows(cells)
    return {
        "header": now.agg(
            F.max("auction_date").alias("auction_date"),
            F.date_format(F.max("auction_date"), "EEEE, MMMM d, yyyy").alias("auction_day"),
            F.sum("head").alias("n_head"),
        ),
        "prices": views.on_bin_spine(views.current_prices(cells).filter(F.col("mode") == "nominal")),
        "recent": views.recent_trend(cells, weeks),
    }


def refresh_lots(
    spark, raw: DataFrame, prior: DataFrame | None, root: str, tag: str, feeder_only: bool = False
) -> dict[str, bool]:
    """Raw report rows through their gates to published vintages."""
    from drover.operators import quality
    from drover.sources import lots_json, tables

    raw = materialize(raw, "raw-lots")
    feeder = lots_json.feeder_lots(raw, F.lit(tag))
    gate = quality.lot_value_gate(raw)
    if prior is not None:
        gate = quality.all_issues(gate, quality.lot_continuity(feeder, prior))
    ordered = vintage.in_publication_order(feeder, C.LOT_ORDER)
    done = {"lots": tables.publish(ordered, root, "lots", tag, gate)}
    if not feeder_only:
        slaughter = vintage.in_publication_order(lots_json.slaughter_lots(raw, F.lit(tag)), C.SLAUGHTER_ORDER)
        done["lots_slaughter"] = tables.publish(slaughter, root, "lots_slaughter", tag, gate)
    return done
