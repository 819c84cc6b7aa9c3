"""Bounded as-of settles and cash-minus-futures basis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drover.config import BASIS_ORDER, CONTRACTS, SETTLE_FALLBACK_DAYS


def settle_calendar(
    settles: DataFrame,
    contracts: tuple[str, ...] = CONTRACTS,
    tolerance: int = SETTLE_FALLBACK_DAYS,
) -> DataFrame:
    """The settle in force on each calendar day: that day's, or the latest one at most
    ``tolerance`` days earlier.

    Instead of searching backwards from every sale date, each settle is laid forward
    over the days it may serve and the newest one wins. That is two hash aggregations
    with no range join, and the result holds at most (calendar days x contracts)
    rows, which bounds the broadcast in :func:`derive_basis`.
    """
    daily = (
        settles.filter(F.col("settle").isNotNull() & F.col("contract_month").isin(*contracts))
        .groupBy("date", "contract_month")
        .agg(F.max("settle").alias("settle"))
    )
    served = daily.withColumn(
        "auction_date", F.explode(F.sequence("date", F.date_add("date", tolerance)))
    )
    return served.groupBy("auction_date", "contract_month").agg(
        F.max_by("settle", "date").alias("settle"), F.max("date").alias("settle_date")
    )


def lookup_settles(
    sales: DataFrame,
    settles: DataFrame,
    contracts: tuple[str, ...] = CONTRACTS,
    tolerance: int = SETTLE_FALLBACK_DAYS,
) -> DataFrame:
    """Settles for the dates that occur in ``sales``; a miss gives no row."""
    days = sales.select("auction_date").distinct()
    calendar = settle_calendar(settles, contracts, tolerance)
    return days.join(F.broadcast(calendar), "auction_date").select(
        "auction_date", "contract_month", "settle", "settle_date"
    )


def derive_basis(
    cash: DataFrame,
    settles: DataFrame,
    contracts: tuple[str, ...] = CONTRACTS,
    tolerance: int = SETTLE_FALLBACK_DAYS,
) -> DataFrame:
    """Cash minus settle, one row per contract found; one row with a null contract where
    no contract has a settle. Settles themselves do not leave this function."""
    calendar = settle_calendar(settles, contracts, tolerance)
    return cash.join(F.broadcast(calendar), "auction_date", "left").select(
        "auction_date", "class", "frame", "muscle_grade", "weight_break_low", "weight_break_high",
        "price_avg_cash", "n_lots", "contract_month",
        (F.col("price_avg_cash") - F.col("settle")).alias("basis"),
    )


def basis_in_order(basis: DataFrame) -> DataFrame:
    return basis.orderBy(*[F.asc_nulls_last(c) for c in BASIS_ORDER])


def basis_scope(
    basis: DataFrame, classes: tuple[str, ...], frame: str, grade: str, first: int = 300, below: int = 900
) -> DataFrame:
    """Rows the basis views show."""
    lo = F.col("weight_break_low")
    return basis.filter(
        F.col("class").isin(*classes) & (F.col("frame") == frame) & (F.col("muscle_grade") == grade)
        & F.col("basis").isNotNull() & (lo >= first) & (lo < below)
    )


def strict_basis(basis: DataFrame, cls: str = "Steers", lo: int = 700) -> DataFrame:
    """The slice that matches the futures contract specification."""
    return basis.filter((F.col("class") == cls) & (F.col("weight_break_low") == lo))
