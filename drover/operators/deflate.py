"""Constant-dollar conversion with a monthly price index."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drover.config import BASE_MONTH
from drover.functions.dates import month_start


def index_by_month(cpi: DataFrame) -> DataFrame:
    """One row per calendar month, so at most 12 rows per calendar year whatever the
    input size. That bound is what allows the broadcast in the joins below."""
    pick = F.max_by("cpi_u", F.struct("vintage", "cpi_u")) if "vintage" in cpi.columns else F.max("cpi_u")
    return (
        cpi.filter(month_start("period").isNotNull() & F.col("cpi_u").isNotNull())
        .groupBy(month_start("period").alias("period"))
        .agg(pick.alias("cpi_u"))
    )


def strict_base(index: DataFrame, base: date = BASE_MONTH) -> Column:
    """Index level of the base month; the job fails if that month is missing."""
    level = index.agg(F.max(F.when(F.col("period") == F.lit(base), F.col("cpi_u")))).scalar()
    missing = F.raise_error(F.lit(f"base month {base} is not in the price index")).cast("double")
    return F.coalesce(level, missing)


def lenient_base(index: DataFrame, base: date = BASE_MONTH) -> Column:
    """Index level of the base month, or of the latest month; null with no index."""
    return index.agg(
        F.coalesce(
            F.max(F.when(F.col("period") == F.lit(base), F.col("cpi_u"))),
            F.max_by("cpi_u", "period"),
        )
    ).scalar()


def deflate_strict(
    weekly: DataFrame, cpi: DataFrame, base: date = BASE_MONTH, day: str = "auction_date"
) -> DataFrame:
    """Adds ``cpi_at_obs``, ``cpi_base`` and ``price_real``; rows without an index month
    are dropped (:func:`undeflated` lists them)."""
    index = index_by_month(cpi)
    lookup = index.select(
        F.col("period").alias("_month"),
        F.col("cpi_u").alias("cpi_at_obs"),
        strict_base(index, base).alias("cpi_base"),
    )
    return (
        weekly.withColumn("_month", month_start(day))
        .join(F.broadcast(lookup), "_month")
        .drop("_month")
        .withColumn("price_real", F.col("price_nominal") * (F.col("cpi_base") / F.col("cpi_at_obs")))
    )


def undeflated(weekly: DataFrame, cpi: DataFrame, day: str = "auction_date") -> DataFrame:
    """Rows the strict form drops."""
    months = index_by_month(cpi).select(F.col("period").alias("_month"))
    return (
        weekly.withColumn("_month", month_start(day))
        .join(F.broadcast(months), "_month", "left_anti")
        .drop("_month")
    )


def with_deflator(
    df: DataFrame, cpi: DataFrame | None, base: date = BASE_MONTH, day: str = "auction_date"
) -> DataFrame:
    """Adds ``deflator``: base level over the month's level, 1.0 where there is none."""
    if cpi is None:
        return df.withColumn("deflator", F.lit(1.0))
    index = index_by_month(cpi)
    lookup = index.select(
        F.col("period").alias("_month"),
        (lenient_base(index, base) / F.col("cpi_u")).alias("_factor"),
    )
    return (
        df.withColumn("_month", month_start(day))
        .join(F.broadcast(lookup), "_month", "left")
        .withColumn("deflator", F.coalesce("_factor", F.lit(1.0)))
        .drop("_month", "_factor")
    )


def real_columns(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``<column>_real`` for each column, from the row's deflator."""
    return df.withColumns({f"{c}_real": F.col(c) * F.col("deflator") for c in columns})


def index_series(cpi: DataFrame, base: date = BASE_MONTH) -> DataFrame:
    """The monthly series with the base-month level on every row (null if absent)."""
    index = index_by_month(cpi)
    level = index.agg(F.max(F.when(F.col("period") == F.lit(base), F.col("cpi_u")))).scalar()
    return index.select("period", "cpi_u", level.alias("base_level")).orderBy("period")
