"""Cleaning and null-safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drover.config import MISSING_MARKERS


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    return F.when(~F.isnan(col(c)), col(c))


def clean_doubles(df: DataFrame) -> DataFrame:
    """NaN means missing in the inputs; Spark would sort it last and poison averages."""
    fixes = {
        f.name: nan_to_null(f.name)
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(fixes) if fixes else df


def marker_to_null(c: Column | str) -> Column:
    """Suppression markers become null, other text is trimmed."""
    text = F.trim(col(c))
    return F.when(~text.isin(*MISSING_MARKERS), text)


def text(c: Column | str) -> Column:
    """Trimmed text, empty to null."""
    trimmed = F.trim(col(c))
    return F.when(trimmed != "", trimmed)


def number(c: Column | str) -> Column:
    """Number or null, never an error."""
    return nan_to_null(F.trim(col(c).cast("string")).try_cast("double"))


def integer(c: Column | str, type_name: str = "int") -> Column:
    return number(c).try_cast(type_name)


def parsed_date(c: Column | str, *formats: str) -> Column:
    """First format that parses, else null."""
    return F.coalesce(*[F.try_to_timestamp(F.trim(col(c)), F.lit(f)).cast("date") for f in formats])


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """0.0 where the denominator is zero or null; a null numerator counts as zero."""
    n = F.coalesce(col(numerator).cast("double"), F.lit(0.0))
    d = F.coalesce(col(denominator).cast("double"), F.lit(0.0))
    return F.when(d != 0, n / d).otherwise(F.lit(0.0))


def positive_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Like :func:`safe_ratio`, but a negative denominator also gives 0.0."""
    return F.when(
        col(denominator) > 0,
        F.coalesce(col(numerator), F.lit(0)).cast("double") / col(denominator),
    ).otherwise(F.lit(0.0))


def sum0(c: Column | str) -> Column:
    """Sum where "nothing to add" is zero."""
    total = F.sum(col(c))
    return F.coalesce(total, F.lit(0).cast("long"))


def county_id(state: Column | str, county: Column | str) -> Column:
    """Zero-padded state (2) and county (3) code in one identifier."""
    return F.concat(F.lpad(col(state), 2, "0"), F.lpad(col(county), 3, "0"))


def scalar_max(df: DataFrame, column: str) -> Column:
    """Largest value as a one-row subquery, usable in any expression."""
    return df.agg(F.max(column)).scalar()
