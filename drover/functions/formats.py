"""Display text; missing values show as a dash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from drover.functions.columns import col

DASH = "—"


def _or_dash(value: Column, shown: Column) -> Column:
    return F.when(value.isNull(), F.lit(DASH)).otherwise(shown)


def millions(c: Column | str) -> Column:
    v = col(c)
    return _or_dash(v, F.format_string("$%.1fM", v.cast("double") / 1_000_000))


def whole(c: Column | str) -> Column:
    v = col(c)
    return _or_dash(v, F.format_number(v.cast("long"), 0))


def percent(c: Column | str, places: int = 1) -> Column:
    v = col(c)
    return _or_dash(v, F.format_string(f"%.{places}f%%", v.cast("double") * 100))


def decimals(c: Column | str, places: int = 2) -> Column:
    v = col(c)
    return _or_dash(v, F.format_string(f"%.{places}f", v.cast("double")))


def dollars(c: Column | str) -> Column:
    v = col(c)
    return _or_dash(v, F.concat(F.lit("$"), F.format_number(v.cast("double"), 2)))


def weeks(c: Column | str) -> Column:
    v = col(c)
    return _or_dash(v, F.format_string("%.1f wks", v.cast("double")))
