"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from drover.functions.columns import col

# Months each rolling window reaches back.
WINDOW_MONTHS = {"5y": 60, "3y": 36}


def month_start(c: Column | str) -> Column:
    return F.trunc(col(c), "month")


def iso_week(c: Column | str) -> Column:
    """ISO week with the rare week 53 folded into 52."""
    return F.least(F.weekofyear(col(c)), F.lit(52))


def windows_of(day: Column | str, anchor: Column, keys: tuple[str, ...]) -> Column:
    """Array of the rolling windows a date belongs to, counted back from ``anchor``."""
    day = col(day)
    tests = []
    for key in keys:
        if key == "all":
            start = None
        elif key == "latest":
            start = F.trunc(anchor, "year")
        else:
            start = F.add_months(anchor, -WINDOW_MONTHS[key])
        inside = day <= anchor if start is None else day.between(start, anchor)
        tests.append(F.when(inside, F.lit(key)))
    return F.array_compact(F.array(*tests))


def year_windows_of(year: Column | str, first: Column, last: Column, keys: tuple[str, ...]) -> Column:
    """Array of the calendar-year windows a year belongs to, counted back from ``last``."""
    year = col(year)
    return F.array_compact(F.array(*[
        F.when(year.between(year_window_start(k, first, last), last), F.lit(k)) for k in keys
    ]))


def year_window_start(key: str, first: Column, last: Column) -> Column:
    # Years each window spans.
    spans = {"last_5": 5, "last_3": 3, "latest": 1}
    if key == "all":
        return first
    if key not in spans:
        raise ValueError(f"unknown year window {key!r}; choose from all, {', '.join(spans)}")
    return F.greatest(last - (spans[key] - 1), first)
