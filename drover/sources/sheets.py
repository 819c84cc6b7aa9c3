"""Wide sheets (one column per contract or per class and bin) to long tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drover.config import CONTRACT_COLUMNS, SETTLE_MAX, SETTLE_MIN
from drover.functions.columns import number


def settles_long(wide: DataFrame, contracts: tuple[str, ...] = CONTRACT_COLUMNS, day: str = "date") -> DataFrame:
    """(date, contract_month, settle) with missing settles removed."""
    typed = wide.filter(F.col(day).isNotNull()).select(F.col(day).cast("date").alias("date"), *[number(c).alias(c) for c in contracts])
    return typed.unpivot(["date"], list(contracts), "contract_month", "settle").filter(F.col("settle").isNotNull())


def plausible_settles(long: DataFrame, lo: float = SETTLE_MIN, hi: float = SETTLE_MAX) -> DataFrame:
    return long.filter(F.col("settle").between(lo, hi))


def rejected_settles(long: DataFrame, lo: float = SETTLE_MIN, hi: float = SETTLE_MAX) -> DataFrame:
    """Out-of-bounds settles, for the count and the log."""
    return long.filter(~F.col("settle").between(lo, hi))


# Fixed values: (class, lower bin edges) in sheet order.
SECOND_OPINION = (("Steers", tuple(range(300, 1000, 100))), ("Heifers", tuple(range(300, 900, 100))))


def second_opinion_columns(layout=SECOND_OPINION) -> dict[str, tuple[str, int]]:
    """Column name to (class, lower edge): ``steers_300`` and so on."""
    return {f"{cls.lower()}_{lo}": (cls, lo) for cls, edges in layout for lo in edges}


def second_opinion_long(wide: DataFrame, day: str = "date", layout=SECOND_OPINION) -> DataFrame:
    """(auction_date, class, bin low, bin high, price) from a class-by-bin sheet."""
    columns = second_opinion_columns(layout)
    cells = F.array(*[
        F.struct(
            F.lit(cls).alias("class"), F.lit(lo).alias("weight_break_low"),
            F.lit(lo + 100).alias("weight_break_high"), number(name).alias("price_avg"),
        )
        for name, (cls, lo) in columns.items()
    ])
    dated = wide.withColumn("auction_date", F.col(day).cast("string").try_cast("date"))
    return dated.filter(F.col("auction_date").isNotNull()).select("auction_date", F.inline(cells)).filter(
        F.col("price_avg").isNotNull()
    )
