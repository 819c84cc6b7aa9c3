"""Descriptive profiles and coverage counts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drover.config import FEEDER_CLASSES, LIVE_FLOOR, ROW_CAPS, UNATTRIBUTED_STATE
from drover.functions.bins import bin_floor
from drover.operators.lots import core_lots
from drover.config import LotScope
from drover.operators.quantiles import counts_and_percentile
from drover.session import materialize


def weeks_per_year(df: DataFrame, day: str = "auction_date") -> DataFrame:
    """Distinct sale dates per year."""
    return df.groupBy(F.year(day).alias("year")).agg(F.countDistinct(day).alias("n_weeks"))


def class_shares(
    df: DataFrame, classes: tuple[str, ...] = FEEDER_CLASSES, day: str = "auction_date", weight: Column | None = None
) -> DataFrame:
    """Share of each expected class per year; an absent class has share 0. ``weight`` is the
    rows that a row stands for, one by default."""
    n = F.lit(1) if weight is None else weight
    counts = df.groupBy(F.year(day).alias("year")).agg(
        F.sum(n).alias("_total"),
        *[F.sum(F.when(F.col("class") == c, n).otherwise(0)).alias(f"_{i}") for i, c in enumerate(classes)],
    )
    shares = F.array(*[
        F.struct(F.lit(c).alias("class"), (F.col(f"_{i}") / F.col("_total")).alias("share"))
        for i, c in enumerate(classes)
    ])
    return counts.select("year", F.inline(shares))


def binned_core(lots: DataFrame, first: int = 300, below: int = 1000, extra: tuple[str, ...] = ()) -> DataFrame:
    """Core lots as (date, class, bin low, bin high, price) and ``extra`` columns."""
    lo = bin_floor("weight_break_low", "avg_weight")
    return (
        core_lots(lots, LotScope(commodity=None), strip=False)
        .select("auction_date", "class", lo.alias("weight_break_low"), (lo + 100).alias("weight_break_high"), "price_avg", *extra)
        .filter((F.col("weight_break_low") >= first) & (F.col("weight_break_low") < below))
    )


CELL = ("year", "class", "weight_break_low", "weight_break_high")


def annual_medians(prices: DataFrame, day: str = "auction_date", extra: tuple[str, ...] = ()) -> DataFrame:
    """Exact median price and row count per (year, class, bin) and ``extra`` keys."""
    keys = (*extra, *CELL)
    rows = prices.withColumn("year", F.year(day)).dropna(subset=list(keys))
    counts, medians = counts_and_percentile(
        rows, keys, "price_avg", 0.5, "price_median", [F.count(F.lit(1)).alias("n_obs")]
    )
    return counts.groupBy(*keys).agg(F.sum("n_obs").alias("n_obs")).join(medians, list(keys), "left")


def load_breakdown(policies: DataFrame, watched_state: str = "NM") -> DataFrame:
    """Per year: rows, attributed states, unattributed rows, rows of one watched state,
    and a map of type code to rows."""
    state = F.col("state_abbr")
    # One row per (year, type, state) first; sets and lists are collected from those.
    small = policies.groupBy("reinsurance_year", "type_code", "state_abbr").agg(F.count(F.lit(1)).alias("_n"))
    count_of = lambda code: F.coalesce(F.sum(F.when(state == code, F.col("_n"))), F.lit(0))
    by_type = small.groupBy("reinsurance_year", "type_code").agg(
        F.sum("_n").alias("_n"),
        count_of(UNATTRIBUTED_STATE).alias("_xx"),
        count_of(watched_state).alias("_watched"),
        F.collect_set(F.when(state != UNATTRIBUTED_STATE, state)).alias("_states"),
    )
    pair = F.when(F.col("type_code").isNotNull(), F.struct("type_code", "_n"))
    return by_type.groupBy("reinsurance_year").agg(
        F.sum("_n").alias("rows"),
        F.size(F.array_distinct(F.flatten(F.collect_list("_states")))).cast("long").alias("unique_states"),
        F.sum("_xx").alias("rows_unattributed"),
        F.sum("_watched").alias("rows_watched"),
        F.map_from_entries(F.sort_array(F.collect_list(pair))).alias("type_code_counts"),
    )


def basis_ranges_by_contract(basis: DataFrame) -> DataFrame:
    """Min, max, median basis and rows per contract. The basis, one row per cell and contract,
    is written first: two passes read it, and deriving it again costs a scan of the lots."""
    basis = materialize(basis.select("contract_month", "basis"), "basis")
    rows = basis.filter(F.col("basis").isNotNull() & F.col("contract_month").isNotNull())
    counts, medians = counts_and_percentile(rows, ("contract_month",), "basis", 0.5, "basis_median")
    stats = counts.groupBy("contract_month").agg(
        F.min("_min").alias("basis_min"), F.max("_max").alias("basis_max"), F.sum("_c").alias("n")
    )
    return stats.join(medians, "contract_month")


def top_values(df: DataFrame, columns: tuple[str, ...], top: int = 10) -> DataFrame:
    """The ``top`` most frequent values of each column, in one pass over the data."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])
    counts = (
        df.select(F.inline(pairs)).filter(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    # Ranked per column; Spark keeps only the first `top` rows of each partition first.
    w = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def policy_profile(policies: DataFrame) -> DataFrame:
    """One-row profile: ranges, distinct states, median coverage price, paid endorsements."""
    parts = [
        F.count(F.lit(1)).alias("rows"),
        *[f(c).alias(f"{c}_{n}") for c in ("effective_date", "end_date") for n, f in (("min", F.min), ("max", F.max))],
        F.count_if(F.col("indemnity_amount") != 0).alias("n_nonzero_indemnity"),
    ]
    counts, median = counts_and_percentile(
        policies, ("_all",), "coverage_price", 0.5, "coverage_price_median", parts,
        base=("state_abbr", "reinsurance_year"), fan=lambda d: d.withColumn("_all", F.lit(1)),
    )
    stats = counts.withColumn("_all", F.lit(1)).groupBy("_all").agg(
        F.sum("rows").alias("rows"),
        F.countDistinct("state_abbr").alias("n_states"),
        F.countDistinct("reinsurance_year").alias("n_years"),
        F.min("effective_date_min").alias("effective_min"),
        F.max("effective_date_max").alias("effective_max"),
        F.min("end_date_min").alias("end_min"),
        F.max("end_date_max").alias("end_max"),
        F.min("_min").alias("coverage_price_min"),
        F.max("_max").alias("coverage_price_max"),
        F.sum("n_nonzero_indemnity").alias("n_nonzero_indemnity"),
    )
    return stats.join(median, "_all").drop("_all")


def report_day(candidates: tuple[str, ...]) -> Column:
    """First non-empty date column, tried in four notations, time of day ignored."""
    raw = F.coalesce(*[F.when(F.col(c).cast("string") != "", F.col(c).cast("string")) for c in candidates])
    head = F.regexp_extract(raw, r"^([^T ]*)", 1)
    # Accepted notations, in order of preference.
    notations = ("M/d/yyyy", "yyyy-M-d", "M-d-yyyy", "yyyy/M/d")
    return F.coalesce(*[F.try_to_timestamp(head, F.lit(f)).cast("date") for f in notations])


def depth_probe(days: DataFrame, day: str = "day", floor: date = LIVE_FLOOR) -> DataFrame:
    """How far back a feed reaches: rows, first and last date, gap to a floor date, and
    whether the row count sits exactly on a known cap."""
    gap = F.datediff(F.col("earliest"), F.lit(floor))
    return days.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count(day).alias("n_dated"),
        F.min(day).alias("earliest"),
        F.max(day).alias("latest"),
    ).withColumns({
        "covered": F.col("earliest") <= F.lit(floor),
        "gap_days": gap,
        "gap_weeks": F.floor(F.greatest(gap, F.lit(0)) / 7).cast("int"),
        "at_row_cap": F.col("n_records").isin(*ROW_CAPS),
    })


def rows_per_year(df: DataFrame, day: str) -> DataFrame:
    return df.filter(F.col(day).isNotNull()).groupBy(F.year(day).alias("year")).agg(F.count(F.lit(1)).alias("n"))


def volume_dip(df: DataFrame, year: int, neighbours: tuple[int, ...], day: str = "auction_date") -> DataFrame:
    """Rows of one year against the range of its neighbours; a missing year counts 0."""
    y = F.year(day)
    counts = df.agg(
        F.count_if(y == year).alias("n_year"), *[F.count_if(y == n).alias(f"_{n}") for n in neighbours]
    )
    around = [F.col(f"_{n}") for n in neighbours]
    return counts.select(
        F.lit(year).alias("year"), "n_year",
        F.least(*around).alias("adjacent_min"), F.greatest(*around).alias("adjacent_max"),
    )


def sample_per_year(df: DataFrame, day: str = "auction_date") -> DataFrame:
    """First row of each year, ties broken by the remaining columns. The first date of
    each year (one row per calendar year) narrows the rows before any is compared."""
    starts = df.filter(F.col(day).isNotNull()).groupBy(F.year(day).alias("year")).agg(F.min(day).alias(day))
    order = F.struct(*[c for c in df.columns if c != day])
    return df.join(F.broadcast(starts), day).groupBy("year").agg(
        F.min_by(F.struct(*df.columns), order).alias("_r")
    ).select("year", "_r.*")
