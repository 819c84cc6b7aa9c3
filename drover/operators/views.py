"""Price and basis views: envelopes, seasonality, trends, same-week comparison.

Every function starts from a small table (:func:`~drover.operators.lots.daily_cells` or
weekly basis) and produces all windows and both money modes in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drover.config import CORE_CLASSES, WINDOW_KEYS
from drover.functions.bins import page_label
from drover.functions.columns import scalar_max
from drover.functions.dates import iso_week, windows_of
from drover.functions.weighted import ZERO_IF_MISSING, from_parts, merge_parts


def in_windows(df: DataFrame, anchor: Column, keys: tuple[str, ...] = WINDOW_KEYS, day: str = "auction_date") -> DataFrame:
    """One copy of each row per rolling window it belongs to (at most ``len(keys)``)."""
    return df.withColumn("window", F.explode(windows_of(day, anchor, keys)))


def in_modes(df: DataFrame) -> DataFrame:
    """One copy per money mode with the factor that turns nominal into that mode."""
    modes = F.array(
        F.struct(F.lit("nominal").alias("mode"), F.lit(1.0).alias("factor")),
        F.struct(F.lit("real").alias("mode"), F.col("deflator").alias("factor")),
    )
    return df.select("*", F.inline(modes))


def _views(cells: DataFrame, keys: tuple[str, ...] = WINDOW_KEYS) -> DataFrame:
    """Cells by window and mode. ``cells`` should be a materialized table: it is read
    once for the anchor date and once for the rows."""
    return in_modes(in_windows(cells, scalar_max(cells, "auction_date"), keys))


def envelope(cells: DataFrame) -> DataFrame:
    """Min, mean, max price and head per (window, mode, class, bin)."""
    f = F.col("factor")
    return (
        _views(cells)
        .groupBy("window", "mode", "class", "bin_lo")
        .agg(
            F.min(F.col("low") * f).alias("price_low"),
            F.try_divide(F.sum(F.col("p_x") * f), F.sum("p_n")).alias("price_mean"),
            F.max(F.col("high") * f).alias("price_high"),
            F.sum("head").alias("head_count"),
        )
        .withColumn("weight_bin", page_label("bin_lo"))
    )


def _mean_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    return (
        df.groupBy(*keys)
        .agg(
            F.try_divide(F.sum(F.col("p_x") * F.col("factor")), F.sum("p_n")).alias("price"),
            F.sum("p_n").alias("n"),
        )
        .withColumn("weight_bin", page_label("bin_lo"))
    )


def seasonality(cells: DataFrame) -> DataFrame:
    """Mean price and lot count per (window, mode, class, bin, ISO week)."""
    return _mean_by(
        _views(cells), "window", "mode", "class", "bin_lo", iso_week("auction_date").alias("iso_week")
    )


def trend(cells: DataFrame) -> DataFrame:
    """Mean price and lot count per (window, mode, class, bin, date)."""
    return _mean_by(_views(cells), "window", "mode", "class", "bin_lo", "auction_date")


def recent_trend(cells: DataFrame, weeks: int = 26) -> DataFrame:
    """Nominal daily means of the last ``weeks`` weeks."""
    start = F.date_sub(scalar_max(cells, "auction_date"), 7 * weeks)
    recent = cells.filter(F.col("auction_date") >= start).withColumn("factor", F.lit(1.0))
    return _mean_by(recent, "class", "bin_lo", "auction_date").drop("n")


def latest_rows(df: DataFrame, day: str = "auction_date") -> DataFrame:
    """Rows of the latest date."""
    return df.filter(F.col(day) == scalar_max(df, day))


def current_prices(cells: DataFrame) -> DataFrame:
    """Head-weighted price per (mode, class, bin) on the latest date."""
    now = in_modes(latest_rows(cells))
    return now.select(
        "mode", "class", "bin_lo", from_parts("p", ZERO_IF_MISSING, F.col("factor")).alias("price")
    )


def same_week_prices(cells: DataFrame, keys: tuple[str, ...] = ("all", "5y", "3y")) -> DataFrame:
    """One head-weighted price per (window, mode, class, bin, prior year), using only the
    ISO week of the latest date."""
    anchor = scalar_max(cells, "auction_date")
    # All dates of one year's cell share a week but not always a month, so the factor
    # is applied to the price sums before they are merged.
    same = cells.filter(
        (iso_week("auction_date") == iso_week(anchor)) & (F.year("auction_date") < F.year(anchor))
    )
    return (
        in_modes(in_windows(same, anchor, keys))
        .withColumns({"p_wx": F.col("p_wx") * F.col("factor"), "p_x": F.col("p_x") * F.col("factor")})
        .groupBy("window", "mode", "class", "bin_lo", F.year("auction_date").alias("year"))
        .agg(*merge_parts("p"))
        .select("window", "mode", "class", "bin_lo", "year", from_parts("p", ZERO_IF_MISSING).alias("price"))
    )


def history_band(yearly: DataFrame) -> DataFrame:
    """Distribution over years per cell. The exact percentiles see one value per year."""
    return yearly.groupBy("window", "mode", "class", "bin_lo").agg(
        F.min("price").alias("hist_min"),
        F.avg("price").alias("hist_avg"),
        F.max("price").alias("hist_max"),
        F.count("price").alias("n_years"),
        F.percentile("price", F.lit(0.25)).alias("q25"),
        F.percentile("price", F.lit(0.75)).alias("q75"),
    )


def band_of(price: Column, q25: Column, q75: Column) -> Column:
    """``top`` wins over ``bot`` when both edges coincide; no price is ``mid``."""
    return F.when(price >= q75, "top").when(price <= q25, "bot").otherwise("mid")


def compare_now(cells: DataFrame) -> DataFrame:
    """History band with the current price, its band and the distance from the mean.

    Both sides are keyed by (mode, class, bin) after aggregation: a few hundred rows.
    """
    history = history_band(same_week_prices(cells))
    merged = history.join(current_prices(cells), ["mode", "class", "bin_lo"], "left")
    return merged.withColumns({
        "weight_bin": page_label("bin_lo"),
        "band": band_of(F.col("price"), F.col("q25"), F.col("q75")),
        "delta": F.col("price") - F.col("hist_avg"),
    })


def on_bin_spine(df: DataFrame, classes: tuple[str, ...] = CORE_CLASSES, first: int = 300, last: int = 800) -> DataFrame:
    """Give every class all ladder bins; bins without data show nulls.

    The spine is the fixed ladder (classes x bins), so its broadcast is constant in size.
    """
    spark = df.sparkSession
    spine = spark.range(first, last + 1, 100).select(
        F.explode(F.array(*[F.lit(c) for c in classes])).alias("class"),
        F.col("id").cast("int").alias("bin_lo"),
    )
    return spine.join(df, ["class", "bin_lo"], "left")


def position_text(df: DataFrame) -> DataFrame:
    """Table cells: price, signed distance from the mean, and position among years."""
    money = lambda c: F.format_string("$%.2f", c)
    price, delta = F.col("price"), F.col("delta")
    sign = F.when(delta >= 0, "+").otherwise("")
    # The words for each band.
    words = F.when(F.col("band") == "top", "Top 25%").when(F.col("band") == "bot", "Bottom 25%").otherwise("Middle 50%")
    known = price.isNotNull() & F.col("hist_avg").isNotNull()
    return df.withColumns({
        "price_text": F.when(price.isNull(), "—").otherwise(money(price)),
        "avg_text": F.when(F.col("hist_avg").isNull(), "—").otherwise(money(F.col("hist_avg"))),
        "delta_text": F.when(~known, "—").otherwise(F.concat(sign, money(delta))),
        "position_text": F.when(~known, "—").otherwise(
            F.concat(words, F.lit(" (of "), F.col("n_years").cast("string"), F.lit(" yr)"))
        ),
    })


def basis_band(basis: DataFrame) -> DataFrame:
    """Min, mean, max basis per (window, contract, mode, class, bin, ISO week). ``basis``
    needs a deflator and is read twice, so pass a materialized table."""
    rows = _basis_views(basis)
    return (
        rows.groupBy(
            "window", "contract_month", "mode", "class", F.col("weight_break_low").alias("bin_lo"),
            iso_week("auction_date").alias("iso_week"),
        )
        .agg(
            F.min("value").alias("basis_min"),
            F.avg("value").alias("basis_avg"),
            F.max("value").alias("basis_max"),
            F.count("value").alias("n"),
        )
        .withColumn("weight_bin", page_label("bin_lo"))
    )


def _basis_views(basis: DataFrame) -> DataFrame:
    views = in_modes(in_windows(basis, scalar_max(basis, "auction_date")))
    return views.withColumn("value", F.col("basis") * F.col("factor"))


# Axis range shown when a slice is empty.
EMPTY_RANGE = {"strict": (-30.0, 10.0), "all": (-50.0, 50.0)}


def basis_ranges(basis: DataFrame, contracts: tuple[str, ...], strict: tuple[str, int] = ("Steers", 700)) -> DataFrame:
    """Padded value range per (window, contract, mode, slice), with a default for slices
    that have no rows. The spine of combinations is fixed in size."""
    is_strict = (F.col("class") == strict[0]) & (F.col("weight_break_low") == strict[1])
    found = (
        _basis_views(basis)
        .withColumn("slice", F.explode(F.when(is_strict, F.array(F.lit("strict"), F.lit("all"))).otherwise(F.array(F.lit("all")))))
        .groupBy("window", "contract_month", "mode", "slice")
        .agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    )
    lits = lambda values: F.array(*[F.lit(v) for v in values])
    spine = (
        basis.sparkSession.range(1)
        .select(F.explode(lits(WINDOW_KEYS)).alias("window"))
        .select("window", F.explode(lits(contracts)).alias("contract_month"))
        .select("*", F.explode(lits(("nominal", "real"))).alias("mode"))
        .select("*", F.explode(lits(tuple(EMPTY_RANGE))).alias("slice"))
    )
    pad = F.greatest((F.col("hi") - F.col("lo")) * 0.05, F.lit(1.0))
    default = lambda i: F.when(F.col("slice") == "strict", EMPTY_RANGE["strict"][i]).otherwise(EMPTY_RANGE["all"][i])
    return spine.join(found, ["window", "contract_month", "mode", "slice"], "left").select(
        "window", "contract_month", "mode", "slice",
        F.coalesce(F.col("lo") - pad, default(0)).alias("y_min"),
        F.coalesce(F.col("hi") + pad, default(1)).alias("y_max"),
    )


def chart_order(cells: DataFrame) -> DataFrame:
    """Lots per class, bin and ISO week in the order charts draw them."""
    weekly = cells.groupBy("class", "bin_lo", iso_week("auction_date").alias("iso_week")).agg(F.sum("n_lots").alias("n"))
    return weekly.orderBy("class", "bin_lo", "iso_week")


def caption(df: DataFrame, day: str = "auction_date") -> DataFrame:
    """First and last date, distinct dates, distinct years and rows. Reduced to one row per
    date first, so the distinct counts see calendar days, not lots."""
    daily = df.groupBy(day).agg(F.count(F.lit(1)).alias("_n"))
    return daily.agg(
        F.min(day).alias("date_min"),
        F.max(day).alias("date_max"),
        F.count(day).alias("n_dates"),
        F.countDistinct(F.year(day)).alias("n_years"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
    )
