"""Scenario pricing over many lots: price slides, sale channels, hold-or-sell."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drover.config import CHANNELS, Channel


def range_errors(limits: dict[str, tuple[str, float, float]]) -> Column:
    """Joined messages for values that are missing or out of range; empty when fine."""
    tests = []
    for name, (label, lo, hi) in limits.items():
        v = F.col(name).cast("double")
        finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
        show = lambda x: f"{x:g}"
        # Wording of the messages.
        tests.append(
            F.when(~finite, F.lit(f"{label} must be a number."))
            .when(v < lo, F.lit(f"{label} must be at least {show(lo)}."))
            .when(v > hi, F.lit(f"{label} must be at most {show(hi)}."))
        )
    return F.concat_ws(" ", *tests)


# Accepted input ranges.
SLIDE_LIMITS = {
    "base_price": ("Base price", 0, 2000),
    "base_weight": ("Base weight", 100, 2000),
    "weight_window": ("Weight window", 0, 200),
    "slide_rate": ("Slide rate", 0, 50),
    "shrink_pct": ("Shrink", 0, 20),
    "delivered_weight": ("Delivered weight", 100, 2000),
    "head_count": ("Head count", 1, 10000),
}
CHANNEL_LIMITS = {
    "lot_size": ("Number of head", 1, 10000),
    "avg_weight": ("Average weight", 100, 2000),
    "base_price": ("Base cash price", 0, 2000),
    "distance_local": ("Distance to local barn", 0, 1000),
    "distance_video": ("Video-rep distance", 0, 500),
    "hauling_rate": ("Hauling rate", 0, 20),
}


def split_valid(df: DataFrame, limits: dict[str, tuple[str, float, float]]) -> tuple[DataFrame, DataFrame]:
    """Rows within the limits, and the others with an ``error`` text."""
    checked = df.withColumn("error", range_errors(limits))
    return checked.filter(F.col("error") == "").drop("error"), checked.filter(F.col("error") != "")


def price_slide(contracts: DataFrame) -> DataFrame:
    """Settle contracts with a weight slide. Heavier than the window lowers the price;
    lighter raises it only in a two-way contract."""
    c = F.col
    shrink = 1 - c("shrink_pct") / 100
    effective = F.when(c("weight_basis") == "pre-shrink", c("base_weight") * shrink).otherwise(c("base_weight"))
    base = contracts.withColumns({"shrink_factor": shrink, "pay_weight": c("delivered_weight") * shrink, "effective_base": effective})
    limits = base.withColumns({
        "upper_window": c("effective_base") + c("weight_window"),
        "lower_window": c("effective_base") - c("weight_window"),
    })
    over, under = c("pay_weight") > c("upper_window"), c("pay_weight") < c("lower_window")
    sided = limits.withColumns({
        "direction": F.when(over, "over").when(under, "under").otherwise("in-window"),
        "distance_cwt": F.when(over, (c("pay_weight") - c("upper_window")) / 100)
        .when(under, (c("lower_window") - c("pay_weight")) / 100)
        .otherwise(F.lit(0.0)),
    })
    step = c("distance_cwt") * c("slide_rate")
    adjusted = sided.withColumn(
        "slide_adjustment",
        F.when(c("direction") == "over", -step)
        .when((c("direction") == "under") & (c("slide_direction") == "two-way"), step)
        .otherwise(F.lit(0.0)),
    )
    return (
        adjusted.withColumn("adjusted_price", c("base_price") + c("slide_adjustment"))
        .withColumn("per_head", c("pay_weight") * (c("adjusted_price") / 100))
        .withColumn("total", c("per_head") * c("head_count"))
    )


def _net_per_cwt(ch: Channel) -> Column:
    """Net price per hundredweight of gross weight in one channel."""
    c = F.col
    gross_cwt = c("lot_size") * c("avg_weight") / 100
    gross_pay = c("base_price") * (c("lot_size") * c("avg_weight") * (1 - ch.shrink_pct / 100) / 100)
    distance = {"local": c("distance_local"), "video": c("distance_video")}.get(ch.haul, F.lit(0.0))
    kept = gross_pay * (1 - ch.commission_pct / 100)
    return (kept - c("lot_size") * (ch.yardage + ch.inspection + ch.fees) - distance * c("hauling_rate")) / gross_cwt


def channel_net(lots: DataFrame, channels: tuple[Channel, ...] = CHANNELS) -> DataFrame:
    """Net revenue of every lot in every channel: a narrow fan-out over the constant cost
    table, then one set of expressions for all channels, and no join."""
    c = F.col
    costs = F.array(*[
        F.struct(
            F.lit(ch.name).alias("channel"), F.lit(ch.commission_pct).alias("_commission"), F.lit(ch.yardage).alias("_yardage"),
            F.lit(ch.inspection).alias("_inspection"), F.lit(ch.fees).alias("_fees"), F.lit(ch.shrink_pct).alias("_shrink"),
            F.lit(ch.haul).alias("_haul"),
        )
        for ch in channels
    ])
    distance = F.when(c("_haul") == "local", c("distance_local")).when(c("_haul") == "video", c("distance_video")).otherwise(0.0)
    fanned = lots.select("*", F.inline(costs))
    weighed = fanned.withColumns({
        "_gross_cwt": c("lot_size") * c("avg_weight") / 100,
        "_pay_cwt": c("lot_size") * c("avg_weight") * (1 - c("_shrink") / 100) / 100,
        "hauling": distance * c("hauling_rate"),
    })
    priced = weighed.withColumn("gross_at_pay_weight", c("base_price") * c("_pay_cwt")).withColumns({
        "commission": c("gross_at_pay_weight") * (c("_commission") / 100),
        "shrink_loss": (c("_gross_cwt") - c("_pay_cwt")) * c("base_price"),
    })
    per_head = c("lot_size") * c("_yardage") + c("lot_size") * c("_inspection") + c("lot_size") * c("_fees")
    netted = priced.withColumn("total_deductions", c("commission") + per_head + c("hauling")).withColumn(
        "net_revenue", c("gross_at_pay_weight") - c("total_deductions")
    )
    return netted.withColumns({
        "net_per_cwt_gross": c("net_revenue") / c("_gross_cwt"),
        "net_per_cwt_pay": c("net_revenue") / c("_pay_cwt"),
        "net_per_head": c("net_revenue") / c("lot_size"),
    }).drop("_commission", "_yardage", "_inspection", "_fees", "_shrink", "_haul", "_gross_cwt", "_pay_cwt")


def channel_spread(lots: DataFrame, channels: tuple[Channel, ...] = CHANNELS) -> DataFrame:
    """Lowest and highest net price per lot and how wide the spread is. The comparison
    stays inside the row, so nothing is shuffled. The first channel wins a tie."""
    nets = {f"_net{i}": _net_per_cwt(ch) for i, ch in enumerate(channels)}
    extremes = lots.withColumns(nets).withColumns({
        "net_min": F.least(*nets) if len(nets) > 1 else F.col("_net0"),
        "net_max": F.greatest(*nets) if len(nets) > 1 else F.col("_net0"),
    })
    named = lambda edge: F.coalesce(*[
        F.when(F.col(f"_net{i}") == F.col(edge), ch.name) for i, ch in enumerate(channels)
    ])
    spread = F.col("spread")
    return (
        extremes.withColumns({
            "channel_min": named("net_min"),
            "channel_max": named("net_max"),
            "spread": F.col("net_max") - F.col("net_min"),
        })
        # Spread classes in $ per cwt.
        .withColumn("spread_class", F.when(spread < 3, "small").when(spread < 8, "moderate").otherwise("wide"))
        .drop(*nets)
    )


# ---- hold or sell --------------------------------------------------------------------


def derive_herd(herds: DataFrame) -> DataFrame:
    """Yearly figures from the raw inputs."""
    c = F.col
    cull = c("cull_price") * c("cull_weight") / 100
    cost = (c("forage_daily") + c("water_daily")) * 365 + c("supplemental_monthly") * 12
    return herds.withColumns({
        "years": c("drought_months") / 12,
        "rate": c("discount_rate") / 100,
        "annual_cost": cost,
        "cull_revenue": cull,
        "salvage": cull,
        "annual_net": c("breeding_success") / 100 * c("calf_revenue") - cost,
    })


def npv_hold(years: Column, rate: Column, net: Column, salvage: Column) -> Column:
    discount = F.pow(1 + rate, -years)
    return F.when(rate == 0, net * years + salvage).otherwise(
        net * F.try_divide(1 - discount, rate) + salvage * discount
    )


def npv_sell(years: Column, rate: Column, cull: Column, replacement: Column) -> Column:
    return cull - replacement * F.pow(1 + rate, -years)


def margin(years: Column, rate: Column | None = None) -> Column:
    """Hold minus sell per head at ``years``, from the derived columns."""
    c = F.col
    r = c("rate") if rate is None else rate
    return npv_hold(years, r, c("annual_net"), c("salvage")) - npv_sell(years, r, c("cull_revenue"), c("replacement_cost"))


CLEAR, MODEST = 100.0, 25.0  # fixed values: $ per head


def decision(diff: Column) -> Column:
    return (
        F.when(diff > CLEAR, "hold-clear").when(diff > MODEST, "hold-margin")
        .when(diff > -MODEST, "borderline").when(diff > -CLEAR, "sell-margin").otherwise("sell-clear")
    )


def hold_or_sell(herds: DataFrame) -> DataFrame:
    """Present values, margin, decision band, break-even duration and herd impact."""
    c = F.col
    d = derive_herd(herds)
    valued = d.withColumns({
        "npv_hold": npv_hold(c("years"), c("rate"), c("annual_net"), c("salvage")),
        "npv_sell": npv_sell(c("years"), c("rate"), c("cull_revenue"), c("replacement_cost")),
    }).withColumn("diff", c("npv_hold") - c("npv_sell"))
    affected = F.floor(c("herd_size") * (c("destocking_depth") / 100) + 0.5)
    return break_even(valued).withColumns({
        "decision": decision(c("diff")),
        "cows_affected": affected,
        "total_impact": F.abs(c("diff")) * affected,
    })


def break_even(derived: DataFrame, shortest: float = 0.01, longest: float = 20.0, tolerance: float = 0.01) -> DataFrame:
    """Duration at which holding and selling break even, by interval halving inside the
    row. ``t_star`` is null with a ``dominant`` side when the sign never changes."""
    halvings = math.ceil(math.log2((longest - shortest) / tolerance))
    lo0, hi0 = F.lit(shortest), F.lit(longest)

    def halve(state: Column, _: Column) -> Column:
        # A one-element array binds the midpoint and its margin, so each step works the
        # margin out once. The sign at the left end is carried along.
        mid = (state["lo"] + state["hi"]) / 2
        point = F.transform(F.array(mid), lambda m: F.struct(m.alias("t"), margin(m).alias("d")))

        def narrow(at: Column) -> Column:
            left = state["d"] * at["d"] < 0
            return F.struct(
                F.when(left, state["lo"]).otherwise(at["t"]).alias("lo"),
                F.when(left, at["t"]).otherwise(state["hi"]).alias("hi"),
                F.when(left, state["d"]).otherwise(at["d"]).alias("d"),
            )

        return F.transform(point, narrow)[0]

    root = F.aggregate(
        F.sequence(F.lit(1), F.lit(halvings)),
        F.struct(lo0.alias("lo"), hi0.alias("hi"), margin(lo0).alias("d")),
        halve,
        lambda s: (s["lo"] + s["hi"]) / 2,
    )
    same_sign = margin(lo0) * margin(hi0) > 0
    return derived.withColumns({
        "t_star": F.when(~same_sign, root),
        "dominant": F.when(same_sign, F.when(margin(lo0) > 0, "HOLD").otherwise("SELL")),
    })


# Grid of the sensitivity table.
DURATIONS = (0.5, 1.0, 2.0, 3.0, 5.0)
RATES = (0.04, 0.07, 0.10, 0.13)


def sensitivity(herds: DataFrame, durations: tuple[float, ...] = DURATIONS, rates: tuple[float, ...] = RATES) -> DataFrame:
    """Margin over a grid of durations and discount rates: a narrow fan-out per herd."""
    lits = lambda values: F.array(*[F.lit(float(v)) for v in values])
    grid = (
        derive_herd(herds)
        .withColumn("grid_years", F.explode(lits(durations)))
        .withColumn("grid_rate", F.explode(lits(rates)))
    )
    diff = margin(F.col("grid_years"), F.col("grid_rate"))
    # Cell classes of the grid.
    shade = (
        F.when(F.col("grid_diff") > CLEAR, "hold-fav").when(F.col("grid_diff") > MODEST, "hold-fav-light")
        .when(F.col("grid_diff") > -MODEST, "borderline").when(F.col("grid_diff") > -CLEAR, "sell-fav-light")
        .otherwise("sell-fav")
    )
    return grid.withColumn("grid_diff", diff).withColumn("grid_class", shade)
