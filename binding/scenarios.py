"""Scenario pricing."""

from __future__ import annotations

from pyspark.sql import functions as F

from binding.registry import q, query, rounded
from binding.tables import table
from drover.config import CHANNELS
from drover.operators import scenario as S

# ---- price slide ---------------------------------------------------------------------


def contracts(spark, d):
    c = F.col
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey",
        (100 + c("l_extendedprice") / 500).alias("base_price"),
        (500 + c("l_quantity")).alias("base_weight"),
        F.when(c("l_returnflag") == "A", "pre-shrink").otherwise("post-shrink").alias("weight_basis"),
        (c("l_linenumber") * 5.0).alias("weight_window"),
        (4 + c("l_tax") * 100).alias("slide_rate"),
        F.when(c("l_linestatus") == "O", "two-way").otherwise("one-way").alias("slide_direction"),
        (c("l_discount") * 100).alias("shrink_pct"),
        F.when(c("l_quantity") < 50, 350 + c("l_quantity") * 8).alias("delivered_weight"),
        F.when(c("l_linenumber") == 7, 0).otherwise(c("l_linenumber") * 10).alias("head_count"),
    )


CONTRACTS = """c AS (SELECT l_orderkey, l_partkey, l_suppkey, 100 + l_extendedprice/500 AS base_price, 500 + l_quantity AS base_weight, l_returnflag = 'A' AS pre, l_linenumber*5.0 AS win,
 4 + l_tax*100 AS rate, l_linestatus = 'O' AS two_way, l_discount*100 AS shrink_pct, CASE WHEN l_quantity < 50 THEN 350 + l_quantity*8 END AS delivered,
 CASE WHEN l_linenumber = 7 THEN 0 ELSE l_linenumber*10 END AS head_count FROM lineitem),
 p AS (SELECT *, delivered*(1 - shrink_pct/100) AS pay, CASE WHEN pre THEN base_weight*(1 - shrink_pct/100) ELSE base_weight END AS eff FROM c WHERE delivered IS NOT NULL AND head_count >= 1),
 s AS (SELECT *, CASE WHEN pay > eff + win THEN 'over' WHEN pay < eff - win THEN 'under' ELSE 'in-window' END AS direction,
 CASE WHEN pay > eff + win THEN -(pay - (eff + win))/100*rate WHEN pay < eff - win AND two_way THEN ((eff - win) - pay)/100*rate ELSE 0.0 END AS adj FROM p)"""


@query("l1_price_slide", f"""WITH {CONTRACTS} SELECT l_orderkey, l_partkey, l_suppkey, direction, {q('pay')} AS pay_weight, {q('base_price + adj')} AS adjusted_price, {q('pay*((base_price + adj)/100)')} AS per_head,
 {q('pay*((base_price + adj)/100)*head_count', 3)} AS total FROM s""")
def _(spark, d):
    valid, _bad = S.split_valid(contracts(spark, d), S.SLIDE_LIMITS)
    out = S.price_slide(valid).select("l_orderkey", "l_partkey", "l_suppkey", "direction", "pay_weight", "adjusted_price", "per_head", "total")
    return rounded(rounded(out, "pay_weight", "adjusted_price", "per_head"), "total", digits=3)


@query("l1_rejected_contracts", f"""WITH {CONTRACTS} SELECT concat_ws(' ', CASE WHEN delivered IS NULL THEN 'Delivered weight must be a number.' END,
 CASE WHEN head_count < 1 THEN 'Head count must be at least 1.' END) AS error, count(*) AS n FROM c WHERE delivered IS NULL OR head_count < 1 GROUP BY 1""")
def _(spark, d):
    _ok, bad = S.split_valid(contracts(spark, d), S.SLIDE_LIMITS)
    return bad.groupBy("error").agg(F.count("*").alias("n"))


# ---- channels ------------------------------------------------------------------------


def offers(spark, d):
    c = F.col
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        (c("l_quantity") + 1).alias("lot_size"), (400 + c("l_linenumber") * 30.0).alias("avg_weight"),
        (100 + c("l_extendedprice") / 500).alias("base_price"), (c("l_partkey") % 200).cast("double").alias("distance_local"),
        (c("l_suppkey") % 50).cast("double").alias("distance_video"), (c("l_tax") * 100).alias("hauling_rate"),
    )


VALUES = ", ".join(
    f"({i}, '{ch.name}', {ch.commission_pct}, {ch.yardage}, {ch.inspection}, {ch.fees}, {ch.shrink_pct}, '{ch.haul}')" for i, ch in enumerate(CHANNELS)
)
OFFERS = f"""o AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1 AS n, 400 + l_linenumber*30.0 AS w, 100 + l_extendedprice/500 AS p, CAST(l_partkey % 200 AS DOUBLE) AS dl,
 CAST(l_suppkey % 50 AS DOUBLE) AS dv, l_tax*100 AS hr FROM lineitem), ch AS (SELECT * FROM (VALUES {VALUES}) AS t(i, channel, com, yard, insp, fee, shr, haul)),
 g AS (SELECT *, n*w/100 AS gc, n*w*(1 - shr/100.0)/100 AS pc FROM o, ch),
 k AS (SELECT *, p*pc AS gross, p*pc*(com/100.0) + n*yard + n*insp + n*fee + CASE haul WHEN 'local' THEN dl WHEN 'video' THEN dv ELSE 0.0 END*hr AS ded FROM g)"""


@query("l2_channel_net", f"""WITH {OFFERS} SELECT l_orderkey, l_partkey, l_suppkey, channel, {q('gross', 3)} AS gross_at_pay_weight, {q('ded', 3)} AS total_deductions, {q('gross - ded', 3)} AS net_revenue,
 {q('(gross - ded)/gc', 3)} AS net_per_cwt_gross, {q('(gross - ded)/pc', 3)} AS net_per_cwt_pay, {q('(gross - ded)/n', 3)} AS net_per_head, {q('(gc - pc)*p', 3)} AS shrink_loss FROM k""")
def _(spark, d):
    valid, _bad = S.split_valid(offers(spark, d), S.CHANNEL_LIMITS)
    names = ("gross_at_pay_weight", "total_deductions", "net_revenue", "net_per_cwt_gross", "net_per_cwt_pay", "net_per_head", "shrink_loss")
    out = S.channel_net(valid).select("l_orderkey", "l_partkey", "l_suppkey", "channel", *names)
    return rounded(out, *names, digits=3)


@query("c13_lots_by_channel", f"""WITH {OFFERS} SELECT channel, count(*) AS n, {q('avg(gross - ded)', 3)} AS mean_net FROM k GROUP BY 1""")
def _(spark, d):
    out = S.channel_net(offers(spark, d)).groupBy("channel").agg(F.count("*").alias("n"), F.avg("net_revenue").alias("mean_net"))
    return rounded(out, "mean_net", digits=3)


@query("l3_channel_spread", f"""WITH {OFFERS}, v AS (SELECT *, (gross - ded)/gc AS x FROM k),
 m AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, n, p, min(x) AS lo, max(x) AS hi, arg_min(channel, x) AS channel_min, arg_max(channel, x) AS channel_max FROM v GROUP BY ALL)
 SELECT l_orderkey, l_partkey, l_suppkey, {q('lo', 3)} AS net_min, {q('hi', 3)} AS net_max, channel_min, channel_max, CASE WHEN hi - lo < 3 THEN 'small' WHEN hi - lo < 8 THEN 'moderate' ELSE 'wide' END AS spread_class FROM m""")
def _(spark, d):
    out = S.channel_spread(offers(spark, d)).select("l_orderkey", "l_partkey", "l_suppkey", "net_min", "net_max", "channel_min", "channel_max", "spread_class")
    return rounded(out, "net_min", "net_max", digits=3)


# ---- hold or sell --------------------------------------------------------------------


def herds(spark, d):
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        "o_orderkey",
        (50 + k % 400).cast("double").alias("herd_size"), (10 + k % 90).cast("double").alias("destocking_depth"),
        (80 + F.col("o_totalprice") / 5000).alias("cull_price"), (900 + k % 500).cast("double").alias("cull_weight"),
        (1 + k % 48).cast("double").alias("drought_months"), (40 + k % 55).cast("double").alias("breeding_success"),
        (0.5 + (k % 8) * 0.75).alias("forage_daily"), ((k % 3) * 0.25).alias("water_daily"), (10 + k % 40).cast("double").alias("supplemental_monthly"),
        (700 + k % 600).cast("double").alias("calf_revenue"), (1200 + k % 1500).cast("double").alias("replacement_cost"),
        ((k % 5) * 3.5).alias("discount_rate"),
    )


def npv(t: str, r: str) -> str:
    hold = f"(CASE WHEN {r} = 0 THEN net*({t}) + cull ELSE net*((1 - pow(1 + {r}, -({t})))/nullif({r}, 0)) + cull*pow(1 + {r}, -({t})) END)"
    sell = f"(cull - repl*pow(1 + {r}, -({t})))"
    return hold, sell


def diff(t: str, r: str = "r") -> str:
    hold, sell = npv(t, r)
    return f"({hold} - {sell})"


HERDS = """h AS (SELECT o_orderkey, CAST(50 + o_orderkey % 400 AS DOUBLE) AS herd, CAST(10 + o_orderkey % 90 AS DOUBLE) AS depth, (80 + o_totalprice/5000)*CAST(900 + o_orderkey % 500 AS DOUBLE)/100 AS cull,
 CAST(1 + o_orderkey % 48 AS DOUBLE)/12 AS t, (o_orderkey % 5)*3.5::DOUBLE/100 AS r, CAST(40 + o_orderkey % 55 AS DOUBLE)/100*CAST(700 + o_orderkey % 600 AS DOUBLE)
 - (((0.5 + (o_orderkey % 8)*0.75) + (o_orderkey % 3)*0.25)*365 + CAST(10 + o_orderkey % 40 AS DOUBLE)*12) AS net, CAST(1200 + o_orderkey % 1500 AS DOUBLE) AS repl FROM orders)"""


def bisect_sql() -> str:
    steps = ["b0 AS (SELECT *, 0.01::DOUBLE AS lo, 20.0::DOUBLE AS hi FROM h)"]
    for i in range(1, 12):
        left = f"{diff('lo')}*{diff('mid')} < 0"
        steps.append(
            f"b{i} AS (SELECT * EXCLUDE (lo, hi, mid), CASE WHEN {left} THEN lo ELSE mid END AS lo, CASE WHEN {left} THEN mid ELSE hi END AS hi "
            f"FROM (SELECT *, (lo + hi)/2 AS mid FROM b{i - 1}))"
        )
    return ", ".join(steps)


HOLD, SELL = npv("t", "r")


@query("l4_hold_or_sell", f"""WITH {HERDS} SELECT o_orderkey, {q(HOLD)} AS npv_hold, {q(SELL)} AS npv_sell, {q(diff('t'))} AS diff FROM h""")
def _(spark, d):
    return rounded(S.hold_or_sell(herds(spark, d)).select("o_orderkey", "npv_hold", "npv_sell", "diff"), "npv_hold", "npv_sell", "diff")


@query("l5_break_even", f"""WITH {HERDS}, {bisect_sql()} SELECT o_orderkey, CASE WHEN {diff('0.01')}*{diff('20.0')} <= 0 THEN {q('(lo + hi)/2')} END AS t_star,
 CASE WHEN {diff('0.01')}*{diff('20.0')} > 0 THEN CASE WHEN {diff('0.01')} > 0 THEN 'HOLD' ELSE 'SELL' END END AS dominant FROM b11""")
def _(spark, d):
    return rounded(S.break_even(S.derive_herd(herds(spark, d))).select("o_orderkey", "t_star", "dominant"), "t_star")


SHADE = "CASE WHEN {x} > 100 THEN 'hold-fav' WHEN {x} > 25 THEN 'hold-fav-light' WHEN {x} > -25 THEN 'borderline' WHEN {x} > -100 THEN 'sell-fav-light' ELSE 'sell-fav' END"


@query("l6_sensitivity", f"""WITH {HERDS}, g AS (SELECT h.*, gt, gr FROM h, (SELECT unnest([0.5, 1.0, 2.0, 3.0, 5.0])::DOUBLE AS gt), (SELECT unnest([0.04, 0.07, 0.10, 0.13])::DOUBLE AS gr)),
 x AS (SELECT *, {diff('gt', 'gr')} AS x FROM g) SELECT o_orderkey, gt AS grid_years, gr AS grid_rate, {q('x')} AS grid_diff, {SHADE.format(x='x')} AS grid_class FROM x""")
def _(spark, d):
    return rounded(S.sensitivity(herds(spark, d)).select("o_orderkey", "grid_years", "grid_rate", "grid_diff", "grid_class"), "grid_diff")


DECISION = "CASE WHEN {x} > 100 THEN 'hold-clear' WHEN {x} > 25 THEN 'hold-margin' WHEN {x} > -25 THEN 'borderline' WHEN {x} > -100 THEN 'sell-margin' ELSE 'sell-clear' END"


@query("l7_decision_bands", f"WITH {HERDS}, x AS (SELECT {diff('t')} AS x FROM h) SELECT {DECISION.format(x='x')} AS decision, count(*) AS n FROM x GROUP BY 1")
def _(spark, d):
    return S.hold_or_sell(herds(spark, d)).groupBy("decision").agg(F.count("*").alias("n"))


@query("l8_herd_impact", f"""WITH {HERDS} SELECT o_orderkey, CAST(floor(herd*(depth/100) + 0.5) AS BIGINT) AS cows_affected, {q(f"abs({diff('t')})*floor(herd*(depth/100) + 0.5)", 2)} AS total_impact FROM h""")
def _(spark, d):
    out = S.hold_or_sell(herds(spark, d)).select("o_orderkey", "cows_affected", "total_impact")
    return rounded(out, "total_impact", digits=2)
