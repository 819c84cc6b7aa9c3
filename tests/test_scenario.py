import pytest

from drover.config import CHANNELS, Channel
from drover.operators import scenario as S


def contract(spark, **over):
    base = dict(base_price=245.0, base_weight=550.0, weight_basis="post-shrink", weight_window=10.0, slide_rate=6.0,
                slide_direction="two-way", shrink_pct=2.0, delivered_weight=600.0, head_count=1)
    base.update(over)
    return spark.createDataFrame([tuple(base.values())], "base_price double, base_weight double, weight_basis string, weight_window double, slide_rate double, slide_direction string, shrink_pct double, delivered_weight double, head_count int")


@pytest.mark.parametrize("over, pay, price, head, direction", [
    ({}, 588.0, 243.32, 1430.7216, "over"),
    (dict(base_price=215.0, base_weight=500.0, slide_rate=8.0, shrink_pct=3.0, delivered_weight=435.0), 421.95, 220.444, 930.1636, "under"),
    (dict(weight_basis="pre-shrink"), 588.0, 242.66, 1426.8408, "over"),
    (dict(delivered_weight=480.0, slide_direction="one-way"), 470.4, 245.0, 1152.48, "under"),
    (dict(delivered_weight=560.0), 548.8, 245.0, 1344.56, "in-window"),
])
def test_price_slide(spark, over, pay, price, head, direction):
    r = S.price_slide(contract(spark, **over)).first()
    assert r.pay_weight == pytest.approx(pay) and r.adjusted_price == pytest.approx(price)
    assert r.per_head == pytest.approx(head, abs=1e-3) and r.direction == direction
    assert r.total == r.per_head


def test_bad_contracts(spark):
    ok, bad = S.split_valid(contract(spark, head_count=0, shrink_pct=25.0, base_price=None), S.SLIDE_LIMITS)
    assert ok.count() == 0
    assert bad.first().error == "Base price must be a number. Shrink must be at most 20. Head count must be at least 1."


OFFER = "lot_size double, avg_weight double, base_price double, distance_local double, distance_video double, hauling_rate double"


@pytest.mark.parametrize("shrink, gross, deductions, net", [
    (0.0, 37406.25, 1322.1875, 36084.0625), (2.0, 36658.125, 1299.74375, 35358.38125),
])
def test_channel_net(spark, shrink, gross, deductions, net):
    lot = spark.createDataFrame([(25.0, 525.0, 285.0, 0.0, 0.0, 0.0)], OFFER)
    r = S.channel_net(lot, (Channel("Local auction", 3.0, 7.0, 1.0, 0.0, shrink, "local"),)).first()
    assert (r.gross_at_pay_weight, r.total_deductions, r.net_revenue) == pytest.approx((gross, deductions, net))
    assert r.net_per_cwt_gross == pytest.approx(net / 131.25) and r.net_per_head == pytest.approx(net / 25)


def test_hauling_uses_the_right_distance(spark):
    lot = spark.createDataFrame([(10.0, 500.0, 200.0, 100.0, 40.0, 2.0)], OFFER)
    hauling = {r.channel: r.hauling for r in S.channel_net(lot).collect()}
    assert hauling == {"Local auction": 200.0, "Special feeder sale": 200.0, "Video auction": 80.0, "Internet auction": 80.0, "Private treaty": 0.0}


def test_spread(spark):
    lot = spark.createDataFrame([(10.0, 500.0, 200.0, 0.0, 0.0, 0.0)], OFFER)
    r = S.channel_spread(lot).first()
    nets = {x.channel: x.net_per_cwt_gross for x in S.channel_net(lot).collect()}
    assert (r.net_min, r.net_max) == pytest.approx((min(nets.values()), max(nets.values())))
    assert nets[r.channel_max] == pytest.approx(r.net_max) and r.spread_class == "wide"
    same = tuple(Channel(n, 1.0, 0.0, 0.0, 0.0, 0.0, "none") for n in ("first", "second"))
    tie = S.channel_spread(lot, same).first()
    assert (tie.channel_min, tie.channel_max, tie.spread_class) == ("first", "first", "small")
    assert len(CHANNELS) == 5


HERD = dict(herd_size=200.0, destocking_depth=50.0, cull_price=130.0, cull_weight=1100.0, drought_months=18.0, breeding_success=60.0,
            forage_daily=4.5, water_daily=0.0, supplemental_monthly=30.0, calf_revenue=850.0, replacement_cost=1800.0, discount_rate=7.0)


def herd(spark, **over):
    values = {**HERD, **over}
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} double" for k in values))


@pytest.mark.parametrize("months, hold, sell, diff, decision", [
    (18.0, -765.6938, -196.2857, -569.4081, "sell-clear"), (3.0, 1048.4037, -339.8097, 1388.2133, "hold-clear"),
])
def test_hold_or_sell(spark, months, hold, sell, diff, decision):
    r = S.hold_or_sell(herd(spark, drought_months=months)).first()
    assert (r.npv_hold, r.npv_sell, r.diff) == pytest.approx((hold, sell, diff), abs=1e-4)
    assert r.t_star == pytest.approx(1.127605, abs=1e-6) and r.dominant is None
    assert (r.decision, r.cows_affected) == (decision, 100)
    assert r.total_impact == pytest.approx(abs(diff) * 100, abs=0.01)


def test_zero_rate_and_dominance(spark):
    r = S.hold_or_sell(herd(spark, discount_rate=0.0, drought_months=12.0)).first()
    assert r.npv_hold == pytest.approx(0.6 * 850 - 2002.5 + 1430) and r.npv_sell == pytest.approx(1430 - 1800)
    assert S.hold_or_sell(herd(spark, calf_revenue=90000.0)).first().dominant == "HOLD"
    sell = S.hold_or_sell(herd(spark, replacement_cost=0.0)).first()
    assert (sell.dominant, sell.t_star) == ("SELL", None)


def test_sensitivity_grid(spark):
    grid = S.sensitivity(herd(spark)).collect()
    assert len(grid) == 20
    at = {(g.grid_years, g.grid_rate): g for g in grid}
    assert at[(5.0, 0.07)].grid_class == "sell-fav" and at[(0.5, 0.07)].grid_class == "hold-fav"
