from datetime import date, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from drover.config import SpikeRule
from drover.operators import basis as B
from drover.operators import deflate, spikes, views
from drover.operators import lots as L
from drover.plans import weekly as plan

LOT = (
    "auction_date date, commodity string, class string, frame string, muscle_grade string, weight_break_low int, "
    "weight_break_high int, avg_weight double, head_count int, price_avg double, source string"
)
DAY = date(2024, 1, 3)


def lot(day=DAY, cls="Steers", frame="Medium and Large", grade="1", low=500, avg=525.0, head=50, price=200.0, source="live", commodity="Feeder Cattle"):
    return (day, commodity, cls, frame, grade, low, None if low is None else low + 49, avg, head, price, source)


def lots(spark, *rows):
    return spark.createDataFrame(list(rows), LOT)


def weekly(spark, prices, sex="Steers", start=date(2020, 1, 8)):
    data = [(start + timedelta(weeks=i), sex, "500-599", 50, 1, p, p, 100.0, 100.0, "live") for i, p in enumerate(prices)]
    return spark.createDataFrame(
        data,
        "auction_date date, sex string, weight_class string, head_count long, n_pens int, price_nominal double, "
        "price_real double, cpi_at_obs double, cpi_base double, source_eras string",
    )


def test_head_weighting(spark):
    out = L.weekly_cells(lots(spark, lot(head=10, price=180.0), lot(head=90, price=200.0))).collect()
    assert len(out) == 1
    assert (out[0].price_nominal, out[0].head_count, out[0].n_pens) == (198.0, 100, 2)


def test_only_the_core_counts(spark):
    df = lots(
        spark, lot(), lot(grade="2"), lot(frame="Medium"), lot(frame="Large"), lot(cls="Bulls"), lot(commodity="Slaughter Cattle"),
        lot(price=0.0), lot(price=None), lot(low=None, avg=None), lot(low=950), lot(cls="Heifers", frame=" Medium and Large ", grade=" 1 "),
    )
    assert {(r.sex, r.weight_class) for r in L.weekly_cells(df).collect()} == {("Steers", "500-599"), ("Heifers", "500-599")}


def test_missing_and_zero_heads_weigh_one(spark):
    out = L.weekly_cells(lots(spark, lot(head=None, price=100.0), lot(head=0, price=200.0), lot(head=2, price=400.0))).first()
    assert out.price_nominal == (100 + 200 + 800) / 4 and out.head_count == 4


def test_sources_and_empty_input(spark):
    out = L.weekly_cells(lots(spark, lot(source="live"), lot(source="legacy"), lot(source="live"))).first()
    assert out.source_eras == "legacy,live"
    empty = L.weekly_cells(spark.createDataFrame([], LOT))
    assert empty.count() == 0 and len(empty.columns) == 7


def test_weekly_cash_keeps_breadth(spark):
    df = lots(spark, lot(head=None, price=100.0), lot(head=3, price=200.0), lot(cls="Bulls"), lot(grade="2"), lot(low=900), lot(low=1000), lot(price=None))
    out = {(r["class"], r.muscle_grade, r.weight_break_low): r for r in L.weekly_cash(df).collect()}
    assert set(out) == {("Steers", "1", 500), ("Bulls", "1", 500), ("Steers", "2", 500), ("Steers", "1", 900)}
    assert out[("Steers", "1", 500)].price_avg_cash == 175.0 and out[("Steers", "1", 500)].n_lots == 2


def cpi(spark, *points):
    return spark.createDataFrame(list(points), "period date, cpi_u double")


BASE = date(2025, 12, 1)


def real_price(spark, price, day, index):
    df = spark.createDataFrame([(day, price)], "auction_date date, price_nominal double")
    return [r.price_real for r in deflate.deflate_strict(df, index, BASE).collect()]


def test_strict_deflation(spark):
    index = cpi(spark, (BASE, 324.0), (date(2002, 4, 1), 180.0))
    assert real_price(spark, 250.0, date(2025, 12, 10), index) == [250.0]
    assert real_price(spark, 40.0, date(2002, 4, 27), index) == [pytest.approx(72.0)]
    assert real_price(spark, 40.0, date(2030, 1, 2), index) == []
    lost = spark.createDataFrame([(date(2030, 1, 2),), (date(2002, 4, 2),)], "auction_date date")
    assert [r[0] for r in deflate.undeflated(lost, index).collect()] == [date(2030, 1, 2)]


def test_missing_base_month_fails(spark):
    with pytest.raises(PySparkException, match="base month"):
        real_price(spark, 40.0, date(2002, 4, 27), cpi(spark, (date(2002, 4, 1), 180.0)))


def test_lenient_deflation(spark):
    days = spark.createDataFrame([(date(2020, 6, 15),), (date(2022, 6, 15),), (date(2025, 12, 15),), (date(2030, 1, 1),)], "auction_date date")
    index = cpi(spark, (date(2020, 6, 1), 257.0), (date(2022, 6, 1), 296.0), (BASE, 318.4))
    got = [r.deflator for r in deflate.with_deflator(days, index, BASE).orderBy("auction_date").collect()]
    assert got == [pytest.approx(318.4 / 257), pytest.approx(318.4 / 296), 1.0, 1.0]
    assert 200 * got[0] == pytest.approx(247.7, abs=0.5)
    no_base = cpi(spark, (date(2020, 6, 1), 257.0), (date(2022, 6, 1), 296.0))
    got = [r.deflator for r in deflate.with_deflator(days, no_base, BASE).orderBy("auction_date").collect()]
    assert got[0] == pytest.approx(296 / 257) and got[1] == 1.0
    assert {r.deflator for r in deflate.with_deflator(days, None).collect()} == {1.0}


def test_duplicate_index_months_take_the_latest_vintage(spark):
    index = spark.createDataFrame(
        [(BASE, 100.0, date(2026, 1, 1)), (BASE, 90.0, date(2026, 2, 1))], "period date, cpi_u double, vintage date"
    )
    assert [tuple(r) for r in deflate.index_by_month(index).collect()] == [(BASE, 90.0)]


@pytest.mark.parametrize("flat, spike, direction", [(200.0, 100.0, "low"), (200.0, 400.0, "high"), (80.0, 40.0, None)])
def test_spikes(spark, flat, spike, direction):
    prices = [flat] * 30
    prices[15] = spike
    screened = spikes.replace_spikes(weekly(spark, prices)).cache()
    hits = spikes.spike_log(screened).collect()
    if direction is None:  # below the absolute floor
        assert hits == []
        return
    assert [(h.direction, h.price_real_orig, h.price_real_replaced, h.local_median_real) for h in hits] == [(direction, spike, flat, flat)]
    cleaned = spikes.cleaned_rows(screened)
    assert {(r.price_real, r.price_nominal) for r in cleaned.collect()} == {(flat, flat)}


def test_nominal_follows_real(spark):
    df = weekly(spark, [200.0] * 15 + [100.0] + [200.0] * 14).withColumn("cpi_base", F.lit(200.0))
    hit = spikes.spike_log(spikes.replace_spikes(df)).first()
    assert hit.price_nominal_replaced == 100.0


def test_series_are_independent(spark):
    steers = [240.0] * 30
    steers[15] = 120.0
    both = weekly(spark, steers).unionByName(weekly(spark, [200.0] * 30, "Heifers"))
    assert [(h.sex, h.weight_class) for h in spikes.spike_log(spikes.replace_spikes(both)).collect()] == [("Steers", "500-599")]


def test_thresholds_are_parameters(spark):
    prices = [200.0] * 30
    prices[15] = 160.0
    tight = SpikeRule(ratio_lo=0.85, ratio_hi=1 / 0.85, min_abs_dev=20.0)
    counts = [spikes.spike_log(spikes.replace_spikes(weekly(spark, prices), rule)).count() for rule in (SpikeRule(), tight)]
    assert counts == [0, 1]


def test_short_series_and_edges(spark):
    assert spikes.spike_log(spikes.replace_spikes(weekly(spark, [200.0, 200.0, 50.0, 200.0]))).count() == 0
    first = [50.0] + [200.0] * 29  # the first row sees seven values
    assert spikes.spike_log(spikes.replace_spikes(weekly(spark, first))).count() == 1
    assert spikes.replace_spikes(weekly(spark, [])).count() == 0


SETTLE = "date date, contract_month string, settle double"


def test_asof_settles(spark):
    sale = date(2024, 5, 10)
    sales = spark.createDataFrame([(sale,)], "auction_date date")
    settles = spark.createDataFrame(
        [(sale, "MAY", 250.0), (date(2024, 5, 9), "MAY", 1.0), (date(2024, 5, 5), "NOV", 240.0),
         (date(2024, 5, 4), "NEARBY", 230.0), (date(2024, 5, 11), "NEARBY", 999.0)], SETTLE
    )
    got = {(r.contract_month, r.settle, r.settle_date) for r in B.lookup_settles(sales, settles).collect()}
    assert got == {("MAY", 250.0, sale), ("NOV", 240.0, date(2024, 5, 5))}
    skipped = spark.createDataFrame([(sale, "MAY", None), (date(2024, 5, 8), "MAY", 5.0)], SETTLE)
    assert [r.settle for r in B.lookup_settles(sales, skipped).collect()] == [5.0]


def test_basis_row_without_any_settle(spark):
    cash = L.weekly_cash(lots(spark, lot(day=date(2024, 5, 10), price=260.0), lot(day=date(2024, 6, 10), price=270.0)))
    settles = spark.createDataFrame([(date(2024, 5, 9), "MAY", 250.0), (date(2024, 5, 10), "NOV", 255.0)], SETTLE)
    got = {(r.auction_date, r.contract_month, r.basis) for r in B.derive_basis(cash, settles).collect()}
    assert got == {(date(2024, 5, 10), "MAY", 10.0), (date(2024, 5, 10), "NOV", 5.0), (date(2024, 6, 10), None, None)}
    none = B.derive_basis(cash, spark.createDataFrame([], SETTLE)).collect()
    assert [r.basis for r in none] == [None, None]


PAGE = LOT.replace("price_avg double", "price_avg double, price_low double, price_high double")


def page_lot(day, price, cls="Steers", low=500, head=10):
    return (day, "Feeder Cattle", cls, "Medium and Large", "1", low, low + 49, 525.0, head, price, price - 5, price + 5, "live")


def test_views_from_cells(spark):
    week = [date(2022, 3, 2), date(2023, 3, 1), date(2024, 2, 28)]  # same ISO week
    rows = [page_lot(week[0], 100.0), page_lot(week[0], 200.0, head=30), page_lot(week[1], 150.0), page_lot(week[2], 190.0), page_lot(week[2], 200.0, cls="Heifers")]
    cells = plan.price_cells(spark.createDataFrame(rows, PAGE), None)
    got = views.compare_now(cells).filter("window = 'all' AND mode = 'nominal' AND class = 'Steers'").first()
    assert (got.hist_min, got.hist_max, got.n_years, got.price) == (150.0, 175.0, 2, 190.0)
    assert got.band == "top" and got.delta == 190.0 - 162.5
    env = views.envelope(cells).filter("window = 'all' AND mode = 'real' AND class = 'Steers'").first()
    assert (env.price_low, env.price_high, env.head_count) == (95.0, 205.0, 60)
    assert env.price_mean == pytest.approx((100 + 200 + 150 + 190) / 4)


def test_band_prefers_top_on_ties(spark):
    df = spark.createDataFrame([(5.0, 5.0, 5.0), (4.0, 5.0, 6.0), (5.5, 5.0, 6.0), (None, 5.0, 6.0)], "p double, q25 double, q75 double")
    assert [r[0] for r in df.select(views.band_of(F.col("p"), F.col("q25"), F.col("q75"))).collect()] == ["top", "bot", "mid", "mid"]


def test_all_views_share_one_materialized_table(spark):
    pens = spark.createDataFrame([page_lot(DAY, 100.0), page_lot(date(2023, 1, 4), 90.0)], PAGE)
    out = plan.price_views(pens, cpi(spark, (date(2024, 1, 1), 110.0), (date(2023, 1, 1), 100.0)))
    assert {k: v.count() > 0 for k, v in out.items()} == dict.fromkeys(out, True)
    card = plan.card(pens)
    assert card["header"].first().auction_day == "Wednesday, January 3, 2024"
    assert card["prices"].count() == 12


def test_clean_weekly_outputs(spark):
    days = [date(2020, 1, 8) + timedelta(weeks=i) for i in range(30)]
    pens = lots(spark, *[lot(day=d, price=100.0 if i == 15 else 200.0) for i, d in enumerate(days)])
    months = sorted({d.replace(day=1) for d in days})
    cleaned, log = plan.clean_weekly(pens, cpi(spark, *[(m, 100.0) for m in months]), base=months[0])
    assert cleaned.count() == 30 and log.count() == 1
    assert cleaned.filter("spike_replaced").first().direction == "low"
