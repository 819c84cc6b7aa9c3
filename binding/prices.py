"""Lots, deflation, spikes, settles and price views."""

from __future__ import annotations

from pyspark.sql import functions as F

from binding.registry import q, query, r, rounded
from binding.tables import (
    BASE, BASE_SQL, BIN, CONTRACTS, CORE, CPI, LOTS, PAGE, PAGE_LABEL, SETTLES, cpi, lots, settles,
)
from drover import config as C
from drover.functions import bins, dates
from drover.functions.columns import scalar_max
from drover.operators import basis as B
from drover.operators import deflate, spikes, views
from drover.operators import lots as L
from drover.operators.ranks import numbered
from drover.plans import weekly as plan

# ---- SQL building blocks -------------------------------------------------------------

HEADS1 = "CASE WHEN coalesce(head_count, 1) > 0 THEN coalesce(head_count, 1) ELSE 1 END"
WEEKLY = f"""weekly AS (SELECT auction_date, class AS sex, lo || '-' || (lo + 99) AS weight_class,
 CAST(sum(h) AS BIGINT) AS head_count, CAST(count(*) AS INTEGER) AS n_pens, sum(price_avg*h)/sum(h) AS price_nominal,
 string_agg(DISTINCT source, ',' ORDER BY source) AS source_eras
 FROM (SELECT *, {BIN} AS lo, {HEADS1} AS h FROM lots WHERE {CORE} AND commodity = 'Feeder Cattle' AND price_avg > 0)
 WHERE lo BETWEEN 300 AND 800 GROUP BY 1, 2, 3)"""
DEFLATED = f"""base AS (SELECT cpi_u AS b FROM cpi WHERE period = {BASE_SQL}),
real AS (SELECT w.*, c.cpi_u AS cpi_at_obs, b.b AS cpi_base, price_nominal * (b.b/c.cpi_u) AS price_real
 FROM weekly w JOIN cpi c ON c.period = CAST(date_trunc('month', auction_date) AS DATE), base b)"""
SCREENED = """med AS (SELECT *, CASE WHEN count(price_real) OVER w >= 5 THEN quantile_cont(price_real, 0.5) OVER w END AS m
 FROM real WINDOW w AS (PARTITION BY sex, weight_class ORDER BY auction_date ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)),
flag AS (SELECT *, price_real/m AS ratio, coalesce((price_real/m <= 0.6 OR price_real/m >= 1.0/0.6) AND abs(price_real - m) > 50, false) AS hit FROM med)"""
FLAGSHIP = f"WITH {LOTS}, {CPI}, {WEEKLY}, {DEFLATED}, {SCREENED}"

CELLS = f"""{LOTS}, {CPI}, {PAGE}, fac AS (SELECT period, coalesce((SELECT cpi_u FROM cpi WHERE period = {BASE_SQL}),
 (SELECT arg_max(cpi_u, period) FROM cpi))/cpi_u AS f FROM cpi),
work AS (SELECT p.*, coalesce(f, 1.0) AS deflator FROM page p LEFT JOIN fac ON period = CAST(date_trunc('month', auction_date) AS DATE)),
anchor AS (SELECT max(auction_date) AS a FROM work),
wins AS (SELECT 'all' AS win, DATE '0001-01-01' AS s FROM anchor UNION ALL SELECT '5y', CAST(a - INTERVAL 5 YEAR AS DATE) FROM anchor
 UNION ALL SELECT '3y', CAST(a - INTERVAL 3 YEAR AS DATE) FROM anchor UNION ALL SELECT 'latest', CAST(date_trunc('year', a) AS DATE) FROM anchor),
modes AS (SELECT 'nominal' AS mode UNION ALL SELECT 'real'),
fan AS (SELECT w.*, win, mode, CASE mode WHEN 'real' THEN deflator ELSE 1.0 END AS f FROM work w JOIN wins ON auction_date >= s, modes)"""
WEEK52 = "least(CAST(week(auction_date) AS INTEGER), 52)"
W3 = "CASE WHEN sum(coalesce(head_count,0)) > 0 THEN coalesce(sum({p}*coalesce(head_count,0)),0)/sum(coalesce(head_count,0)) ELSE avg({p}) END"


def cells(spark, d):
    return plan.price_cells(lots(spark, d), cpi(spark, d), BASE)


# ---- filters and bins ----------------------------------------------------------------


@query("b1_core_lots", f"""WITH {LOTS} SELECT class, count(*) AS n, {q('sum(price_avg)', 2)} AS price_sum FROM lots
 WHERE {CORE} AND commodity = 'Feeder Cattle' GROUP BY 1""")
def _(spark, d):
    return L.core_lots(lots(spark, d)).groupBy("class").agg(F.count("*").alias("n"), r(F.sum("price_avg"), 2).alias("price_sum"))


@query("b2_page_lots", f"WITH {LOTS}, {PAGE} SELECT class, bin_lo, count(*) AS n FROM page GROUP BY 1, 2")
def _(spark, d):
    return L.page_lots(lots(spark, d)).groupBy("class", "bin_lo").agg(F.count("*").alias("n"))


@query("b3_priced_lots", f"WITH {LOTS} SELECT class, count(*) AS n FROM lots WHERE price_avg > 0 GROUP BY 1")
def _(spark, d):
    return lots(spark, d).filter(L.priced()).groupBy("class").agg(F.count("*").alias("n"))


@query("b4_ladder_labels", f"""WITH {LOTS} SELECT CASE WHEN {BIN} BETWEEN 300 AND 800 THEN {BIN} || '-' || ({BIN} + 99) END AS weight_class,
 count(*) AS n FROM lots GROUP BY 1""")
def _(spark, d):
    label = bins.ladder_label(bins.bin_floor("weight_break_low", "avg_weight"))
    return lots(spark, d).groupBy(label.alias("weight_class")).agg(F.count("*").alias("n"))


@query("b5_bin_bounds", f"""WITH {LOTS} SELECT lo, lo + 100 AS hi, count(*) AS n FROM (SELECT {BIN} AS lo FROM lots)
 WHERE lo >= 300 AND lo < 1000 GROUP BY 1""")
def _(spark, d):
    lo = bins.bin_floor("weight_break_low", "avg_weight")
    return (
        lots(spark, d).select(lo.alias("lo")).filter((F.col("lo") >= 300) & (F.col("lo") < 1000))
        .groupBy("lo").agg(F.count("*").alias("n")).withColumn("hi", F.col("lo") + 100)
    )


@query("b6_page_labels", f"WITH {LOTS}, {PAGE} SELECT {PAGE_LABEL} AS weight_bin, count(*) AS n FROM page GROUP BY 1")
def _(spark, d):
    return L.page_lots(lots(spark, d)).groupBy(bins.page_label("bin_lo").alias("weight_bin")).agg(F.count("*").alias("n"))


@query("b8_date_windows", f"""WITH {CELLS} SELECT win AS "window", min(auction_date) AS first_date, max(auction_date) AS last_date, count(*) AS n
 FROM work JOIN wins ON auction_date >= s GROUP BY 1""")
def _(spark, d):
    c = cells(spark, d)
    return views.in_windows(c, scalar_max(c, "auction_date")).groupBy("window").agg(
        F.min("auction_date").alias("first_date"), F.max("auction_date").alias("last_date"), F.sum("n_lots").alias("n")
    )


@query("b9_comparison_windows", f"""WITH {CELLS} SELECT win AS "window", mode, class, bin_lo, CAST(year(auction_date) AS INTEGER) AS year,
 {q(W3.format(p='price_avg*f'))} AS price
 FROM fan, anchor WHERE win <> 'latest' AND year(auction_date) < year(a) AND {WEEK52} = least(week(a), 52) GROUP BY 1, 2, 3, 4, 5""")
def _(spark, d):
    return rounded(views.same_week_prices(cells(spark, d)), "price")


@query("b10_last_26_weeks", f"""WITH {CELLS} SELECT class, bin_lo, auction_date, {PAGE_LABEL} AS weight_bin, {q('avg(price_avg)')} AS price
 FROM work, anchor WHERE auction_date >= a - 182 GROUP BY 1, 2, 3""")
def _(spark, d):
    return rounded(views.recent_trend(cells(spark, d)), "price")


@query("b11_latest_lots", f"""WITH {LOTS}, {PAGE} SELECT class, bin_lo, head_count, {q('price_avg')} AS price_avg FROM page
 WHERE auction_date = (SELECT max(auction_date) FROM page)""")
def _(spark, d):
    now = views.latest_rows(L.page_lots(lots(spark, d)))
    return rounded(now.select("class", "bin_lo", "head_count", "price_avg"), "price_avg")


@query("b15_iso_week", f"WITH {LOTS} SELECT {WEEK52} AS iso_week, count(*) AS n FROM lots GROUP BY 1")
def _(spark, d):
    return lots(spark, d).groupBy(dates.iso_week("auction_date").alias("iso_week")).agg(F.count("*").alias("n"))


# ---- weekly cells, deflation, spikes -------------------------------------------------


@query("d1_weekly_cells", f"""WITH {LOTS}, {WEEKLY} SELECT auction_date, sex, weight_class, head_count, n_pens,
 {q('price_nominal')} AS price_nominal, source_eras FROM weekly""")
def _(spark, d):
    return rounded(L.weekly_cells(lots(spark, d)), "price_nominal")


CASH = f"""cash AS (SELECT auction_date, class, frame, muscle_grade, lo AS weight_break_low, lo + 100 AS weight_break_high,
 CAST(sum(coalesce(head_count,1)) AS DOUBLE) AS head_total, count(price_avg) AS n_lots,
 CASE WHEN sum(coalesce(head_count,1)) <> 0 THEN sum(price_avg*coalesce(head_count,1))/sum(coalesce(head_count,1)) END AS price_avg_cash
 FROM (SELECT *, {BIN} AS lo FROM lots WHERE price_avg IS NOT NULL AND auction_date IS NOT NULL) WHERE lo >= 300 AND lo < 1000
 GROUP BY 1, 2, 3, 4, 5, 6)"""


@query("d2_weekly_cash", f"WITH {LOTS}, {CASH} SELECT * EXCLUDE (price_avg_cash), {q('price_avg_cash')} AS price_avg_cash FROM cash")
def _(spark, d):
    return rounded(L.weekly_cash(lots(spark, d)), "price_avg_cash")


@query("c1_deflate_strict", f"""WITH {LOTS}, {CPI}, {WEEKLY}, {DEFLATED} SELECT auction_date, sex, weight_class, {q('price_nominal')} AS price_nominal,
 {q('price_real')} AS price_real, {q('cpi_at_obs')} AS cpi_at_obs FROM real""")
def _(spark, d):
    out = deflate.deflate_strict(L.weekly_cells(lots(spark, d)), cpi(spark, d), BASE)
    keep = out.select("auction_date", "sex", "weight_class", "price_nominal", "price_real", "cpi_at_obs")
    return rounded(keep, "price_nominal", "price_real", "cpi_at_obs")


@query("c1_undeflated_weeks", f"""WITH {LOTS}, {CPI}, {WEEKLY} SELECT auction_date, sex, weight_class FROM weekly
 WHERE CAST(date_trunc('month', auction_date) AS DATE) NOT IN (SELECT period FROM cpi)""")
def _(spark, d):
    return deflate.undeflated(L.weekly_cells(lots(spark, d)), cpi(spark, d)).select("auction_date", "sex", "weight_class")


@query("c2_deflate_lenient", f"""WITH {CELLS} SELECT auction_date, class, bin_lo, count(*) AS n_lots, {q('max(deflator)', 6)} AS deflator
 FROM work GROUP BY 1, 2, 3""")
def _(spark, d):
    return rounded(cells(spark, d).select("auction_date", "class", "bin_lo", "n_lots", "deflator"), "deflator", digits=6)


@query("b20_real_columns", f"""WITH {CELLS} SELECT class, bin_lo, {q('avg(price_low*deflator)')} AS low_real, {q('avg(price_avg*deflator)')} AS avg_real,
 {q('avg(price_high*deflator)')} AS high_real FROM work GROUP BY 1, 2""")
def _(spark, d):
    real = deflate.real_columns(
        deflate.with_deflator(L.page_lots(lots(spark, d)), cpi(spark, d), BASE), ("price_low", "price_avg", "price_high")
    )
    out = real.groupBy("class", "bin_lo").agg(
        F.avg("price_low_real").alias("low_real"), F.avg("price_avg_real").alias("avg_real"), F.avg("price_high_real").alias("high_real")
    )
    return rounded(out, "low_real", "avg_real", "high_real")


@query("e1_local_median", f"""WITH {LOTS}, {CPI}, {WEEKLY}, {DEFLATED}, {SCREENED} SELECT auction_date, sex, weight_class, {q('m')} AS local_median FROM med""")
def _(spark, d):
    real = deflate.deflate_strict(L.weekly_cells(lots(spark, d)), cpi(spark, d), BASE)
    return rounded(spikes.with_local_median(real).select("auction_date", "sex", "weight_class", "local_median"), "local_median")


@query("e1_local_median_halo", f"""WITH {LOTS}, {CPI}, {WEEKLY}, {DEFLATED}, {SCREENED} SELECT auction_date, sex, weight_class, {q('m')} AS local_median FROM med""")
def _(spark, d):
    """The same from blocks of 32 rows of a series with the half window on either side."""
    real = deflate.deflate_strict(L.weekly_cells(lots(spark, d)), cpi(spark, d), BASE)
    return rounded(spikes.with_local_median(real, block=32).select("auction_date", "sex", "weight_class", "local_median"), "local_median")


CLEANED_SQL = f"""{FLAGSHIP} SELECT auction_date, sex, weight_class, head_count, n_pens,
 {q('CASE WHEN hit THEN m*(cpi_at_obs/cpi_base) ELSE price_nominal END')} AS price_nominal,
 {q('CASE WHEN hit THEN m ELSE price_real END')} AS price_real, {q('cpi_at_obs')} AS cpi_at_obs, hit AS spike_replaced,
 CASE WHEN NOT hit THEN '' WHEN ratio <= 0.6 THEN 'low' ELSE 'high' END AS direction, source_eras FROM flag"""


@query("e2_cleaned_weekly", CLEANED_SQL)
def cleaned_weekly(spark, d):
    screened = plan.screened_weekly(lots(spark, d), cpi(spark, d), BASE)
    return rounded(spikes.cleaned_rows(screened), "price_nominal", "price_real", "cpi_at_obs")


@query("e2_cleaned_strict_rule", f"""WITH {LOTS}, {CPI}, {WEEKLY}, {DEFLATED},
 med AS (SELECT *, CASE WHEN count(price_real) OVER w >= 3 THEN quantile_cont(price_real, 0.5) OVER w END AS m
 FROM real WINDOW w AS (PARTITION BY sex, weight_class ORDER BY auction_date ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))
 SELECT sex, weight_class, count(*) AS n, count(*) FILTER ((price_real/m <= 0.85 OR price_real/m >= 1.0/0.85) AND abs(price_real - m) > 20) AS n_spikes
 FROM med GROUP BY 1, 2""")
def _(spark, d):
    rule = C.SpikeRule(half_window=2, min_values=3, ratio_lo=0.85, ratio_hi=1 / 0.85, min_abs_dev=20.0)
    screened = plan.screened_weekly(lots(spark, d), cpi(spark, d), BASE, rule=rule)
    return screened.groupBy("sex", "weight_class").agg(F.count("*").alias("n"), F.count_if("spike_replaced").alias("n_spikes"))


@query("a14_spike_log", f"""{FLAGSHIP} SELECT auction_date, sex, weight_class, CASE WHEN ratio <= 0.6 THEN 'low' ELSE 'high' END AS direction,
 round(price_real, 4) AS price_real_orig, round(m, 4) AS price_real_replaced, round(price_nominal, 4) AS price_nominal_orig,
 round(m*(cpi_at_obs/cpi_base), 4) AS price_nominal_replaced, round(ratio, 4) AS ratio FROM flag WHERE hit""")
def _(spark, d):
    log = spikes.spike_log(plan.screened_weekly(lots(spark, d), cpi(spark, d), BASE))
    return log.drop("local_median_real", "cpi_at_obs")


# ---- settles and basis ---------------------------------------------------------------

CONTRACT_SQL = ", ".join(f"'{c}'" for c in CONTRACTS)
ASOF = f"""days AS (SELECT DISTINCT auction_date FROM cash),
hits AS (SELECT auction_date, contract_month, settle, date AS settle_date,
 row_number() OVER (PARTITION BY auction_date, contract_month ORDER BY date DESC) AS k
 FROM days JOIN settles ON date BETWEEN auction_date - 5 AND auction_date
 WHERE settle IS NOT NULL AND contract_month IN ({CONTRACT_SQL})),
found AS (SELECT * EXCLUDE (k) FROM hits WHERE k = 1)"""
BASIS = f"""{LOTS}, {CASH}, {SETTLES}, {ASOF},
basis AS (SELECT c.*, f.contract_month, price_avg_cash - settle AS basis FROM cash c LEFT JOIN found f USING (auction_date))"""


@query("c3_asof_settles", f"""WITH {LOTS}, {CASH}, {SETTLES}, {ASOF} SELECT auction_date, contract_month, {q('settle')} AS settle, settle_date FROM found""")
def _(spark, d):
    return rounded(B.lookup_settles(L.weekly_cash(lots(spark, d)), settles(spark, d), CONTRACTS), "settle")


@query("c4_basis", f"""WITH {BASIS} SELECT auction_date, class, frame, muscle_grade, weight_break_low, weight_break_high,
 {q('price_avg_cash')} AS price_avg_cash, n_lots, contract_month, {q('basis')} AS basis FROM basis""")
def _(spark, d):
    return rounded(plan.weekly_basis(lots(spark, d), settles(spark, d), CONTRACTS), "price_avg_cash", "basis")


SHOWN = f"""{BASIS}, {CPI}, fac AS (SELECT period, coalesce((SELECT cpi_u FROM cpi WHERE period = {BASE_SQL}),
 (SELECT arg_max(cpi_u, period) FROM cpi))/cpi_u AS f FROM cpi),
work AS (SELECT b.*, coalesce(f, 1.0) AS deflator FROM basis b LEFT JOIN fac ON period = CAST(date_trunc('month', auction_date) AS DATE)
 WHERE {CORE} AND basis IS NOT NULL AND weight_break_low >= 300 AND weight_break_low < 900),
anchor AS (SELECT max(auction_date) AS a FROM work),
wins AS (SELECT 'all' AS win, DATE '0001-01-01' AS s FROM anchor UNION ALL SELECT '5y', CAST(a - INTERVAL 5 YEAR AS DATE) FROM anchor
 UNION ALL SELECT '3y', CAST(a - INTERVAL 3 YEAR AS DATE) FROM anchor UNION ALL SELECT 'latest', CAST(date_trunc('year', a) AS DATE) FROM anchor),
modes AS (SELECT 'nominal' AS mode UNION ALL SELECT 'real'),
fan AS (SELECT w.*, win, mode, basis * CASE mode WHEN 'real' THEN deflator ELSE 1.0 END AS v FROM work w JOIN wins ON auction_date >= s, modes)"""


def shown_basis(spark, d):
    return plan.basis_for_views(plan.weekly_basis(lots(spark, d), settles(spark, d), CONTRACTS), cpi(spark, d), BASE)


@query("b13_strict_basis", f"""WITH {SHOWN} SELECT auction_date, contract_month, {q('basis')} AS basis FROM work WHERE class = 'Steers' AND weight_break_low = 700""")
def _(spark, d):
    return rounded(B.strict_basis(shown_basis(spark, d)).select("auction_date", "contract_month", "basis"), "basis")


@query("d7_basis_band", f"""WITH {SHOWN} SELECT win AS "window", contract_month, mode, class, weight_break_low AS bin_lo, {WEEK52} AS iso_week,
 {q('min(v)')} AS basis_min, {q('avg(v)')} AS basis_avg, {q('max(v)')} AS basis_max, count(v) AS n,
 weight_break_low || '–' || (weight_break_low + 99) || ' lb' AS weight_bin FROM fan GROUP BY 1, 2, 3, 4, 5, 6""")
def _(spark, d):
    return rounded(views.basis_band(shown_basis(spark, d)), "basis_min", "basis_avg", "basis_max")


@query("d23_basis_ranges", f"""WITH {SHOWN}, sl AS (SELECT *, 'all' AS slice FROM fan UNION ALL
 SELECT *, 'strict' FROM fan WHERE class = 'Steers' AND weight_break_low = 700),
 g AS (SELECT win, contract_month, mode, slice, min(v) AS lo, max(v) AS hi FROM sl GROUP BY 1, 2, 3, 4),
 spine AS (SELECT win, contract_month, mode, slice FROM wins, (SELECT unnest([{CONTRACT_SQL}, '9-NONE']) AS contract_month), modes, (SELECT unnest(['strict','all']) AS slice))
 SELECT s.win AS "window", s.contract_month, s.mode, s.slice,
 {q("coalesce(lo - greatest((hi-lo)*0.05, 1.0), CASE s.slice WHEN 'strict' THEN -30.0 ELSE -50.0 END)")} AS y_min,
 {q("coalesce(hi + greatest((hi-lo)*0.05, 1.0), CASE s.slice WHEN 'strict' THEN 10.0 ELSE 50.0 END)")} AS y_max
 FROM spine s LEFT JOIN g USING (win, contract_month, mode, slice)""")
def _(spark, d):
    return rounded(views.basis_ranges(shown_basis(spark, d), (*CONTRACTS, "9-NONE")), "y_min", "y_max")


@query("f1_basis_in_order", f"""WITH {BASIS} SELECT auction_date, class, weight_break_low, contract_month, CAST(row_number() OVER (PARTITION BY auction_date
 ORDER BY class NULLS LAST, weight_break_low NULLS LAST, contract_month NULLS LAST) AS INTEGER) AS place FROM basis""")
def _(spark, d):
    b = plan.weekly_basis(lots(spark, d), settles(spark, d), CONTRACTS)
    order = ("auction_date", "class", "weight_break_low", "contract_month")
    placed = numbered(b.select(*order), [F.asc_nulls_last(c) for c in order], within=("auction_date",))
    return placed.withColumn("place", F.col("place").cast("int"))


# ---- price views ---------------------------------------------------------------------


@query("d3_current_prices", f"""WITH {CELLS} SELECT mode, class, bin_lo, {q(W3.format(p='price_avg*f'))} AS price
 FROM fan, anchor WHERE win = 'all' AND auction_date = a GROUP BY 1, 2, 3""")
def _(spark, d):
    return rounded(views.current_prices(cells(spark, d)), "price")


@query("d4_envelope", f"""WITH {CELLS} SELECT win AS "window", mode, class, bin_lo, {PAGE_LABEL} AS weight_bin, {q('min(price_low*f)')} AS price_low,
 {q('avg(price_avg*f)')} AS price_mean, {q('max(price_high*f)')} AS price_high, CAST(coalesce(sum(head_count), 0) AS BIGINT) AS head_count
 FROM fan GROUP BY 1, 2, 3, 4""")
def _(spark, d):
    return rounded(views.envelope(cells(spark, d)), "price_low", "price_mean", "price_high")


@query("d5_seasonality", f"""WITH {CELLS} SELECT win AS "window", mode, class, bin_lo, {WEEK52} AS iso_week, {PAGE_LABEL} AS weight_bin,
 {q('avg(price_avg*f)')} AS price, count(price_avg) AS n FROM fan GROUP BY 1, 2, 3, 4, 5""")
def _(spark, d):
    return rounded(views.seasonality(cells(spark, d)), "price")


@query("d6_trend", f"""WITH {CELLS} SELECT win AS "window", mode, class, bin_lo, auction_date, {PAGE_LABEL} AS weight_bin,
 {q('avg(price_avg*f)')} AS price, count(price_avg) AS n FROM fan GROUP BY 1, 2, 3, 4, 5""")
def _(spark, d):
    return rounded(views.trend(cells(spark, d)), "price")


YEARLY_WEEK = f"""yr AS (SELECT win, mode, class, bin_lo, year(auction_date) AS y, {W3.format(p='price_avg*f')} AS price
 FROM fan, anchor WHERE win <> 'latest' AND year(auction_date) < year(a) AND {WEEK52} = least(week(a), 52) GROUP BY 1, 2, 3, 4, 5),
hist AS (SELECT win, mode, class, bin_lo, min(price) AS hist_min, avg(price) AS hist_avg, max(price) AS hist_max, count(price) AS n_years,
 quantile_cont(price, 0.25) AS q25, quantile_cont(price, 0.75) AS q75 FROM yr GROUP BY 1, 2, 3, 4),
cur AS (SELECT mode, class, bin_lo, {W3.format(p='price_avg*f')} AS price FROM fan, anchor WHERE win = 'all' AND auction_date = a GROUP BY 1, 2, 3),
cmp AS (SELECT h.*, c.price, CASE WHEN c.price >= q75 THEN 'top' WHEN c.price <= q25 THEN 'bot' ELSE 'mid' END AS band
 FROM hist h LEFT JOIN cur c USING (mode, class, bin_lo))"""


@query("d18_history_band", f"""WITH {CELLS}, {YEARLY_WEEK} SELECT win AS "window", mode, class, bin_lo, {q('hist_min')} AS hist_min, {q('hist_avg')} AS hist_avg,
 {q('hist_max')} AS hist_max, n_years, {q('q25')} AS q25, {q('q75')} AS q75 FROM hist""")
def _(spark, d):
    out = views.history_band(views.same_week_prices(cells(spark, d)))
    return rounded(out, "hist_min", "hist_avg", "hist_max", "q25", "q75")


@query("d19_percentile_band", f"""WITH {CELLS}, {YEARLY_WEEK} SELECT win AS "window", mode, class, bin_lo, {q('price')} AS price, band FROM cmp""")
def _(spark, d):
    return rounded(views.compare_now(cells(spark, d)).select("window", "mode", "class", "bin_lo", "price", "band"), "price")


@query("c7_history_with_current", f"""WITH {CELLS}, {YEARLY_WEEK} SELECT win AS "window", mode, class, bin_lo, {q('hist_avg')} AS hist_avg, {q('price')} AS price FROM cmp""")
def _(spark, d):
    return rounded(views.compare_now(cells(spark, d)).select("window", "mode", "class", "bin_lo", "hist_avg", "price"), "hist_avg", "price")


@query("b24_delta_and_position", f"""WITH {CELLS}, {YEARLY_WEEK} SELECT win AS "window", mode, class, bin_lo, {q('price - hist_avg')} AS delta,
 CASE WHEN price IS NULL OR hist_avg IS NULL THEN '—' ELSE CASE band WHEN 'top' THEN 'Top 25%' WHEN 'bot' THEN 'Bottom 25%' ELSE 'Middle 50%' END
 || ' (of ' || n_years || ' yr)' END AS position_text FROM cmp""")
def _(spark, d):
    out = views.position_text(views.compare_now(cells(spark, d)))
    return rounded(out.select("window", "mode", "class", "bin_lo", "delta", "position_text"), "delta")


@query("c11_bin_spine", f"""WITH {CELLS}, cur AS (SELECT class, bin_lo, {W3.format(p='price_avg*f')} AS price FROM fan, anchor
 WHERE win = 'all' AND mode = 'nominal' AND auction_date = a GROUP BY 1, 2)
 SELECT class, CAST(bin_lo AS INTEGER) AS bin_lo, {q('price')} AS price FROM (SELECT class, bin_lo FROM (SELECT unnest(['Steers','Heifers']) AS class), (SELECT unnest([300,400,500,600,700,800]) AS bin_lo))
 LEFT JOIN cur USING (class, bin_lo)""")
def _(spark, d):
    now = views.current_prices(cells(spark, d)).filter(F.col("mode") == "nominal").drop("mode")
    return rounded(views.on_bin_spine(now), "price")


@query("d22_window_caption", f"""WITH {LOTS}, {PAGE} SELECT min(auction_date) AS date_min, max(auction_date) AS date_max, count(DISTINCT auction_date) AS n_dates,
 count(DISTINCT year(auction_date)) AS n_years, count(*) AS n_rows FROM page""")
def _(spark, d):
    return views.caption(L.page_lots(lots(spark, d)))


@query("d28_index_series", f"""WITH {CPI} SELECT period, {q('cpi_u')} AS cpi_u, {q(f"(SELECT cpi_u FROM cpi WHERE period = {BASE_SQL})")} AS base_level FROM cpi""")
def _(spark, d):
    return rounded(deflate.index_series(cpi(spark, d), BASE), "cpi_u", "base_level")


@query("f4_chart_order", f"""WITH {CELLS} SELECT class, bin_lo, {WEEK52} AS iso_week, count(*) AS n FROM work GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""")
def _(spark, d):
    return views.chart_order(cells(spark, d))


@query("d3_card_header", f"""WITH {LOTS}, {PAGE} SELECT max(auction_date) AS auction_date, strftime(max(auction_date), '%A, %B %-d, %Y') AS auction_day,
 CAST(coalesce(sum(head_count), 0) AS BIGINT) AS n_head FROM page WHERE auction_date = (SELECT max(auction_date) FROM page)""")
def _(spark, d):
    return plan.card(lots(spark, d))["header"]


@query("f5_latest_index_month", f"WITH {CPI} SELECT period, {q('cpi_u')} AS cpi_u FROM cpi ORDER BY period DESC LIMIT 1")
def _(spark, d):
    from drover.operators.vintage import latest_row

    return rounded(latest_row(cpi(spark, d), "period"), "cpi_u")
