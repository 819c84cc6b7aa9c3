"""Data-quality gates and descriptive profiles."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binding.ingest import PRIOR, payloads, prior_index
from binding.prices import BASIS
from binding.registry import q, query, rounded
from binding.tables import CONTRACTS, CORE_TYPES, CPI, LOTS, POLICIES, cpi, lots, policies, settles, table
from drover.operators import profile as P
from drover.operators import quality as Q
from drover.operators import vintage as V
from drover.plans import weekly as plan
from drover.session import fresh_path, materialize
from drover.sources import lots_json

# ---- shapes --------------------------------------------------------------------------


@query("k1_json_key_signature", """SELECT sha256('root:k') AS signature, 'root:k' AS shape, count(*) AS n_rows FROM events""")
def _(spark, d):
    return Q.key_signature(table(spark, d, "events"), "props")


@query("k1_signature_gate", """SELECT 'schema_signature' AS rule_id, 'fail' AS severity, CAST(0 AS BIGINT) AS n_bad, CAST(1 AS BIGINT) AS n_total, CAST(NULL AS VARCHAR) AS sample
 FROM (SELECT count(*) FROM events)""")
def _(spark, d):
    import hashlib

    found = Q.key_signature(table(spark, d, "events"), "props")
    return Q.check_signature(found, hashlib.sha256(b"root:k").hexdigest())


def nested(spark, d):
    """Index bodies made of orders; some points have a key of their own."""
    note = F.when(F.col("o_orderkey") % 97 == 0, F.lit(',"note":"n"')).otherwise(F.lit(""))
    head, tail = F.lit('{"status":"ok","Results":{"series":[{"id":"x","data":[{"year":"'), F.lit("}]}]}}")
    body = F.concat(head, F.year("o_orderdate").cast("string"), F.lit('","value":1'), note, tail)
    return table(spark, d, "orders").select(body.alias("body"))


LEVELS = {"series": "$.Results.series[0]", "row": "$.Results.series[0].data[0]"}
SHAPES = """sh AS (SELECT 'root:Results,status|series:data,id|row:' || CASE WHEN o_orderkey % 97 = 0 THEN 'note,value,year' ELSE 'value,year' END AS shape FROM orders)"""


@query("k1_nested_signature", f"WITH {SHAPES} SELECT shape, sha256(shape) AS signature, count(*) AS n_rows FROM sh GROUP BY 1")
def _(spark, d):
    return Q.key_signature(nested(spark, d), "body", levels=LEVELS)


@query("k1_baseline", f"""WITH {SHAPES}, n AS (SELECT count(DISTINCT shape) AS n FROM sh), one AS (SELECT count(DISTINCT shape) AS n FROM sh WHERE shape NOT LIKE '%note%')
 SELECT 'recorded' AS step, CAST(0 AS BIGINT) AS n_bad, one.n AS n_total FROM one UNION ALL SELECT 'changed', n.n - one.n, n.n FROM n, one
 UNION ALL SELECT 'rebaselined', 0, n.n FROM n UNION ALL SELECT 'after', 0, n.n FROM n""")
def _(spark, d):
    """The first run records, a new shape fails, and after an explicit rebaseline it passes."""
    path = fresh_path(spark, "baseline")
    found = materialize(Q.key_signature(nested(spark, d), "body", levels=LEVELS), "shapes")
    steps = [("recorded", found.filter("shape NOT LIKE '%note%'"), False), ("changed", found, False), ("rebaselined", found, True), ("after", found, False)]
    reports = [
        materialize(Q.signature_gate(shapes, path, again).select(F.lit(step).alias("step"), "n_bad", "n_total"), step)
        for step, shapes, again in steps
    ]
    return Q.all_issues(*reports)


# ---- insurance -----------------------------------------------------------------------


def rule(rule_id, bad, scope="true", severity="fail", source="policies"):
    return (
        f"SELECT '{rule_id}' AS rule_id, '{severity}' AS severity, count(*) FILTER (({scope}) AND ({bad})) AS n_bad, "
        f"count(*) FILTER ({scope}) AS n_total FROM {source}"
    )


def policy_gate_sql() -> str:
    parts = []
    for name, lo, hi in (("coverage_price", 20, 800), ("expected_end_value", 20, 800), ("cost_per_cwt", 0.01, 100)):
        scope = f"{CORE_TYPES} AND {name} IS NOT NULL"
        parts += [rule(f"{name}_low", f"{name} < {lo}", scope), rule(f"{name}_high", f"{name} > {hi}", scope)]
    parts += [
        rule("coverage_level_pct_range", "coverage_level_pct < 0 OR coverage_level_pct > 1", "coverage_level_pct IS NOT NULL"),
        rule("length_weeks_value", "length_weeks NOT IN (13,17,21,26,30,34,39,43,47,52)", "length_weeks IS NOT NULL"),
        rule("effective_date_missing", "effective_date IS NULL"),
        rule("end_date_missing", "end_date IS NULL"),
        rule("end_before_start", "end_date < effective_date", "effective_date IS NOT NULL AND end_date IS NOT NULL"),
    ]
    for c in ("n_endorsements_earning", "n_endorsements_indemn", "n_head", "subsidy_amount", "total_premium_amount",
              "producer_premium_amount", "liability_amount", "total_weight_cwt"):
        parts.append(rule(f"{c}_negative", f"{c} < 0", f"{c} IS NOT NULL"))
    parts += [
        rule("commodity_code_filter", "commodity_code IS DISTINCT FROM '0801'"),
        rule("plan_code_filter", "plan_code IS DISTINCT FROM '81'"),
    ]
    return f"WITH {POLICIES} " + " UNION ALL ".join(parts)


@query("k3_policy_values", policy_gate_sql())
def _(spark, d):
    return Q.run_rules(policies(spark, d), Q.policy_rules()).drop("sample")


@query("k4_year_coverage", f"""WITH {POLICIES}, y AS (SELECT DISTINCT reinsurance_year AS y FROM policies), raw AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders)
 SELECT 'year_range' AS rule_id, count(*) FILTER (NOT y BETWEEN 1996 AND 2000) AS n_bad, count(*) AS n_total FROM y
 UNION ALL SELECT 'year_missing', count(*) FILTER (y NOT IN (SELECT y FROM y)), count(*) FROM raw""")
def _(spark, d):
    have = policies(spark, d)
    raw = table(spark, d, "orders").select(F.year("o_orderdate").alias("reinsurance_year"))
    return Q.check_years(have, raw, 2000, first=1996).select("rule_id", "n_bad", "n_total")


@query("c9_missing_years", f"""WITH {POLICIES} SELECT DISTINCT year(ts) AS year FROM events WHERE year(ts) NOT IN (SELECT reinsurance_year FROM policies)""")
def _(spark, d):
    have = policies(spark, d).select(F.col("reinsurance_year").alias("year"))
    return V.absent_from(table(spark, d, "events").select(F.year("ts").alias("year")), have, "year")


# ---- lots ----------------------------------------------------------------------------

FEED = "raw AS (SELECT *, l_extendedprice/100 AS p FROM lineitem WHERE l_linenumber NOT IN (4, 5))"
LOT_ISSUES = f"""WITH {FEED}
 SELECT 'avg_price_not_numeric' AS rule_id, CAST(0 AS BIGINT) AS n_bad, count(*) AS n_total FROM raw
 UNION ALL SELECT 'avg_price_bounds', count(*) FILTER (l_tax >= 0.005 AND NOT p BETWEEN 20 AND 800), count(*) FROM raw
 UNION ALL SELECT 'avg_price_min_not_numeric', 0, count(*) FROM raw
 UNION ALL SELECT 'avg_price_min_bounds', count(*) FILTER (NOT p - 1 BETWEEN 20 AND 800), count(*) FROM raw
 UNION ALL SELECT 'avg_price_max_not_numeric', 0, count(*) FROM raw
 UNION ALL SELECT 'avg_price_max_bounds', count(*) FILTER (NOT p + 1 BETWEEN 20 AND 800), count(*) FROM raw
 UNION ALL SELECT 'head_count_not_numeric', 0, count(*) FROM raw
 UNION ALL SELECT 'head_count_negative', 0, count(*) FROM raw
 UNION ALL SELECT 'weight_span', 0, count(*) FROM raw"""


@query("k5_raw_lot_issues", LOT_ISSUES)
def _(spark, d):
    return Q.raw_lot_issues(lots_json.raw_rows(payloads(spark, d), fields=Q.LOT_ISSUE_FIELDS)).select("rule_id", "n_bad", "n_total")


@query("k5_lot_value_gate", f"""WITH i AS ({LOT_ISSUES}) SELECT 'lot_values' AS rule_id, CASE WHEN sum(n_bad)/max(n_total) > 0.001 THEN 'fail' ELSE 'warn' END AS severity,
 CAST(sum(n_bad) AS BIGINT) AS n_bad, max(n_total) AS n_total FROM i""")
def _(spark, d):
    return Q.lot_value_gate(lots_json.raw_rows(payloads(spark, d), fields=Q.LOT_ISSUE_FIELDS)).drop("sample")


@query("k6_lot_continuity", f"""WITH {LOTS}, n AS (SELECT DISTINCT auction_date AS day FROM lots WHERE year(auction_date) <> 1996),
 p AS (SELECT DISTINCT auction_date AS day FROM lots WHERE auction_date < DATE '2001-09-01' AND year(auction_date) <> 1998), m AS (SELECT max(day) - 14 AS cut FROM p)
 SELECT 'deep_history_date' AS rule_id, count(*) FILTER (day < cut) AS n_bad, count(*) AS n_total FROM n, m WHERE day NOT IN (SELECT day FROM p)
 UNION ALL SELECT 'vanished_date', count(*) FILTER (day < cut), count(*) FROM p, m WHERE day NOT IN (SELECT day FROM n)""")
def _(spark, d):
    days = lots(spark, d).select("auction_date")
    new = days.filter(F.year("auction_date") != 1996)
    prior = days.filter((F.col("auction_date") < F.lit(date(2001, 9, 1))) & (F.year("auction_date") != 1998))
    return Q.lot_continuity(new, prior).select("rule_id", "n_bad", "n_total")


# ---- price index ---------------------------------------------------------------------


def raw_points(index):
    """Index as text points with a suppressed February and one invalid May."""
    m = F.month("period")
    value = F.when(m == 2, " - ").when((m == 5) & (F.year("period") == 1997), "abc").otherwise(F.col("cpi_u").cast("string"))
    points = index.select(
        F.year("period").cast("string").alias("year"),
        F.concat(F.lit("M"), F.lpad(m.cast("string"), 2, "0")).alias("period"), value.alias("value"),
    )
    return points.unionByName(points.filter("period = 'M12'").withColumn("period", F.lit("M13")))


POINTS = """pts AS (SELECT period, CASE WHEN month(period) = 2 OR (month(period) = 5 AND year(period) = 1997) THEN NULL ELSE cpi_u END AS v,
 month(period) = 5 AND year(period) = 1997 AS invalid FROM cpi),
 ch AS (SELECT *, (v - lag(v) OVER (ORDER BY period))/lag(v) OVER (ORDER BY period) AS change FROM pts)"""


@query("e4_monthly_change", f"""WITH {CPI}, {POINTS} SELECT period, {q('change', 6)} AS change, coalesce(abs(change) > 0.05, false) AS flagged, invalid FROM ch""")
def _(spark, d):
    out = Q.monthly_change(raw_points(cpi(spark, d))).select("period", "change", "flagged", "invalid")
    return rounded(out, "change", digits=6)


@query("k7_index_gate", f"""WITH {CPI}, {POINTS} SELECT 'index_not_numeric' AS rule_id, count(*) FILTER (invalid) AS n_bad, count(*) AS n_total FROM ch
 UNION ALL SELECT 'index_monthly_change', count(*) FILTER (abs(change) > 0.05), count(*) FROM ch""")
def _(spark, d):
    return Q.index_gate(raw_points(cpi(spark, d))).select("rule_id", "n_bad", "n_total")


@query("k8_index_continuity", f"""WITH {CPI}, {PRIOR}, l AS (SELECT max(period) AS m FROM prior), e AS (SELECT max(period) AS nm FROM cpi),
 o AS (SELECT c.period, c.cpi_u, p.cpi_u AS was FROM cpi c LEFT JOIN prior p USING (period), l WHERE c.period <= m - INTERVAL 2 MONTH)
 SELECT 'index_has_rows' AS rule_id, CAST(0 AS BIGINT) AS n_bad, CAST(1 AS BIGINT) AS n_total FROM e
 UNION ALL SELECT 'index_ends_earlier', CAST(nm < m AS BIGINT), 1 FROM e, l
 UNION ALL SELECT 'index_adds_months', CAST(datediff('month', m, nm) > 1 AS BIGINT), 1 FROM e, l
 UNION ALL SELECT 'index_new_history', count(*) FILTER (was IS NULL), count(*) FROM o
 UNION ALL SELECT 'index_deep_revision', count(*) FILTER (abs(was - cpi_u) > 1e-6), count(*) FROM o""")
def _(spark, d):
    index = materialize(cpi(spark, d), "index")
    return Q.index_continuity(index, prior_index(index)).select("rule_id", "n_bad", "n_total")


# ---- historical batch ----------------------------------------------------------------

FLOORS = {1994: 1, 1998: 40, 2001: 50}


@query("d16_weeks_per_year", f"WITH {LOTS} SELECT year(auction_date) AS year, count(DISTINCT auction_date) AS n_weeks FROM lots GROUP BY 1")
def _(spark, d):
    return P.weeks_per_year(lots(spark, d))


@query("d16_class_shares", f"""WITH {LOTS} SELECT y AS year, c AS class, {q('count(*) FILTER (class = c)/count(*)')} AS share FROM (SELECT year(auction_date) AS y, class FROM lots),
 (SELECT unnest(['Steers','Heifers','Bulls']) AS c) GROUP BY 1, 2""")
def _(spark, d):
    return rounded(P.class_shares(lots(spark, d)), "share")


@query("k9_history_gate", f"""WITH {LOTS}, wk AS (SELECT year(auction_date) AS y, count(DISTINCT auction_date) AS n FROM lots GROUP BY 1),
 sh AS (SELECT y, c, f, count(*) FILTER (class = c)/count(*) AS s FROM (SELECT year(auction_date) AS y, class FROM lots), (VALUES ('Steers', 0.3), ('Heifers', 0.2), ('Bulls', 0.4)) AS t(c, f) GROUP BY 1, 2, 3)
 {rule('auction_date_missing', 'auction_date IS NULL', source='lots')}
 UNION ALL {rule('auction_date_window', "NOT auction_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'", source='lots')}
 UNION ALL {rule('class_value', "class NOT IN ('Steers','Heifers','Bulls')", source='lots')}
 UNION ALL {rule('grade_value', "muscle_grade NOT IN ('1','1-2','2','3')", severity='warn', source='lots')}
 UNION ALL {rule('price_missing', 'price_avg IS NULL', source='lots')}
 UNION ALL {rule('price_bounds', 'NOT price_avg BETWEEN 20 AND 800', source='lots')}
 UNION ALL SELECT 'weeks_per_year', 'fail', count(*) FILTER (coalesce(n, 0) < f), count(*) FROM (VALUES (1994, 1), (1998, 40), (2001, 50)) AS t(y, f) LEFT JOIN wk USING (y)
 UNION ALL SELECT 'class_share', 'fail', count(*) FILTER (NOT (y = 1995 AND c = 'Bulls') AND s < f), count(*) FILTER (NOT (y = 1995 AND c = 'Bulls')) FROM sh
 UNION ALL SELECT 'class_share_excused', 'warn', count(*) FILTER (y = 1995 AND c = 'Bulls' AND s < f), count(*) FILTER (y = 1995 AND c = 'Bulls') FROM sh
 UNION ALL SELECT 'required_columns', 'fail', CAST(0 AS BIGINT), CAST(11 AS BIGINT) FROM (SELECT count(*) FROM lots)
 UNION ALL SELECT 'not_empty', 'fail', CAST(0 AS BIGINT), count(*) FROM lots""")
def _(spark, d):
    shares = {"Steers": 0.3, "Heifers": 0.2, "Bulls": 0.4}
    return Q.history_gate(lots(spark, d), (date(1996, 1, 1), date(2000, 12, 31)), FLOORS, shares, ((1995, "Bulls"),)).drop("sample")


# ---- consistency of two sources ------------------------------------------------------

MEDIANS = """bc AS (SELECT source, year(auction_date) AS year, class, lo AS weight_break_low, lo + 100 AS weight_break_high, price_avg FROM
 (SELECT *, CAST(floor(coalesce(weight_break_low, avg_weight)/100)*100 AS INTEGER) AS lo FROM lots WHERE class IN ('Steers','Heifers') AND frame = 'Medium and Large' AND muscle_grade = '1') WHERE lo >= 300 AND lo < 1000),
 md AS (SELECT source, year, class, weight_break_low, weight_break_high, quantile_cont(price_avg, 0.5) AS m, count(*) AS n FROM bc GROUP BY ALL),
 cc AS (SELECT r.year, r.class, r.weight_break_low, r.weight_break_high, r.m AS ref_median, r.n AS ref_n, o.m AS our_median, o.n AS our_n, (o.m - r.m)/r.m*100 AS delta_pct
 FROM (SELECT * FROM md WHERE source = 'legacy') r JOIN (SELECT * FROM md WHERE source = 'live') o USING (year, class, weight_break_low, weight_break_high))"""


def cells_of_two(spark, d):
    medians = materialize(P.annual_medians(P.binned_core(lots(spark, d), extra=("source",)), extra=("source",)), "medians")
    return materialize(Q.consistency_of(medians, "live", "legacy"), "consistency")


@query("d15_annual_medians", f"""WITH {LOTS}, {MEDIANS} SELECT year, class, weight_break_low, weight_break_high, {q('quantile_cont(price_avg, 0.5)')} AS price_median, count(*) AS n_obs FROM bc GROUP BY 1, 2, 3, 4""")
def _(spark, d):
    return rounded(P.annual_medians(P.binned_core(lots(spark, d))), "price_median")


@query("c8_consistency_cells", f"""WITH {LOTS}, {MEDIANS} SELECT year, class, weight_break_low, weight_break_high, {q('ref_median')} AS ref_median, ref_n, {q('our_median')} AS our_median, our_n, {q('delta_pct')} AS delta_pct FROM cc""")
def _(spark, d):
    return rounded(cells_of_two(spark, d).drop("abs_delta_pct"), "ref_median", "our_median", "delta_pct")


@query("d21_consistency_summary", f"""WITH {LOTS}, {MEDIANS} SELECT count(*) AS n_cells, {q('avg(abs(delta_pct))')} AS mean_abs, {q('quantile_cont(abs(delta_pct), 0.5)')} AS median_abs, {q('max(abs(delta_pct))')} AS max_abs,
 count(*) FILTER (abs(delta_pct) > 5) AS n_over_5, count(*) FILTER (abs(delta_pct) > 10) AS n_over_10 FROM cc""")
def _(spark, d):
    return rounded(Q.consistency_summary(cells_of_two(spark, d)).drop("verdict"), "mean_abs", "median_abs", "max_abs")


@query("k10_consistency_verdict", f"""WITH {LOTS}, {MEDIANS} SELECT CASE WHEN avg(abs(delta_pct)) > 5 OR max(abs(delta_pct)) > 25 THEN 'fail' WHEN avg(abs(delta_pct)) > 3 OR max(abs(delta_pct)) > 10 THEN 'warn' ELSE 'pass' END AS verdict,
 count(*) AS n_cells FROM cc""")
def _(spark, d):
    return Q.consistency_summary(cells_of_two(spark, d)).select("verdict", "n_cells")


@query("f3_worst_cells", f"""WITH {LOTS}, {MEDIANS} SELECT year, class, weight_break_low, {q('delta_pct')} AS delta_pct FROM cc ORDER BY abs(cc.delta_pct) DESC, year, class, weight_break_low LIMIT 3""")
def _(spark, d):
    return rounded(Q.worst_cells(cells_of_two(spark, d)).select("year", "class", "weight_break_low", "delta_pct"), "delta_pct")


# ---- manifest ------------------------------------------------------------------------


@query("k11_out_of_order", f"""WITH {LOTS} SELECT 'manifest_last_is_newest' AS rule_id, CAST(1 AS BIGINT) AS n_bad, count(DISTINCT source) AS n_total FROM lots""")
def _(spark, d):
    """The older vintage of one dataset was written last."""
    both = lots(spark, d)
    written = {("live", "2002-01-07"): 1, ("live", "2002-01-14"): 2, ("legacy", "2001-12-31"): 4, ("legacy", "2002-01-07"): 3}
    entries = [
        V.manifest_entry(both.filter(F.col("source") == s), s, v).withColumn("written_at_utc", F.lit(f"2002-02-0{k} 00:00:00").cast("timestamp"))
        for (s, v), k in written.items()
    ]
    return Q.manifest_order(reduce(DataFrame.unionByName, entries)).select("rule_id", "n_bad", "n_total")


@query("k11_manifest_gate", f"""WITH {LOTS}, m AS (SELECT source AS dataset, CAST(vintage AS VARCHAR) AS vintage, count(*) AS rows FROM lots GROUP BY 1, 2)
 SELECT 'not_empty' AS rule_id, CAST(0 AS BIGINT) AS n_bad, count(*) AS n_total FROM m
 UNION ALL SELECT 'manifest_vintage', 0, count(*) FROM m UNION ALL SELECT 'manifest_sha256', 0, count(*) FROM m UNION ALL SELECT 'manifest_written_at_utc', 0, count(*) FROM m
 UNION ALL SELECT 'manifest_last_is_newest', 0, count(DISTINCT dataset) FROM m""")
def _(spark, d):
    both = lots(spark, d)
    entries = [V.manifest_entry(both.filter(F.col("source") == s), s, v) for s, v in (("live", "2002-01-07"), ("legacy", "2001-12-31"))]
    return Q.manifest_gate(entries[0].unionByName(entries[1])).select("rule_id", "n_bad", "n_total")


# ---- profiles ------------------------------------------------------------------------


@query("d20_basis_by_contract", f"""WITH {BASIS} SELECT contract_month, {q('min(basis)')} AS basis_min, {q('max(basis)')} AS basis_max, {q('quantile_cont(basis, 0.5)')} AS basis_median, count(basis) AS n
 FROM basis WHERE basis IS NOT NULL AND contract_month IS NOT NULL GROUP BY 1""")
def _(spark, d):
    b = plan.weekly_basis(lots(spark, d), settles(spark, d), CONTRACTS)
    return rounded(P.basis_ranges_by_contract(b), "basis_min", "basis_max", "basis_median")


@query("d25_depth_probe", """WITH t AS (SELECT CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders)
 SELECT count(*) AS n_records, count(day) AS n_dated, min(day) AS earliest, max(day) AS latest, min(day) <= DATE '1994-06-01' AS covered, CAST(min(day) - DATE '1994-06-01' AS INTEGER) AS gap_days,
 CAST(floor(greatest(min(day) - DATE '1994-06-01', 0)/7) AS INTEGER) AS gap_weeks, count(*) IN (5000, 100000) AS at_row_cap FROM t""")
def _(spark, d):
    # Five notations by order key; the last one is not a date.
    k, day = F.col("o_orderkey") % 5, F.col("o_orderdate")
    shown = (
        F.when(k == 0, F.date_format(day, "MM/dd/yyyy")).when(k == 1, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(k == 2, F.date_format(day, "M-d-yyyy")).when(k == 3, F.date_format(day, "yyyy/MM/dd HH:mm")).otherwise("soon")
    )
    text = table(spark, d, "orders").select(F.lit("").alias("report_begin_date"), shown.alias("report_date"))
    days = text.select(P.report_day(("report_begin_date", "report_date")).alias("day"))
    return P.depth_probe(days, floor=date(1994, 6, 1))


@query("d25_year_histogram", "SELECT year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY 1")
def _(spark, d):
    return P.rows_per_year(table(spark, d, "orders"), "o_orderdate")


@query("d27_volume_dip", f"""WITH {LOTS}, c AS (SELECT year(auction_date) AS y, count(*) AS n FROM lots GROUP BY 1)
 SELECT 1998 AS year, (SELECT n FROM c WHERE y = 1998) AS n_year, (SELECT min(n) FROM c WHERE y IN (1997, 1999, 2000)) AS adjacent_min, (SELECT max(n) FROM c WHERE y IN (1997, 1999, 2000)) AS adjacent_max""")
def _(spark, d):
    return P.volume_dip(lots(spark, d), 1998, (1997, 1999, 2000))


@query("e7_sample_per_year", """SELECT year, day, o_orderkey FROM (SELECT year(o_orderdate) AS year, CAST(o_orderdate AS DATE) AS day, o_orderkey,
 row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderdate, o_orderkey) AS k FROM orders) WHERE k = 1""")
def _(spark, d):
    days = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"), "o_orderkey")
    return P.sample_per_year(days, "day")
