"""Insurance summaries and back-test."""

from __future__ import annotations

from pyspark.sql import functions as F

from binding import rendered
from binding.registry import q, query, r, rounded
from binding.tables import CORE_TYPES, HOME, POLICIES, policies, table
from drover.config import YEAR_WINDOWS
from drover.functions import bins
from drover.functions.columns import county_id, safe_ratio
from drover.functions.dates import year_windows_of
from drover.operators import insurance as I
from drover.operators import profile
from drover.operators import sorted_state as K
from drover.plans import insurance as plan
from drover.session import materialize

STATE = "S05"
YWINS = f"""bounds AS (SELECT min(reinsurance_year) AS lo, max(reinsurance_year) AS hi FROM policies WHERE {CORE_TYPES}),
ywins AS (SELECT 'all' AS win, lo AS y0, hi FROM bounds UNION ALL SELECT 'last_5', greatest(hi - 4, lo), hi FROM bounds
 UNION ALL SELECT 'last_3', greatest(hi - 2, lo), hi FROM bounds UNION ALL SELECT 'latest', hi, hi FROM bounds)"""
SUMS = ", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in I.COUNTS)
W4 = "CASE WHEN sum(coalesce(n_head,0)) > 0 THEN sum(coalesce({c},0)*coalesce(n_head,0))/sum(coalesce(n_head,0)) ELSE avg({c}) END"
W4_MEANS = ", ".join(f"{W4.format(c=src)} AS {out}" for out, src in I.MEANS.items())


def safe(n, d):
    return f"CASE WHEN coalesce({d}, 0) <> 0 THEN coalesce({n}, 0)/CAST({d} AS DOUBLE) ELSE 0.0 END"


RATIOS = {
    "indemnified_share": safe("n_endorsements_indemn", "n_endorsements_earning"),
    "indemnity_to_producer_premium_rate": safe("indemnity_amount", "producer_premium_amount"),
    "subsidy_share": safe("subsidy_amount", "total_premium_amount"),
    "producer_share_of_premium": safe("producer_premium_amount", "total_premium_amount"),
}
RATIO_SQL = ", ".join(f"{q(e)} AS {n}" for n, e in RATIOS.items())
RATIO3_SQL = ", ".join(f"{q(e)} AS {n}" for n, e in list(RATIOS.items())[:3])
ROUND_MEANS = ", ".join(f"{q(f'coalesce({m}, 0.0)')} AS {m}" for m in I.MEANS)
ZERO_COUNTS = ", ".join(f"coalesce({c}, 0) AS {c}" for c in I.COUNTS)


def cube_of(df):
    return materialize(I.policy_cube(df), "cube")


def cube(spark, d):
    return cube_of(policies(spark, d))


def tidy(df, *extra):
    return rounded(df, *[c for c in (*I.MEANS, *RATIOS, *extra) if c in df.columns])


@query("b7_year_windows", f"""WITH {POLICIES}, {YWINS} SELECT win AS "window", state_abbr, count(*) AS n FROM policies JOIN ywins ON reinsurance_year BETWEEN y0 AND hi
 WHERE {CORE_TYPES} GROUP BY 1, 2""")
def _(spark, d):
    core = policies(spark, d).filter(I.is_core())
    first, last = I.year_bounds(core)
    fanned = core.withColumn("window", F.explode(year_windows_of(I.YEAR, first, last, YEAR_WINDOWS)))
    return fanned.groupBy("window", "state_abbr").agg(F.count("*").alias("n"))


@query("b7_window_bounds", f"""WITH {POLICIES}, {YWINS} SELECT win AS "window", y0 AS first_year, hi AS last_year FROM ywins""")
def _(spark, d):
    return I.window_bounds(policies(spark, d).filter(I.is_core()))


@query("b12_backtest_subset", f"""WITH {POLICIES}, {YWINS}, w AS (SELECT p.*, win FROM policies p JOIN ywins ON reinsurance_year BETWEEN y0 AND hi WHERE {CORE_TYPES})
 SELECT 'national' AS part, count(*) AS n FROM w WHERE win = 'last_3' UNION ALL
 SELECT 'attributed', count(*) FROM w WHERE win = 'last_3' AND state_abbr <> 'XX' UNION ALL
 SELECT 'state', count(*) FROM w WHERE win = 'latest' AND state_abbr = '{STATE}'""")
def _(spark, d):
    slices = {"national": (None, "last_3", True), "attributed": ("All", "last_3", False), "state": (STATE, "latest", True)}
    return I.slice_sizes(policies(spark, d), slices)


@query("b16_county_ids", f"""WITH {POLICIES} SELECT lpad(state_fips, 2, '0') || lpad(county_fips, 3, '0') AS fips_5, count(*) AS n FROM policies GROUP BY 1""")
def _(spark, d):
    return policies(spark, d).groupBy(county_id("state_fips", "county_fips").alias("fips_5")).agg(F.count("*").alias("n"))


COVERAGE_BIN = """CASE WHEN coverage_level_pct >= 1.0 THEN 1.0 WHEN coverage_level_pct >= 0.95 THEN 0.95 WHEN coverage_level_pct >= 0.9 THEN 0.9
 WHEN coverage_level_pct >= 0.85 THEN 0.85 WHEN coverage_level_pct >= 0.8 THEN 0.8 WHEN coverage_level_pct >= 0.75 THEN 0.75
 WHEN coverage_level_pct >= 0.7 THEN 0.7 END"""
LABEL = "CASE WHEN {c} >= 1.0 THEN '100%' ELSE CAST(round({c}*100) AS INTEGER) || '–' || CAST(round(({c}+0.05)*100) AS INTEGER) || '%' END"


@query("b17_coverage_bins", f"""WITH {POLICIES} SELECT CAST(b AS DOUBLE) AS coverage_bin, count(*) AS n FROM (SELECT {COVERAGE_BIN} AS b FROM policies) GROUP BY 1""")
def _(spark, d):
    return policies(spark, d).groupBy(bins.coverage_bin("coverage_level_pct").alias("coverage_bin")).agg(F.count("*").alias("n"))


@query("b21_coverage_labels", f"""WITH {POLICIES} SELECT {LABEL.format(c='b')} AS label, count(*) AS n FROM
 (SELECT CAST({COVERAGE_BIN} AS DOUBLE) AS b FROM policies) WHERE b IS NOT NULL GROUP BY 1""")
def _(spark, d):
    binned = policies(spark, d).select(bins.coverage_bin("coverage_level_pct").alias("b")).filter("b IS NOT NULL")
    return binned.groupBy(bins.coverage_label("b").alias("label")).agg(F.count("*").alias("n"))


ADV = "adv AS (SELECT *, (indemnity_amount - producer_premium_amount)/total_weight_cwt AS a FROM {src} WHERE total_weight_cwt > 0)"


@query("b18_advantage", f"""WITH {POLICIES}, {ADV.format(src='policies')} SELECT state_abbr, count(*) AS n, {q('min(a)')} AS low, {q('max(a)')} AS high, {q('avg(a)')} AS mean FROM adv GROUP BY 1""")
def _(spark, d):
    a = F.col("advantage_per_cwt")
    out = I.with_advantage(policies(spark, d)).groupBy("state_abbr").agg(
        F.count("*").alias("n"), F.min(a).alias("low"), F.max(a).alias("high"), F.avg(a).alias("mean")
    )
    return rounded(out, "low", "high", "mean")


@query("b19_safe_ratio", f"""WITH {POLICIES} SELECT type_code, {q('sum(' + safe('indemnity_amount', 'producer_premium_amount') + ')', 3)} AS total FROM policies GROUP BY 1""")
def _(spark, d):
    ratio = safe_ratio("indemnity_amount", "producer_premium_amount")
    return policies(spark, d).groupBy("type_code").agg(r(F.sum(ratio), 3).alias("total"))


def yearly_sql(source: str, win: str, state: str | None) -> str:
    own = f"AND state_abbr = '{state}'" if state else ""
    b = YWINS.replace("FROM policies", f"FROM {source}")
    return f"""{b}, full_b AS (SELECT min(reinsurance_year) AS lo, max(reinsurance_year) AS hi FROM {source}),
 spine AS (SELECT unnest(generate_series(CASE '{win}' WHEN 'all' THEN lo WHEN 'last_5' THEN greatest(hi-4, lo) WHEN 'last_3' THEN greatest(hi-2, lo) ELSE hi END, hi)) AS reinsurance_year FROM full_b),
 g AS (SELECT reinsurance_year, {SUMS}, sum(total_weight_cwt) AS total_weight_cwt, {W4_MEANS}
  FROM {source}, (SELECT y0, hi FROM ywins WHERE win = '{win}') WHERE {CORE_TYPES} AND reinsurance_year BETWEEN y0 AND hi {own} GROUP BY 1),
 o AS (SELECT CAST(s.reinsurance_year AS INTEGER) AS reinsurance_year, g.* EXCLUDE (reinsurance_year) FROM spine s LEFT JOIN g USING (reinsurance_year))
 SELECT reinsurance_year, {ZERO_COUNTS}, {q("CASE WHEN (SELECT count(*) FROM g) = 0 THEN 0.0 ELSE total_weight_cwt END")} AS total_weight_cwt, {ROUND_MEANS}, {RATIO_SQL} FROM o"""


@query("d8_yearly_summary", f"WITH {POLICIES}, {yearly_sql('policies', 'last_5', None)}")
def _(spark, d):
    return tidy(I.yearly_summary(cube(spark, d), None, "last_5"), "total_weight_cwt")


def _vintages(spark, d):
    """The endorsements as a first vintage and a second, which adds rows and revises some: those of
    line 3 come with it, and those of line 5 had other values before."""
    key = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    final = policies(spark, d, key)
    wrong = final.withColumns({
        "n_head": F.col("n_head") + 7, "coverage_price": F.col("coverage_price") * 2, "state_abbr": F.lit("S01"),
        "reinsurance_year": F.col("reinsurance_year") + 1, "type_code": F.lit("810"),
    })
    line = F.col("l_linenumber")
    buckets = K.buckets_for(table(spark, d, "lineitem").count())
    first = K.keyed(final.filter(~line.isin(3, 5)).unionByName(wrong.filter(line == 5)), key, buckets=buckets)
    second = K.keyed(final.filter(line.isin(3, 5)), key, buckets=buckets)
    path = rendered.at_rest(spark, d, "policy_state", lambda p: K.write_sorted(first, p, buckets, dealt=True))
    return K.read_sorted(spark, first.schema, path, buckets), second


@query("d8_cube_by_deltas", f"WITH {POLICIES}, {yearly_sql('policies', 'last_5', None)}")
def _(spark, d):
    """The cube of the first vintage, revised by the second, gives the summary of the whole."""
    state, second = _vintages(spark, d)
    before = rendered.texts(spark, d, "policy_cube", lambda: I.policy_cube(state))
    after = materialize(I.revised_cube(before, materialize(K.changes(state, second), "changes")), "cube")
    return tidy(I.yearly_summary(after, None, "last_5"), "total_weight_cwt")


@query("c5_year_spine", f"WITH {POLICIES}, {yearly_sql('policies', 'all', STATE)}")
def _(spark, d):
    return tidy(I.yearly_summary(cube(spark, d), STATE, "all"), "total_weight_cwt")


@query("c5_year_spine_empty_slice", f"WITH {POLICIES}, {yearly_sql('policies', 'last_3', 'S99')}")
def _(spark, d):
    return tidy(I.yearly_summary(cube(spark, d), "S99", "last_3"), "total_weight_cwt")


@query("d8_yearly_by_state", f"""WITH {POLICIES}, areas AS (SELECT *, state_abbr AS area FROM policies WHERE state_abbr <> 'XX' UNION ALL SELECT *, 'All' FROM policies),
 yb AS (SELECT min(reinsurance_year) AS lo, max(reinsurance_year) AS hi FROM policies),
 spine AS (SELECT area, y AS reinsurance_year FROM (SELECT DISTINCT area FROM areas), (SELECT CAST(unnest(generate_series(lo, hi)) AS INTEGER) AS y FROM yb)),
 g AS (SELECT area, reinsurance_year, {SUMS}, sum(total_weight_cwt) AS total_weight_cwt, {W4_MEANS} FROM areas WHERE {CORE_TYPES} GROUP BY 1, 2),
 o AS (SELECT * FROM spine LEFT JOIN g USING (area, reinsurance_year))
 SELECT area, reinsurance_year, {ZERO_COUNTS}, {q('total_weight_cwt')} AS total_weight_cwt, {ROUND_MEANS}, {RATIO_SQL} FROM o""")
def _(spark, d):
    return tidy(I.yearly_summary_by_state(cube(spark, d)), "total_weight_cwt")


@query("c6_sums_with_means", f"""WITH {POLICIES} SELECT reinsurance_year, CAST(sum(n_head) AS BIGINT) AS n_head, {q(W4.format(c='coverage_price'))} AS avg_coverage_price
 FROM policies WHERE {CORE_TYPES} GROUP BY 1""")
def _(spark, d):
    out = I.yearly_summary(cube(spark, d)).select("reinsurance_year", "n_head", "avg_coverage_price")
    return rounded(out, "avg_coverage_price")


STATE_G = f"""sg AS (SELECT win, state_abbr, {SUMS}, sum(total_weight_cwt) AS total_weight_cwt FROM policies JOIN ywins ON reinsurance_year BETWEEN y0 AND hi
 WHERE {CORE_TYPES} AND state_abbr <> 'XX' GROUP BY 1, 2)"""


@query("d9_state_summary", f"""WITH {POLICIES}, {YWINS}, {STATE_G} SELECT * EXCLUDE (win, total_weight_cwt), {q('total_weight_cwt')} AS total_weight_cwt, {RATIO3_SQL} FROM sg
 WHERE win = 'last_5' ORDER BY producer_premium_amount DESC, state_abbr""")
def _(spark, d):
    return tidy(I.state_summary(cube(spark, d)), "total_weight_cwt")


@query("c12_state_by_window", f"""WITH {POLICIES}, {YWINS}, {STATE_G} SELECT win AS "window", * EXCLUDE (win, total_weight_cwt), {q('total_weight_cwt')} AS total_weight_cwt, {RATIO3_SQL} FROM sg""")
def _(spark, d):
    return tidy(I.state_summary_by_window(cube(spark, d)), "total_weight_cwt")


@query("d10_county_summary", f"""WITH {POLICIES}, {YWINS} SELECT state_abbr, state_fips, county_fips, lpad(state_fips, 2, '0') || lpad(county_fips, 3, '0') AS fips_5, county_name,
 CAST(sum(n_endorsements_earning) AS BIGINT) AS n_endorsements_earning, CAST(sum(n_endorsements_indemn) AS BIGINT) AS n_endorsements_indemn,
 CAST(coalesce(sum(n_head), 0) AS BIGINT) AS n_head,
 CAST(sum(producer_premium_amount) AS BIGINT) AS producer_premium_amount, CAST(sum(indemnity_amount) AS BIGINT) AS indemnity_amount
 FROM policies, (SELECT y0, hi FROM ywins WHERE win = 'last_5') WHERE {CORE_TYPES} AND reinsurance_year BETWEEN y0 AND hi AND state_abbr = '{STATE}' GROUP BY ALL""")
def _(spark, d):
    return I.county_summary(policies(spark, d), STATE)


def metrics_sql(state: str, year: str) -> str:
    where = f"{CORE_TYPES} AND state_abbr = '{state}'" if state != "All" else CORE_TYPES
    return f"""WITH {POLICIES}, y AS (SELECT {year} AS y FROM policies WHERE {where}),
 g AS (SELECT count(*) AS rows, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in I.COUNTS)}, sum(total_weight_cwt) AS total_weight_cwt, {W4_MEANS} FROM policies WHERE {where} AND reinsurance_year = (SELECT y FROM y))
 SELECT '{state}' AS state_abbr, CAST((SELECT y FROM y) AS INTEGER) AS year, rows, {', '.join(I.COUNTS)}, {q('total_weight_cwt')} AS total_weight_cwt,
 {', '.join(f'{q(m)} AS {m}' for m in I.MEANS)}, {RATIO_SQL} FROM g"""


@query("d11_summary_metrics", metrics_sql(STATE, "max(reinsurance_year)"))
def _(spark, d):
    return tidy(I.summary_metrics(cube(spark, d), STATE), "total_weight_cwt")


@query("d11_summary_metrics_national", metrics_sql("All", "max(reinsurance_year) - 2"))
def _(spark, d):
    c = cube(spark, d)
    year = c.filter("core").agg(F.max(I.YEAR)).scalar() - 2
    return tidy(I.summary_metrics(c, None, year), "total_weight_cwt")


GLANCE = [
    ("Endorsements earning premium", "n", "n_endorsements_earning"), ("Endorsements indemnified", "n", "n_endorsements_indemn"),
    ("Net head insured", "n", "n_head"), ("Total weight (cwt)", "n", "total_weight_cwt"), ("Liability ($)", "m", "liability_amount"),
    ("Producer premium ($)", "m", "producer_premium_amount"), ("Subsidy ($)", "m", "subsidy_amount"), ("Total premium ($)", "m", "total_premium_amount"),
    ("Subsidy share of total premium", "p", "subsidy_amount/total_premium_amount"),
    ("Producer share of total premium", "p", "producer_premium_amount/total_premium_amount"), ("Avg cost per cwt", "d", "avg_cost_per_cwt"),
    ("Avg endorsement length", "w", "avg_endorsement_length_weeks"), ("Avg coverage price ($/cwt)", "d", "avg_coverage_price"),
    ("Avg expected end value ($/cwt)", "d", "avg_expected_end_value"), ("Avg coverage level", "p", "avg_coverage_level_pct"),
    ("Indemnity ($)", "m", "indemnity_amount"), ("Indemnified-endorsement share", "p", "n_endorsements_indemn/n_endorsements_earning"),
    ("Indemnity-to-producer-premium ratio", "x", "indemnity_amount/producer_premium_amount"),
]
AS_TEXT = {
    "n": "format('{{:,}}', CAST(round({e}) AS BIGINT))", "m": "printf('$%.1fM', ({e})/1000000)", "p": "printf('%.1f%%', ({e})*100)",
    "d": "printf('$%.2f', {e})", "w": "printf('%.1f wks', {e})", "x": "printf('%.2f', {e})",
}


@query("d11_glance_text", f"""WITH {POLICIES}, areas AS (SELECT *, state_abbr AS area FROM policies WHERE state_abbr <> 'XX' UNION ALL SELECT *, 'All' FROM policies),
 l AS (SELECT area, max(reinsurance_year) AS latest_year FROM areas GROUP BY 1),
 g AS (SELECT area, latest_year, {SUMS}, sum(total_weight_cwt) AS total_weight_cwt, {W4_MEANS} FROM areas JOIN l USING (area) WHERE reinsurance_year = latest_year AND {CORE_TYPES} GROUP BY 1, 2)
 """ + " UNION ALL ".join(f"SELECT area, latest_year, {i} AS position, '{m}' AS metric, {AS_TEXT[k].format(e=e)} AS value FROM g" for i, (m, k, e) in enumerate(GLANCE, 1)))
def _(spark, d):
    return I.glance_text(I.latest_year_metrics(cube(spark, d))).drop("group")


STATS = f"""count(*) AS n_endorsements, {q('avg(a)')} AS mean_advantage_per_cwt, {q('quantile_cont(a, 0.5)')} AS median_advantage_per_cwt,
 {q('stddev_samp(a)')} AS std_advantage_per_cwt, {q('stddev_samp(a)/sqrt(count(*))')} AS sem_advantage_per_cwt,
 {q('avg(a) - 1.96*(stddev_samp(a)/sqrt(count(*)))')} AS ci95_lower, {q('avg(a) + 1.96*(stddev_samp(a)/sqrt(count(*)))')} AS ci95_upper,
 {q('count(*) FILTER (indemnity_amount > 0)/count(*)')} AS indemnified_share, CAST(coalesce(sum(n_head), 0) AS BIGINT) AS total_head,
 {q('sum(total_weight_cwt)')} AS total_weight_cwt, count(*) < 30 AS suppressed"""
STAT_COLUMNS = (
    "mean_advantage_per_cwt", "median_advantage_per_cwt", "std_advantage_per_cwt", "sem_advantage_per_cwt",
    "ci95_lower", "ci95_upper", "indemnified_share", "total_weight_cwt",
)
BINNED = f"binned AS (SELECT *, CAST({COVERAGE_BIN} AS DOUBLE) AS b FROM adv WHERE {CORE_TYPES})"


@query("d12_by_coverage", f"""WITH {POLICIES}, {ADV.format(src='policies')}, {BINNED} SELECT b AS coverage_level_pct, {STATS} FROM binned WHERE b IS NOT NULL GROUP BY 1""")
def _(spark, d):
    return rounded(I.by_coverage(policies(spark, d)), *STAT_COLUMNS)


@query("d12_by_coverage_state", f"""WITH {POLICIES}, {YWINS}, {ADV.format(src='policies')}, {BINNED} SELECT b AS coverage_level_pct, {STATS} FROM binned,
 (SELECT y0, hi FROM ywins WHERE win = 'last_3') WHERE b IS NOT NULL AND state_abbr = '{STATE}' AND reinsurance_year BETWEEN y0 AND hi GROUP BY 1""")
def _(spark, d):
    return rounded(I.by_coverage(policies(spark, d), STATE, "last_3"), *STAT_COLUMNS)


EVERYWHERE = f"""areas AS (SELECT *, state_abbr AS area FROM binned WHERE state_abbr <> 'XX' UNION ALL SELECT *, 'All' FROM binned),
 ev AS (SELECT win AS "window", area, b AS coverage_level_pct, {STATS} FROM areas JOIN ywins ON reinsurance_year BETWEEN y0 AND hi WHERE b IS NOT NULL GROUP BY 1, 2, 3)"""


@query("c12_backtest_everywhere", f"WITH {POLICIES}, {YWINS}, {ADV.format(src='policies')}, {BINNED}, {EVERYWHERE} SELECT * FROM ev")
def _(spark, d):
    return rounded(I.by_coverage_everywhere(policies(spark, d)), *STAT_COLUMNS)


WITH_HALF = STATS + ", coalesce(1.96*(stddev_samp(a)/sqrt(count(*))), 0.0) AS half"


@query("b23_visible_bins", f"""WITH {POLICIES}, {YWINS}, {ADV.format(src='policies')}, {BINNED}, {EVERYWHERE.replace(STATS, WITH_HALF)} SELECT "window", area, coverage_level_pct, {LABEL.format(c='coverage_level_pct')} AS range_label,
 n_endorsements, {q('half', 3)} AS err_up, {q('half', 3)} AS err_dn FROM ev WHERE NOT suppressed""")
def _(spark, d):
    shown = plan.backtest(policies(spark, d)).select("window", "area", "coverage_level_pct", "range_label", "n_endorsements", "err_up", "err_dn")
    return rounded(shown, "err_up", "err_dn", digits=3)


@query("d13_by_year", f"""WITH {POLICIES}, {ADV.format(src='policies')} SELECT reinsurance_year, count(*) AS n_endorsements, {q('avg(a)')} AS mean_advantage_per_cwt,
 {q('quantile_cont(a, 0.5)')} AS median_advantage_per_cwt, count(*) FILTER (indemnity_amount > 0) AS n_indemnified,
 {q('count(*) FILTER (indemnity_amount > 0)/count(*)')} AS indemnified_share FROM adv WHERE {CORE_TYPES} GROUP BY 1""")
def _(spark, d):
    return rounded(I.by_year(policies(spark, d)), "mean_advantage_per_cwt", "median_advantage_per_cwt", "indemnified_share")


def sample_sql(state: str | None, label: str) -> str:
    own = f"AND state_abbr = '{state}'" if state else ""
    return f"""SELECT count(*) AS n_endorsements, count(*) FILTER (indemnity_amount > 0) AS n_indemnified, coalesce(min(reinsurance_year), 0) AS year_min,
 coalesce(max(reinsurance_year), 0) AS year_max, '{label}' AS state_label, {q('coalesce(count(*) FILTER (indemnity_amount > 0)/nullif(count(*), 0), 0.0)')} AS indemnified_share,
 {q('coalesce(avg(a), 0.0)')} AS mean_advantage_per_cwt FROM adv WHERE {CORE_TYPES} {own}"""


@query("d14_sample_summary", f"""WITH {POLICIES}, {ADV.format(src='policies')} {sample_sql(None, 'National (all states)')} UNION ALL {sample_sql(STATE, STATE)} UNION ALL {sample_sql('S99', 'S99')}""")
def _(spark, d):
    return rounded(I.sample_summaries(policies(spark, d), (None, STATE, "S99")), "indemnified_share", "mean_advantage_per_cwt")


BENCH = f"""{YWINS}, {STATE_G}, ranked AS (SELECT *, row_number() OVER (PARTITION BY win ORDER BY producer_premium_amount DESC, state_abbr) AS rank FROM sg)"""


@query("e5_benchmark_ranks", f"""WITH {POLICIES}, {BENCH} SELECT CAST(rank AS INTEGER) AS rank, state_abbr, producer_premium_amount, {q(RATIOS['indemnified_share'])} AS indemnified_share
 FROM ranked WHERE win = 'last_5' AND (rank <= 10 OR state_abbr IN ('{HOME}', '{STATE}'))""")
def _(spark, d):
    rows = I.benchmark_rows(cube(spark, d), "last_5", STATE, HOME)
    return rounded(rows.select("rank", "state_abbr", "producer_premium_amount", "indemnified_share"), "indemnified_share")


@query("f2_top_ten_text", f"""WITH {POLICIES}, {BENCH} SELECT CAST(rank AS INTEGER) AS rank, state_abbr AS state, format('{{:,}}', n_endorsements_earning) AS endorsements,
 format('{{:,}}', n_head) AS head FROM ranked WHERE win = 'all' AND rank <= 10""")
def _(spark, d):
    rows = I.benchmark_rows(cube(spark, d), "all", "All", "none")
    return I.benchmark_text(rows).select("rank", "state", "endorsements", "head")


@query("g5_states", f"""WITH {POLICIES} SELECT DISTINCT state_abbr FROM policies WHERE state_abbr <> 'XX'""")
def _(spark, d):
    return I.available_states(policies(spark, d), HOME)


@query("g5_years", f"""WITH {POLICIES} SELECT DISTINCT reinsurance_year FROM policies""")
def _(spark, d):
    return I.available_years(policies(spark, d))


@query("d17_load_breakdown", f"""WITH {POLICIES} SELECT reinsurance_year, count(*) AS rows, count(DISTINCT state_abbr) FILTER (state_abbr <> 'XX') AS unique_states,
 count(*) FILTER (state_abbr = 'XX') AS rows_unattributed, count(*) FILTER (state_abbr = '{STATE}') AS rows_watched,
 count(*) FILTER (type_code = '809') AS n_809, count(*) FILTER (type_code = '813') AS n_813 FROM policies GROUP BY 1""")
def _(spark, d):
    out = profile.load_breakdown(policies(spark, d), STATE)
    counts = F.col("type_code_counts")
    return out.withColumns({"n_809": counts["809"], "n_813": counts["813"]}).drop("type_code_counts")


@query("d24_policy_profile", f"""WITH {POLICIES} SELECT count(*) AS rows, count(DISTINCT state_abbr) AS n_states, count(DISTINCT reinsurance_year) AS n_years, min(effective_date) AS effective_min,
 max(effective_date) AS effective_max, min(end_date) AS end_min, max(end_date) AS end_max, {q('min(coverage_price)')} AS coverage_price_min,
 {q('max(coverage_price)')} AS coverage_price_max, count(*) FILTER (indemnity_amount <> 0) AS n_nonzero_indemnity, {q('quantile_cont(coverage_price, 0.5)')} AS coverage_price_median FROM policies""")
def _(spark, d):
    return rounded(profile.policy_profile(policies(spark, d)), "coverage_price_min", "coverage_price_max", "coverage_price_median")


TOP = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM policies WHERE {c} IS NOT NULL GROUP BY 2" for c in ("commodity_code", "type_code", "state_abbr")
)


@query("d24_top_values", f"""WITH {POLICIES}, c AS ({TOP}), k AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM c)
 SELECT "column", value, n, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 5""")
def _(spark, d):
    return profile.top_values(policies(spark, d), ("commodity_code", "type_code", "state_abbr"), 5)


@query("d26_state_and_national", f"""WITH {POLICIES} SELECT state_abbr AS area, CAST(sum(indemnity_amount) AS BIGINT) AS indemnity_amount, count(*) AS rows FROM policies
 WHERE {CORE_TYPES} AND state_abbr <> 'XX' GROUP BY 1 UNION ALL SELECT 'All', CAST(sum(indemnity_amount) AS BIGINT), count(*) FROM policies WHERE {CORE_TYPES}""")
def _(spark, d):
    fanned = cube(spark, d).filter("core").withColumn("area", F.explode(I._areas()))
    return fanned.groupBy("area").agg(F.sum("indemnity_amount").alias("indemnity_amount"), F.sum("rows").alias("rows"))
