from functools import reduce

import pytest
from pyspark.sql import functions as F

from drover.operators import insurance as I
from drover.session import materialize

SCHEMA = (
    "reinsurance_year int, state_abbr string, type_code string, coverage_level_pct double, n_head int, total_weight_cwt double, "
    "producer_premium_amount long, indemnity_amount long, n_endorsements_earning long, n_endorsements_indemn long, "
    "liability_amount long, subsidy_amount long, total_premium_amount long, length_weeks int, coverage_price double, "
    "expected_end_value double, cost_per_cwt double, state_fips string, county_fips string, county_name string"
)


def policy(year=2024, state="AZ", kind="809", level=0.95, head=50, weight=100.0, premium=1500, indemnity=1500, price=250.0, county="1"):
    paid = 1 if indemnity > 0 else 0
    return (year, state, kind, level, head, weight, premium, indemnity, 1, paid, 10000, 500, premium + 500, 13, price, None if price is None else price + 5, 4.0, "4", county, "c" + str(county) if county else None)


CORPUS = [
    policy(2020, kind="809", level=0.95, weight=100.0, premium=1500, indemnity=0),
    policy(2024, kind="810", level=0.95, weight=200.0, premium=2000, indemnity=4000),
    policy(2024, kind="811", level=0.90, weight=150.0),
    policy(2024, kind="812", level=0.80, weight=100.0, premium=1000, indemnity=0),
    policy(2024, state="TX", kind="809", level=0.95),
    policy(2024, kind="823", level=0.95, premium=100, indemnity=9000),
    policy(2024, kind="809", level=0.95, weight=0.0),
]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(CORPUS, SCHEMA).cache()


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_advantage(spark):
    df = frame(spark, [policy(weight=100.0, premium=1500, indemnity=3000), policy(weight=150.0), policy(weight=0.0), policy(weight=None)])
    assert sorted(r.advantage_per_cwt for r in I.with_advantage(df).collect()) == [0.0, 15.0]


def test_bins_of_a_state(corpus):
    bins = {r.coverage_level_pct: r for r in I.by_coverage(corpus, "AZ").collect()}
    assert set(bins) == {0.80, 0.90, 0.95}
    top = bins[0.95]
    assert (top.n_endorsements, top.mean_advantage_per_cwt, top.total_weight_cwt, top.indemnified_share) == (2, -2.5, 300.0, 0.5)
    assert top.median_advantage_per_cwt == -2.5 and top.suppressed
    one = I.by_coverage(corpus, "TX").collect()
    assert [(r.coverage_level_pct, r.n_endorsements, r.std_advantage_per_cwt, r.ci95_lower) for r in one] == [(0.95, 1, None, None)]


def test_low_and_missing_levels_are_dropped(spark):
    df = frame(spark, [policy(level=0.8807), policy(level=0.50), policy(level=None)])
    assert [(r.coverage_level_pct, r.n_endorsements) for r in I.by_coverage(df).collect()] == [(0.85, 1)]


def test_by_year(corpus):
    out = {r.reinsurance_year: r for r in I.by_year(corpus, "AZ").collect()}
    assert {y: r.n_endorsements for y, r in out.items()} == {2020: 1, 2024: 3}
    assert out[2024].median_advantage_per_cwt == 0.0


def test_sample_summary(corpus):
    az = I.sample_summary(corpus, "AZ").first()
    assert (az.n_endorsements, az.year_min, az.year_max, az.state_label) == (4, 2020, 2024, "AZ")
    none = I.sample_summary(corpus, "ZZ").first()
    assert (none.n_endorsements, none.mean_advantage_per_cwt, none.indemnified_share, none.year_min) == (0, 0.0, 0.0, 0)


@pytest.mark.parametrize("n, hidden", [(29, True), (30, False)])
def test_suppression(spark, n, hidden):
    out = I.by_coverage(frame(spark, [policy()] * n)).first()
    assert out.suppressed is hidden
    assert I.visible_bins(I.by_coverage(frame(spark, [policy()] * n))).count() == (0 if hidden else 1)


def test_national_includes_unattributed(spark):
    df = frame(spark, [policy()] * 30 + [policy(state="XX")] * 30)
    for state, n in ((None, 60), ("All", 60), ("AZ", 30)):
        assert I.by_coverage(df, state).first().n_endorsements == n
    assert I.backtest_subset(df, None, include_unattributed=False).count() == 30


def test_interval_is_symmetric(spark):
    df = frame(spark, [policy(indemnity=1500 + 10 * i) for i in range(30)])
    r = I.by_coverage(df).first()
    half = 1.96 * r.sem_advantage_per_cwt
    assert r.ci95_upper - r.mean_advantage_per_cwt == pytest.approx(half)
    assert r.mean_advantage_per_cwt - r.ci95_lower == pytest.approx(half)
    assert r.std_advantage_per_cwt == pytest.approx(0.1 * (sum((i - 14.5) ** 2 for i in range(30)) / 29) ** 0.5)


@pytest.mark.parametrize("window, years", [
    ("latest", {2026}), ("last_3", {2024, 2025, 2026}), ("last_5", {2022, 2023, 2024, 2025, 2026}), ("all", set(range(2018, 2027))),
])
def test_year_windows(spark, window, years):
    df = frame(spark, [policy(y) for y in range(2018, 2027)])
    assert {r.reinsurance_year for r in I.apply_year_window(df, window).collect()} == years


def test_unknown_window(spark):
    with pytest.raises(ValueError):
        I.apply_year_window(frame(spark, [policy()]), "decade")


def test_window_bounds_ignore_the_state(spark):
    df = frame(spark, [policy(2026, state="TX"), policy(2018), policy(2024), policy(2030, kind="823")])
    assert {r.reinsurance_year for r in I.backtest_subset(df, "AZ", "last_3").collect()} == {2024}


def test_states(spark):
    df = frame(spark, [policy(state=s) for s in ("TX", "XX", "AZ", "CO", None)])
    assert [r[0] for r in I.available_states(df).collect()] == ["AZ", "CO", "TX"]
    assert [r[0] for r in I.available_years(df).collect()] == [2024]


def test_yearly_summary_pads(spark):
    df = frame(spark, [policy(2020), policy(2022, state="TX"), policy(2023, kind="823", state="TX")])
    cube = I.policy_cube(df)
    az = I.yearly_summary(cube, "AZ").orderBy("reinsurance_year").collect()
    assert [r.reinsurance_year for r in az] == [2020, 2021, 2022, 2023]
    assert [r.n_head for r in az] == [50, 0, 0, 0]
    assert [r.total_weight_cwt for r in az] == [100.0, None, None, None]
    assert az[1].avg_coverage_price == 0.0 and az[0].avg_coverage_price == 250.0
    empty = I.yearly_summary(cube, "ZZ").collect()
    assert len(empty) == 4 and {r.total_weight_cwt for r in empty} == {0.0}


def test_weighted_means_count_missing_values_as_zero(spark):
    df = frame(spark, [policy(price=100.0, head=10), policy(price=None, head=10)])
    assert I.yearly_summary(I.policy_cube(df)).first().avg_coverage_price == 50.0
    none = frame(spark, [policy(price=100.0, head=None), policy(price=200.0, head=0)])
    assert I.yearly_summary(I.policy_cube(none)).first().avg_coverage_price == 150.0


def test_states_plus_unattributed_equal_nation(spark):
    rows = [policy(2020 + i % 4, state=("AZ", "TX", "XX")[i % 3], premium=100 * i) for i in range(40)]
    cube = I.policy_cube(frame(spark, rows))
    by_state = I.yearly_summary_by_state(cube).groupBy("area").agg(F.sum("producer_premium_amount").alias("p"))
    totals = {r.area: r.p for r in by_state.collect()}
    unattributed = sum(100 * i for i in range(40) if i % 3 == 2)
    assert totals["All"] == totals["AZ"] + totals["TX"] + unattributed


def test_state_and_county_summaries(spark):
    df = frame(spark, [policy(2024, county="1"), policy(2024, county="1"), policy(2024, county=None), policy(2010), policy(2024, state="XX"), policy(2024, state="TX", premium=9000)])
    out = I.state_summary(I.policy_cube(df)).collect()
    assert [(r.state_abbr, r.producer_premium_amount) for r in out] == [("TX", 9000), ("AZ", 4500)]
    counties = I.county_summary(df, "AZ").collect()
    assert [(r.fips_5, r.county_name, r.producer_premium_amount) for r in counties] == [("04001", "c1", 3000), (None, None, 1500)]


def test_summary_metrics(corpus):
    cube = I.policy_cube(corpus)
    m = I.summary_metrics(cube, "AZ").first()
    assert (m.year, m.rows, m.n_endorsements_earning) == (2024, 4, 4)
    none = I.summary_metrics(cube, "AZ", 1999).first()
    assert (none.rows, none.n_head) == (0, None)


def test_benchmark_keeps_home_and_selected(spark):
    states = [f"S{i:02d}" for i in range(12)] + ["AZ"]
    df = frame(spark, [policy(state=s, premium=10000 - 100 * i) for i, s in enumerate(states)])
    out = {r.state_abbr: r["rank"] for r in I.benchmark_rows(I.policy_cube(df), "all", "S11").collect()}
    assert len(out) == 12 and out["AZ"] == 13 and out["S11"] == 12 and "S10" not in out
    text = I.benchmark_text(I.benchmark_rows(I.policy_cube(df), "all", "S11")).filter("rank = 1").first()
    assert text.producer_premium == "$0.0M" and text.indemnified_share == "100.0%"


def test_everywhere_equals_single_slices(spark):
    rows = [policy(2015 + i % 10, state=("AZ", "TX", "XX")[i % 3], level=0.7 + (i % 7) * 0.05, indemnity=(i * 37) % 3000) for i in range(120)]
    df = materialize(frame(spark, rows), "everywhere-test")
    everywhere = I.by_coverage_everywhere(df).cache()
    assert {r.area for r in everywhere.select("area").distinct().collect()} == {"AZ", "TX", "All"}
    for area, window in (("AZ", "last_5"), ("All", "all"), ("TX", "latest")):
        single = I.by_coverage(df, None if area == "All" else area, window)
        same = everywhere.filter((F.col("area") == area) & (F.col("window") == window)).drop("area", "window")
        tidy = lambda d: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in d.collect())
        assert tidy(single) == tidy(same)


def test_glance_lines(corpus):
    lines = I.glance_text(I.latest_year_metrics(I.policy_cube(corpus)))
    assert lines.filter("area = 'AZ'").count() == 18
    assert lines.filter("area = 'AZ' AND position = 1").first().value == "4"


def test_union_of_reports_helper(corpus):
    parts = [I.sample_summary(corpus, s) for s in (None, "AZ")]
    assert reduce(lambda a, b: a.unionByName(b), parts).count() == 2
