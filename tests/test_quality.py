from datetime import date

import pytest
from pyspark.sql import functions as F

from drover import config as C
from drover.operators import profile as P
from drover.operators import quality as Q
from drover.operators import vintage as V
from drover.sources import endorsements


def issues(report):
    return {r.rule_id: r.n_bad for r in report.collect() if r.n_bad}


def test_rules_count_scope_and_sample(spark):
    df = spark.createDataFrame([(1,), (5,), (None,), (9,)], "x int")
    rules = [Q.Rule("big", F.col("x") > 4, sample=F.col("x")), Q.Rule("odd", F.col("x") % 2 == 1, F.col("x") < 6, Q.WARN)]
    assert [tuple(r) for r in Q.run_rules(df, rules).collect()] == [("big", "fail", 2, 4, "5"), ("odd", "warn", 2, 2, None)]
    assert Q.failures(Q.run_rules(df, rules)).count() == 1


def test_policy_rules(spark):
    from tests.test_sources import line

    lines = [line(), line(coverage_price="5"), line(coverage_price="1500", type_code="823"), line(cost_per_cwt="0"), line(length_weeks="14"),
             line(coverage_level_pct="1.2"), line(effective_date="x"), line(end_date="2023-01-01"), line(n_head="-1"), line(commodity_code="0802"), line(plan_code="")]
    df = endorsements.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert issues(Q.run_rules(df, Q.policy_rules())) == {
        "coverage_price_low": 1, "cost_per_cwt_low": 1, "length_weeks_value": 1, "coverage_level_pct_range": 1, "effective_date_missing": 1,
        "end_before_start": 1, "n_head_negative": 1, "commodity_code_filter": 1, "plan_code_filter": 1,
    }


def test_year_coverage(spark):
    have = spark.createDataFrame([(2003,), (2004,), (1999,)], "reinsurance_year int")
    raw = spark.createDataFrame([(2003,), (2005,)], "reinsurance_year int")
    assert issues(Q.check_years(have, raw, 2026)) == {"year_range": 1, "year_missing": 1}


RAW = "commodity string, price_unit string, avg_price string, avg_price_min string, avg_price_max string, head_count string, weight_break_low string, weight_break_high string"


def raw_lot(price="200", low="190", high="210", heads="5", lo="500", hi="549", commodity="Feeder Cattle"):
    return (commodity, "Per Cwt", price, low, high, heads, lo, hi)


def test_lot_values(spark):
    good = [raw_lot()] * 2000
    rows = good + [raw_lot(price="5000", low="1.44"), raw_lot(price="N/A"), raw_lot(commodity="Other", price="1")]
    df = spark.createDataFrame(rows, RAW)
    assert issues(Q.raw_lot_issues(df)) == {"avg_price_bounds": 1, "avg_price_min_bounds": 1}
    assert Q.lot_value_gate(df).first().severity == "warn"  # two issues in 2 002 rows are tolerated
    worse = spark.createDataFrame(rows + [raw_lot(heads="x", lo="500", hi="500")], RAW)
    assert issues(Q.raw_lot_issues(worse)) == {"avg_price_bounds": 1, "avg_price_min_bounds": 1, "head_count_not_numeric": 1, "weight_span": 1}
    assert not Q.failures(Q.lot_value_gate(worse)).isEmpty()
    assert not Q.failures(Q.lot_value_gate(df.filter("commodity = 'Other'"))).isEmpty()


def test_lot_continuity(spark):
    days = lambda *d: spark.createDataFrame([(x,) for x in d], "auction_date date")
    prior = days(date(2026, 1, 7), date(2026, 1, 14), date(2026, 1, 28))
    ok = days(date(2026, 1, 7), date(2026, 1, 14), date(2026, 1, 21), date(2026, 2, 4))
    assert issues(Q.lot_continuity(ok, prior)) == {}
    deep = days(date(2025, 12, 31), date(2026, 1, 14), date(2026, 1, 28))
    assert issues(Q.lot_continuity(deep, prior)) == {"deep_history_date": 1, "vanished_date": 1}


def points(spark, *rows):
    return spark.createDataFrame(list(rows), "year string, period string, value string")


def test_monthly_change_resets_after_gaps(spark):
    df = points(spark, ("2025", "M01", "100"), ("2025", "M02", "104"), ("2025", "M03", "(NA)"), ("2025", "M04", "150"), ("2025", "M05", "oops"),
                ("2025", "M06", "200"), ("2025", "M07", "220"), ("2025", "M13", "1"))
    out = Q.monthly_change(df).orderBy("period").collect()
    assert [r.change for r in out] == [None, pytest.approx(0.04), None, None, None, None, pytest.approx(0.1)]
    assert issues(Q.index_gate(df)) == {"index_not_numeric": 1, "index_monthly_change": 1}


def index(spark, *values, start=1):
    return spark.createDataFrame([(date(2025, start + i, 1), float(v)) for i, v in enumerate(values)], "period date, cpi_u double")


def test_index_continuity(spark):
    prior = index(spark, 100, 101, 102, 103)
    assert issues(Q.index_continuity(index(spark, 100, 101, 102.5, 103.5, 104), prior)) == {}
    assert issues(Q.index_continuity(index(spark, 100, 109, 102, 103), prior)) == {"index_deep_revision": 1}
    assert issues(Q.index_continuity(index(spark, 100, 101, 102, 103, 104, 105), prior)) == {"index_adds_months": 1}
    assert issues(Q.index_continuity(index(spark, 100, 101, 102), prior)) == {"index_ends_earlier": 1}
    assert issues(Q.index_continuity(index(spark, 100, 101, 102, 103), prior.filter("cpi_u <> 101"))) == {"index_new_history": 1}
    assert "index_has_rows" in issues(Q.index_continuity(prior.limit(0), prior))


def test_signatures(spark):
    df = spark.createDataFrame([('{"b":1,"a":{"y":1,"x":2}}',), ('{"a":{"x":9,"y":1},"b":2}',), ('[{"a":1}]',)], "j string")
    out = {r.shape: r.n_rows for r in Q.key_signature(df, "j", "$.a").collect()}
    assert out == {"root:a,b|row:x,y": 2, "root:list": 1}
    found = Q.key_signature(df.filter("j LIKE '{%'"), "j", "$.a")
    baseline = found.first().signature
    assert issues(Q.check_signature(found, baseline)) == {} == issues(Q.check_signature(found, None))
    assert issues(Q.check_signature(found, "0" * 64)) == {"schema_signature": 1}


def test_schema_hash_sees_every_change():
    base = Q.schema_hash(endorsements.DECLARED)
    assert len(base) == 64 and base == Q.schema_hash(list(endorsements.DECLARED))
    swapped = [endorsements.DECLARED[1], endorsements.DECLARED[0], *endorsements.DECLARED[2:]]
    renamed = [(0, "Reinsurance Year", "year", "smallint"), *endorsements.DECLARED[1:]]
    assert len({base, Q.schema_hash(swapped), Q.schema_hash(renamed)}) == 3


def history(spark, n_weeks=45, bulls=True):
    classes = ["Steers"] * 5 + ["Heifers"] * 4 + (["Bulls"] if bulls else [])
    rows = [
        (date(2018, 1, 3).fromordinal(date(2018, 1, 3).toordinal() + 7 * w), "Feeder Cattle", c, "Medium and Large", "1", 5, 190.0, 210.0, 200.0, 100, date(2026, 1, 1))
        for w in range(n_weeks) for c in classes
    ]
    return spark.createDataFrame(rows, "auction_date date, commodity string, class string, frame string, muscle_grade string, head_count int, price_low double, price_high double, price_avg double, receipts int, vintage date")


def test_history_gate(spark):
    floors = {2018: 40}
    assert issues(Q.coverage_gate(history(spark), floors)) == {}
    assert issues(Q.coverage_gate(history(spark, 30), {2018: 40, 2019: 1})) == {"weeks_per_year": 2}
    assert issues(Q.balance_gate(history(spark))) == {}
    assert issues(Q.balance_gate(history(spark, bulls=False))) == {"class_share": 1}
    assert issues(Q.balance_gate(history(spark, bulls=False), warn_only=((2018, "Bulls"),))) == {"class_share_excused": 1}
    bad = history(spark).withColumn("muscle_grade", F.lit("9")).withColumn("price_avg", F.lit(5.0))
    assert {"grade_value", "price_bounds"} <= set(issues(Q.history_gate(bad)))
    assert issues(Q.required_columns(bad.drop("receipts"), Q.HISTORY_COLUMNS)) == {"required_columns": 1}
    assert "not_empty" in issues(Q.history_gate(history(spark).limit(0)))


def medians(spark, *values):
    rows = [(2018, "Steers", 300 + 100 * i, 400 + 100 * i, float(v), 10) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "year int, class string, weight_break_low int, weight_break_high int, price_median double, n_obs long")


@pytest.mark.parametrize("ours, verdict", [([100, 100], "pass"), ([104, 104], "warn"), ([112, 100], "fail"), ([100, 100, 100, 111], "warn"), ([130, 100, 100, 100, 100, 100], "fail"), ([], "skipped")])
def test_consistency(spark, ours, verdict):
    theirs = medians(spark, *([100] * 6))
    cells = Q.consistency_cells(medians(spark, *ours) if ours else theirs.limit(0), theirs)
    assert Q.consistency_summary(cells).first().verdict == verdict
    assert Q.worst_cells(cells).count() == min(3, len(ours))


def test_manifest_upsert_and_order(spark):
    a = V.manifest_entry(spark.range(3), "t", "2026-01")
    b = V.manifest_entry(spark.range(4), "t", "2026-02")
    table = V.upsert_manifest(a.unionByName(b), V.manifest_entry(spark.range(9), "t", "2026-01"))
    assert [(r.vintage, r.rows) for r in table.collect()] == [("2026-01", 9), ("2026-02", 4)]
    assert [(r.vintage, r.n_vintages) for r in V.latest_entries(table).collect()] == [("2026-02", 2)]
    wrong = table.withColumn("position", F.when(F.col("vintage") == "2026-01", 2).otherwise(1))
    assert issues(Q.manifest_gate(wrong)) == {"manifest_last_is_newest": 1}
    assert "not_empty" in issues(Q.manifest_gate(table.limit(0)))


def test_content_hash_ignores_order_only(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "x int, y string")
    sha = lambda d: d.agg(V.content_hash(["x", "y"])).first()[0]
    assert sha(df) == sha(df.orderBy(F.desc("x")).repartition(3))
    assert len({sha(df), sha(df.distinct()), sha(df.filter("x = 1")), sha(df.limit(0))}) == 4


KEYED = "auction_date date, class string, frame string, muscle_grade string, weight_break_low int, weight_break_high int, vintage date, price double"


def keyed(spark, *rows):
    return spark.createDataFrame([(date(2024, 1, 3), "Steers", "ML", "1", low, low, v, p) for low, v, p in rows], KEYED)


def test_latest_vintage_wins(spark):
    old, new = date(2024, 1, 4), date(2024, 1, 11)
    df = keyed(spark, (500, old, 1.0), (500, new, 2.0), (500, new, 3.0), (None, old, 4.0), (None, old, 5.0), (600, old, 6.0))
    assert sorted(r.price for r in V.latest_vintage_wins(df).collect()) == [3.0, 5.0, 6.0]
    assert sorted(r.price for r in V.winning_vintage_rows(df).collect()) == [2.0, 3.0, 4.0, 5.0, 6.0]
    assert V.latest_vintage_wins(df).columns == df.columns


def test_combine(spark):
    old, new = date(2024, 1, 4), date(2024, 1, 11)
    a, b = keyed(spark, (500, new, 1.0)), keyed(spark, (500, old, 2.0), (600, old, 3.0)).withColumn("breed", F.lit("Beef"))
    both = V.combine({"live": a, "legacy": b})
    assert both.label == "combined: live + legacy"
    assert sorted((r.price, r.source, r.breed) for r in both.df.collect()) == [(1.0, "live", None), (3.0, "legacy", "Beef")]
    assert V.combine({"live": a, "legacy": None}).label == "live"
    assert V.combine({"live": None}) is None
    assert V.union_sources({"live": a, "legacy": b}).count() == 3


def test_revisions(spark):
    new = index(spark, 100, 101, 102)
    prior = spark.createDataFrame([(date(2025, 1, 1), 100.0, 2), (date(2025, 2, 1), 100.5, 1)], "period date, cpi_u double, revision_count int")
    out = [r.revision_count for r in V.revision_counts(new, prior).orderBy("period").collect()]
    assert out == [2, 2, 0]
    assert {r.revision_count for r in V.revision_counts(new, None).collect()} == {0}


def test_profiles(spark):
    df = spark.createDataFrame([("2019-05-01", ""), ("", "05/02/2020"), ("05-03-2021T10:00", None), ("2022/05/04 x", None), ("soon", None)], "a string, b string")
    days = df.select(P.report_day(("a", "b")).alias("day"))
    assert [r.day for r in days.collect()] == [date(2019, 5, 1), date(2020, 5, 2), date(2021, 5, 3), date(2022, 5, 4), None]
    probe = P.depth_probe(days).first()
    assert (probe.n_records, probe.n_dated, probe.covered, probe.gap_days, probe.gap_weeks, probe.at_row_cap) == (5, 4, False, 14, 2, False)
    dip = P.volume_dip(days.withColumnRenamed("day", "auction_date"), 2019, (2020, 2023)).first()
    assert (dip.n_year, dip.adjacent_min, dip.adjacent_max) == (1, 0, 1)


def test_lot_issues_need_only_their_fields(spark):
    """Rows came with all fields, each read as text and made a number in every rule before."""
    raw = spark.createDataFrame([(C.FEEDER, C.PER_CWT, "x", "900", "N/A", "-1", "500", "450")], ", ".join(f"{f} string" for f in Q.LOT_ISSUE_FIELDS))
    got = {r.rule_id: r.n_bad for r in Q.raw_lot_issues(raw).collect()}
    assert {k for k, n in got.items() if n} == {"avg_price_not_numeric", "avg_price_min_bounds", "head_count_negative", "weight_span"}
