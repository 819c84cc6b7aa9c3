from datetime import date

import pytest
from pyspark.sql import functions as F

from drover.functions import bins, columns, dates, formats, weighted


@pytest.mark.parametrize("low, avg, label", [
    (400.0, 420.0, "400-499"), (450.0, 480.0, "400-499"), (300.0, 350.0, "300-399"), (800.0, 820.0, "800-899"),
    (None, 520.0, "500-599"), (None, 699.0, "600-699"), (None, None, None), (200.0, 250.0, None),
    (900.0, 950.0, None), (None, float("nan"), None), (350.0, 380.0, "300-399"), (400.0, 520.0, "400-499"),
])
def test_ladder_label(spark, low, avg, label):
    df = spark.createDataFrame([(low, avg)], "low double, avg double")
    assert df.select(bins.ladder_label(bins.bin_floor("low", "avg"))).first()[0] == label


def test_page_label_and_wide_range(spark):
    df = spark.createDataFrame([(300,), (800,), (900,)], "lo int")
    assert [r[0] for r in df.select(bins.page_label("lo")).collect()] == ["300–399 lb", "800–899 lb", None]
    assert [r[0] for r in df.select(bins.in_ladder("lo", 300, 900)).collect()] == [True, True, True]


@pytest.mark.parametrize("level, lower", [
    (0.8807, 0.85), (0.50, None), (None, None), (0.70, 0.70), (0.75, 0.75), (0.7499, 0.70), (0.95, 0.95), (1.0, 1.0), (1.2, 1.0),
])
def test_coverage_bin(spark, level, lower):
    df = spark.createDataFrame([(level,)], "c double")
    assert df.select(bins.coverage_bin("c")).first()[0] == lower


def test_coverage_label(spark):
    df = spark.createDataFrame([(0.70,), (0.95,), (1.0,)], "c double")
    assert [r[0] for r in df.select(bins.coverage_label("c")).collect()] == ["70–75%", "95–100%", "100%"]


def test_weight_rules(spark):
    df = spark.createDataFrame(
        [("a", 180.0, 10), ("a", 200.0, 90), ("b", 100.0, None), ("b", 200.0, 0), ("b", 400.0, -5),
         ("c", 100.0, None), ("c", 200.0, None), ("d", None, 10), ("d", 100.0, 10)],
        "k string, x double, w int",
    )

    def means(rule):
        out = df.groupBy("k").agg(weighted.weighted_mean("x", "w", rule).alias("m")).collect()
        return {r["k"]: r["m"] for r in out}

    floor = means(weighted.ONE_HEAD_FLOOR)
    assert floor["a"] == 198.0 and floor["b"] == pytest.approx(700 / 3)
    missing = means(weighted.ONE_IF_MISSING)
    assert missing["b"] == pytest.approx((100 - 2000) / -4) and missing["c"] == 150.0
    zero = means(weighted.ZERO_IF_MISSING)
    assert zero["c"] == 150.0  # no weight at all: simple mean
    assert zero["d"] == 50.0  # a missing value still counts in the weight


def test_parts_merge_to_the_same_mean(spark):
    df = spark.createDataFrame([(i % 3, float(i), i % 4) for i in range(40)], "k int, x double, w int")
    rule = weighted.ZERO_IF_MISSING
    direct = df.agg(weighted.weighted_mean("x", "w", rule)).first()[0]
    cells = df.groupBy("k").agg(*weighted.parts("x", "w", rule, "p"))
    merged = cells.agg(*weighted.merge_parts("p")).select(weighted.from_parts("p", rule)).first()[0]
    assert merged == pytest.approx(direct)


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0), (3.0, -1.0)], "n double, d double")
    assert [r[0] for r in df.select(columns.safe_ratio("n", "d")).collect()] == [0.5, 0.0, 0.0, 0.0, -3.0]
    assert [r[0] for r in df.select(columns.positive_ratio("n", "d")).collect()] == [0.5, 0.0, 0.0, 0.0, 0.0]


def test_coercion(spark):
    df = spark.createDataFrame([(" .018060 ",), ("x",), ("",), ("NaN",), ("300.0",), (None,)], "t string")
    assert [r[0] for r in df.select(columns.number("t")).collect()] == [0.01806, None, None, None, 300.0, None]
    assert [r[0] for r in df.select(columns.integer("t")).collect()] == [0, None, None, None, 300, None]
    markers = spark.createDataFrame([("",), ("-",), (" (NA) ",), ("N/A",), ("(X)",), ("NA",), (" 1 ",)], "t string")
    assert [r[0] for r in markers.select(columns.marker_to_null("t")).collect()] == [None] * 6 + ["1"]


def test_clean_doubles(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, None)], "x double, y int")
    assert [tuple(r) for r in columns.clean_doubles(df).collect()] == [(None, 1), (2.0, None)]


def test_iso_week_folds_53(spark):
    df = spark.createDataFrame([(date(2020, 12, 31),), (date(2021, 1, 4),), (date(2019, 12, 30),)], "d date")
    assert [r[0] for r in df.select(dates.iso_week("d")).collect()] == [52, 1, 1]


def test_date_windows(spark):
    df = spark.createDataFrame([(date(2019, 2, 28),), (date(2019, 2, 27),), (date(2021, 3, 1),), (date(2024, 1, 1),)], "d date")
    anchor = F.lit(date(2024, 2, 29))
    got = [r[0] for r in df.select(dates.windows_of("d", anchor, ("all", "5y", "3y", "latest"))).collect()]
    assert got == [["all", "5y"], ["all"], ["all", "5y", "3y"], ["all", "5y", "3y", "latest"]]


def test_county_id(spark):
    df = spark.createDataFrame([("4", "7"), ("35", "009")], "s string, c string")
    assert [r[0] for r in df.select(columns.county_id("s", "c")).collect()] == ["04007", "35009"]


def test_formats(spark):
    df = spark.createDataFrame([(1234567.0, 0.1234), (None, None)], "m double, p double")
    out = df.select(formats.millions("m"), formats.whole("m"), formats.percent("p"), formats.dollars("m"), formats.decimals("p"), formats.weeks("p"))
    assert [tuple(r) for r in out.collect()] == [("$1.2M", "1,234,567", "12.3%", "$1,234,567.00", "0.12", "0.1 wks"), ("—",) * 6]
