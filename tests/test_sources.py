import gzip
import json
import random
import zipfile
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from drover.operators import quality as Q
from drover.plans import insurance as insurance_plan
from drover.plans import weekly as weekly_plan
from drover.sources import endorsements, index_json, long_reports, lots_json, reports, sheets, tables, volumes

SLAUGHTER = dict(
    commodity="Slaughter Cattle", price_unit="Per Cwt", **{"class": "Cows"}, quality_grade_name="Boner 80-85%", dressing="Average",
    lot_desc="None", report_date="04/22/2026", avg_weight=1180, avg_weight_min=965, avg_weight_max=1870, head_count=13,
    avg_price=167.6, avg_price_min=161, avg_price_max=171, receipts=81,
)
FEEDER = dict(
    commodity="Feeder Cattle", price_unit="Per Cwt", **{"class": "Steers"}, frame="Medium and Large", muscle_grade="1", report_date="04/22/2026",
    weight_break_low=500, weight_break_high=549, avg_weight=525, head_count=50, avg_price="200.5", avg_price_min=None, avg_price_max=210, receipts=81,
)


def raw(spark, *payloads):
    return lots_json.raw_rows(spark.createDataFrame([(json.dumps(p),) for p in payloads], "value string"))


def test_slaughter_filters(spark):
    rows = [
        SLAUGHTER, {**SLAUGHTER, "class": "Bulls"}, {**SLAUGHTER, "class": "Dairy Cows"}, {**SLAUGHTER, "class": "Steers"},
        {**SLAUGHTER, "price_unit": "Per Head"}, {**SLAUGHTER, "commodity": "Replacement Cattle"}, {**SLAUGHTER, "avg_price": 19.9},
        {**SLAUGHTER, "avg_price": 800.1}, {**SLAUGHTER, "avg_price": "n/a"}, {**SLAUGHTER, "avg_price": None}, {**SLAUGHTER, "report_date": "bad"}, FEEDER,
    ]
    out = lots_json.slaughter_lots(raw(spark, {"results": rows}), "2026-04-23")
    assert sorted(r["class"] for r in out.collect()) == ["Bulls", "Cows", "Dairy Cows"]
    cow = out.filter(F.col("class") == "Cows").first()
    assert (cow.auction_date, cow.avg_weight, cow.head_count, cow.price_low, cow.price_avg, cow.price_high) == (date(2026, 4, 22), 1180.0, 13, 161.0, 167.6, 171.0)
    assert out.columns == ["auction_date", "commodity", "class", "quality_grade_name", "dressing", "lot_desc", "avg_weight", "avg_weight_min",
                           "avg_weight_max", "head_count", "price_low", "price_high", "price_avg", "receipts", "vintage"]


@pytest.mark.parametrize("payload", [{"results": []}, {}, {"results": [FEEDER]}, [], [FEEDER]])
def test_no_slaughter_rows(spark, payload):
    assert lots_json.slaughter_lots(raw(spark, payload), "2026-04-23").count() == 0


def test_feeder_from_list_and_envelope(spark):
    rows = raw(spark, {"results": [FEEDER, SLAUGHTER]}, [{**FEEDER, "weight_break_low": None}])
    out = lots_json.feeder_lots(rows, "2026-04-23").orderBy(F.asc_nulls_last("weight_break_low")).collect()
    assert [(r.weight_break_low, r.price_low, r.price_avg, r.vintage) for r in out] == [(500, None, 200.5, date(2026, 4, 23)), (None, None, 200.5, date(2026, 4, 23))]


def test_lot_files_and_gated_refresh(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    days = [f"{m:02d}/0{d}/2026" for m in (1, 2, 3) for d in (3, 7)]
    (folder / "a.json").write_text(json.dumps({"results": [{**FEEDER, "report_date": d} for d in days]}))
    (folder / "b.json").write_text(json.dumps([{**SLAUGHTER, "report_date": days[-1]}]))
    root = str(tmp_path / "out")
    rows = lots_json.read_raw_rows(spark, str(folder))
    assert weekly_plan.refresh_lots(spark, rows, None, root, "2026-03-08") == {"lots": True, "lots_slaughter": True}
    first = tables.read_latest(spark, root, "lots")
    assert first.count() == 6
    bad = [{**FEEDER, "avg_price": 9999.0}] + [{**FEEDER, "report_date": d} for d in days]
    again = weekly_plan.refresh_lots(spark, raw(spark, {"results": bad}), first, root, "2026-03-15")
    assert again == {"lots": False, "lots_slaughter": False}
    assert tables.read_latest(spark, root, "lots").first().vintage == date(2026, 3, 8)
    deep = [{**FEEDER, "report_date": "01/15/2020"}] + [{**FEEDER, "report_date": d} for d in days]
    assert not weekly_plan.refresh_lots(spark, raw(spark, deep), first, root, "2026-03-15", feeder_only=True)["lots"]


def body(*points):
    return {"Results": {"series": [{"data": [dict(zip(("year", "period", "value"), p)) for p in points]}]}}


def test_index_bodies(spark):
    payload = [body(("2025", "M01", "100.0"), ("2025", "M02", "101.0"), ("2025", "M13", "9.0")), body(("2025", "M02", "102.5"), ("2025", "S01", "1"), ("2025", "M03", "-"))]
    df = spark.createDataFrame([(json.dumps(payload),)], "value string")
    out = index_json.index_table(index_json.raw_points(df), "2025-04-01").orderBy("period").collect()
    assert [(r.period, r.cpi_u, r.revision_count) for r in out] == [(date(2025, 1, 1), 100.0, 0), (date(2025, 2, 1), 102.5, 0)]
    single = spark.createDataFrame([(json.dumps(body(("2025", "M01", "100.0"))),)], "value string")
    assert index_json.index_table(index_json.raw_points(single), "2025-04-01").count() == 1


def test_newest_index_file(spark, tmp_path):
    (tmp_path / "idx_2025-03.json").write_text(json.dumps(body(("2025", "M01", "1.0"))))
    (tmp_path / "idx_2025-04.json").write_text(json.dumps(body(("2025", "M01", "2.0"))))
    assert [r.value for r in index_json.read_latest_points(spark, str(tmp_path)).collect()] == ["2.0"]


def line(**over):
    values = dict(
        reinsurance_year="2024", commodity_year="2024", state_fips="04", state_abbr="AZ", county_fips="001", county_name="Apache     ",
        commodity_code="0801", commodity_name="Feeder Cattle", plan_code="81", plan_name="LRP", type_code="809", type_name='Steers "1"',
        practice_code="1", practice_name="x", effective_date="2024-01-05", length_weeks="13", coverage_price="250.5", expected_end_value="255",
        coverage_level_pct=".9800", rate=".018060", cost_per_cwt="4.5", end_date="2024-04-05", n_endorsements_earning="1", n_endorsements_indemn="0",
        n_head="50", total_weight_cwt="300", subsidy_amount="500", total_premium_amount="1500", producer_premium_amount="1000",
        liability_amount="70000", indemnity_amount="-5",
    )
    values.update(over)
    return "|".join(values.values())


def test_endorsement_lines(spark):
    df = spark.createDataFrame([(line(),), (line(n_head="", effective_date="2024-13-01", rate="x", county_name=""),)], "value string")
    a, b = endorsements.parse_lines(df).collect()
    assert (a.state_fips, a.county_name, a.type_name, a.rate, a.indemnity_amount, a.effective_date) == ("04", "Apache", 'Steers "1"', 0.01806, -5, date(2024, 1, 5))
    assert (b.n_head, b.effective_date, b.rate, b.county_name) == (None, None, None, None)
    assert len(a) == 31


def test_wrong_width_fails(spark):
    with pytest.raises(PySparkException, match="expected 31 fields"):
        endorsements.parse_lines(spark.createDataFrame([("a|b",)], "value string")).collect()


def zip_of(path, name, *lines):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(name, "\r\n".join(lines) + "\r\n")


def test_zip_corpus_and_refresh(spark, tmp_path):
    for year in (2023, 2024):
        rows = [line(reinsurance_year=str(year), length_weeks=w) for w in ("13", "17")] + [line(commodity_code="0802")]
        zip_of(tmp_path / f"lrp_{year}_2026-04-27.zip", f"lrp_{year}.txt", *rows)
    zip_of(tmp_path / "lrp_2024_2025-01-01.zip", "old.txt", line())
    zip_of(tmp_path / "other.zip", "other.txt", line())
    lines = endorsements.zipped_lines(spark, str(tmp_path), batch=2)
    assert lines.count() == 8
    corpus = endorsements.corpus(lines, "2026-04-27")
    assert sorted((r.file_year, r["count"]) for r in corpus.groupBy("file_year").count().collect()) == [(2023, 2), (2024, 2)]
    root = str(tmp_path / "out")
    assert insurance_plan.refresh(lines, root, "2026-04-27", 2026)
    assert tables.read_latest(spark, root, "endorsements").count() == 4
    out = insurance_plan.summaries(tables.read_latest(spark, root, "endorsements"))
    assert out["states"].count() == 4 and insurance_plan.backtest(corpus).count() == 0


def test_zip_with_two_members_fails(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "lrp_2024_2026-04-27.zip", "w") as z:
        z.writestr("a.txt", "x")
        z.writestr("b.txt", "y")
    with pytest.raises(PySparkException, match="expected one member"):
        endorsements.zipped_lines(spark, str(tmp_path)).collect()


def test_text_files(spark, tmp_path):
    (tmp_path / "lrp_2024_2026-04-27.txt").write_text(line() + "\n" + line() + "\n")
    assert endorsements.corpus(endorsements.text_lines(spark, str(tmp_path)), "2026-04-27").count() == 2
    a = endorsements.read_corpus(spark, str(tmp_path), "2026-04-27").drop("file_year", "vintage").collect()
    b = endorsements.corpus(endorsements.text_lines(spark, str(tmp_path)), "2026-04-27").drop("file_year", "vintage").collect()
    assert [r.asDict() for r in a] == [r.asDict() for r in b] and a[0].type_name == 'Steers "1"'


@pytest.mark.parametrize("text", ["a|b", line() + "|extra"])
def test_text_file_of_wrong_width_fails(spark, tmp_path, text):
    (tmp_path / "lrp_2024_2026-04-27.txt").write_text(text + "\n")
    with pytest.raises(PySparkException, match="expected 31 fields"):
        endorsements.read_corpus(spark, str(tmp_path), "2026-04-27").collect()


def test_settle_sheet(spark):
    wide = spark.createDataFrame(
        [(date(2024, 5, 1), "250.5", 29.0), (date(2024, 5, 2), None, 601.0), (None, "1", 300.0), (date(2024, 5, 3), "x", 300.0)],
        "date date, MAY string, NEARBY double",
    )
    long = sheets.settles_long(wide, ("MAY", "NEARBY"))
    assert sheets.plausible_settles(long).count() == 2 and sheets.rejected_settles(long).count() == 2


def test_second_opinion_sheet(spark):
    names = list(sheets.second_opinion_columns())
    assert len(names) == 13
    wide = spark.createDataFrame([tuple(["2024-05-01"] + [None] * 12 + [210.0]), tuple(["bad"] + [1.0] * 13)], ["date"] + names)
    assert [tuple(r) for r in sheets.second_opinion_long(wide).collect()] == [(date(2024, 5, 1), "Heifers", 800, 900, 210.0)]


REPORT = """Weekly Summary
Feeder Cattle Weighted Average Report for 01/24/2018
Receipts:  2,595       Last Week:  4278

 12  300-345  320  150.00-160.00  155.00
  Feeder Steers Medium and Large 1
 Head   Wt Range   Avg Wt    Price Range   Avg Price
   5    300-345     322    210.00-223.00     216.24   Calves
  10     405        405       195.50         195.50
   7   450.5-455    452    190.00-191.00     190.50 Value Enhanced

   3    500-545     520    170.00-171.00     170.50
  Feeder Holstein Steers Large 3

   4    700-745     720    100.00-101.00     100.50
  demand light
   4    700-745     720    100.00-101.00     100.50
  Feeder Heifers Medium and Large 1-2
   6    600-645     620    140.00-141.00     140.50
  Feeder Bulls Medium and Large 2
   1    900         900    90.00             90.00Thin
Slaughter Cows:
  Feeder Bulls Medium and Large 1
   9    500-545     520    170.00-171.00     170.50
"""


def parsed(spark, text, name="x.txt"):
    df = spark.createDataFrame([(text, name)], "value string, file_name string")
    return reports.parse_reports(df, "2026-01-01", file_name="file_name")


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_report(spark, newline):
    out = parsed(spark, REPORT.replace("\n", newline)).collect()
    got = [(r["class"], r.frame, r.muscle_grade, r.breed, r.weight_break_low, r.weight_break_high, r.head_count, r.price_low, r.price_high, r.price_avg, r.annotation) for r in out]
    ml = "Medium and Large"
    assert got == [
        ("Steers", ml, "1", "Beef", 300, 345, 5, 210.0, 223.0, 216.24, "Calves"),
        ("Steers", ml, "1", "Beef", 405, 405, 10, 195.5, 195.5, 195.5, ""),
        ("Steers", ml, "1", "Beef", 450, 455, 7, 190.0, 191.0, 190.5, "Value Enhanced"),
        ("Steers", "Large", "3", "Holstein", 700, 745, 4, 100.0, 101.0, 100.5, ""),
        ("Heifers", ml, "1-2", "Beef", 600, 645, 6, 140.0, 141.0, 140.5, ""),
        ("Bulls", ml, "2", "Beef", 900, 900, 1, 90.0, 90.0, 90.0, "Thin"),
    ]
    assert {(r.auction_date, r.receipts) for r in out} == {(date(2018, 1, 24), 2595)}


def test_report_dates(spark):
    two_digit = parsed(spark, REPORT.replace("Report for 01/24/2018", "for 1/27/10"))
    assert two_digit.first().auction_date == date(2010, 1, 27)
    undated = REPORT.replace("Feeder Cattle Weighted Average Report for 01/24/2018", "")
    assert parsed(spark, undated, "cv_ls75020180118.txt").first().auction_date == date(2018, 1, 18)
    with pytest.raises(PySparkException, match="no sale date"):
        parsed(spark, undated).collect()


def test_report_files(spark, tmp_path):
    (tmp_path / "CV_LS75020180124.TXT").write_text(REPORT)
    (tmp_path / "CV_LS75020180131.TXT").write_text(REPORT.replace("01/24/2018", "01/31/2018"))
    out = reports.read_reports(spark, str(tmp_path), "2026-01-01")
    assert sorted((r.file_name, r["count"]) for r in out.groupBy("file_name").count().collect()) == [("CV_LS75020180124.TXT", 6), ("CV_LS75020180131.TXT", 6)]


def test_optional_readers(spark, tmp_path):
    assert tables.read_optional(spark, str(tmp_path / "none")) is None
    assert tables.read_any(spark, str(tmp_path / "none")) is None
    spark.createDataFrame([(1, float("nan"))], "a int, b double").coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    assert [tuple(r) for r in tables.read_any(spark, str(tmp_path / "t")).collect()] == [(1, None)]
    (tmp_path / "u.csv").write_text("a,b\n1,2.5\n")
    assert [tuple(r) for r in tables.read_any(spark, str(tmp_path / "u"), "a int, b double").collect()] == [(1, 2.5)]


def test_frozen_dataset(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.write_vintage(spark.range(1), str(tmp_path), "cpi_release", "2026-01-01")


def test_vintages_are_independent(spark, tmp_path):
    root = str(tmp_path)
    passed = Q.run_rules(spark.range(1), [Q.Rule("fine", F.lit(False))])
    failed = Q.run_rules(spark.range(1), [Q.Rule("broken", F.lit(True))])
    assert tables.publish(spark.range(3), root, "t", "2026-01-01", passed)
    assert tables.publish(spark.range(5), root, "t", "2026-02-01", passed)
    assert not tables.publish(spark.range(9), root, "t", "2026-03-01", failed)
    assert tables.read_latest(spark, root, "t").count() == 5
    assert tables.publish(spark.range(4), root, "t", "2026-02-01", failed, allow_fail=True)
    assert tables.read_latest(spark, root, "t").count() == 4
    manifest = [(r.vintage, r.rows) for r in tables.read_manifest(spark, root).collect()]
    assert manifest == [("2026-01-01", 3), ("2026-02-01", 4)]
    assert Q.failures(Q.manifest_gate(tables.read_manifest(spark, root))).isEmpty()
    tables.point_latest(spark, root, "t", "2026-01-01")
    assert tables.read_latest(spark, root, "t").count() == 3


# ---- large files read by several tasks -----------------------------------------------


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes, so that small files are read by many tasks."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    yield lambda size: [spark.conf.set(n, str(v)) for n, v in zip(names, (size, 0), strict=True)]
    for n, v in zip(names, before, strict=True):
        spark.conf.set(n, v)


ODD_TEXTS = ["a", "},", 'x},{"y', "\\", '\\"},', "{}", "},},}", "é\n", "", '},"', '{"a":1},{', None, 5, 1.5]


@pytest.mark.parametrize("size", [400, 3000, 1 << 27])
def test_one_envelope_is_read_by_several_tasks(spark, tmp_path, small_splits, size):
    rng = random.Random(size)
    want = []
    for i in range(6):
        rows = [{f: rng.choice(ODD_TEXTS) for f in rng.sample(lots_json.RAW_FIELDS, rng.randint(1, 6))} for _ in range(rng.choice([0, 1, 40, 150]))]
        want += rows
        body = rows if i % 2 else {"stats": {"n": 1}, "a": [1, 2], "note": "x},{", "results": rows, "tail": {"z": "},"}}
        marks = [(",", ":"), (", ", ": "), (" ,", " :")][i % 3]
        (tmp_path / f"{i}.json").write_text(json.dumps(body, indent=[None, 2][i % 2], ensure_ascii=False, separators=marks), encoding="utf-8")
    small_splits(size)
    got = [tuple(r) for r in lots_json.read_split_rows(spark, str(tmp_path)).collect()]
    shown = [tuple(None if r.get(f) is None else str(r[f]) for f in lots_json.RAW_FIELDS) for r in want if any(v is not None for v in r.values())]
    assert sorted(got, key=repr) == sorted(shown, key=repr)
    if size < 10_000:
        assert lots_json.pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 6


def in_volumes(rng, folder, name, text, extension):
    """One text cut at line ends into compressed volumes, numbered past 999."""
    lines = [f"{line}\n" for line in text.split("\n")[:-1]]
    ends = sorted({0, len(lines), *(rng.randint(0, len(lines)) for _ in range(9))})
    for i, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
        (folder / f"{name}.c{996 + i}.{extension}.gz").write_bytes(gzip.compress("".join(lines[a:b]).encode()))


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("size", [400, 1 << 27])
def test_one_envelope_in_volumes_is_read_by_several_tasks(spark, tmp_path, small_splits, size, indent):
    """A compressed file could not be split before, and a record cut by the end of a file was lost."""
    rng = random.Random(size)
    want = []
    for i in range(4):
        rows = [{f: rng.choice(ODD_TEXTS) for f in rng.sample(lots_json.RAW_FIELDS, rng.randint(1, 6))} for _ in range(rng.choice([1, 40, 150]))]
        want += rows
        if indent:
            body = rows if i % 2 else {"note": "x},{", "results": rows, "tail": {"z": "},"}}
            text = json.dumps(body, indent=indent, ensure_ascii=False)
        else:  # a line ends after every record, or within it
            shown = [json.dumps(r, ensure_ascii=False, separators=(",", ":")) for r in rows]
            text = '{"note":"x},{","results":[' + rng.choice([",\n".join(shown), ",".join("{\n" + t[1:] for t in shown)]) + ']}'
        in_volumes(rng, tmp_path, f"{i}", text + "\n", "json")
    small_splits(size)
    got = [tuple(r) for r in lots_json.read_split_rows(spark, str(tmp_path), volumes.NUMBERED).collect()]
    shown = [tuple(None if r.get(f) is None else str(r[f]) for f in lots_json.RAW_FIELDS) for r in want if any(v is not None for v in r.values())]
    assert sorted(got, key=repr) == sorted(shown, key=repr)
    if size < 10_000:
        assert lots_json.pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 4


def a_report(rng, n):
    """Lines of all kinds in any order, so that every rule of a run is met."""
    data = lambda: f"{rng.choice(['', '  '])}{rng.randint(1, 99)}   {rng.choice(['500', '500-545', '500.5'])}  512  {rng.choice(['101.50', '101.50-104.00'])}   103.25{rng.choice(['', '  ', '  Calves', ' Fleshy  Feeder '])}"
    kinds = [
        data, data, data, lambda: "", lambda: "   ", lambda: "demand was moderate", lambda: " 12 heads", lambda: " Head   Wt Range   Avg Wt    Price Range   Avg Price  x",
        lambda: f"{rng.choice(['', '  '])}Feeder {rng.choice(['', 'Holstein '])}{rng.choice(['Steers', 'Heifers', 'Bulls'])} {rng.choice(['Large', 'Medium and Large'])} {rng.choice(['1', '1-2', '3'])} ",
        lambda: " Feeder Steers Small 1", lambda: data() + "\x0b" + data(), lambda: "Receipts:  2,500   Last", lambda: "Feeder Cattle Weighted Average for 4/5/03",
    ]
    weights = [6, 6, 6, 2, 1, 2, 1, 3, 5, 1, 1, 0.3, 0.2]
    lines = [k() for k in rng.choices(kinds, weights, k=n)]
    if rng.random() < 0.7:
        lines.insert(rng.randint(n // 2, n), rng.choice(["Slaughter Cows:  Head", "  Source: x", "# note"]))
    return lines


@pytest.mark.parametrize("size", [64, 700, 1 << 27])
def test_long_reports_equal_the_row_wise_parser(spark, tmp_path, small_splits, size):
    rng = random.Random(size)
    for i, n in enumerate((0, 1, 3, 60, 200, 200)):
        lines = a_report(rng, n)
        (tmp_path / f"CV_LS7502001030{i + 1}.TXT").write_bytes(rng.choice(["\n", "\r\n"]).join(lines).encode())
    # A title and receipts that go on in the next line, over one long run of data lines.
    body = ["Feeder Cattle Weighted Average", "Report for 03/09/2001", "Receipts:", " 1,234", "Feeder Steers Large 1"]
    (tmp_path / "CV_LS750x.TXT").write_text("\n".join([*body, *[f" {i} 500 500 100.00 100.00" for i in range(1, 90)], "x", " 9 500 500 100.00 100.00"]))
    want = [tuple(r) for r in reports.read_reports(spark, str(tmp_path), "2001-01-01").collect()]
    small_splits(size)
    got = [tuple(r) for r in long_reports.read_long_reports(spark, str(tmp_path), "2001-01-01").collect()]
    assert len(want) > 100 and sorted(got, key=repr) == sorted(want, key=repr)
    if size < 10_000:
        assert long_reports.lines(spark, str(tmp_path)).rdd.getNumPartitions() > 7


@pytest.mark.parametrize("size", [64, 1 << 27])
def test_long_reports_in_volumes_equal_the_row_wise_parser(spark, tmp_path, small_splits, size):
    """A compressed file could not be split before, and a file in parts was taken for several reports."""
    rng = random.Random(size)
    for folder in ("whole", "cut"):
        (tmp_path / folder).mkdir()
    for i, n in enumerate((1, 3, 60, 200, 200, 200)):
        text = "\n".join(a_report(rng, n)) + "\n"
        name = f"CV_LS7502001030{i + 1}"
        (tmp_path / "whole" / name).write_text(text)
        in_volumes(rng, tmp_path / "cut", name, text, "TXT")
    want = [tuple(r) for r in reports.read_reports(spark, str(tmp_path / "whole"), "2001-01-01").collect()]
    small_splits(size)
    got = [tuple(r) for r in long_reports.read_long_reports(spark, str(tmp_path / "cut"), "2001-01-01", volumes.NUMBERED).collect()]
    assert len(want) > 50 and sorted(got, key=repr) == sorted(want, key=repr)


def test_a_long_report_without_a_date_fails(spark, tmp_path):
    (tmp_path / "x.TXT").write_text("Feeder Steers Large 1\n 1 500 500 100.00 100.00\n")
    with pytest.raises(Exception, match="no sale date"):
        long_reports.read_long_reports(spark, str(tmp_path), "2001-01-01").collect()


def test_long_reports_are_scanned_in_order_without_a_shuffle(spark, tmp_path):
    """All lines of a file went through one sort before; batches of seven lines carry header and run."""
    rng = random.Random(5)
    for i in range(3):
        (tmp_path / f"CV_LS7502001030{i + 1}.TXT").write_text("\n".join(a_report(rng, 150)))
    plan = long_reports.scanned(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Window" not in plan
    want = sorted((tuple(r) for r in reports.read_reports(spark, str(tmp_path), "2001-01-01").collect()), key=repr)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    for size in ("1", "7"):
        spark.conf.set(name, size)
        got = [tuple(r) for r in long_reports.read_long_reports(spark, str(tmp_path), "2001-01-01").collect()]
        assert sorted(got, key=repr) == want
    spark.conf.set(name, before)


def test_only_the_fields_asked_for_are_parsed(spark):
    rows = [dict.fromkeys(lots_json.RAW_FIELDS, 1) | {"commodity": "Slaughter Cattle", "price_unit": "Per Cwt", "class": "Cows", "report_date": "01/02/2001", "avg_price": "90"}]
    df = spark.createDataFrame([(json.dumps(rows),), (json.dumps({"results": rows}),)], "value string")
    fields = (*lots_json.KEPT_BY, "head_count", "lot_desc")
    raw = lots_json.raw_rows(df, fields=fields)
    assert set(raw.columns) == set(fields)
    whole = lots_json.slaughter_lots(lots_json.raw_rows(df), "2001-01-01")
    got = lots_json.slaughter_lots(raw, "2001-01-01")
    assert got.columns == ["auction_date", "commodity", "class", "lot_desc", "head_count", "price_avg", "vintage"]
    assert got.collect() == whole.select(got.columns).collect() and got.count() == len(df.collect())
