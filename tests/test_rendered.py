"""Raw files of large tables: rendered by the tasks that read the rows."""

import json

import pytest

import __spark_entry__ as entry
from binding import ingest, rendered
from binding.tables import table as table_of
from check import connect, table
from drover.session import release
from drover.sources import volumes

SF = "/root/testdata/sf0.001"


@pytest.fixture
def large(spark, monkeypatch):
    """Every table counts as large."""
    monkeypatch.setattr(rendered, "LARGE", 0)
    yield
    rendered.clear(spark)
    release(spark)


def test_rows_of_a_large_table_are_not_moved_to_be_rendered(spark, large):
    plan = rendered.dealt(spark, SF, "lineitem")._jdf.queryExecution().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("name", ["a2_slaughter_lots_json", "a4_endorsement_lines", "a4_endorsement_files", "a5_endorsement_corpus"])
def test_results_of_a_large_table(spark, large, name):
    df = entry.queries()[name](spark, SF)
    cur = connect(SF).execute(entry.oracle_sql()[name])
    assert table(df.columns, df.collect()) == table([c[0] for c in cur.description], cur.fetchall())


def test_named_files_are_written_by_several_tasks(spark, tmp_path, large):
    """One task wrote each file name before."""
    rows = lambda: spark.range(0, 4000, 1, 4).selectExpr("concat('f', id % 2, '.txt') AS file_name", "CAST(id AS string) AS value")
    path = rendered.split_named_files(spark, str(tmp_path), "t", rows)
    found = spark.read.text(path).selectExpr("value", "_metadata.file_name AS name", "_metadata.file_path AS file")
    assert found.select("file").distinct().count() == 8
    assert sorted((int(r.value), r.name) for r in found.collect()) == [(i, f"f{i % 2}.txt") for i in range(4000)]


def test_envelopes_of_a_large_table_are_several(spark, large, monkeypatch):
    """One task wrote one file of any length before."""
    monkeypatch.setattr(ingest, "ENVELOPE_ROWS", 1000)
    files = spark.read.text(ingest.envelopes(spark, SF), wholetext=True).collect()
    n = table_of(spark, SF, "lineitem").count()
    assert len(files) == 1 + n // 1000 > 3
    assert sum(len(json.loads(f.value)["results"]) - 1 for f in files) == n
    test_results_of_a_large_table(spark, None, "a1_feeder_lots_json")


def test_long_reports_of_a_large_table_are_several(spark, large, monkeypatch):
    monkeypatch.setattr(ingest, "REPORT_ROWS", 1000)
    assert len(spark.read.text(ingest.long_reports(spark, SF)).inputFiles()) > 40
    test_results_of_a_large_table(spark, None, "e6_header_carry_long")


def test_long_reports_at_rest_are_compressed_volumes(spark, large, monkeypatch):
    """The text lay there uncompressed before, as one file can only be split so."""
    monkeypatch.setattr(volumes, "ROWS", 300)
    path = ingest.long_reports(spark, SF)
    found = spark.read.text(path)
    text = found.selectExpr("sum(octet_length(value) + 1)").first()[0]
    assert rendered.size_of(spark, path) * 3 < text
    assert len(found.inputFiles()) > 2 * table_of(spark, SF, "lineitem").select("l_linenumber").distinct().count()
    for name in ("a7_long_reports", "e6_header_carry_long"):
        test_results_of_a_large_table(spark, None, name)


def test_envelopes_at_rest_are_compressed_volumes(spark, large, monkeypatch):
    """The text lay there uncompressed before, as one file can only be split so."""
    monkeypatch.setattr(volumes, "ROWS", 1000)
    path = ingest.envelopes(spark, SF)
    found = spark.read.text(path)
    text = found.selectExpr("sum(octet_length(value) + 1)").first()[0]
    assert rendered.size_of(spark, path) * 3 < text
    assert len(found.inputFiles()) == 1 + (table_of(spark, SF, "lineitem").count() + 1) // 1000 > 3
    test_results_of_a_large_table(spark, None, "a1_feeder_lots_json")
