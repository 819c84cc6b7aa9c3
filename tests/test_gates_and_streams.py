"""Gates, revisions, baselines and one-pass forms in their edge cases."""

import json
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from drover import session
from drover.operators import insurance as I
from drover.operators import quality as Q
from drover.operators import vintage as V
from drover.operators.quantiles import exact_percentile
from drover.plans import weekly as plan
from drover.sources import lots_json, tables
from drover.streaming import refresh as R

LOT = "k int, day date, head int, price double, vintage date"
D = date


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_hot_group_of_many_values_is_narrowed(spark):
    rng = random.Random(11)
    hot = [100 + rng.random() for _ in range(20_000)]  # all in one magnitude bucket
    gap = [1.0 + i * 1e-9 for i in range(500)] + [1.09 + i * 1e-9 for i in range(500)]  # the two ranks lie far apart
    data = [("hot", x) for x in hot] + [("gap", x) for x in gap] + [("same", 5.0)] * 3000
    df = spark.createDataFrame(data, "k string, x double").repartition(5)
    got = {r.k: r.m for r in exact_percentile(df, ("k",), "x", 0.5, "m", near=100).collect()}
    mid = lambda v: (sorted(v)[len(v) // 2 - 1] + sorted(v)[len(v) // 2]) / 2
    assert got == {"hot": pytest.approx(mid(hot)), "gap": pytest.approx(mid(gap)), "same": 5.0}


def test_late_rows_are_null_safe_and_blind_to_the_vintage(spark):
    current = spark.createDataFrame([(1, D(2024, 1, 3), None, 5.0, D(2024, 1, 4)), (2, D(2024, 3, 6), 7, 6.0, D(2024, 3, 7))], LOT)
    same = current.withColumn("vintage", F.lit(D(2024, 3, 9)))
    merged, late = R.bounded_upsert(current, same, ("k", "day"), "day", 14)
    assert late.count() == 0
    assert rows_of(merged, "k", "head", "price") == [(1, None, 5.0), (2, 7, 6.0)]
    changed = current.withColumn("head", F.lit(9))
    assert rows_of(R.bounded_upsert(current, changed, ("k", "day"), "day", 14)[1], "k", "head") == [(1, 9)]


def test_old_lots_that_share_a_key_pass_through(spark):
    old = [(1, D(2024, 1, 3), h, 5.0, D(2024, 1, 4)) for h in (3, 4)]
    current = spark.createDataFrame([*old, (2, D(2024, 3, 6), 7, 6.0, D(2024, 3, 7))], LOT)
    batch = spark.createDataFrame([(2, D(2024, 3, 6), 8, 6.5, D(2024, 3, 9)), (3, None, 1, 1.0, D(2024, 3, 9))], LOT)
    merged, late = R.bounded_upsert(current, batch, ("k", "day"), "day", 14)
    assert rows_of(merged, "k", "head") == [(1, 3), (1, 4), (2, 8), (3, 1)] and late.count() == 0


def test_only_marks_move_to_find_late_rows(spark):
    """A long history comes again with three changes: whole rows of neither side are shuffled."""
    history = spark.range(20_000).select(
        F.col("id").cast("int").alias("k"), F.expr("date_add(DATE'2024-01-01', CAST(id % 50 AS INT))").alias("day"), F.lit(None).cast("int").alias("head"),
        F.rand(1).alias("price"), F.lit(D(2024, 1, 4)).alias("vintage"),
    )
    again = history.withColumn("vintage", F.lit(D(2024, 3, 9)))
    for changed, n_late in ((F.col("k") < 3, 3), (F.col("k") >= 3, 19_997), (F.lit(False), 0), (F.lit(True), 20_000)):
        batch = again.withColumn("head", F.when(changed, 9).otherwise(F.col("head")))
        was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
        try:
            late = R.late_rows(history, batch, D(2024, 3, 1), "day")
            assert late.columns == batch.columns and (late.count(), late.filter("head = 9").count()) == (n_late, n_late)
            assert "Exchange hashpartitioning" not in late._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_late_rows_differ_in_any_place(spark):
    kinds = "day date, a int, b int, s string, t string, x double, at timestamp, l array<int>, vintage date"
    day, at = D(2024, 1, 3), datetime(2024, 1, 3, 1, 2, 3, 4)
    row = (day, None, 5, "ab", "c", 0.0, at, [None, 1], D(2024, 1, 4))
    put = lambda **new: tuple(new.get(n, v) for n, v in zip("day a b s t x at l vintage".split(), row))
    late = [put(a=5, b=None), put(s="a", t="bc"), put(at=at.replace(microsecond=5)), put(l=[1, None]), put(l=None), put(l=[]), put(x=None), put(x=float("nan")), put(s=None)]
    same = [put(vintage=D(2024, 3, 9)), put(x=-0.0)]
    current = spark.createDataFrame([row, row], kinds)
    seen = lambda df: sorted(map(repr, df.collect()))
    for batch in (late + late + same, late[:1] + same, same, late, [put(day=None, a=7), put(day=D(2024, 3, 6), a=7)]):
        got = R.late_rows(current, spark.createDataFrame(batch, kinds), D(2024, 2, 1), "day")
        assert seen(got) == seen(spark.createDataFrame([r for r in batch if r in late], kinds))
    wide = spark.createDataFrame([put(a=None)], kinds.replace("b int", "b long"))  # the same value in a wider type is known
    assert R.late_rows(current, wide, D(2024, 2, 1), "day").count() == 0
    assert R.late_rows(current.limit(0), current, D(2024, 2, 1), "day").count() == 2


def test_revising_stream(spark, tmp_path):
    src, state, late, ck = (str(tmp_path / n) for n in ("in", "state", "late", "ck"))

    def arrive(*rows):
        spark.createDataFrame(rows, LOT).coalesce(1).write.mode("append").parquet(src)
        R.revise(R.file_stream(spark, src, LOT), state, late, ("k", "day"), "day", 14, ck).awaitTermination()

    arrive((1, D(2024, 1, 3), 3, 5.0, D(2024, 1, 4)), (1, D(2024, 1, 3), 4, 5.0, D(2024, 1, 4)), (2, D(2024, 3, 6), None, 6.0, D(2024, 3, 7)))
    arrive((2, D(2024, 3, 6), 8, 6.5, D(2024, 3, 9)), (4, D(2024, 1, 10), 1, 1.0, D(2024, 3, 9)), (3, D(2024, 3, 13), 1, 2.0, D(2024, 3, 14)))
    assert rows_of(spark.read.parquet(state), "k", "head") == [(1, 3), (1, 4), (2, 8), (3, 1)]
    assert rows_of(spark.read.parquet(late), "k", "head") == [(4, 1)]


def test_stream_publishes_only_good_batches(spark, tmp_path):
    src, root, ck = (str(tmp_path / n) for n in ("in", "root", "ck"))
    schema = "ts timestamp, kind string, value double"
    gate = lambda b: Q.run_rules(b, [Q.Rule("negative", F.col("value") < 0)])
    for n, value in enumerate((1.0, -1.0)):
        spark.createDataFrame([(datetime(2024, 1, 1), "a", value)], schema).coalesce(1).write.mode("append").parquet(src)
        R.gated_publish(R.file_stream(spark, src, schema), gate, root, "e", ck, lambda b: f"2024-01-0{b + 1}").awaitTermination()
    assert [r.value for r in tables.read_latest(spark, root, "e").collect()] == [1.0]
    assert [str(r.vintage) for r in tables.read_manifest(spark, root).collect()] == ["2024-01-01"]
    assert rows_of(tables.read_reports(spark, root), "vintage", "n_bad") == [(D(2024, 1, 1), 0), (D(2024, 1, 2), 1)]


def test_sources_are_counted_as_read(spark):
    lot = spark.createDataFrame([(1, D(2024, 1, 1))], "k int, vintage date")
    both = V.combine({"live": lot, "legacy": lot, "none": None}, key=("k",))
    assert both.df.count() == 1
    assert rows_of(both.counts(), "source", "rows", "present") == [("legacy", 1, True), ("live", 1, True), ("none", 0, False)]


def test_manifest_order_can_fail(spark):
    rows = [("a", "2024-01-01", datetime(2024, 1, 2)), ("a", "2023-01-01", datetime(2024, 1, 3)), ("b", "2024-01-01", datetime(2024, 1, 2))]
    m = spark.createDataFrame(rows, "dataset string, vintage string, written_at_utc timestamp")
    r = Q.manifest_order(m).first()
    assert (r.n_bad, r.n_total, r["sample"]) == (1, 2, "a")


def test_signature_baseline(spark, tmp_path):
    shapes = lambda *b: Q.key_signature(spark.createDataFrame([(x,) for x in b], "b string"), "b", levels={"row": "$.r[0]"})
    one, two, path = '{"r":[{"a":1}]}', '{"r":[{"a":1,"z":2}]}', str(tmp_path / "base")
    assert Q.signature_gate(shapes(one), path).first().n_bad == 0
    assert Q.signature_gate(shapes(one), path).first().n_bad == 0
    assert Q.signature_gate(shapes(one, two), path).first().n_bad == 1
    assert Q.signature_gate(shapes(two), path, rebaseline=True).first().n_bad == 0
    assert Q.signature_gate(shapes(one), path).first().n_bad == 1


def test_history_gate_equals_its_parts(spark):
    rows = [(D(2018, 1, 1 + i % 9), "Feeder", c, "M", g, 1, 1.0, 1.0, p, 1, D(2024, 1, 1))
            for i, (c, g, p) in enumerate([("Steers", "1", 100.0), ("Heifers", "9", None), ("Cows", "1", 5.0), (None, None, 100.0)] * 5)]
    df = spark.createDataFrame(rows, "auction_date date, commodity string, class string, frame string, muscle_grade string, head_count int, price_low double, price_high double, price_avg double, receipts int, vintage date")
    floors = {2018: 10, 2019: 1}
    whole = Q.history_gate(df, weeks=floors)
    parts = Q.all_issues(Q.not_empty(df), Q.run_rules(df, Q.history_rules()), Q.required_columns(df, Q.HISTORY_COLUMNS), Q.coverage_gate(df, floors), Q.balance_gate(df))
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))
    assert [r.n_bad for r in Q.history_gate(df.limit(0), weeks=floors).filter("rule_id = 'not_empty'").collect()] == [1]


def test_repeated_index_months_are_reduced_first(spark):
    raw = spark.createDataFrame([("2024", "M01", "100"), ("2024", "M01", "100"), ("2024", "M02", "110")], "year string, period string, value string")
    got = [(r.period.month, r.change) for r in Q.monthly_change(raw).orderBy("period").collect()]
    assert got == [(1, None), (2, pytest.approx(0.1))]


def test_slices_in_one_pass(spark):
    rows = [("S1", 2020, 1.0), ("XX", 2021, 3.0), ("S2", 2021, 5.0), (None, 2021, 7.0)]
    p = spark.createDataFrame([(s, y, "809", 10.0, 0, a) for s, y, a in rows],
                              "state_abbr string, reinsurance_year int, type_code string, total_weight_cwt double, producer_premium_amount int, indemnity_amount double")
    got = {r.part: r.n for r in I.slice_sizes(p, {"all": (None, "all", True), "known": (None, "latest", False), "s": ("S1", "latest", True)}).collect()}
    assert got == {"all": 4, "known": 1, "s": 0}
    many = {r.state_label: r for r in I.sample_summaries(p, (None, "S1", "S9")).collect()}
    assert many["National (all states)"].n_endorsements == 4 and many["S1"].mean_advantage_per_cwt == pytest.approx(0.1)
    assert (many["S9"].n_endorsements, many["S9"].year_min, many["S9"].mean_advantage_per_cwt) == (0, 0, 0.0)
    assert tuple(I.sample_summary(p, "S1").first()) == tuple(many["S1"])


def test_years_of_any_file_are_read(spark, tmp_path):
    path = str(tmp_path / "y")
    spark.createDataFrame([(1989, "a"), (2031, "b")], "reinsurance_year int, s string").write.partitionBy("reinsurance_year").parquet(path)
    assert rows_of(spark.read.parquet(path), "reinsurance_year", "s") == [(1989, "a"), (2031, "b")]


def test_markets_are_series_of_their_own(spark):
    lot = lambda market, week, price: (market, D(2020, 1, 1 + 7 * week) if week < 4 else D(2020, 2, week), "Feeder Cattle", "Steers", "Medium and Large", "1", 500, 550, 525.0, 10, price, "live")
    rows = [lot("north", w, 200.0) for w in range(3)] + [lot("south", w, 100.0) for w in range(3)]
    pens = spark.createDataFrame(rows, "market string, auction_date date, commodity string, class string, frame string, muscle_grade string, weight_break_low int, weight_break_high int, avg_weight double, head_count int, price_avg double, source string")
    cpi = spark.createDataFrame([(D(2020, 1, 1), 100.0)], "period date, cpi_u double")
    cleaned, log = plan.clean_weekly(pens, cpi, base=D(2020, 1, 1), markets=("market",))
    assert {(r.market, r.price_nominal) for r in cleaned.collect()} == {("north", 200.0), ("south", 100.0)} and "market" in log.columns


def test_payload_files_are_streamed(spark, tmp_path):
    row = {"commodity": "Feeder Cattle", "class": "Steers", "avg_price": "200"}
    (tmp_path / "a.json").write_text(json.dumps({"results": [row, row]}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps([row]))
    (tmp_path / "c.json").write_text(json.dumps({"results": []}))
    assert [tuple(r) for r in lots_json.read_raw_rows(spark, str(tmp_path)).select("class", "avg_price").collect()] == [("Steers", "200")] * 3


def test_release_deletes_what_was_written(spark):
    import os

    df = session.materialize(spark.range(3), "short")
    path = session._written[-1]
    local = path.removeprefix("file:")
    assert df.count() == 3 and os.path.exists(local)
    kept, session._written[:] = session._written[:-1], [path]
    session.release(spark)
    session._written[:] = kept
    assert not os.path.exists(local)


def test_a_feed_is_written_in_its_own_partitions(spark, tmp_path):
    from binding import streams

    batch = spark.range(90).repartition(3)
    assert streams._landed(batch, str(tmp_path / "feed")) == 1000
    assert len(list((tmp_path / "feed").glob("part-*"))) == 3 and spark.read.parquet(str(tmp_path / "feed")).count() == 90
