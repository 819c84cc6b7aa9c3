from datetime import date, datetime

from pyspark.sql import functions as F

from drover.operators import quality as Q
from drover.operators import sorted_state as K
from drover.sources import tables as T
from drover.streaming import refresh as R
from drover.streaming import upsert as U
from drover.streaming import windows as W

SCHEMA = "ts timestamp, kind string, value double"


def write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_good_and_bad_batches(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    gate = lambda b: Q.run_rules(b, [Q.Rule("negative", F.col("value") < 0)])
    write(spark, src, [(datetime(2024, 1, 1), "a", 1.0)])
    run = lambda: R.gated_append(R.file_stream(spark, src, SCHEMA), gate, out, ck).awaitTermination()
    run()
    write(spark, src, [(datetime(2024, 1, 2), "a", -1.0), (datetime(2024, 1, 2), "a", 2.0)])
    run()
    run()  # nothing new
    assert spark.read.parquet(f"{out}/accepted").count() == 1
    assert spark.read.parquet(f"{out}/rejected").count() == 2


def days(*rows):
    return [(datetime(2024, *d) if d else None, k, v) for d, k, v in rows]


def run_weeks(spark, src, out, ck, **more):
    W.run_windows(R.file_stream(spark, src, SCHEMA), ("kind",), out, ck, **more).awaitTermination()


def weeks(df):
    return sorted((r.week, r.kind, r.n, r.total, r.low, r.high) for r in df.collect())


def test_stream_equals_batch_over_several_runs(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    write(spark, src, days(((1, 1), "a", 1.0), ((1, 7, 23), "a", 2.0)))
    run_weeks(spark, src, out, ck)
    write(spark, src, days(((1, 3), "a", 4.0), ((1, 8), "b", 8.0)))
    run_weeks(spark, src, out, ck)
    got = weeks(W.read_windows(spark, out, ("kind",)))
    assert got == weeks(W.weekly(spark.read.parquet(src), ("kind",), "ts", "value"))
    assert got == [(date(2024, 1, 1), "a", 3, 7.0, 1.0, 4.0), (date(2024, 1, 8), "b", 1, 8.0, 8.0, 8.0)]
    assert W.read_late(spark, out).count() == 0 and Q.failures(W.read_gates(spark, out)).count() == 0


def test_late_rows_are_set_aside_and_counted(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    feeds = (
        days(((1, 2), "a", 1.0), ((1, 9), "a", 2.0)),
        days(((6, 4), "a", 4.0), ((1, 10), "b", 8.0)),  # January is still open when this batch begins
        days(((1, 3), "a", 16.0), ((5, 22), "b", 32.0), (None, "a", 64.0), ((5, 19, 23), "a", 128.0)),
    )
    for feed in feeds:
        write(spark, src, feed)
        run_weeks(spark, src, out, ck)
    late = {(r.batch, r.reason, r.value) for r in W.read_late(spark, out).collect()}
    assert late == {(2, "late", 16.0), (2, "untimed", 64.0), (2, "late", 128.0)}
    failed = {(r.batch, r.rule_id, r.n_bad, r.n_total) for r in Q.failures(W.read_gates(spark, out)).collect()}
    assert failed == {(2, "late_rows", 2, 4), (2, "untimed_rows", 1, 4)}
    both = W.read_windows(spark, out, ("kind",)).unionByName(W.weekly(W.read_late(spark, out), ("kind",), "ts", "value"))
    again = both.groupBy("week", "kind").agg(*[f(c).alias(c) for f, c in ((F.sum, "n"), (F.sum, "total"), (F.min, "low"), (F.max, "high"))])
    assert weeks(again) == weeks(W.weekly(spark.read.parquet(src), ("kind",), "ts", "value"))


def test_a_replayed_batch_splits_its_rows_as_before(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    for feed in (days(((6, 4), "a", 4.0)), days(((1, 3), "a", 16.0), ((6, 5), "a", 1.0))):
        write(spark, src, feed)
        run_weeks(spark, src, out, ck)
    before = weeks(W.read_windows(spark, out, ("kind",)))
    (tmp_path / "ck" / "commits" / "1").unlink()  # as if the job had died before the batch was recorded
    (tmp_path / "ck" / "commits" / ".1.crc").unlink(missing_ok=True)
    run_weeks(spark, src, out, ck)
    assert weeks(W.read_windows(spark, out, ("kind",))) == before and W.read_late(spark, out).count() == 1


STATE = "a int, b string, x double, seen date"


def publish(spark, root, tag, rows, gate=None, **more):
    df = spark.createDataFrame(rows, STATE)
    report = Q.run_rules(df, [Q.Rule("negative", F.col("x") < 0)])
    return U.upsert_vintage(df, root, "t", tag, ("a", "b"), report, buckets=4, **more)


def latest(spark, root):
    return sorted(((r.a, r.b, r.x) for r in T.read_latest(spark, root, "t").collect()), key=repr)


def test_vintages_are_whole_tables(spark, tmp_path):
    root = str(tmp_path)
    d = date(2024, 1, 1)
    assert publish(spark, root, "2024-01-01", [(1, "p", 1.0, d), (2, None, 2.0, d), (2, None, 3.0, d), (None, "q", 4.0, d)])
    assert latest(spark, root) == sorted([(1, "p", 1.0), (2, None, 3.0), (None, "q", 4.0)], key=repr)
    assert publish(spark, root, "2024-01-02", [(2, None, 5.0, d), (3, "p", 6.0, d)])
    second = sorted([(1, "p", 1.0), (2, None, 5.0), (3, "p", 6.0), (None, "q", 4.0)], key=repr)
    assert latest(spark, root) == second
    assert not publish(spark, root, "2024-01-03", [(1, "p", -1.0, d)])
    assert latest(spark, root) == second
    assert publish(spark, root, "2024-01-02", [(2, None, 5.0, d), (3, "p", 6.0, d)])  # replayed: from the vintage before it
    assert latest(spark, root) == second
    assert publish(spark, root, "2024-01-04", [])
    assert latest(spark, root) == second
    assert T.read_manifest(spark, root).select("rows").collect()[-1].rows == 4
    assert spark.catalog.listTables() == [] or not any(t.name.startswith("drover_state") for t in spark.catalog.listTables())


def test_an_older_row_does_not_replace_a_newer_one(spark, tmp_path):
    root = str(tmp_path)
    old, new = date(2024, 1, 1), date(2024, 1, 2)
    publish(spark, root, "2024-01-01", [(1, "p", 1.0, new), (2, "p", 1.0, None)], order=("seen",))
    publish(spark, root, "2024-01-02", [(1, "p", 2.0, old), (2, "p", 2.0, old), (3, "p", 3.0, None)], order=("seen",))
    assert latest(spark, root) == [(1, "p", 1.0), (2, "p", 2.0), (3, "p", 3.0)]


def test_the_state_is_read_where_it_lies(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, "2024-01-01", [(i, "p", 1.0, None) for i in range(100)])
    batch = K.keyed(spark.createDataFrame([(7, "p", 9.0, None)], STATE), ("a", "b"))
    state = K.read_sorted(spark, batch.schema, f"{root}/t/vintage=2024-01-01", 4)
    plan = K.merged(state, batch)._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin"):]
    assert "FullOuter" in join and "Bucketed: true" in plan
    left = join[: join.index("FileScan")]
    assert "Exchange" not in left and "Sort [" not in left


def test_bounded_upsert(spark):
    cols = "k int, auction_date date, vintage date, x int"
    cur = spark.createDataFrame([(1, date(2024, 1, 3), date(2024, 1, 4), 1), (2, date(2024, 3, 6), date(2024, 3, 7), 2)], cols)
    new = spark.createDataFrame([(1, date(2024, 1, 3), date(2024, 3, 9), 9), (2, date(2024, 3, 6), date(2024, 3, 9), 8), (3, date(2024, 3, 13), date(2024, 3, 14), 3), (1, date(2024, 1, 3), date(2024, 1, 4), 1)], cols)
    merged, late = R.bounded_upsert(cur, new, ("k", "auction_date"), "auction_date", 14)
    assert sorted((r.k, r.x) for r in merged.collect()) == [(1, 1), (2, 8), (3, 3)]
    assert [(r.k, r.x) for r in late.collect()] == [(1, 9)]
