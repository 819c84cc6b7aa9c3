import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from drover.config import SpikeRule
from drover.operators import insurance as I
from drover.operators import sorted_state as K
from drover.operators import spikes
from drover.operators.ranks import in_blocks, numbered
from drover.operators.vintage import latest_vintage_wins
from drover.streaming import refresh as R

ROWS = "g string, a int, b double"


def some_rows(spark, seed, n=400):
    rng = random.Random(seed)
    data = [(rng.choice(["x", "x", "x", "y", None]), rng.choice([None, *range(20)]), rng.choice([None, 1.5, 2.5])) for _ in range(n)]
    return spark.createDataFrame([*data, *[("hot", 1, 1.0)] * n], ROWS).repartition(8)


def test_places_are_those_of_a_window(spark):
    df = some_rows(spark, 1)
    order = [F.asc_nulls_last(c) for c in ("g", "a", "b")]
    for within in ((), ("g",), ("g", "a")):
        got = numbered(df, order, within)
        w = Window.partitionBy(*within).orderBy(*order)
        want = df.withColumn("place", F.row_number().over(w).cast("long"))
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert numbered(df.limit(0), order, ("g",)).count() == 0


def test_equal_rows_are_spread_and_no_window_sees_them_all(spark):
    got = numbered(some_rows(spark, 2), [F.asc(c) for c in ("g", "a", "b")], ("g",))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    hot = got.filter("g = 'hot'").select(F.spark_partition_id().alias("p"), "place").collect()
    assert sorted(r.place for r in hot) == list(range(1, 401))


def test_one_long_series_in_many_blocks(spark):
    rng = random.Random(4)
    start = date(1990, 1, 3)
    data = [(start + timedelta(weeks=i), "Steers", "500-599", None if rng.random() < 0.1 else rng.gauss(150, 40)) for i in range(500)]
    data += [(start + timedelta(weeks=i), "Heifers", "500-599", float(i)) for i in range(3)]
    df = spark.createDataFrame(data, "auction_date date, sex string, weight_class string, price_real double")
    want = sorted(map(tuple, spikes.with_local_median(df).collect()), key=repr)
    for block in (6, 64, 500, 10_000):
        assert sorted(map(tuple, spikes.with_local_median(df, block=block).collect()), key=repr) == want
    dealt = in_blocks(df, ("sex", "weight_class"), [F.asc(c) for c in ("sex", "weight_class", "auction_date")], 64, 6)
    assert dealt.filter("sex = 'Steers' AND _own").select("_block").distinct().count() == 8
    assert dealt.count() == 503 + 7 * 12 and dealt.filter("_own").count() == 503
    with pytest.raises(ValueError):
        in_blocks(df, ("sex",), [F.asc("sex")], 5, 6)


def lots(spark, seed, vintage, n=300):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(60)]), rng.choice(["p", None]), rng.random(), vintage + timedelta(days=rng.randint(0, 2))) for _ in range(n)]
    return spark.createDataFrame(rows, "a int, b string, x double, seen date")


def test_merge_of_sorted_vintages(spark, tmp_path):
    key, order = ("a", "b"), ("seen", "x")
    old, new = lots(spark, 1, date(2024, 1, 1)), lots(spark, 2, date(2024, 1, 2))
    sides = []
    for name, df in (("old", old), ("new", new)):
        rows = K.keyed(df, key, order)
        K.write_sorted(rows, f"{tmp_path}/{name}", 4)
        sides.append(K.read_sorted(spark, rows.schema, f"{tmp_path}/{name}", 4))
    won = K.merged(*sides, order)
    want = latest_vintage_wins(old.unionByName(new), key, "seen", ("x",))
    assert sorted(map(tuple, won.drop(K.KEY).select(*want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    plan = won._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort [" not in plan and "SortMergeJoin" in plan


def test_rows_are_dealt_once_to_buckets_that_follow_their_number(spark, tmp_path):
    key, order = ("a", "b"), ("seen", "x")
    assert K.buckets_for(10) == 8 and K.buckets_for(400 * K.BUCKET_ROWS) == 400
    df = lots(spark, 4, date(2024, 1, 1))
    rows = K.keyed(df, key, order, buckets=5)
    assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    K.write_sorted(rows, f"{tmp_path}/t", 5, dealt=True)
    back = K.read_sorted(spark, rows.schema, f"{tmp_path}/t", 5)
    want = K.keyed(df, key, order).select(*back.columns)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    plan = K.merged(back, rows, order)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and len(list(tmp_path.glob("t/part-*"))) == 5


def test_changes_are_what_came_and_what_went(spark):
    key, order = ("a", "b"), ("seen",)
    d = date(2024, 1, 1)
    schema = "a int, b string, x double, seen date"
    state = K.keyed(spark.createDataFrame([(1, "p", 1.0, d), (2, None, 2.0, d), (3, "p", 3.0, date(2025, 1, 1))], schema), key, order)
    batch = K.keyed(spark.createDataFrame([(2, None, 9.0, d), (3, "p", 9.0, d), (None, "q", 4.0, d)], schema), key, order)
    got = sorted(((r.a, r.x, r._sign) for r in K.changes(state, batch, order).collect()), key=repr)
    assert got == sorted([(2, 9.0, 1), (2, 2.0, -1), (None, 4.0, 1)], key=repr)


POLICY = (
    "id int, reinsurance_year int, state_abbr string, type_code string, n_head int, total_weight_cwt double, producer_premium_amount long, "
    "indemnity_amount long, n_endorsements_earning long, n_endorsements_indemn long, liability_amount long, subsidy_amount long, "
    "total_premium_amount long, length_weeks int, coverage_price double, expected_end_value double, coverage_level_pct double, cost_per_cwt double"
)


def endorsements(spark, seed, ids):
    rng = random.Random(seed)
    real = lambda: rng.choice([None, round(rng.random() * 300, 3)])
    whole = lambda: rng.randint(0, 5000)
    rows = [
        (i, rng.choice([2022, 2023, 2024]), rng.choice(["AZ", "TX", None, "XX"]), rng.choice(["809", "823"]), rng.choice([None, 0, 40]), real(), whole(),
         whole(), 1, rng.randint(0, 1), whole(), whole(), whole(), rng.choice([None, 13, 26]), real(), real(), real(), real())
        for i in ids
    ]
    return spark.createDataFrame(rows, POLICY)


def test_cube_by_deltas_equals_the_rebuild(spark):
    first, second = endorsements(spark, 1, range(200)), endorsements(spark, 2, range(150, 260))
    state, batch = K.keyed(first, ("id",)), K.keyed(second, ("id",))
    got = I.revised_cube(I.policy_cube(state), K.changes(state, batch))
    want = I.policy_cube(K.merged(state, batch))
    table = lambda df: {tuple(r[k] for k in I.CUBE_KEYS): [r[c] for c in want.columns if c not in I.CUBE_KEYS] for r in df.collect()}
    a, b = table(got.select(*want.columns)), table(want)
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=1e-9, abs=1e-6)


def test_a_cell_goes_with_its_last_row(spark):
    first = endorsements(spark, 3, [1]).withColumn("state_abbr", F.lit("NM"))
    moved = first.withColumn("state_abbr", F.lit("AZ"))
    state = K.keyed(first, ("id",))
    after = I.revised_cube(I.policy_cube(state), K.changes(state, K.keyed(moved, ("id",))))
    assert [r.state_abbr for r in after.collect()] == ["AZ"]


REVISED = "k int, auction_date date, vintage date, x int"


def test_a_first_batch_that_died_half_way_is_written_again(spark, tmp_path):
    src, state, late, ck = (str(tmp_path / n) for n in ("in", "state", "late", "ck"))
    day = lambda m, d: date(2024, m, d)
    half = spark.createDataFrame([(1, day(1, 3), day(1, 4), 1)], REVISED).withColumn(R.MONTH, F.trunc("auction_date", "month"))
    half.write.partitionBy(R.MONTH).parquet(state)  # what a job that died has left
    spark.createDataFrame([(1, day(1, 3), day(1, 4), 1), (2, day(3, 6), day(3, 7), 2)], REVISED).write.parquet(f"{src}/0")
    src_all = f"{src}/*"
    run = lambda: R.revise(R.file_stream(spark, src_all, REVISED), state, late, ("k", "auction_date"), "auction_date", 14, ck).awaitTermination()
    run()
    assert sorted((r.k, r.x) for r in spark.read.parquet(state).collect()) == [(1, 1), (2, 2)] and spark.read.parquet(late).count() == 0
    spark.createDataFrame([(1, day(1, 3), day(3, 9), 9), (1, day(1, 3), day(1, 4), 1), (2, day(3, 6), day(3, 9), 8), (3, day(2, 6), day(3, 9), 3)], REVISED).write.parquet(f"{src}/1")
    run()
    assert sorted((r.k, r.x) for r in spark.read.parquet(state).collect()) == [(1, 1), (2, 8)]
    assert sorted((r.k, r.x) for r in spark.read.parquet(late).collect()) == [(1, 9), (3, 3)]
