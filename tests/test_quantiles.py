import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from drover.operators.quantiles import counts_and_percentile, exact_percentile


def expected(groups, p):
    return {k: float(np.percentile(v, p * 100)) for k, v in groups.items()}


def check(spark, groups, p, **options):
    data = [(k, float(x)) for k, v in groups.items() for x in v]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "k string, x double").repartition(4)
    got = {r.k: r.m for r in exact_percentile(df, ("k",), "x", p, "m", **options).collect()}
    assert set(got) == set(groups)
    for k, v in expected(groups, p).items():
        assert got[k] == pytest.approx(v, rel=1e-12, abs=1e-9), (k, p)


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.99, 1.0])
def test_matches_brute_force(spark, p):
    rng = random.Random(7)
    groups = {
        "one": [3.0],
        "two": [1.0, 2.0],
        "hot": [rng.gauss(0, 100) for _ in range(6000)],
        "outlier": [rng.random() for _ in range(800)] + [1e12, -1e12],
        "ties": [float(rng.randint(0, 3)) for _ in range(900)],
        "constant": [5.0] * 700,
        "bimodal": [0.0] * 500 + [1000.0] * 500,
    }
    check(spark, groups, p)


@pytest.mark.parametrize("seed", range(4))
def test_random_groups(spark, seed):
    rng = random.Random(seed)
    groups = {f"g{i}": [round(rng.lognormvariate(3, 2), rng.randint(0, 3)) for _ in range(rng.randint(1, 1500))] for i in range(6)}
    signs = {k: [x * rng.choice([-1, 1]) for x in v] if i % 2 else v for i, (k, v) in enumerate(groups.items())}
    check(spark, signs, rng.choice([0.5, 0.3, 0.9]), near=rng.choice([1, 50, 100_000]))


def test_overlapping_groups(spark):
    rng = random.Random(3)
    data = [(rng.randint(0, 5), rng.gauss(5, 20)) for _ in range(1500)]
    df = spark.createDataFrame(data, "b int, x double")
    fan = lambda d: d.withColumn("k", F.explode(F.when(F.col("b") % 2 == 0, F.array(F.lit("even"), F.lit("all"))).otherwise(F.array(F.lit("all")))))
    got = {r.k: r.m for r in counts_and_percentile(df, ("k",), "x", 0.5, "m", base=("b",), fan=fan)[1].collect()}
    assert got["all"] == pytest.approx(np.median([x for _, x in data]))
    assert got["even"] == pytest.approx(np.median([x for b, x in data if b % 2 == 0]))


def test_extreme_magnitudes(spark):
    check(spark, {"a": [5e-324, 1e308, -1e308, 0.0, -5e-324, 1.0, 2.0, -0.0]}, 0.5)


def test_nulls_are_ignored(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None)], "k string, x double")
    assert [tuple(r) for r in exact_percentile(df, ("k",), "x", 0.5, "m").collect()] == [("a", 2.0)]
