import math
import random

import numpy as np

from contrail.operators import wide_corr
from contrail.operators.stats import corr_matrix
from contrail.operators.wide_corr import corr_wide


def frame(spark, n=900, seed=3):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        a = rnd.gauss(1e9, 3)
        rows.append((a, -2 * a + rnd.gauss(0, 1), rnd.choice([None, rnd.random()]), 7.0, None,
                     rnd.randint(0, 9), rnd.choice([None, None, a])))
    return spark.createDataFrame(rows, "a double, b double, c double, k double, n double, i int, "
                                       "p double").repartition(5)


def table(df):
    return {(r["var_a"], r["var_b"]): r["corr"] for r in df.collect()}


def test_equals_the_pairwise_matrix(spark):
    df = frame(spark)
    cols = df.columns
    wide, narrow = table(corr_wide(df, cols)), table(corr_matrix(df, cols))
    assert wide.keys() == narrow.keys()
    for pair, want in narrow.items():
        got = wide[pair]
        if want is None or got is None:
            assert want is None and got is None, pair
        elif math.isnan(want):
            assert math.isnan(got), pair
        else:
            assert abs(got - want) < 1e-7, pair


def test_equals_numpy_at_large_offsets(spark, monkeypatch):
    monkeypatch.setattr(wide_corr, "BLOCK_ROWS", 37)
    monkeypatch.setattr(wide_corr, "FAN", 2)
    rng = np.random.default_rng(1)
    x = rng.normal(1e8, 1, (800, 12)) @ rng.normal(0, 1, (12, 12))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], [f"c{i}" for i in range(12)])
    got = table(corr_wide(df.repartition(6), df.columns))
    want = np.corrcoef(x.T)
    assert max(abs(got[f"c{i}", f"c{j}"] - want[i, j]) for i in range(12) for j in range(12)) < 1e-6


def test_one_pass_and_no_pair_expressions(spark):
    df = spark.range(200).selectExpr(*[f"id * {k} % 7 AS c{k}" for k in range(60)])
    plan = corr_wide(df, df.columns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 200") == 1
    assert len(plan) < 60_000


def test_empty_and_infinite(spark):
    empty = spark.createDataFrame([], "a double, b double")
    assert corr_wide(empty, ["a", "b"]).count() == 0
    df = spark.createDataFrame([(1.0, 2.0), (2.0, float("inf")), (3.0, float("nan")), (4.0, 8.0)],
                               "a double, b double")
    assert abs(table(corr_wide(df, ["a", "b"]))["a", "b"] - 1.0) < 1e-9
