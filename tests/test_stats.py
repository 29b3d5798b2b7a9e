import math

from contrail.operators.stats import (
    corr_matrix,
    correlated_to_drop,
    drop_correlated,
    high_corr_columns,
    high_corr_pairs,
    trend,
)


def test_corr_matrix_symmetric_unit_diagonal(spark):
    rows = [(i, 2 * i + (i % 3), (i * 7) % 11, 5) for i in range(50)]
    df = spark.createDataFrame(rows, "a int, b int, c int, k int")
    m = {(r.var_a, r.var_b): r.corr for r in corr_matrix(df, ["a", "b", "c", "k"]).collect()}
    assert len(m) == 16
    for x in "abck":
        assert m[(x, x)] == 1.0
    assert abs(m[("a", "b")] - m[("b", "a")]) < 1e-15
    assert m[("a", "b")] > 0.99
    assert math.isnan(m[("a", "k")])  # constant column -> NaN (no error under ANSI)


def test_high_corr_excludes_nan_and_exact_threshold(spark):
    stub = spark.createDataFrame(
        [("a", 0, "b", 1, 0.9), ("a", 0, "c", 2, float("nan")), ("b", 1, "c", 2, -0.95),
         ("c", 2, "b", 1, -0.95), ("a", 0, "a", 0, 1.0)],
        "var_a string, pos_a int, var_b string, pos_b int, corr double")
    pairs = [(r.var_a, r.var_b) for r in high_corr_pairs(stub).collect()]
    assert pairs == [("b", "c")]
    cols = sorted(r.column_name for r in high_corr_columns(stub).collect())
    assert cols == ["b", "c"]


def test_drop_correlated_auto(spark):
    rows = [(i, 2 * i + 1, (i * 7) % 11, i % 5) for i in range(50)]
    df = spark.createDataFrame(rows, "a int, b int, c int, y int")
    assert correlated_to_drop(df, ["a", "b", "c"]) == ["b"]
    assert drop_correlated(df, ["c"], auto=True, candidates=["a", "b"]).columns == ["a", "y"]


def test_trend_fallback(spark):
    df = spark.createDataFrame([(1, 10), (1, 20), (2, 5)], "Month int, ArrDelay int")
    got = [tuple(r) for r in trend(df, "ArrDelay").collect()]
    assert got == [(1, 15.0, 2), (2, 5.0, 1)]


def test_corr_pairwise_deletion_with_nulls(spark):
    import pandas as pd
    rows = [(float(i), None if i % 4 == 0 else float(i * i % 13), None if i % 5 == 0 else float(i % 7))
            for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.var_a, r.var_b): r.corr for r in corr_matrix(df, ["a", "b", "c"]).collect()}
    want = pd.DataFrame(rows, columns=["a", "b", "c"]).corr()  # pandas: pairwise complete
    for a in "abc":
        for b in "abc":
            assert abs(got[(a, b)] - want.loc[a, b]) < 1e-9, (a, b)


def test_pair_moments_bounds(spark):
    from pyspark.sql import functions as F

    from contrail.operators.stats import pair_moments
    df = spark.createDataFrame([(1.0, 10.0, True), (3.0, 30.0, True), (9.0, 5.0, False)],
                               "x double, y double, fit boolean")
    rows = {(r.pos_a, r.pos_b): r for r in pair_moments(df, ["x", "y"], F.col("fit")).collect()}
    assert (rows[(0, 0)].min_a, rows[(0, 0)].max_a) == (1.0, 3.0)
    assert (rows[(1, 1)].min_a, rows[(1, 1)].max_a) == (10.0, 30.0)
    import statistics
    assert abs(rows[(0, 1)].var_a - statistics.pvariance([1.0, 3.0, 9.0])) < 1e-12
    assert abs(rows[(0, 1)].cov - (-50.0 / 3)) < 1e-12


def test_corr_with_nulls_does_not_multiply_rows(spark):
    """A pair never present together is NULL, and no Generate multiplies the rows."""
    df = spark.createDataFrame([(1.0, None, 1e9), (None, 2.0, 1e9 + 1), (3.0, None, 1e9 + 3)],
                               "a double, b double, c double")
    got = {(r.var_a, r.var_b): r.corr for r in corr_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] is None
    assert abs(got[("a", "c")] - 1.0) < 1e-9
    plan = corr_matrix(df, ["a", "b", "c"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
