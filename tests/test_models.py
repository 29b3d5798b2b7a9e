import os

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from contrail.operators.models import (
    evaluate,
    fit_forest,
    fit_linear,
    grid_search,
    regression_metrics,
)
from contrail.operators.split import fold_column


@pytest.fixture()
def linear_data(spark):
    df = spark.range(400).select(
        (F.col("id") % 17).cast("double").alias("x1"),
        ((F.col("id") * 7) % 13).cast("double").alias("x2"),
        F.col("id").cast("string").alias("key"))
    df = df.withColumn("y", 3.0 + 2.0 * F.col("x1") - 0.5 * F.col("x2"))
    return VectorAssembler(inputCols=["x1", "x2"], outputCol="features").transform(df)


def test_linear_recovers_coefficients(linear_data):
    m = fit_linear(linear_data, "y")
    assert abs(m.intercept - 3.0) < 1e-6
    assert all(abs(a - b) < 1e-6 for a, b in zip(m.coefficients.toArray(), [2.0, -0.5]))


def test_metrics_match_evaluator(spark, linear_data):
    noisy = linear_data.withColumn("y", F.col("y") + (F.col("x1") * 13 % 5) - 2)
    pred = fit_linear(noisy, "y").transform(noisy)
    m = regression_metrics(pred, "y").first()
    for name in ("rmse", "mse", "mae", "r2", "var"):
        assert abs(m[name] - evaluate(pred, "y", metric=name)) < 1e-9, name
    assert abs(m.r2 - (1 - m.mse / noisy.select(F.var_pop("y")).first()[0])) < 1e-12


def test_forest_beats_mean_on_step(spark):
    df = spark.range(600).select((F.col("id") % 100).cast("double").alias("x"))
    df = df.withColumn("y", F.when(F.col("x") < 50, 0.0).otherwise(10.0))
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    pred = fit_forest(df, "y", num_trees=10).transform(df)
    m = regression_metrics(pred, "y").first()
    assert m.r2 > 0.95


def test_grid_search_table(linear_data):
    train = linear_data.withColumn("fold", fold_column(["key"], 3))
    model, table = grid_search(train, "y", fold_col="fold", parallelism=2)
    rows = table.collect()
    assert len(rows) == 9
    assert {(r.regParam, r.elasticNetParam) for r in rows} == {
        (a, b) for a in (0.01, 0.1, 0.5) for b in (0.0, 0.5, 1.0)}
    assert min(r.avg_rmse for r in rows) == min(model.avgMetrics)
    best = [(r.regParam, r.elasticNetParam) for r in rows if r.is_best]
    assert len(best) == 1
    chosen = model.bestModel
    assert best[0] == (chosen.getRegParam(), chosen.getElasticNetParam())


def test_grid_search_leaves_no_staged_table(spark, linear_data):
    from contrail.session import staging_root
    root = staging_root(spark).removeprefix("file:")
    train = linear_data.withColumn("fold", fold_column(["key"], 3))
    before = set(os.listdir(root))
    grid_search(train, "y", fold_col="fold", reg_params=(0.1,), elastic_net=(0.0,))
    assert not [p for p in set(os.listdir(root)) - before if "cv-input" in p]
