import random

import pytest
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from contrail.operators.certificates import (
    elastic_net_certificate,
    fitted_models,
    forest_table,
    training_moments,
)
from contrail.operators.features import assemble
from contrail.operators.model_store import differing_rows, load_model, save_model, score_both
from contrail.operators.models import fit_forest, grid_search

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def folds(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(600):
        a, b = rnd.gauss(5, 2), rnd.gauss(-1, 9)
        rows.append((a, b, rnd.random(), 3 * a - 0.1 * b + rnd.gauss(0, 4), i % 3))
    df = spark.createDataFrame(rows, "a double, b double, c double, y double, fold int")
    return assemble(df, COLS)


@pytest.fixture(scope="module")
def proof(spark, folds):
    model, _ = grid_search(folds, "y", fold_col="fold", stage=False, keep_models=True)
    return training_moments(folds, "y", COLS, "fold", 3), fitted_models(spark, model)


def test_every_fit_of_the_grid_is_optimal(proof):
    moments, fits = proof
    table = elastic_net_certificate(moments, fits, COLS)
    assert table.count() == 27 * 4
    assert table.filter("violated").count() == 0
    # some fits have coefficients that the L1 part sets to 0, whose condition is a bound
    assert table.filter("coefficient = 0 AND term <> 'intercept'").count() > 0


def test_a_wrong_fit_is_found(proof):
    moments, fits = proof
    for name, wrong in {
        "coefficient": fits.withColumn("coefficients", F.transform(
            "coefficients", lambda c, i: F.when(i == 0, c * 1.01).otherwise(c))),
        "zeroed": fits.withColumn("coefficients", F.transform(
            "coefficients", lambda c, i: F.when(i == 0, 0.0).otherwise(c))),
        "intercept": fits.withColumn("intercept", F.col("intercept") + 0.1),
        "penalty": fits.withColumn("regParam", F.col("regParam") + 0.3),
        "fold": fits.withColumn("fold", (F.col("fold") + 1) % 3),
    }.items():
        table = elastic_net_certificate(moments, wrong, COLS)
        assert table.filter("violated").select("fold", "regParam", "elasticNetParam"
                                               ).distinct().count() == 27, name


def test_forest_table_replays_the_trees(spark, folds):
    model = fit_forest(folds, "y", num_trees=3, seed=1, maxDepth=3)
    nodes = forest_table(spark, model, COLS).collect()
    assert {n["tree"] for n in nodes} == {0, 1, 2}
    by = {(n["tree"], n["node"]): n for n in nodes}
    for r in model.transform(folds).select(*COLS, "prediction").limit(50).collect():
        total = 0.0
        for tree in range(3):
            at = 1
            while by[tree, at]["feature"] is not None:
                n = by[tree, at]
                at = 2 * at + (0 if r[n["feature"]] <= n["threshold"] else 1)
            total += by[tree, at]["prediction"]
        assert abs(total / 3 - r["prediction"]) < 1e-9
    one = DecisionTreeRegressor(labelCol="y", maxDepth=1).fit(folds)
    assert forest_table(spark, one, COLS).count() == 3


def test_stored_model_scores_alike(spark, folds):
    from pyspark.ml.regression import LinearRegression

    from contrail.operators.features import model_pipeline
    rows = folds.select(*COLS, "y", F.concat(F.lit("id"), F.monotonically_increasing_id()).alias(
        "key"), F.when(F.col("fold") == 0, "x").when(F.col("fold") == 1, "y").otherwise(
        "z").alias("kind"))
    lr = LinearRegression(labelCol="y")
    model = model_pipeline(["kind"], COLS, lr).fit(rows)
    path = save_model(spark, model)
    scored = score_both(rows, model, load_model(path), "key")
    assert tuple(differing_rows(scored).first()) == (600, 0, 0)
    with pytest.raises(Exception, match="overwrite|exist"):
        save_model(spark, model, path)
    assert save_model(spark, model, path, overwrite=True) == path
    other = model_pipeline(["kind"], COLS, lr).fit(rows.filter("a > 5"))
    assert differing_rows(score_both(rows, model, other, "key")).first()["n_differing"] == 600
