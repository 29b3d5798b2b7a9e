"""Regression models, metrics and cross-validated grid search (Spark ML).

Fitting is distributed by Spark ML itself: linear regression solves the
normal equations from one tree-aggregated pass (L-BFGS above 4096
features); the forest builds per-level histograms with tree aggregation.
Metrics are ONE SQL aggregate over the predictions (the evaluator would
make one pass per metric).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.operators import binned_forest
from contrail.operators.sizing import at_most_rows, partition_rows
from contrail.session import ROWS_PER_FILE, materialize_at, remove_staged

DEFAULT_PREDICTION = "prediction"
GRID_REG_PARAMS = (0.01, 0.1, 0.5)
GRID_ELASTIC_NET = (0.0, 0.5, 1.0)
#: Training rows of one task: the forest keeps a number a tree and a bin a feature of each row in
#: blocks of a partition, about 0.5 KB a row with 100 trees and few features.
FOREST_ROWS = 400_000
#: Bytes of these numbers over all rows, beyond which the forest is grown from staged bins.
FOREST_CACHE_BYTES = 1 << 29


def fit_linear(train: DataFrame, label: str, features: str = "features",
               prediction: str = DEFAULT_PREDICTION, **params):
    """``LinearRegression`` with Spark's defaults unless overridden."""
    lr = LinearRegression(featuresCol=features, labelCol=label, predictionCol=prediction,
                          **params)
    return lr.fit(train)


def fit_forest(train: DataFrame, label: str, features: str = "features",
               prediction: str = DEFAULT_PREDICTION, num_trees: int = 100, seed: int = 123,
               **params):
    """``RandomForestRegressor`` writing the SAME prediction column the
    evaluation reads (the reference's forest wrote another one).

    A training frame with a partition of more than ``FOREST_ROWS`` rows is dealt evenly first: a
    scan deals files by bytes, so that packed rows come to few tasks and to blocks beyond memory.
    Beyond ``FOREST_CACHE_BYTES`` the same forest is grown by ``binned_forest``, which keeps nothing
    of a row in memory; with other parameters than Spark's defaults it is always Spark's."""
    rf = RandomForestRegressor(featuresCol=features, labelCol=label, predictionCol=prediction,
                               numTrees=num_trees, seed=seed, **params)
    used = list(dict.fromkeys(c for c in (features, label, params.get("weightCol")) if c))
    train = train.select(*[F.col(f"`{c}`") for c in used])
    counted = partition_rows(train)
    if not params and num_trees > 1 and counted[0] * num_trees * 4 > FOREST_CACHE_BYTES:
        grown = binned_forest.grow(train, label, features, counted[0], num_trees, seed)
        if grown:
            model = rf._copyValues(binned_forest.to_model(train.sparkSession, *grown, rf.uid))
            model._transfer_params_to_java()
            return model
    return rf.fit(at_most_rows(train, FOREST_ROWS, counted))


def coefficients_frame(spark, model, feature_names: Sequence[str]) -> DataFrame:
    """``(term, value)`` rows: the intercept and one row per feature slot."""
    rows = [("intercept", float(model.intercept))]
    rows += [(n, float(v)) for n, v in zip(feature_names, model.coefficients.toArray())]
    return spark.createDataFrame(rows, "term string, value double")


def regression_metrics(predictions: DataFrame, label: str,
                       prediction: str = DEFAULT_PREDICTION) -> DataFrame:
    """One row: ``n, rmse, mse, mae, r2, var`` from a single aggregate.

    r2 = 1 - SSE/SST and var = mean((p - mean(y))^2), as RegressionEvaluator
    defines them. Variances come from Spark's stable one-pass moments, so
    no sum-of-squares cancellation at large n.
    """
    y = F.col(f"`{label}`").cast("double")
    p = F.col(f"`{prediction}`").cast("double")
    e = p - y
    agg = predictions.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(e * e).alias("mse"),
        F.avg(F.abs(e)).alias("mae"),
        F.var_pop(y).alias("_var_y"),
        F.avg(y).alias("_mean_y"),
        F.var_pop(p).alias("_var_p"),
        F.avg(p).alias("_mean_p"),
    )
    return agg.select(
        "n",
        F.sqrt("mse").alias("rmse"),
        "mse",
        "mae",
        (F.lit(1.0) - F.try_divide(F.col("mse"), F.col("_var_y"))).alias("r2"),
        (F.col("_var_p") + (F.col("_mean_p") - F.col("_mean_y")) ** 2).alias("var"),
    )


def evaluate(predictions: DataFrame, label: str, prediction: str = DEFAULT_PREDICTION,
             metric: str = "rmse") -> float:
    """Spark's own evaluator (used to cross-check ``regression_metrics``)."""
    return RegressionEvaluator(labelCol=label, predictionCol=prediction,
                               metricName=metric).evaluate(predictions)


def grid_search(train: DataFrame, label: str, features: str = "features", *,
                reg_params: Sequence[float] = GRID_REG_PARAMS,
                elastic_net: Sequence[float] = GRID_ELASTIC_NET,
                num_folds: int = 3, fold_col: str | None = None, seed: int = 123,
                parallelism: int = 2, prediction: str = DEFAULT_PREDICTION,
                stage: bool = True, keep_models: bool = False):
    """3-fold CV of linear regression over regParam x elasticNetParam on RMSE.

    Runs on the training side only. With ``fold_col`` (e.g. from
    ``split.fold_column``) the folds are deterministic; ``parallelism``
    fits several grid points at once. ``stage`` first writes the model input
    (features, label, fold) to the shared staging folder: every fold and
    every solver iteration then reads that table instead of re-deriving the
    features through the whole upstream plan, and the lineage is cut; the
    staged table is removed after fitting (with ``stage=False`` the best
    model's training summary can still read its input). ``keep_models`` keeps every
    fold's fits in ``cv_model.subModels`` (coefficients only). Returns
    ``(cv_model, table)`` where table is ``(regParam, elasticNetParam,
    avg_rmse, is_best)``; of ties the first grid point is the best.
    """
    # each fold's sides are cached: only with the columns that the fits read
    train = train.select(features, label, *([fold_col] if fold_col else []))
    if stage:
        train, path = materialize_at(train, "cv-input", ROWS_PER_FILE)
    lr = LinearRegression(featuresCol=features, labelCol=label, predictionCol=prediction)
    grid = (ParamGridBuilder().addGrid(lr.regParam, list(reg_params))
            .addGrid(lr.elasticNetParam, list(elastic_net)).build())
    evaluator = RegressionEvaluator(labelCol=label, predictionCol=prediction,
                                    metricName="rmse")
    kwargs = dict(estimator=lr, estimatorParamMaps=grid, evaluator=evaluator,
                  numFolds=num_folds, seed=seed, parallelism=parallelism,
                  collectSubModels=keep_models)
    if fold_col:
        kwargs["foldCol"] = fold_col
    spark = train.sparkSession
    try:
        cv_model = CrossValidator(**kwargs).fit(train)
    finally:
        if stage:
            remove_staged(spark, path)
    best = min(range(len(grid)), key=lambda i: cv_model.avgMetrics[i])
    rows = [(float(pm[lr.regParam]), float(pm[lr.elasticNetParam]), float(m), i == best)
            for i, (pm, m) in enumerate(zip(grid, cv_model.avgMetrics))]
    table = spark.createDataFrame(
        rows, "regParam double, elasticNetParam double, avg_rmse double, is_best boolean")
    return cv_model, table
