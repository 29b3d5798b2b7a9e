"""Fitted pipelines on the shared storage, and the proof that they came back whole."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import staging_path


def save_model(spark: SparkSession, model: PipelineModel, path: str | None = None, *,
               overwrite: bool = False) -> str:
    """Store a fitted pipeline under ``path`` (a fresh folder of the staging root); returns the
    path. An existing model stays unless ``overwrite``."""
    path = path or staging_path(spark, "model")
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_both(df: DataFrame, first: PipelineModel, second: PipelineModel, key: str,
               prediction: str = "prediction") -> DataFrame:
    """``(key, first, second)``: both models' predictions of the same rows in one pass, without a
    join; what a stage adds is dropped before the other model adds it again."""
    once = first.transform(df).select(*[F.col(f"`{c}`") for c in df.columns],
                                      F.col(prediction).alias("_first"))
    return second.transform(once).select(F.col(f"`{key}`").alias("key"), F.col("_first").alias(
        "first"), F.col(prediction).alias("second"))


def differing_rows(scored: DataFrame) -> DataFrame:
    """``(n_rows, n_differing, n_null)``: rows whose two predictions are not the same bits."""
    return scored.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.count_if(~F.col("first").eqNullSafe(F.col("second"))).alias("n_differing"),
                      F.count_if(F.col("first").isNull()).alias("n_null"))
