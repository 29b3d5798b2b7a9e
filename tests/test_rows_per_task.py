"""Rows that one task reads are bounded, whatever few bytes Parquet packs them to."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from contrail.operators import models
from contrail.operators.sizing import at_most_rows
from contrail.plans import flows
from contrail.plans.config import TRIPS_CONFIG
from contrail.plans.queries import QUERIES
from contrail.session import materialize, staged_paths
from contrail.sources.tables import trips_text
from tests.conftest import SF_SMALL


def most_rows(spark, path):
    files = spark.read.parquet(path).groupBy(F.input_file_name()).count()
    return files.agg(F.max("count")).first()[0]


@pytest.fixture()
def points(spark):
    df = spark.range(0, 300, 1, 1).select((F.col("id") % 10).cast("double").alias("x"),
                                          F.col("id").cast("string").alias("key"))
    df = df.withColumn("y", 2.0 * F.col("x")).withColumn("fold", (F.col("key") % 3).cast("int"))
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(df)


def test_staged_files_hold_bounded_rows(spark):
    with staged_paths() as paths:
        df = materialize(spark.range(0, 1000, 1, 1), "bounded", 100)
    assert df.count() == 1000 and most_rows(spark, paths[0]) == 100


def test_rows_are_dealt_only_beyond_the_bound(spark):
    df = spark.range(0, 1000, 1, 1)
    assert at_most_rows(df, 1000) is df
    dealt = at_most_rows(df, 100)
    assert dealt.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] <= 110
    assert sorted(r[0] for r in dealt.collect()) == list(range(1000))
    none = spark.createDataFrame([], "a int")
    assert at_most_rows(none, 5) is none


def test_forest_trains_on_bounded_partitions(spark, points, monkeypatch):
    seen = []
    real = models.RandomForestRegressor.fit
    monkeypatch.setattr(models.RandomForestRegressor, "fit",
                        lambda self, df: seen.append(df) or real(self, df))
    models.fit_forest(points, "y", num_trees=2)
    monkeypatch.setattr(models, "FOREST_ROWS", 30)
    models.fit_forest(points, "y", num_trees=2)
    assert [df.columns for df in seen] == [["features", "y"]] * 2
    assert seen[0].rdd.getNumPartitions() == 1 and seen[1].rdd.getNumPartitions() == 10
    assert seen[1].count() == 300


def test_grid_search_caches_only_what_the_fits_read(spark, points, monkeypatch):
    seen = []
    real = models.CrossValidator.fit
    monkeypatch.setattr(models.CrossValidator, "fit",
                        lambda self, df: seen.append(df.columns) or real(self, df))
    models.grid_search(points, "y", fold_col="fold", reg_params=(0.1,), elastic_net=(0.0,),
                       stage=False)
    assert seen == [["features", "y", "fold"]]


def test_flow_stages_bounded_files(spark, monkeypatch):
    monkeypatch.setattr(flows, "ROWS_PER_FILE", 200)
    res = flows.run_categorical(trips_text(spark, SF_SMALL), TRIPS_CONFIG.with_(models=()))
    paths = res.report["staged_paths"]
    assert len(paths) == 2 and all(most_rows(spark, p) <= 200 for p in paths)


@pytest.mark.parametrize("name", ["distinct_sketch", "string_index_table"])
def test_joins_run_once(spark, name):
    files = QUERIES[name](spark, SF_SMALL).inputFiles()
    assert files and not [f for f in files if "lineitem" in f]
