"""The forest that is grown from staged bins: its draws, its sums and its model."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import functions as F

from contrail.operators import binned_forest, models
from contrail.operators.binned_forest import bundles, poisson_draws, thresholds

FEATURES = ["a", "b", "h0", "h1", "h2", "rare"]


@pytest.fixture()
def points(spark):
    """6,000 rows: two numbers, a one-hot vector's slots, and a flag that sometimes joins h0."""
    h = lambda i, m: F.pmod(F.xxhash64(F.lit(i), "id"), F.lit(m))
    df = spark.range(0, 6000, 1, 3).select(
        "id", h(1, 40).alias("a"), h(2, 1000).alias("b"), h(3, 4).alias("c"),
        (h(4, 50) == 0).cast("double").alias("rare"))
    df = df.select("*", *[(F.col("c") == i).cast("double").alias(f"h{i}") for i in range(3)])
    df = df.withColumn("y", 1e6 + F.col("a") + 20 * F.col("h1") + 15 * F.col("rare")
                       + F.when(F.col("b") > 300, 30).otherwise(0) + h(5, 7) / 7)
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)


def test_thresholds():
    assert thresholds(np.array([3.0, 1.0, 1.0, 8.0])).tolist() == [2.0, 5.5]
    assert len(thresholds(np.array([4.0, 4.0]))) == 0
    many = thresholds(np.arange(1000.0))
    assert len(many) == 31 and abs(np.diff(many) - 31.25).max() < 1.0


def test_features_that_meet_share_no_byte():
    x = np.array([[1, 0, 0], [0, 1, 0], [0, 0, 0], [0, 1, 1.0]])
    cuts = [np.array([0.5])] * 3
    assert [g.members for g in bundles(x, cuts)] == [[0, 1], [2]]
    assert [g.members for g in bundles(x, cuts, {0})] == [[0], [1], [2]]


def test_draws_are_poisson_and_their_own_for_each_tree():
    drawn = poisson_draws(123)()(np.arange(200_000))
    first, second = drawn(0).astype(float), drawn(1).astype(float)
    for k, share in enumerate([0.36788, 0.36788, 0.18394, 0.06131, 0.01533, 0.00307]):
        assert abs((first == k).mean() - share) < 0.004
    assert first.max() >= 6 and abs(first.var() - 1) < 0.02
    assert abs(np.corrcoef(first, second)[0, 1]) < 0.01
    assert (poisson_draws(123)()(np.arange(100, 200))(0) == first[100:200]).all()
    assert (poisson_draws(124)()(np.arange(200_000))(0) != first).any()


def _walk(node, x, w, y, cuts, shift, seen):
    """Each node's sums, and that no allowed split of its feature is better."""
    at = w.sum(), (w * (y - shift)).sum(), (w * (y - shift) ** 2).sum()
    assert np.allclose((node.n, node.s, node.q), at, rtol=1e-9, atol=1e-6)
    seen.append(node)
    if node.children:
        def gain(j, cut):
            left = x[:, j] <= cut
            parts = [(w[s].sum(), (w[s] * (y[s] - shift)).sum()) for s in (left, ~left)]
            if min(n for n, _ in parts) < 1:
                return -1.0
            return (sum(s * s / n for n, s in parts) - at[1] ** 2 / at[0]) / at[0]
        gains = [gain(node.feature, c) for c in cuts[node.feature]]
        cut = cuts[node.feature][0 if len(gains) == 1 else node.bin]
        assert np.isclose(node.gain, max(gains), rtol=1e-6)
        left = x[:, node.feature] <= cut
        for child, side in zip(node.children, (left, ~left), strict=True):
            _walk(child, x[side], w[side], y[side], cuts, shift, seen)


@pytest.mark.parametrize("split_rows", [10_000, 40])
def test_every_row_is_in_every_trees_sums(spark, points, monkeypatch, split_rows):
    """Recomputed row by row; with a sample of 40 rows, bytes are shared that later clash."""
    monkeypatch.setattr(binned_forest, "SPLIT_ROWS", split_rows)
    monkeypatch.setattr(binned_forest, "BLOCK_ROWS", 700)
    kept = []
    real = binned_forest.materialize_at
    monkeypatch.setattr(binned_forest, "materialize_at",
                        lambda df, *a: kept.append(real(df.cache(), *a)) or kept[-1])
    monkeypatch.setattr(binned_forest, "remove_staged", lambda *a: None)
    trees, cuts, shift, n = binned_forest.grow(points, "y", "features", 6000, 6, 5)
    assert n == 6
    assert kept[-1][0].agg(F.max("n")).first()[0] <= 700
    ids = [r.first + i for r in kept[-1][0].select("first", "n").collect() for i in range(r.n)]
    assert len(set(ids)) == 6000
    # a row's number is its task and its place in it
    rows = {(p << 33) + i: r for p, part in enumerate(points.select("features", "y").rdd.glom()
                                                      .collect()) for i, r in enumerate(part)}
    x = np.array([rows[i].features.toArray() for i in ids])
    y = np.array([rows[i].y for i in ids])
    drawn = poisson_draws(5)()(np.array(ids))
    for t, root in enumerate(trees):
        seen = []
        _walk(root, x, drawn(t).astype(float), y, cuts, shift, seen)
        assert len(seen) > 9


def test_clashing_features_get_bytes_of_their_own(spark, points, monkeypatch):
    staged = []
    real = binned_forest._stage
    monkeypatch.setattr(binned_forest, "_stage",
                        lambda rows, groups, *a: staged.append([g.members for g in groups])
                        or real(rows, groups, *a))
    monkeypatch.setattr(binned_forest, "bundles", lambda x, cuts, apart=frozenset(): bundles(
        x * (np.arange(6) != 5), cuts, apart))
    binned_forest.grow(points, "y", "features", 6000, 2, 5)
    assert staged == [[[0], [1], [2, 3, 4, 5]], [[0], [1], [2], [3], [4], [5]]]


def test_beyond_memory_the_forest_is_grown_from_bins(spark, points, monkeypatch, tmp_path):
    by_spark = models.fit_forest(points, "y", num_trees=60, prediction="p")
    monkeypatch.setattr(models, "FOREST_CACHE_BYTES", 0)
    monkeypatch.setattr(models.RandomForestRegressor, "fit", None)
    own = models.fit_forest(points, "y", num_trees=60, prediction="p")
    assert isinstance(own, RandomForestRegressionModel) and own.getNumTrees == 60
    a, b = (models.regression_metrics(m.transform(points), "y", "p").first()
            for m in (by_spark, own))
    assert a.n == b.n == 6000 and abs(a.r2 - b.r2) < 0.05 and b.r2 > 0.7
    assert max(abs(own.featureImportances.toArray()
                   - by_spark.featureImportances.toArray())) < 0.1
    own.write().overwrite().save(str(tmp_path / "forest"))
    again = RandomForestRegressionModel.load(str(tmp_path / "forest"))
    assert again.transform(points).select("p").collect() == own.transform(
        points).select("p").collect()


def test_labels_that_are_no_numbers_are_refused(spark, points):
    bad = points.withColumn("y", F.when(F.col("id") != 5000, F.col("y")))
    with pytest.raises(Exception, match="must not be NULL"):
        binned_forest.grow(bad, "y", "features", 6000, 2, 5)


def test_too_many_features_are_left_to_spark(points, monkeypatch):
    monkeypatch.setattr(binned_forest, "MAX_FEATURES", 5)
    assert binned_forest.grow(points, "y", "features", 6000, 2, 5) is None
    monkeypatch.setattr(models, "FOREST_CACHE_BYTES", 0)
    assert models.fit_forest(points, "y", num_trees=2).getNumTrees == 2


def test_without_a_staging_folder_the_forest_is_sparks(points, monkeypatch):
    def none(spark):
        raise RuntimeError("spark.checkpoint.dir is not set")
    monkeypatch.setattr(binned_forest, "staging_root", none)
    monkeypatch.setattr(models, "FOREST_CACHE_BYTES", 0)
    assert models.fit_forest(points, "y", num_trees=2).getNumTrees == 2


def test_flow_stages_the_features_of_many_rows_once(spark, flights_csv, monkeypatch):
    from contrail.plans import flows
    from contrail.plans.config import PipelineConfig
    from contrail.sources import scan_csv
    cfg = PipelineConfig(split_key=("Month", "DepTime", "Distance"), forest_trees=5)
    few = flows.run_categorical(scan_csv(spark, flights_csv), cfg)
    assert "staged_features" not in few.report
    monkeypatch.setattr(flows, "STAGE_FEATURE_ROWS", 0)
    monkeypatch.setattr(models, "FOREST_CACHE_BYTES", 0)
    many = flows.run_categorical(scan_csv(spark, flights_csv), cfg)
    files = many.encoded.inputFiles()
    assert files and all(many.report["staged_features"] in f for f in files)
    a, b = ({r.model: r for r in m.metrics.collect()} for m in (few, many))
    assert a["linear"].n == b["linear"].n == b["forest"].n
    assert abs(a["linear"].rmse - b["linear"].rmse) < 1e-6
    assert b["forest"].r2 > 0.3
    assert many.encoded.schema["features"].metadata == few.encoded.schema["features"].metadata
